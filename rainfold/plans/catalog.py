"""All registered queries (importing the plan modules fills the registry)."""

from __future__ import annotations

from . import q_io, q_learning, q_sampling, q_serving, q_streaming, q_timeseries, q_weather  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
