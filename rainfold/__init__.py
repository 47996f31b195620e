"""rainfold: tabular learning and forecasting as Spark DataFrame operators.

Sub-packages: ``sources`` (CSV, zipped CSV, JSON payloads, model tables),
``operators`` (relational, sampling, features, classify, metrics,
timeseries, serving), ``functions`` (key hashing), ``streaming`` (request
answering) and ``plans`` (registered queries with their DuckDB oracles).
"""

__version__ = "0.1.0"
