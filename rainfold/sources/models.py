"""Fitted forecast models as a table (the stand-in for pickled model objects).

A model row holds everything ``timeseries.forecast`` needs: order, constant,
mean, AR and MA coefficients, noise variance and the forecast start state.
Saving replaces the stored table; loading reads it back with its schema, so
a serving job can forecast without refitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import lagsums
from . import batches

MODEL_COLUMNS = ["series", "p", "d", "q", "const", "mu", "ar", "ma", "sigma2", "aic", "n", "zs", "es",
                 "y_last", "dy_last"]


def save_forecast_models(models: DataFrame, path: str) -> None:
    models.select(*MODEL_COLUMNS).write.mode("overwrite").parquet(path)


def load_states(spark: SparkSession, path: str) -> DataFrame:
    """The stored lag sums (``operators.lagsums``) after the last batch."""
    return batches.read(spark, path, batches.committed(spark, path)[-1])


def grow_states(spark: SparkSession, path: str, number: int, more: DataFrame) -> bool:
    """Add batch ``number`` (0, 1, …) of new rows ``(series, idx, y)`` to the stored
    lag sums; False if it was added before.

    Every batch writes the next version of the sums beside the others, so the last
    whole one can be read meanwhile.  Rows of earlier batches aren't read again.
    """
    done, name = batches.committed(spark, path), f"{number:08d}"
    if name in done:
        return False
    if number != len(done):
        raise ValueError(f"batch {number} can't follow {len(done)} batches")
    state = lagsums.extend(load_states(spark, path), more) if done else lagsums.summary(more)
    return batches.append(state, path, name)


def load_forecast_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*MODEL_COLUMNS)
