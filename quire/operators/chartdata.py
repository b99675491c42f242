"""Chart-ready data (the drawing itself is left to the caller's plotting tool)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.scalars import round_half_even, title_case

DEFAULT_METRICS = ("mean", "min", "max", "count")


def unpivot_metrics(df: DataFrame, id_col: str = "REGION",
                    metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """A12 / Q-H: wide statistics -> (id, Metric, Value, ValueRounded); metric
    names title-cased, values as DOUBLE, labels rounded to 1 decimal."""
    wide = df.select(id_col, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = wide.unpivot([id_col], list(metrics), "Metric", "Value")
    return long.select(id_col, title_case(F.col("Metric")).alias("Metric"), "Value",
                       round_half_even(F.col("Value"), 1).alias("ValueRounded"))


def line_series(df: DataFrame, x: str = "YEAR", y: str = "OCC_ABS",
                series: str = "geo") -> DataFrame:
    """Q-F: (x, y, series) points."""
    return df.select(x, y, series)


def bar_data(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Q-G: (x, y[, color], text) with the bar label equal to y."""
    cols = [x, y] + ([color] if color else [])
    return df.select(*cols, F.col(y).alias("text"))
