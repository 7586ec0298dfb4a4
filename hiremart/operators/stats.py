"""Benchmark queries and duration statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str) -> DataFrame:
    """``(table_name, row_count)`` for one table."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """B1-B3 for several tables at once (one row each)."""
    out = None
    for name, df in tables.items():
        r = row_count(df, name)
        out = r if out is None else out.unionByName(r)
    return out


def count_by(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Rows per value of a column; NULL is a group."""
    return (df.groupBy(F.col(col).alias(alias or col))
            .agg(F.count(F.lit(1)).cast("long").alias("cnt")))


def count_by_path(df: DataFrame, json_path: str, alias: str, raw_col: str = "raw") -> DataFrame:
    """Rows per value at a path inside a JSON document column."""
    return (df.groupBy(F.get_json_object(raw_col, json_path).alias(alias))
            .agg(F.count(F.lit(1)).cast("long").alias("cnt")))


def duration_stats(df: DataFrame, keys: Sequence[str], value: str, scale: float = 1000.0) -> DataFrame:
    """Per group ``runs, min_ms, avg_ms, max_ms, std_ms`` of a duration in seconds.

    ``std_ms`` is the *population* standard deviation, 0.0 for a single run.
    """
    v = F.col(value).cast("double") * F.lit(scale)
    n = F.count(v)
    return (df.groupBy(*keys)
            .agg(n.cast("long").alias("runs"),
                 F.min(v).alias("min_ms"),
                 F.avg(v).alias("avg_ms"),
                 F.max(v).alias("max_ms"),
                 F.when(n > 1, F.stddev_pop(v)).otherwise(F.lit(0.0)).alias("std_ms")))


def mean_of_means(df: DataFrame, key: str, value: str) -> DataFrame:
    """The mean of per-item means for each ``key`` (e.g. engine)."""
    return (df.groupBy(key)
            .agg(F.avg(value).alias("mean_of_means"),
                 F.count(F.lit(1)).cast("long").alias("n_items")))
