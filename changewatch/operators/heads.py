"""The first rows of every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def head_by_key(df: DataFrame, key: str, order: list[Column], rows: int,
                parts: int = 64) -> DataFrame:
    """The first ``rows`` rows of each key, with their ``position``.

    Ranked twice: first within a key and a part of it, then among the survivors, of which there are
    at most ``parts * rows`` per key. A key that holds a large share of all rows is thus spread over
    ``parts`` tasks; before each shuffle Spark also cuts every group of a task to ``rows``.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    inner = Window.partitionBy(key, "part").orderBy(*order)
    outer = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("part", part)
        .withColumn("position", F.row_number().over(inner)).filter(F.col("position") <= rows)
        .drop("part", "position")
        .withColumn("position", F.row_number().over(outer)).filter(F.col("position") <= rows)
    )
