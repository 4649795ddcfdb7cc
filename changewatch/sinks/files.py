"""Tab-separated and text output.

Folders are overwritten as a whole, so files of keys that no longer occur go away with them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changewatch.functions.actions import action_map
from changewatch.operators.heads import head_by_key


def _tsv(df: DataFrame):
    return df.write.mode("overwrite").option("sep", "\t").option("header", True)


def write_table(df: DataFrame, path: str) -> None:
    _tsv(df).csv(path)


def write_report(df: DataFrame, folder: str, order: list[Column], head_rows: int = 50) -> None:
    """The whole report, sorted, under ``full`` and its first rows under ``head``. Both read ``df``; give it a stored
    table where it is dear."""
    _tsv(df.orderBy(*order)).csv(f"{folder}/full")
    _tsv(df.orderBy(*order).limit(head_rows).coalesce(1)).csv(f"{folder}/head")


def write_keyed_report(df: DataFrame, folder: str, key: str, order: list[Column],
                       head_rows: int = 50) -> None:
    """One folder per key under ``full``, and one with the first rows of the key under ``head``.

    Both are single writes, however many keys there are. Rows are brought together by key with a
    rebalance, which splits keys that are too large for one task and merges small ones.
    """
    def write(rows: DataFrame, path: str, *sort: Column) -> None:
        (_tsv(rows.hint("rebalance", F.col(key)).sortWithinPartitions(key, *sort))
         .option("partitionOverwriteMode", "static").partitionBy(key).csv(path))

    write(df, f"{folder}/full", *order)
    write(head_by_key(df, key, order, head_rows), f"{folder}/head", F.col("position"))


def write_progress(df: DataFrame, folder: str) -> None:
    """The sentence of a progress row, and its raw numbers."""
    df.select("sentence").coalesce(1).write.mode("overwrite").text(f"{folder}/sentence")
    raw = F.concat_ws("\t", F.col("patrolled").cast("string"), F.col("total").cast("string"))
    df.select(raw.alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/raw")


def write_action_map(spark: SparkSession, folder: str) -> None:
    """``category<TAB>a, b, c`` lines in map order."""
    line = F.concat("category", F.lit("\t"), "actions")
    action_map(spark).coalesce(1).sortWithinPartitions("position") \
        .select(line.alias("value")).write.mode("overwrite").text(folder)


def write_last_update(spark: SparkSession, as_of: datetime, folder: str) -> None:
    """The run's time in epoch seconds (UTC)."""
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))
    spark.range(1).select(epoch.cast("string").alias("value")).coalesce(1) \
        .write.mode("overwrite").text(folder)
