"""Source tables stored so that later reads cost less: by day, or bucketed by change.

Tables stored by day have a folder for each day of their 14-digit time. A bound on that time, a literal or one that is itself found in
data, then also bounds the folders that are read. Tables bucketed by change are joined without a shuffle.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changewatch.operators import enrich
from changewatch.sources import queries
from changewatch.sources.readers import Tables
from changewatch.sources.schemas import TABLES

#: The time of the tables that are stored by day.
STAMPS = {"recentchanges": "rc_timestamp", "logging": "log_timestamp"}
DAY = "day"


def work_folder(spark: SparkSession) -> str:
    """A fresh folder that all machines see, below the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, as
    on one machine, it is a folder of this machine, with a warning."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        warnings.warn("spark.checkpoint.dir is unset; intermediate tables go to this machine", stacklevel=2)
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="changewatch-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def day_of(stamp: Column) -> Column:
    """The day of a 14-digit time. Days are in the order of times, so a bound on one is a bound on the other."""
    return F.substring(stamp, 1, 8)


def write_by_day(df: DataFrame, stamp: str, path: str) -> None:
    """One folder for each day. A day of very many rows is split among tasks, small ones share one; days that are there already
    and have rows in ``df`` are replaced, others stay."""
    (df.withColumn(DAY, day_of(F.col(stamp))).hint("rebalance", F.col(DAY)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path))


def store_by_day(tables: Tables, folder: str, names: list[str] | None = None) -> None:
    """Store the tables that have a time, or those named."""
    for name in names or STAMPS:
        write_by_day(tables[name], STAMPS[name], f"{folder}/{name}")


def read_by_day(spark: SparkSession, folder: str, name: str, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """A table stored by day, only the folders of days that can have times from ``low`` to ``high``. The bounds are 14-digit texts, or
    scalar subqueries that give one: those are evaluated first and then choose the folders. Rows of the days at either end are all there;
    a table without a folder for any of the days is empty."""
    df = spark.read.schema(f"{TABLES[name]}, {DAY} string").parquet(f"{folder}/{name}")
    if low is not None:
        df = df.filter(F.col(DAY) >= day_of(low))
    if high is not None:
        df = df.filter(F.col(DAY) <= day_of(high))
    return df


def bounded(spark: SparkSession, tables: Tables, folder: str, bounds: dict[str, tuple[Column | None, Column | None]]) -> Tables:
    """``tables`` with those named in ``bounds`` read from ``folder``, by day, between their bounds."""
    return tables.replaced({
        name: lambda n=name, b=between: read_by_day(spark, folder, n, *b) for name, between in bounds.items()})


def patrol_log(spark: SparkSession, tables: Tables, folder: str) -> DataFrame:
    """Patrol entries since the oldest change in scope, from tables stored by day. The oldest time is found in the changes; of the log
    only its days are read."""
    stored = bounded(spark, tables, folder, {"recentchanges": (None, None)})
    since = queries.main_namespace_changes(stored).agg(F.min("rc_timestamp")).scalar()
    return queries.patrol_log(bounded(spark, stored, folder, {"logging": (since, None)}), since)


# -- bucketed by change

class Colocated:
    """Changes with their editors, their flags, their scores and their comments, each bucketed and sorted by ``rc_id`` in as many
    buckets. What belongs to a change is brought to its bucket when it is stored, once; reports that join them again and again then
    read bucket by bucket, without a shuffle. New days are added with ``append``.

    Flags and scores have at most one row for a change, so joins keep the rows. Tables are named after ``prefix`` in the
    session's catalogue and lie in ``folder``."""

    PARTS = ("changes", "flags", "scores", "comments")

    def __init__(self, spark: SparkSession, folder: str, prefix: str, buckets: int):
        self.spark, self.folder, self.prefix, self.buckets = spark, folder, prefix, buckets

    def name(self, part: str) -> str:
        return f"{self.prefix}_{part}"

    def store(self, tables: Tables, append: bool = False) -> Colocated:
        changes = queries.main_namespace_changes(tables)
        ids = changes.select("rc_id", "rc_comment_id", queries.revision_key())
        scores = queries.revision_scores(tables)
        parts = {
            "changes": queries.with_editor(changes, tables).drop("rc_comment_id"),
            "flags": queries.change_flags(tables),
            "scores": ids.join(scores, F.col("revision") == F.col("oresc_rev")).select("rc_id", "oresc_damaging", "oresc_goodfaith"),
            "comments": queries.with_comment(ids.drop("revision"), tables),
        }
        for part, df in parts.items():
            # dealt like the buckets, so that a bucket is one file of each write
            (df.repartition(self.buckets, "rc_id").write.mode("append" if append else "overwrite").format("parquet")
             .bucketBy(self.buckets, "rc_id").sortBy("rc_id").option("path", f"{self.folder}/{part}").saveAsTable(self.name(part)))
        return self

    def changes(self) -> DataFrame:
        """The enriched changes, as ``enrich.changes`` gives them."""
        changes, flags, scores, comments = (self.spark.table(self.name(part)) for part in self.PARTS)
        joined = changes.join(flags, "rc_id", "left").join(scores, "rc_id", "left").join(comments, "rc_id")
        return enrich.finished(joined)

    def drop(self) -> None:
        for part in self.PARTS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(part)}")
