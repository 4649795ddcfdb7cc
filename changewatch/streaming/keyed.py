"""Keyed reports kept up to date from a stream of changes: each batch replaces the keys that it touches, and no other.

A report holds the open changes of each key. A batch brings changes as they are now; it may be done again after a failure, or come twice, and
leaves the same report: a row of it takes the place of the row with its id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


class KeyedReport:
    """Rows of a report below ``path``: the open ones in ``is_open=true``, a folder for each key, and others, as marks of what has been closed, in
    ``is_open=false``. ``schema`` is that of the rows, key, ``ident`` and ``version`` included; the version orders the states of a row, as an
    update may come before what it updates."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, ident: str, version: str):
        self.spark, self.key, self.ident, self.version = spark, key, ident, version
        self.stored = StructType([f for f in schema.fields if f.name != key]).add("is_open", "boolean").add(schema[key])
        self.full, self.staging = f"{path.rstrip('/')}/full", f"{path.rstrip('/')}/staging"

    def _path(self, name: str, uri: bool = False):
        """A path, and the file system that it is in."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(name) if uri else name)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def rows(self, keys: list | None = None) -> DataFrame:
        """All rows with ``is_open``, or those of some keys, of which alone the folders are read."""
        system, path = self._path(self.full)
        if not system.exists(path):
            return self.spark.createDataFrame([], self.stored)
        found = self.spark.read.schema(self.stored).parquet(self.full)
        return found if keys is None else found.filter(F.col(self.key).isin(keys))

    def report(self) -> DataFrame:
        return self.rows().filter("is_open").drop("is_open")

    def replace(self, batch: DataFrame, number: int) -> None:
        """Bring the report up to ``batch``: rows like those of the report, with ``is_open``. Only folders of its keys are read and written, and
        those that are left without rows go. Rows without a key are left out.

        The new state of the keys is written beside the report first, so that no folder is overwritten from itself. A batch that broke off is
        done again from what the report is then: only rows of the batch move, and it brings them again."""
        batch = batch.filter(F.col(self.key).isNotNull()).select(*self.stored.names)
        keys = [row[0] for row in batch.select(self.key).distinct().collect()]  # a folder each
        if not keys:
            return
        staged = f"{self.staging}/batch={number}"
        latest = Window.partitionBy(self.key, self.ident).orderBy(F.desc(self.version), "is_open")
        before = self.rows(keys)
        before.unionByName(batch).withColumn("_place", F.row_number().over(latest)).filter("_place = 1").drop("_place") \
            .write.mode("overwrite").parquet(staged)
        merged = self.spark.read.schema(self.stored).parquet(staged)
        places = merged.select("is_open", self.key).distinct()
        emptied = []
        if before.inputFiles():
            emptied = before.select("is_open", self.key, F.col("_metadata.file_path").alias("file")) \
                .join(places, ["is_open", self.key], "left_anti").select("file").distinct().collect()
        merged.hint("rebalance", F.col(self.key)).sortWithinPartitions("is_open", self.key, self.ident).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("is_open", self.key).parquet(self.full)
        for row in emptied:
            system, path = self._path(row.file, uri=True)
            system.delete(path.getParent(), True)
        system, path = self._path(staged)
        system.delete(path, True)


def follow(changes: DataFrame, report: Callable[[DataFrame], DataFrame], into: KeyedReport, state: str,
           every: str | None = None) -> StreamingQuery:
    """Keep a report up to date with a stream of changes. ``report`` gives the rows of a batch, with ``is_open``; ``state`` is the folder of the
    stream's progress, shared by all machines."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return changes.writeStream.foreachBatch(lambda batch, number: into.replace(report(batch), number)) \
        .option("checkpointLocation", state).trigger(**trigger).start()
