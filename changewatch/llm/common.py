"""What the operators share: the shared folder, batches of texts, the order of ids."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import warnings
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir`` of the session. Only
    where it is unset, as in tests, a folder of this machine is set."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        warnings.warn("spark.checkpoint.dir is unset; intermediate tables go to this machine", stacklevel=2)
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        folder = context.getCheckpointDir()
    return folder


#: While a table is written its shuffle files go when it is done, and rows reach Python in batches of some MB, for texts of any usual length.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
_open: list[list[str]] = []  # the tables of each scope that is open, the innermost last
_left: dict[str, list[str]] = {}  # by application, what the last stage's result may still read


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder, read back. It cuts the lineage, survives lost executors and is
    computed once however often it is read. Its shuffle files go as soon as it is written. Inside of ``scratch`` the table goes
    with that scope, or with the next outer one if it is to ``keep``; others go with the application's checkpoint folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    before = {name: spark.conf.get(name) for name in WHILE_WRITING}
    try:
        for name, value in WHILE_WRITING.items():
            spark.conf.set(name, value)
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    if scopes := _open[:-1] if keep else _open:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


FEWEST, ROWS = 8, 200_000  # tasks at least, and narrow rows of a task


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, narrow and of about so many rows, in tasks of some ROWS each and FEWEST at least. Of a small table each round of a loop
    would else cost one task and one file for every partition of a shuffle. It never takes more tasks than there are partitions."""
    return df.coalesce(max(FEWEST, rows // ROWS))


def removed(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end, but for those to keep. Nothing lazy that reads them may leave."""
    _open.append([])
    try:
        yield
    finally:
        removed(spark, _open.pop())


@contextmanager
def stage_tables(spark: SparkSession, docs: DataFrame) -> Iterator[None]:
    """For a stage of a pipeline, whose lazy result is written and read again before the next stage: first removes what the stage
    before has left, unless ``docs`` reads it still, as where its result was handed on unwritten."""
    application = spark.sparkContext.applicationId
    left, read = _left.pop(application, []), docs.inputFiles()
    used = [path for path in left if any(path.split(":", 1)[-1].lstrip("/") in file for file in read)]
    removed(spark, [path for path in left if path not in used])
    _open.append([])
    try:
        yield
    finally:
        _left[application] = used + _open.pop()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once for an application; they need not have it installed."""
    package = Path(__file__).resolve().parents[1]
    application = spark.sparkContext.applicationId
    if application in _shipped or not package.is_dir():
        return
    handle, name = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for module in sorted(package.rglob("*.py")):
            archive.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(name)
    _shipped.add(application)


_held: list[Callable] = []


def held(function: Callable) -> Callable:
    """For what a worker makes once and uses for all its tasks, as a tokenizer with the words that it has met: the results are kept until
    the worker's next task of another operator, see ``tidy``."""
    cached = lru_cache(maxsize=2)(function)
    _held.append(cached)
    return cached


def tidy(keep: Callable | None = None) -> None:
    """Give memory of finished work back to the system, and large blocks from now on as soon as they are free. Workers are
    used again by later tasks, and what the allocators keep of earlier ones would add up beside what the task at hand needs. So would
    what earlier operators hold, of which only that of ``keep`` stays."""
    for cached in _held:
        if cached is not keep:
            cached.cache_clear()
    pa.default_memory_pool().release_unused()
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        library = ctypes.CDLL(None)
        library.mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD: larger blocks are mapped, and unmapped when freed
        library.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD
        library.malloc_trim(0)
    except (OSError, AttributeError):  # another C library; nothing depends on it
        pass


def mapped(df: DataFrame, function: Callable, schema: str, keep: Callable | None = None) -> DataFrame:
    """``mapInArrow`` with the package at the workers. ``keep`` is what ``function`` has ``held``."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(keep)
        yield from function(batches)
        tidy(keep)

    return df.mapInArrow(run, schema)


def quoted(name: str) -> Column:
    """A column whose name may have dots and marks in it."""
    return F.col(f"`{name.replace('`', '``')}`")


def text_of(column: str) -> Column:
    """A text column, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with their texts, each run of at most ``most_bytes`` or one row."""
    for batch in batches:
        column = batch.column(text)
        texts = column.to_pylist()
        start = size = 0
        for i, value in enumerate(texts):
            if size and size + len(value) > most_bytes:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(value) + 1
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column."""
    return df.agg(F.sum(F.octet_length(text_of(column)))).head()[0] or 0


def with_next(ids: DataFrame, key: str, name: str, parts: int = 200) -> DataFrame:
    """Distinct non-null whole-number ids with the next larger one; the largest has the smallest as its next.

    The ids are cut into ranges at approximate quantiles, so that no task sorts them all; the successor of
    the last id of a range is the first of the next range, from a table of one row per range."""
    ids = ids.select(F.col(key).cast("long").alias(key)).where(F.col(key).isNotNull()).distinct()
    cuts = ids.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10000)).head()[0]
    cuts = sorted(set(cuts or []))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda cut: cut < F.col(key)))
    dealt = ids.withColumn("part", part)
    firsts = dealt.groupBy("part").agg(F.min(key).alias("first"))
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    everywhere = Window.partitionBy(F.lit(0))
    following = firsts.select("part", F.coalesce(
        F.lead("first").over(order), F.min("first").over(everywhere)).alias("following"))
    inside = Window.partitionBy("part").orderBy(key)
    return (dealt.withColumn(name, F.lead(key).over(inside))
            .join(F.broadcast(following), "part")  # at most `parts` rows
            .select(key, F.coalesce(name, "following").alias(name)))
