"""Readers. Each gives one DataFrame per source table; ``Tables`` hands them out by name."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changewatch.sources.schemas import TABLES, conform, schema_of


class Tables:
    """Source tables by name, read when first asked for."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._seen: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(f"unknown source table: {name}")
        if name not in self._seen:
            self._seen[name] = conform(self._load(name), name)
        return self._seen[name]

    def replaced(self, others: dict[str, Callable[[], DataFrame]]) -> Tables:
        """These tables with some taken from elsewhere, such as namespaces from a JSON file."""
        return Tables(lambda name: others[name]() if name in others else self[name])


def from_parquet(spark: SparkSession, folder: str) -> Tables:
    """One Parquet folder per table, ``folder/<table>``."""
    return Tables(lambda name: spark.read.parquet(f"{folder}/{name}"))


# Numeric key that a table is split on for parallel reads.
SPLIT_KEYS = {
    "recentchanges": "rc_id", "actor": "actor_id", "comment": "comment_id",
    "change_tag": "ct_id", "score": "oresc_rev", "logging": "log_id", "block_target": "bt_id",
    "block": "bl_target", "revtag": "rt_revision", "page": "page_id",
}


def jdbc_options(table: str, bounds: tuple[int, int] | None, partitions: int) -> dict[str, str]:
    """Reader options that split a table on its key; Spark pushes filters and columns down."""
    options = {"fetchsize": "10000", "pushDownPredicate": "true"}
    if bounds is not None and table in SPLIT_KEYS:
        options |= {"partitionColumn": SPLIT_KEYS[table], "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options


def from_jdbc(spark: SparkSession, url: str, properties: dict[str, str],
              bounds: dict[str, tuple[int, int]] | None = None, partitions: int = 64,
              names: dict[str, str] | None = None) -> Tables:
    """Tables of a SQL database. ``bounds`` gives the key range of the tables to read in parallel,
    ``names`` the database's name of a table where it differs from ours. A table that has a key to split on
    but no bounds comes through one connection into one task, with a warning."""
    def load(name: str) -> DataFrame:
        if name in SPLIT_KEYS and name not in (bounds or {}):
            warnings.warn(f"{name} is read by one task; give bounds of {SPLIT_KEYS[name]}", stacklevel=2)
        reader = spark.read.format("jdbc").options(
            url=url, dbtable=(names or {}).get(name, name), **properties)
        return reader.options(**jdbc_options(name, (bounds or {}).get(name), partitions)).load()

    return Tables(load)


def read_entity_usage(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated item usage counts with a header line, plain or gzip. A gzip file cannot be
    split, so it is read by one task; ``repartition`` follows for whatever comes next."""
    return (
        spark.read.option("sep", "\t").option("header", True).option("enforceSchema", True)
        .schema(schema_of("entity_usage")).csv(path)
        .repartition("qid")
    )


def read_namespaces(spark: SparkSession, path: str) -> DataFrame:
    """Namespace names from the site-info answer of a wiki's web API, saved as JSON:
    ``{"query": {"namespaces": {"0": {"id": 0, "name": ""}, ..}}}``."""
    schema = "query struct<namespaces: map<string, struct<name: string>>>"
    return (
        spark.read.schema(schema).option("multiLine", True).json(path)
        .select(F.explode("query.namespaces").alias("id", "data"))
        .select(F.col("id").cast("int").alias("id"), F.col("data.name").alias("name"))
    )


def read_request_links(spark: SparkSession, path: str) -> DataFrame:
    """Titles linked from a page, from the link list of a wiki's web API, saved as JSON:
    ``{"query": {"pages": {"7": {"links": [{"ns": 0, "title": "Q1"}, ..]}}}}``."""
    schema = "query struct<pages: map<string, struct<links: array<struct<title: string>>>>>"
    return (
        spark.read.schema(schema).option("multiLine", True).json(path)
        .select(F.explode("query.pages").alias("page_id", "page"))
        .select(F.explode("page.links").alias("link"))
        .select(F.col("link.title").alias("title"))
    )
