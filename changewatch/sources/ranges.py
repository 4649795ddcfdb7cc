"""Parallel reads of a database table with parts of equal size, whose bounds the table itself gives.

Equal steps between the smallest and the largest key make parts of very different size where keys have gaps or are bunched. Here the
database is asked for the quantiles of the key, which costs it one pass over the key's index and gives a row for each part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changewatch.sources.readers import SPLIT_KEYS, Tables


def quantile_query(table: str, key: str, parts: int) -> str:
    """SQL for the largest key of each of ``parts`` equal parts."""
    return (f"SELECT part, MAX(k) AS upper_key FROM (SELECT {key} AS k, NTILE({parts}) OVER (ORDER BY {key}) AS part "
            f"FROM {table} WHERE {key} IS NOT NULL) parts GROUP BY part")


def predicates(key: str, uppers: list[int]) -> list[str]:
    """Conditions that each row meets exactly one of, null keys the first. Equal bounds, of a key that fills several parts, count once;
    keys larger than all bounds, new since these were asked for, are in the last part."""
    bounds = sorted(set(uppers))[:-1]
    if not bounds:
        return ["1 = 1"]
    return [f"({key} <= {bounds[0]} OR {key} IS NULL)",
            *[f"({key} > {low} AND {key} <= {high})" for low, high in zip(bounds, bounds[1:])],
            f"{key} > {bounds[-1]}"]


def split_tables(ask: Callable[[str], DataFrame], read: Callable[[str, list[str] | None], DataFrame], parts: int,
                 names: dict[str, str] | None = None) -> Tables:
    """Tables read in ``parts``. ``ask`` runs SQL where the tables are, ``read`` gives a table by its name there, in a task for each of the
    predicates. Tables without a key to split on are read whole."""
    def load(name: str) -> DataFrame:
        there = (names or {}).get(name, name)
        if name not in SPLIT_KEYS:
            return read(there, None)
        key = SPLIT_KEYS[name]
        uppers = [row.upper_key for row in ask(quantile_query(there, key, parts)).select("upper_key").collect()]  # a row for each part
        return read(there, predicates(key, [int(upper) for upper in uppers]))

    return Tables(load)


def from_jdbc_split(spark: SparkSession, url: str, properties: dict[str, str], parts: int = 64, names: dict[str, str] | None = None) -> Tables:
    """Tables of a SQL database with NTILE (all current ones), each with a key in ``parts`` parts of equal size. No bounds have to be given."""
    def ask(sql: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, query=sql, **properties).load().toDF("part", "upper_key")

    def read(table: str, conditions: list[str] | None) -> DataFrame:
        options = {"fetchsize": "10000", **properties}
        if conditions is None:
            return spark.read.jdbc(url, table, properties=options)
        return spark.read.jdbc(url, table, predicates=conditions, properties=options)

    return split_tables(ask, read, parts, names)
