"""Sketches that are stored by part, a day say, and merged for any set of parts: distinct counts and quantiles without the rows.

Exact forms (``counts``, ``quantiles``) are the default. A sketch has a size that rows don't change, so years of days can be merged for
a window that nobody thought of when they were stored; what it gives is near the exact figure, within a bound that its size sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

LG_K = 14  # 16 KB at most for a distinct count
QUANTILE_K = 1000  # some 10 KB for quantiles


def distinct_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """The relative error that an estimate of a distinct count stays under, but for chances of 1 in 16,000 at four deviations."""
    return deviations * 1.04 / math.sqrt(2 ** lg_k)


def distinct_sketches(df: DataFrame, keys: list[str], value: Column, lg_k: int = LG_K) -> DataFrame:
    """(keys, sketch): a sketch of the distinct values for each key. Nulls don't count; keys of nulls only have an empty sketch."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, estimate) of all that the sketches of a key have seen, values of several of them once."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def quantile_sketches(df: DataFrame, keys: list[str], value: Column, k: int = QUANTILE_K) -> DataFrame:
    """(keys, sketch): a sketch of the distribution of whole numbers for each key. Nulls don't count, and keys of nulls only are left out."""
    return df.filter(value.isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_bigint(value.cast("bigint"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: list[str], percents: list[int], k: int = QUANTILE_K) -> DataFrame:
    """(keys, pct, value): a value that was seen, at about that percentile of all that the sketches of a key have seen. Sketches drop
    values by chance, so another run may give others, within the same bound."""
    ranks = F.array(*[F.lit(p / 100) for p in percents])
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"))
    values = merged.select(*keys, F.kll_sketch_get_quantile_bigint("sketch", ranks).alias("values"))
    pairs = F.arrays_zip(F.array(*map(F.lit, percents)).alias("pct"), F.col("values").alias("value"))
    return values.select(*keys, F.inline(pairs).alias("pct", "value"))


def rank_errors(estimates: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """(key, pct, error): how far the percentile is from the ranks that its value (column ``value``) has among the exact counts (key, v,
    n), as a share of all rows; 0 if it lies between its first and its last rank.

    One window over the distinct values of a key and its estimates; no estimate is compared with every value."""
    rows = counted.select(key, "v", "n", F.lit(None).cast("int").alias("pct")).unionByName(
        estimates.filter(F.col(key).isNotNull()).select(key, F.col("value").alias("v"), F.lit(0).cast("bigint").alias("n"), F.col("pct").cast("int").alias("pct")))
    by_value = Window.partitionBy(key).orderBy("v")
    upto, total = F.sum("n").over(by_value), F.sum("n").over(Window.partitionBy(key))
    below = F.coalesce(F.sum("n").over(by_value.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = F.col("pct") / 100.0
    error = F.greatest(below / total - share, share - upto / total, F.lit(0.0))
    return rows.select(key, "pct", error.alias("error")).filter(F.col("pct").isNotNull())
