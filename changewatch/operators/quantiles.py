"""Exact percentiles of whole-number values per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, v, n): how often each whole number occurs."""
    return (
        df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key, F.col(value).cast("bigint").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    )


def ranked_counts(counted: DataFrame, key: str, bucket: int = 3600) -> DataFrame:
    """(key, v, n, first, end, rows): counted whole numbers with their ranks first..end-1 among all rows of a key, and how many rows that
    are. A null value stays, with n of 0 and no rank.

    The rank of a value is the number of rows in lower buckets plus that of lower values in its bucket, so no task sorts a whole key: one
    window runs over the bucket totals of a key, one over the at most ``bucket`` distinct values of a bucket. Both start from the counted
    table, which is shuffled once."""
    counted = counted.select(key, "v", F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0).alias("n"),
                             F.floor(F.col("v") / float(bucket)).alias("bucket"))

    def before(*within: str) -> Window:
        return Window.partitionBy(*within).rowsBetween(Window.unboundedPreceding, -1)

    buckets = counted.groupBy(key, "bucket").agg(F.sum("n").alias("n")).select(
        F.col(key).alias("_key"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("n").over(before(key).orderBy("bucket")), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(key)).alias("rows"))
    in_bucket = F.coalesce(F.sum("n").over(before(key, "bucket").orderBy("v")), F.lit(0))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("bucket").eqNullSafe(F.col("_bucket"))
    first = F.col("before") + F.col("in_bucket")
    return counted.withColumn("in_bucket", in_bucket).join(buckets, same).select(
        key, "v", "n", first.alias("first"), (first + F.col("n")).alias("end"), "rows")


def scaled(pct: Column) -> Column:
    """The rank of a percentile, times 100: it lies between two whole ranks."""
    return pct * (F.col("rows") - 1)


def is_below(pct: Column) -> Column:
    """Whether a value of ``ranked_counts`` is the neighbour of the percentile from below."""
    return (F.col("first") * 100 <= scaled(pct)) & (scaled(pct) < F.col("end") * 100)


def is_above(pct: Column) -> Column:
    return ((F.col("first") - 1) * 100 < scaled(pct)) & (scaled(pct) <= (F.col("end") - 1) * 100)


def between(low: Column, high: Column, scaled_rank: Column) -> Column:
    return low + F.pmod(scaled_rank, F.lit(100)) / 100.0 * (high - low)


def exact_percentiles(df: DataFrame, key: str, value: str, percents: Column,
                      bucket: int = 3600) -> DataFrame:
    """(key, pct, value): percentiles with linear interpolation between neighbours.

    ``percents`` is an array of whole numbers 0..100. Values are counted and ranked first; a value then gives a row for each percentile
    that it is a neighbour of, and none for the others."""
    ranked = ranked_counts(value_counts(df, key, value), key, bucket)
    low = F.max(F.when(is_below(F.col("pct")), F.col("v")))
    high = F.max(F.when(is_above(F.col("pct")), F.col("v")))
    return (
        ranked.withColumn("pct", F.explode(F.filter(percents, lambda pct: is_below(pct) | is_above(pct))))
        .withColumn("scaled", scaled(F.col("pct")))
        .groupBy(key, "pct", "scaled").agg(low.alias("low"), high.alias("high"))
        .select(key, "pct", between(F.col("low"), F.col("high"), F.col("scaled")).alias("value"))
    )
