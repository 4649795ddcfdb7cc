"""How long changes wait for a review, by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changewatch.operators.histograms import delay_histogram
from changewatch.operators.quantiles import between, exact_percentiles, is_above, is_below, ranked_counts, scaled


def patrollers(progress: DataFrame) -> DataFrame:
    return progress.filter(F.col("language").isNotNull() & F.col("patroller").isNotNull()) \
        .groupBy("language", "patroller").agg(F.count(F.lit(1)).alias("patrols"))


def unpatrolled(progress: DataFrame) -> DataFrame:
    """Rows without a delay by language; 0 where every one has one."""
    return progress.filter(F.col("language").isNotNull()).groupBy("language") \
        .agg(F.count_if(F.col("delay_seconds").isNull()).alias("unpatrolled"))


def describe(progress: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, smallest, quartiles and largest of the delay in seconds.

    One pass: delays are counted by language, null ones too, and all figures come from the ranked counts. Moments are exact sums, so
    they don't depend on the order of the rows. A language without delays has a count of 0."""
    counted = progress.filter(F.col("language").isNotNull()).groupBy("language", F.col("delay_seconds").cast("bigint").alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    n, v = F.col("n"), F.col("v").cast("decimal(20,0)")
    quartiles = {p: F.lit(p) for p in (25, 50, 75)}
    sums = ranked_counts(counted, "language").groupBy("language").agg(
        F.sum("n").alias("count"), F.sum(v * n).alias("total"),
        F.sum((v * v).cast("decimal(25,0)") * n.cast("decimal(12,0)")).alias("squares"),
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"), F.max("rows").alias("rows"),
        *[F.max(F.when(is_below(p), F.col("v"))).alias(f"low{name}") for name, p in quartiles.items()],
        *[F.max(F.when(is_above(p), F.col("v"))).alias(f"high{name}") for name, p in quartiles.items()])
    count, total = F.col("count").cast("double"), F.col("total").cast("double")
    spread = F.col("squares") * F.col("count") - F.col("total") * F.col("total")
    return sums.select(
        "language", "count", F.try_divide(total, count).alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(spread.cast("double") / count / (count - 1))).alias("std"), "min",
        *[between(F.col(f"low{name}"), F.col(f"high{name}"), scaled(p)).alias(f"p{name}") for name, p in quartiles.items()], "max")


def histogram(progress: DataFrame) -> DataFrame:
    return delay_histogram(progress, "language", "delay_seconds")


def percentiles(progress: DataFrame) -> DataFrame:
    """Percentiles 0..100 of the delay in hours."""
    return exact_percentiles(progress, "language", "delay_seconds",
                             F.sequence(F.lit(0), F.lit(100))) \
        .select("language", "pct", (F.col("value") / 3600.0).alias("hours"))
