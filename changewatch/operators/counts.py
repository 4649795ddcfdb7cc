"""Counting by one dimension and a second, few-valued one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TOTAL = "total"


def counts_by(df: DataFrame, dim: Column, name: str, series: Column, *,
              distinct: Column | None = None, per: float | None = None,
              total: bool = True) -> DataFrame:
    """Long table (``name``, series, n): rows, or distinct values of ``distinct``, by dimension and
    series. Rows with a null key are left out. ``per`` divides by the length of the window, and
    ``total`` adds the sum over the series (of distinct counts, too: the sum of the parts).

    The totals are taken from the counted table, so the input is aggregated once and not expanded.
    """
    measure = F.count(F.lit(1)) if distinct is None else F.count_distinct(distinct)
    keyed = df.withColumns({name: dim, "series": series}) \
        .filter(F.col(name).isNotNull() & F.col("series").isNotNull())
    counted = keyed.groupBy(name, "series").agg(measure.alias("n"))
    if total:
        is_total = F.grouping("series") == 1
        counted = (
            counted.groupingSets([[name, "series"], [name]], name, "series")
            .agg(F.sum("n").alias("n"), is_total.alias("is_total"))
            .select(name, F.when(F.col("is_total"), TOTAL).otherwise(F.col("series"))
                    .alias("series"), "n")
        )
    if per is not None:
        counted = counted.withColumn("n", F.col("n") / F.lit(float(per)))
    return counted


def status_totals(df: DataFrame, dim: str, name: str | None = None) -> DataFrame:
    """(dim, open, reviewed, total), both statuses always present. Null keys are left out."""
    return (
        df.filter(F.col(dim).isNotNull())
        .groupBy(F.col(dim).alias(name or dim))
        .agg(F.count_if(F.col("rc_patrolled") == 0).alias("open"),
             F.count_if(F.col("rc_patrolled") == 1).alias("reviewed"),
             F.count(F.lit(1)).alias("total"))
    )


def status_breakdown(df: DataFrame, dim: str, name: str | None = None,
                     more_than: int | None = None) -> DataFrame:
    """(dim, status, n, total): the counts by status that occur, of keys with a total above the
    limit."""
    totals = status_totals(df, dim, name)
    if more_than is not None:
        totals = totals.filter(F.col("total") > more_than)
    return (
        totals.select(
            name or dim, "total",
            F.explode(F.array(
                F.struct(F.lit("open").alias("status"), F.col("open").alias("n")),
                F.struct(F.lit("reviewed").alias("status"), F.col("reviewed").alias("n")),
            )).alias("part"))
        .select(name or dim, "part.status", "part.n", "total")
        .filter(F.col("n") > 0)
    )
