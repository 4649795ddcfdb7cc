"""The most frequent values, exactly, from a mergeable sketch and a second look at its candidates only.

The sketch holds a bounded number of values with counts that are never too small, and too large by a known bound at most. So what it gives as
most frequent are candidates; their exact counts tell whether any other value can still belong to the first ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRACKED = 10_000  # values that a sketch holds
CANDIDATES = 100


def frequent_sketches(df: DataFrame, keys: list[str], value: Column, tracked: int = TRACKED) -> DataFrame:
    """(keys, rows, sketch) of the values of each key, a day say; to store and to merge later."""
    named = df.withColumn("_value", value).filter(F.col("_value").isNotNull())
    sketch = F.expr(f"approx_top_k_accumulate(_value, {tracked})")
    return named.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), sketch.alias("sketch"))


def merged_candidates(sketches: DataFrame, candidates: int = CANDIDATES, tracked: int = TRACKED) -> DataFrame:
    """(item, count): the most frequent values by the sketches put together, with counts that are too large by ``most_error`` at most.
    There has to be a sketch at least."""
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    return merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {candidates})")).alias("found")).select("found.item", "found.count")


def most_error(rows: int, tracked: int = TRACKED) -> float:
    """How much a sketch's count is too large at most, and how often a value that it doesn't hold can occur. It holds fewer values than a
    table of the next power of two over 4/3 of ``tracked``, and errs by 3.5 rows for each place in it."""
    size = 1
    while size < tracked * 4 / 3:
        size *= 2
    return 3.5 * rows / size


def exact_top(df: DataFrame, value: Column, sketches: DataFrame, count: int = 10, candidates: int = CANDIDATES,
              tracked: int = TRACKED) -> tuple[DataFrame, bool]:
    """(value, n) of the ``count`` most frequent values, equally frequent ones by value, and whether the candidates were enough. Where a value
    that is none of them could belong to the first ones, as where nearly all occur equally often, all are counted instead.

    What comes to the driver is ``candidates`` rows at most. ``sketches`` are those of the same rows, best read from where they are stored."""
    spark = df.sparkSession
    named = df.select(value.alias("value")).filter(F.col("value").isNotNull())
    seen = sketches.agg(F.sum("rows")).head()[0] or 0
    found = {row.item: row["count"] for row in merged_candidates(sketches, candidates, tracked).collect()} if seen else {}
    error = most_error(seen, tracked)

    def first(rows: DataFrame) -> DataFrame:
        return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(count)

    top = first(named.filter(F.col("value").isin(list(found)))).collect() if found else []
    full = len(found) == candidates
    others = max(error, min(found.values())) if full else error  # no value besides the candidates occurs more often
    enough = others < 1 or len(top) == count and top[-1].n > others
    if not enough:
        top = first(named).collect()
    return spark.createDataFrame([tuple(row) for row in top], f"value {named.schema['value'].dataType.simpleString()}, n long"), enough
