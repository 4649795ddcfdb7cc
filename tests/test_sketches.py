"""Sketches against exact figures: by part and merged, with hot keys, ties, nulls and nothing at all."""

import random

import pytest
from pyspark.sql import functions as F

from changewatch.operators import frequent, sketches
from changewatch.operators.quantiles import value_counts


def test_merged_distinct_counts_are_those_of_all_rows(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 7).alias("day"), F.when(F.col("id") % 3 == 0, "one").otherwise(F.concat(F.lit("e"), F.col("id") % 20_000)).alias("editor"))
    rows = rows.union(spark.createDataFrame([(8, None), (3, None)], "day long, editor string"))
    by_day = sketches.distinct_sketches(rows, ["day"], F.col("editor"))
    whole = sketches.distinct_sketches(rows.withColumn("x", F.lit(1)), ["x"], F.col("editor"))
    exact = rows.agg(F.count_distinct("editor")).head()[0]
    merged = sketches.merged_distinct(by_day.withColumn("x", F.lit(1)), ["x"]).head().estimate
    assert merged == sketches.merged_distinct(whole, ["x"]).head().estimate  # parts lose nothing
    assert abs(merged - exact) <= sketches.distinct_error() * exact
    days = {r.day: r.estimate for r in sketches.merged_distinct(by_day, ["day"]).collect()}
    assert days[8] == 0
    for r in rows.groupBy("day").agg(F.count_distinct("editor").alias("n")).collect():
        assert abs(days[r.day] - r.n) <= sketches.distinct_error() * r.n + 1


def test_merged_quantiles_have_the_right_ranks(spark):
    rng = random.Random(3)
    values = [("a", int(rng.expovariate(1e-5)), i % 9) for i in range(40_000)] + [("b", 5, i % 9) for i in range(500)]
    values += [("c", 7, 1), ("d", None, 1), ("a", None, 2), (None, 4, 1)]
    rows = spark.createDataFrame(values, "language string, v long, day int")
    by_day = sketches.quantile_sketches(rows, ["language", "day"], F.col("v"))
    found = sketches.merged_quantiles(by_day, ["language"], list(range(101)))
    found = spark.createDataFrame(found.collect(), found.schema)  # another run may give others within the bound
    own = {key: {r.pct: r.value for r in found.collect() if r.language == key} for key in ("a", "b", "c", "d")}
    assert set(own["b"].values()) == {5} and set(own["c"].values()) == {7} and own["d"] == {}
    a = sorted(v for key, v, _ in values if key == "a" and v is not None)
    assert (own["a"][0], own["a"][100]) == (a[0], a[-1])
    errors = {(r.language, r.pct): r.error for r in sketches.rank_errors(found, value_counts(rows, "language", "v"), "language").collect()}
    assert len(errors) == 303 and max(errors.values()) < 0.01
    for pct, value in own["a"].items():  # the errors against their definition
        low, high = sum(v < value for v in a) / len(a), sum(v <= value for v in a) / len(a)
        assert errors["a", pct] == pytest.approx(max(low - pct / 100, pct / 100 - high, 0))


def draw(spark, rows):
    return spark.createDataFrame(rows, "day int, v string")


def exact(rows, count):
    seen = {}
    for _, v in rows:
        if v is not None:
            seen[v] = seen.get(v, 0) + 1
    return sorted(seen.items(), key=lambda own: (-own[1], own[0]))[:count]


@pytest.mark.parametrize("kind,enough", [("skewed", True), ("few", True), ("uniform", False), ("ties", False), ("none", True)])
def test_most_frequent_values_are_exact(spark, kind, enough):
    rng = random.Random(7)
    rows = {
        "skewed": [(i % 5, f"v{int(rng.paretovariate(0.7))}") for i in range(30_000)] + [(1, None)] * 10,
        "few": [(1, "a"), (2, "b"), (2, "a"), (3, None)],
        "uniform": [(i % 5, f"v{i}") for i in range(5_000)],
        "ties": [(i % 5, f"v{i % 400}") for i in range(4_000)],
        "none": [],
    }[kind]
    df = draw(spark, rows)
    by_day = frequent.frequent_sketches(df, ["day"], F.col("v"), 1000)
    top, were_enough = frequent.exact_top(df, F.col("v"), by_day, 10, candidates=50, tracked=1000)
    assert [tuple(r) for r in top.orderBy(F.desc("n"), "value").collect()] == exact(rows, 10)
    assert were_enough == enough or kind == "skewed"


def test_sketch_counts_are_within_their_error(spark):
    rng = random.Random(9)
    rows = [(i % 3, f"v{int(rng.paretovariate(0.5)) % 5000}") for i in range(30_000)]
    df = draw(spark, rows)
    counts = dict(exact(rows, 10**6))
    found = frequent.merged_candidates(frequent.frequent_sketches(df, ["day"], F.col("v"), 200), 40, 200).collect()
    error = frequent.most_error(len(rows), 200)
    assert found and all(counts[r.item] <= r["count"] <= counts[r.item] + error for r in found)
    assert all(n <= error for v, n in counts.items() if v not in {r.item for r in found}) or len(found) == 40
