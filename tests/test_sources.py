"""Parts of tables whose bounds are found in them, and filters over the keys in scope."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from changewatch.operators import enrich
from changewatch.sources import derived, queries, ranges, readers, reduced
from test_layout import metric

FOLDER = "/root/testdata/sf0.001"


def split(spark, rows, parts):
    """The parts of a table of actors, cut by the bounds that SQL finds in it."""
    spark.createDataFrame(rows, "actor_id bigint, actor_user bigint, actor_name string").createOrReplaceTempView("people")
    uppers = [r.upper_key for r in spark.sql(ranges.quantile_query("people", "actor_id", parts)).collect()]
    conditions = ranges.predicates("actor_id", uppers)
    return conditions, [spark.table("people").filter(c) for c in conditions]


def drawn(kind):
    rng = random.Random(4)
    return {
        "bunched": [rng.randint(0, 50) if i % 2 else 10**12 + i for i in range(4000)],
        "exponential": [int(rng.expovariate(1e-9)) for _ in range(4000)],
        "negative": list(range(-2000, 2000)),
    }[kind]


@pytest.mark.parametrize("kind", ["bunched", "exponential", "negative"])
def test_parts_are_of_equal_size_and_hold_every_row_once(spark, kind):
    rows = [(key, i, f"n{i}") for i, key in enumerate(drawn(kind))] + [(None, -1, "nobody")] * 3
    conditions, parts = split(spark, rows, 16)
    counts = [p.count() for p in parts]
    assert sum(counts) == len(rows) and len({r.actor_name for p in parts for r in p.collect()}) == 4001
    if kind != "bunched":
        assert len(conditions) == 16 and max(counts) <= 1.2 * len(rows) / 16
    else:  # half of all rows have 51 keys, which can't be cut
        assert max(counts) <= len(rows) / 16 + 3 * len(rows) / 2 / 51


def test_parts_of_hot_few_and_no_keys(spark):
    conditions, parts = split(spark, [(7, i, "x") for i in range(1000)] + [(i, i, "y") for i in range(500)], 8)
    assert sum(p.count() for p in parts) == 1500 and len(conditions) < 8
    for rows in ([], [(None, 1, "x")], [(5, 1, "x")]):
        conditions, parts = split(spark, rows, 8)
        assert conditions == ["1 = 1"] and parts[0].count() == len(rows)
    conditions, parts = split(spark, [(1, 1, "a"), (2, 2, "b")], 8)
    assert sorted(p.count() for p in parts) == [1, 1]
    new = spark.createDataFrame([(99, 0, "new")], "actor_id bigint, actor_user bigint, actor_name string")
    assert sum(new.filter(c).count() for c in conditions) == 1  # came after the bounds were found


def test_split_tables_give_the_same_results(spark, tmp_path):
    source = derived.from_events(spark, FOLDER)
    asked = []

    def read(name, conditions):
        asked.append((name, conditions and len(conditions)))
        table = spark.table(name)
        parts = [table.filter(c) for c in conditions or ["1 = 1"]]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        return whole

    names = {name: f"wiki_{name}" for name in ("recentchanges", "actor", "comment", "change_tag", "change_tag_def", "score", "score_model")}
    for name, there in names.items():
        source[name].createOrReplaceTempView(there)
    tables = ranges.split_tables(spark.sql, read, 6, names)
    assert sorted(map(str, enrich.changes(tables).collect())) == sorted(map(str, enrich.changes(source).collect()))
    assert dict(asked)["wiki_recentchanges"] == 6 and dict(asked)["wiki_score_model"] is None


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """Stored tables with twenty times as many scores, the rest of revisions out of scope."""
    folder = tmp_path_factory.mktemp("grown")
    tables = derived.from_events(spark, FOLDER)
    for name in ("recentchanges", "score", "score_model", "change_tag", "change_tag_def"):
        tables[name].write.parquet(str(folder / name))
    old = tables["score"].withColumn("oresc_rev", F.explode(F.array(*[F.col("oresc_rev") - i * 10**12 for i in range(1, 20)])))
    old.write.mode("append").parquet(str(folder / "score"))
    return readers.from_parquet(spark, str(folder))


def shuffled(df):
    df.collect()
    return sum(p.metrics().get("shuffleRecordsWritten").get().value() for p in metric(df, "ShuffleExchangeExec", "oresc_rev"))


def test_filter_drops_rows_before_the_shuffle(spark, grown):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = queries.scores_in_scope(grown)
        rows, every = sorted(map(str, plain.collect())), shuffled(plain)
        with reduced.scope_filters(spark, reduced.keys_in_scope(grown), least_scan="0"):
            filtered = queries.scores_in_scope(grown)
            assert sorted(map(str, filtered.collect())) == rows
            assert "might_contain" in filtered._jdf.queryExecution().optimizedPlan().toString()
            few = shuffled(filtered)
        assert few < 0.2 * every
        again = queries.scores_in_scope(grown)
        assert "might_contain" not in again._jdf.queryExecution().optimizedPlan().toString()  # settings are back
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_have_a_bound():
    assert reduced.bits_for(0) == 1 << 16 and reduced.bits_for(10**6) == 10**7
    assert reduced.bits_for(10**8) == reduced.MOST_BITS and reduced.bits_for(10**10) is None


def test_changes_in_scope_are_dealt_to_all_tasks(spark):
    """However small their files are, they are not told to each task, nor gathered in one; a repeated id counts once."""
    tables = derived.from_events(spark, FOLDER)
    flags = queries.change_flags(tables)
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "REPARTITION_BY_NUM" in plan and plan.count("BroadcastExchange") <= 1
    twice = readers.Tables(lambda name: tables[name].union(tables[name]))
    assert sorted(map(tuple, queries.change_flags(twice).collect())) == sorted(map(tuple, flags.collect()))
