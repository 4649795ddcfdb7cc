"""Tables stored by day and bucketed by change: what is read, what is shuffled, and that results stay."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from changewatch.operators import enrich
from changewatch.plans import breakdowns, trends
from changewatch.sources import derived, layout, queries
from changewatch.functions.values import stamp_literal

FOLDER = "/root/testdata/sf0.001"
SETTINGS = registry.SETTINGS


@pytest.fixture(scope="module")
def tables(spark):
    return derived.from_events(spark, FOLDER)


@pytest.fixture(scope="module")
def by_day(tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("days"))
    layout.store_by_day(tables, folder)
    return folder


def executed(df):
    rows = sorted(map(str, df.collect()))
    return rows, df._jdf.queryExecution().executedPlan().toString()


def metric(df, node, name):
    """Sum of a metric over the scans of a plan that has run."""
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        plan = waiting.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(plan.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            waiting.append(plan.plan())
            continue
        if kind == node and name in plan.toString():
            found.append(plan)
        children = plan.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


def test_every_day_has_a_folder_and_all_rows_stay(spark, tables, by_day):
    for name, stamp in layout.STAMPS.items():
        days = {r[0] for r in tables[name].select(layout.day_of(F.col(stamp))).distinct().collect()}
        assert {d.split("=")[1] for d in os.listdir(f"{by_day}/{name}") if "=" in d} == days
        read = layout.read_by_day(spark, by_day, name)
        assert sorted(map(tuple, read.drop("day").collect()), key=str) == sorted(map(tuple, tables[name].collect()), key=str)


def test_bound_found_in_data_chooses_the_folders(spark, tables, by_day):
    df = layout.patrol_log(spark, tables, by_day)
    rows, plan = executed(df)
    since = enrich.changes(tables).agg(F.min("rc_timestamp")).scalar()
    assert rows == sorted(map(str, queries.patrol_log(tables, since).collect()))
    scans = metric(df, "FileSourceScanExec", "log_id")
    assert len(scans) == 1
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan[plan.index("log_id"):], re.S)
    assert "Subquery" in plan and pruned
    files = scans[0].metrics().get("numFiles").get().value()
    every = len(layout.read_by_day(spark, by_day, "logging").inputFiles())
    assert 0 < files < every  # blocks of former years lie in folders that are not read


def test_window_reads_its_days_alone(spark, tables, by_day):
    window = stamp_literal(SETTINGS.window_start), stamp_literal(SETTINGS.today)
    bounded = layout.bounded(spark, tables, by_day, {"recentchanges": window})
    rows, _ = executed(trends.edits(enrich.changes(bounded), "date", SETTINGS))
    assert rows == sorted(map(str, trends.edits(enrich.changes(tables), "date", SETTINGS).collect()))
    read = layout.read_by_day(spark, by_day, "recentchanges", *window)
    read.collect()
    scan = metric(read, "FileSourceScanExec", "rc_id")[0]
    days = {r.day for r in layout.read_by_day(spark, by_day, "recentchanges").select("day").distinct().collect()}
    kept = {d for d in days if "20240102" <= d <= "20240130"}
    assert scan.metrics().get("numPartitions").get().value() == len(kept) < len(days)


def test_late_rows_replace_their_day_only(spark, tables, tmp_path):
    folder = str(tmp_path / "late")
    layout.store_by_day(tables, folder, ["recentchanges"])
    changes = tables["recentchanges"]
    day = changes.agg(F.min(layout.day_of(F.col("rc_timestamp")))).head()[0]
    before = {d: os.listdir(f"{folder}/recentchanges/{d}") for d in os.listdir(f"{folder}/recentchanges") if "=" in d}
    own = changes.filter(layout.day_of(F.col("rc_timestamp")) == day)
    late = own.limit(1).withColumn("rc_id", F.lit(10**9).cast("bigint"))
    layout.write_by_day(own.unionByName(late), "rc_timestamp", f"{folder}/recentchanges")
    after = {d: os.listdir(f"{folder}/recentchanges/{d}") for d in before}
    assert {d for d in before if before[d] != after[d]} == {f"day={day}"}
    assert layout.read_by_day(spark, folder, "recentchanges").count() == changes.count() + 1


def test_times_that_are_no_times_have_a_place(spark, tmp_path):
    rows = [(1, "20240101000000"), (2, None), (3, "soon"), (4, "")]
    df = spark.createDataFrame(rows, "rc_id bigint, rc_timestamp string")
    layout.write_by_day(df, "rc_timestamp", str(tmp_path / "odd"))
    assert spark.read.parquet(str(tmp_path / "odd")).count() == 4


@pytest.fixture(scope="module")
def colocated(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("buckets"))
    found = layout.Colocated(spark, folder, "colocated_test", 4).store(tables)
    yield found
    found.drop()


def test_bucketed_changes_join_without_a_shuffle(spark, tables, colocated):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, plan = executed(colocated.changes())
        plan = plan.split("== Initial Plan ==")[0]
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        report = breakdowns.category_by_status(colocated.changes(), SETTINGS)  # all that is left is the shuffle of its counts
        _, plan = executed(report)
        assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == sorted(map(str, enrich.changes(tables).collect()))


def test_new_changes_are_added_to_the_buckets(spark, tables, tmp_path):
    half = {n: tables.replaced({"recentchanges": lambda n=n: tables["recentchanges"].filter(F.col("rc_id") % 2 == n)}) for n in (0, 1)}
    grown = layout.Colocated(spark, str(tmp_path), "colocated_grown", 4).store(half[0])
    grown.store(half[1], append=True)
    try:
        assert sorted(map(str, grown.changes().collect())) == sorted(map(str, enrich.changes(tables).collect()))
    finally:
        grown.drop()


def test_work_folder_is_below_the_one_the_cluster_names(spark):
    assert layout.work_folder(spark).startswith(f"{spark.conf.get('spark.checkpoint.dir')}/{spark.sparkContext.applicationId}/")
