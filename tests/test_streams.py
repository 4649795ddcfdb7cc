"""Keyed reports and open changes from streams: any order of arrival, batches done again, restarts."""

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from changewatch.operators import enrich
from changewatch.plans import keyed as keyed_plans, trends
from changewatch.sources import derived
from changewatch.streaming import jobs, keyed, status

FOLDER = "/root/testdata/sf0.001"
SETTINGS = registry.SETTINGS
ROWS = "language string, rc_id long, version int, title string"


@pytest.fixture
def report(spark, tmp_path):
    return keyed.KeyedReport(spark, str(tmp_path / "report"), spark.createDataFrame([], ROWS).schema, "language", "rc_id", "version")


def batch(spark, rows):
    return spark.createDataFrame(rows, f"{ROWS}, is_open boolean")


def now(report):
    return sorted((r.language, r.rc_id, r.title) for r in report.report().collect())


def folders(report):
    path = f"{report.full}/is_open=true"
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith("parquet")) for d in os.listdir(path)} if os.path.isdir(path) else {}


def test_batches_replace_their_keys_only(spark, report):
    assert now(report) == []
    report.replace(batch(spark, [("en", 1, 0, "a", True), ("en", 2, 0, "b", True), ("de", 3, 0, "c", True), (None, 9, 0, "x", True)]), 0)
    assert now(report) == [("de", 3, "c"), ("en", 1, "a"), ("en", 2, "b")]
    before = folders(report)
    second = batch(spark, [("en", 1, 1, "a", False), ("fr/x y", 4, 0, "d", True), ("en", 2, 0, "b", True)])
    report.replace(second, 1)
    assert now(report) == [("de", 3, "c"), ("en", 2, "b"), ("fr/x y", 4, "d")]
    assert folders(report)["language=de"] == before["language=de"]  # untouched
    again = now(report)
    report.replace(second, 1)  # the same batch once more, as after a failure
    assert now(report) == again
    report.replace(batch(spark, [("fr/x y", 4, 2, "d", False), ("de", 3, 1, "c", False)]), 2)
    assert now(report) == [("en", 2, "b")]
    assert set(folders(report)) == {"language=en"}  # emptied keys are gone
    report.replace(batch(spark, [("de", 3, 0, "c", True)]), 3)  # what came late is older than what closed it
    assert now(report) == [("en", 2, "b")]
    report.replace(batch(spark, []), 4)
    assert now(report) == [("en", 2, "b")] and not os.listdir(report.staging)


def test_keyed_report_from_a_stream_equals_the_report(spark, tmp_path):
    changes = enrich.changes(derived.from_events(spark, FOLDER)).select(
        "rc_id", "rc_timestamp", "rc_title", "rc_patrolled", "summary_action", "summary_param1")
    source = str(tmp_path / "changes")
    opened = changes.withColumns({"rc_patrolled": F.lit(0), "version": F.lit(0)})
    reviewed = changes.filter("rc_patrolled = 1").withColumn("version", F.lit(1))
    parts = [df.filter(F.col("rc_id") % 3 == i) for df in (reviewed, opened) for i in range(3)]  # reviews come first
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)

    def rows(own):
        wanted = own.filter(F.col("summary_action").isin(keyed_plans.actions_of("terms")))
        return wanted.select(F.col("summary_param1").alias("language"), "rc_id", "version", F.col("rc_title").alias("title"),
                             (F.col("rc_patrolled") == 0).alias("is_open"))

    into = keyed.KeyedReport(spark, str(tmp_path / "report"), spark.createDataFrame([], ROWS).schema, "language", "rc_id", "version")
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 2).parquet(source)
    keyed.follow(stream, rows, into, str(tmp_path / "state")).awaitTermination(240)
    wanted = changes.filter(F.col("summary_action").isin(keyed_plans.actions_of("terms")) & (F.col("rc_patrolled") == 0)
                            & F.col("summary_param1").isNotNull())
    assert now(into) == sorted((r.summary_param1, r.rc_id, r.rc_title) for r in wanted.collect())


@pytest.mark.parametrize("order", ["changes first", "entries first", "mixed"])
def test_open_changes_equal_the_report_in_any_order(spark, tmp_path, order):
    changes = enrich.changes(derived.from_events(spark, FOLDER)).filter(trends.in_window(SETTINGS)).select(
        "rc_id", "rc_this_oldid", "time", "actor_user", "rc_patrolled")
    expected = sorted(map(tuple, changes.filter("rc_patrolled = 0").groupBy(F.to_date("time").alias("date")).agg(
        F.count(F.lit(1)).alias("total"), F.count("actor_user").alias("registered")).withColumn(
        "anon", F.col("total") - F.col("registered")).collect()))
    first = changes.withColumn("rc_patrolled", F.when(F.col("rc_this_oldid") == 0, F.col("rc_patrolled")).otherwise(0).cast("int"))
    first = first.unionByName(first.limit(20))  # some come twice
    log = changes.filter("rc_patrolled = 1").select(F.col("rc_this_oldid").alias("rc_curid"), F.col("time").alias("log_time"))
    log = log.unionByName(log.limit(20))
    rng = random.Random(order)
    paths = {"c": str(tmp_path / "c"), "l": str(tmp_path / "l")}
    first.repartition(3).write.parquet(paths["c"])
    log.repartition(3).write.parquet(paths["l"])
    schemas = {name: spark.read.parquet(path).schema for name, path in paths.items()}
    files = [(name, f) for name, path in paths.items() for f in sorted(os.listdir(path)) if f.endswith(".parquet")]
    files.sort(key={"changes first": lambda own: own[0], "entries first": lambda own: own[0] == "c", "mixed": lambda own: rng.random()}[order])
    for name in "cl":
        os.mkdir(tmp_path / f"in-{name}")
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")
    for name, file in files:  # each run starts from the state that the one before has left
        os.link(f"{paths[name]}/{file}", tmp_path / f"in-{name}" / file)
        if order == "mixed" or file == files[-1][1]:
            streams = {n: jobs.follow(spark, str(tmp_path / f"in-{n}"), schemas[n]) for n in "cl"}
            result = status.open_changes(streams["c"], streams["l"], timedelta(days=31), "60 days")
            query = status.start(result, sink, state)
            query.awaitTermination(240)
            assert query.exception() is None
    found = status.remaining(spark.read.schema(status.OUTPUT).parquet(sink))
    assert sorted(map(tuple, found.collect())) == expected


def test_state_is_given_up_after_its_time(spark, tmp_path):
    from datetime import datetime
    start = datetime(2024, 1, 1)
    schema = "rc_id bigint, rc_this_oldid bigint, time timestamp_ntz, actor_user bigint, rc_patrolled int"
    steps = [([(1, 101, start, None, 0)], []), ([(2, 102, start + timedelta(days=90), 5, 0)], []), ([(3, 103, start + timedelta(days=91), 5, 0)], []),
             ([], [(101, start + timedelta(days=91)), (102, start + timedelta(days=92))])]
    for name in ("c", "l"):
        os.mkdir(tmp_path / name)
    for own, entries in steps:
        if own:
            spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "c"))
        if entries:
            spark.createDataFrame(entries, "rc_curid bigint, log_time timestamp_ntz").coalesce(1).write.mode("append").parquet(str(tmp_path / "l"))
        changes = jobs.follow(spark, str(tmp_path / "c"), spark.createDataFrame([], schema).schema)
        log = jobs.follow(spark, str(tmp_path / "l"), spark.createDataFrame([], "rc_curid bigint, log_time timestamp_ntz").schema)
        result = status.open_changes(changes, log, timedelta(days=31), "1 hour")
        status.start(result, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(240)
    found = status.remaining(spark.read.schema(status.OUTPUT).parquet(str(tmp_path / "out"))).collect()
    assert sorted((str(r.date), r.total, r.registered) for r in found) == [("2024-01-01", 1, 0), ("2024-04-01", 1, 1)]  # 101 stays open, 102 doesn't
