"""Worklists from day partials: equal to those from all changes, before and after late rows."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from changewatch.config import Settings
from changewatch.operators import enrich
from changewatch.plans import incremental, worklists
from changewatch.sources import derived

FOLDER = "/root/testdata/sf0.001"
SETTINGS = registry.SETTINGS


@pytest.fixture(scope="module")
def changes(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("changes") / "changes")
    enrich.changes(derived.from_events(spark, FOLDER)).write.parquet(path)
    odd = spark.read.parquet(path).limit(3).withColumns({"rc_timestamp": F.lit("soon"), "time": F.lit(None).cast("timestamp_ntz"),
                                                          "reverted": F.lit(True), "rc_id": F.col("rc_id") + 10**9})
    return spark.read.parquet(path).unionByName(odd)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def whole(changes, settings):
    return rows(worklists.worklists(changes, worklists.spans(settings)))


@pytest.mark.parametrize("as_of", [SETTINGS.as_of, datetime(2024, 1, 30), datetime(2024, 1, 17, 5, 43, 21), datetime(2024, 2, 2, 23, 59, 59)])
def test_equal_to_all_changes_at_any_time(spark, changes, tmp_path, as_of):
    settings = Settings(as_of=as_of)
    partials = incremental.DayPartials(spark, str(tmp_path / "p"))
    partials.refresh(changes)
    assert rows(incremental.worklists(partials.read(), changes, settings)) == whole(changes, settings)


def files(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def test_late_changes_touch_their_days_only(spark, changes, tmp_path):
    path = str(tmp_path / "p")
    partials = incremental.DayPartials(spark, path)
    partials.refresh(changes)
    before = files(path)
    moment = SETTINGS.as_of - timedelta(days=2)
    late = changes.filter("time IS NOT NULL").limit(1).withColumns({
        "rc_id": F.lit(2 * 10**9).cast("bigint"), "time": F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz"),
        "rc_timestamp": F.lit(moment.strftime("%Y%m%d%H%M%S")), "actor_name": F.lit("Latecomer"), "rc_patrolled": F.lit(0)})
    first = changes.agg(F.min(incremental.day_of(F.col("time")))).head()[0]
    assert first == incremental.NO_DAY
    gone = changes.filter("time IS NOT NULL").agg(F.min(incremental.day_of(F.col("time")))).head()[0]
    now = changes.filter(incremental.day_of(F.col("time")) != gone).unionByName(late)
    days = partials.changed_days(changes, now)
    assert days == sorted([gone, moment.strftime("%Y%m%d")])
    partials.refresh(now, days)
    after = files(path)
    assert set(before) - set(after) == {f"day={gone}"}  # a day that has lost its changes
    assert {d for d in after if after[d] != before.get(d)} == {f"day={moment:%Y%m%d}"}
    assert rows(incremental.worklists(partials.read(), now, SETTINGS)) == whole(now, SETTINGS)
    partials.refresh(now, days)  # again
    assert rows(incremental.worklists(partials.read(), now, SETTINGS)) == whole(now, SETTINGS)
    partials.refresh(now, [])
    assert set(files(path)) == set(after)


def test_reviews_change_their_day(spark, changes, tmp_path):
    partials = incremental.DayPartials(spark, str(tmp_path / "p"))
    partials.refresh(changes)
    one = changes.filter("rc_patrolled = 0 AND time IS NOT NULL").agg(F.max("rc_id")).head()[0]
    now = changes.withColumn("rc_patrolled", F.when(F.col("rc_id") == one, 1).otherwise(F.col("rc_patrolled")))
    days = partials.changed_days(changes, now)
    assert len(days) == 1
    partials.refresh(now, days)
    assert rows(incremental.worklists(partials.read(), now, SETTINGS)) == whole(now, SETTINGS)


def test_no_changes(spark, changes, tmp_path):
    none = changes.filter("false")
    partials = incremental.DayPartials(spark, str(tmp_path / "p"))
    partials.refresh(none)
    assert incremental.worklists(partials.read(), none, SETTINGS).collect() == []


def test_only_days_in_which_spans_begin_are_read(spark, changes, tmp_path):
    partials = incremental.DayPartials(spark, str(tmp_path / "p"))
    partials.refresh(changes)
    plan = incremental.worklists(partials.read(), changes, SETTINGS)._jdf.queryExecution().optimizedPlan().toString()
    for days in (3, 7, 14, 31):
        assert f"{SETTINGS.days_ago(days):%Y%m%d}000000" in plan
