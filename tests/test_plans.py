"""What reaches the scan, how much is shuffled, and sums that must agree."""

import re
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from changewatch.operators import enrich, histograms, quantiles
from changewatch.plans import blocks, progress, scores, trends, worklists
from changewatch.sources import derived, queries, readers

FOLDER = "/root/testdata/sf0.001"
SETTINGS = registry.SETTINGS


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The source tables that the enrichment reads, as Parquet."""
    folder = tmp_path_factory.mktemp("tables")
    tables = derived.from_events(spark, FOLDER)
    for name in ("recentchanges", "actor", "comment", "change_tag", "change_tag_def", "score", "score_model", "logging",
                 "block", "block_target"):
        tables[name].write.parquet(str(folder / name))
    return readers.from_parquet(spark, str(folder))


def plan(df):
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


WINDOW_RESULTS = {
    **{f"edits_{u}": lambda c, u=u: trends.edits(c, u, SETTINGS) for u in ("date", "weekday", "hour")},
    **{f"status_{u}": lambda c, u=u: trends.patrol_status(c, u, SETTINGS) for u in ("date", "weekday", "hour")},
    **{f"editors_{u}": lambda c, u=u: trends.editors(c, u, SETTINGS) for u in ("date", "weekday", "hour")},
    "sources": lambda c: trends.sources_by_date(c, SETTINGS),
    "categories": lambda c: trends.categories_by_date(c, SETTINGS),
    "reverted": lambda c: trends.reverted_by_date(c, SETTINGS),
    "remaining": lambda c: trends.remaining_by_date(c, SETTINGS),
    "progress_today": lambda c: worklists.progress_today(c, SETTINGS),
}


@pytest.mark.parametrize("name", sorted(WINDOW_RESULTS))
def test_time_bound_reaches_the_scan(stored, name):
    text = plan(WINDOW_RESULTS[name](enrich.changes(stored)))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "rc_timestamp" in line]
    assert any("GreaterThanOrEqual(rc_timestamp" in line for line in pushed)


def test_block_report_is_one_pass(stored):
    report = blocks.anonymous(enrich.changes(stored), queries.block_history(stored), queries.current_blocks(stored), SETTINGS)
    report.collect()
    final = plan(report).split("Initial Plan")[0]
    exchanges = re.findall(r"\b(?:Broadcast)?Exchange [^\n]*", final)
    assert len(exchanges) <= 12, "\n".join(exchanges)


def test_literals_are_no_backlinks(spark):
    from changewatch.plans import items
    rows = [("Q5", p, "1") for p in ("statements", "identifiers", "sitelinks")]
    rows += [("Q9", "label@en", "Q5"), ("Q8", "P31", "Q5"), ("Q7", "statements", "Q5"), ("Q8", "P279", "Q5")]
    facts = items.item_facts(spark.createDataFrame(rows, "subject string, predicate string, object string"),
                             spark.createDataFrame([("Q5",)], "item string")).collect()
    assert [(r.item, r.backlinks) for r in facts] == [("Q5", 1)]


@pytest.mark.parametrize("params,expected", [
    ('a:2:{s:8:"4::curid";s:9:"123456789";s:9:"5::previd";i:0;}', 123456789),
    ('a:2:{s:8:"4::curid";s:11:"12345678901";s:9:"5::previd";i:0;}', 12345678901),
    ('a:2:{s:8:"4::curid";i:77;s:9:"5::previd";i:5;}', 77), ("a:0:", None), (None, None)])
def test_revision_in_log_parameters(spark, params, expected):
    tables = {"logging": spark.createDataFrame([(1, "patrol", "patrol", 0, "20240101000000", params, 1)],
                                               "log_id long, log_type string, log_action string, log_namespace int, log_timestamp string, log_params string, log_actor long"),
              "actor": spark.createDataFrame([(1, "A")], "actor_id long, actor_name string")}
    assert queries.patrol_log(tables).collect()[0].rc_curid == expected


def test_changes_without_revision_meet_nothing(stored):
    changes = enrich.changes(stored)
    assert changes.filter("rc_this_oldid = 0").count() > 0
    assert changes.filter("rc_this_oldid = 0 AND oresc_damaging IS NOT NULL").count() == 0


def test_percentiles_and_moments_equal_numpy(spark):
    values = {key: np.random.default_rng(i).integers(-5000, 2_000_000, n).tolist() for i, (key, n) in enumerate(
        {"a": 1, "b": 2, "c": 1000, "d": 333}.items())} | {"e": [7] * 50}
    rows = [(k, v) for k, own in values.items() for v in own] + [(None, 3), ("f", None)]
    df = spark.createDataFrame(rows, "language string, delay_seconds long")
    wanted = F.sequence(F.lit(0), F.lit(100))
    got = {(r.language, r.pct): r["value"] for r in quantiles.exact_percentiles(df, "language", "delay_seconds", wanted).collect()}
    assert got.keys() == {(k, p) for k in values for p in range(101)}
    for k, own in values.items():
        np.testing.assert_allclose([got[k, p] for p in range(101)], np.percentile(own, range(101)), rtol=1e-12)
    described = {r.language: r for r in progress.describe(df).collect()}
    for k, own in values.items():
        assert described[k]["count"] == len(own) and np.isclose(described[k]["mean"], np.mean(own))
        assert (described[k]["std"] is None) if len(own) == 1 else np.isclose(described[k]["std"], np.std(own, ddof=1))
    assert described["f"]["count"] == 0 and described["f"]["mean"] is None


def test_delays_past_the_last_edge_can_be_shown(spark):
    df = spark.createDataFrame([("a", h * 3600) for h in (-2, 1, 5, 60, 97)], "k string, s long")
    rows = histograms.delay_histogram(df, "k", "s", overflow=True).collect()
    assert sum(r.n for r in rows) == 5 and [r.n for r in rows if r.bin_start is None] == [2]
    assert sum(r.n for r in histograms.delay_histogram(df, "k", "s").collect()) == 3


def test_sums_agree(stored):
    changes = enrich.changes(stored)
    by_kind = {}
    for r in trends.edits(changes, "date", SETTINGS).collect():
        by_kind.setdefault(r.date, {})[r.series] = r.n
    assert by_kind and all(sum(v for k, v in own.items() if k != "total") == own["total"] for own in by_kind.values())
    scored = changes.filter("oresc_damaging IS NOT NULL AND oresc_goodfaith IS NOT NULL").count()
    heat = scores.heatmap(changes, SETTINGS).collect()
    assert sum(r.n for r in heat) == scored == sum({r.editor: r.revisions for r in heat}.values())


def test_heatmap_equals_numpy(stored):
    changes = enrich.changes(stored).filter("actor_user IS NOT NULL")
    rows = changes.select("oresc_damaging", "oresc_goodfaith").dropna().collect()
    x, y = (np.array([r[i] for r in rows]) for i in (0, 1))
    cells, *_ = np.histogram2d(x, y, bins=20)
    got = np.zeros((20, 20))
    found = histograms.score_heatmap(changes, F.lit("registered"), "oresc_damaging", "oresc_goodfaith", 20).collect()
    for r in found:
        got[r.x_bin, r.y_bin] += r.n
    assert got.sum() == cells.sum() and np.abs(got - cells).sum() <= 0.02 * cells.sum()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_seconds_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        from changewatch.functions.values import seconds_between
        df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30))], "a timestamp_ntz, b timestamp_ntz")
        assert df.select(seconds_between(F.col("a"), F.col("b"))).head()[0] == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
