"""Writers, readers, the batch run and the streaming jobs."""

import gzip
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changewatch import __main__ as command
from changewatch.config import Settings
from changewatch.operators import enrich
from changewatch.plans import trends
from changewatch.sinks import files
from changewatch.sources import derived, readers
from changewatch.sources.schemas import TABLES
from changewatch.streaming import jobs

FOLDER = "/root/testdata/sf0.001"
SETTINGS = Settings(as_of=datetime(2024, 1, 30, 12))


def keys_in(folder):
    return sorted(d.split("=", 1)[1] for d in os.listdir(folder) if "=" in d)


def test_keyed_report_drops_stale_keys_and_keeps_all_rows(spark, tmp_path):
    def rows(keys):
        return spark.createDataFrame([(k, i) for k in keys for i in range(60)], "k string, i int")

    out = str(tmp_path / "report")
    files.write_keyed_report(rows(["a", "b"]), out, "k", [F.col("i")])
    files.write_keyed_report(rows(["b", "c"]), out, "k", [F.col("i")])
    assert keys_in(f"{out}/full") == keys_in(f"{out}/head") == ["b", "c"]
    read = spark.read.option("sep", "\t").option("header", True).csv
    assert read(f"{out}/full").count() == 120
    head = read(f"{out}/head").filter("k = 'c'").select(F.col("i").cast("int")).collect()
    assert sorted(r.i for r in head) == list(range(50))


def test_batch_run_writes_all_reports(spark, tmp_path):
    out = str(tmp_path / "out")
    source = derived.from_events(spark, FOLDER)
    for name in TABLES:
        if name not in ("namespaces", "request_links", "entity_usage"):
            source[name].write.parquet(str(tmp_path / "source" / name))
    links = [{"title": r.title} for r in source["request_links"].collect()]
    (tmp_path / "links.json").write_text(json.dumps({"query": {"pages": {"7": {"links": links}}}}))
    names = {str(r.id): {"id": r.id, "name": r.name} for r in source["namespaces"].collect()}
    (tmp_path / "names.json").write_text(json.dumps({"query": {"namespaces": names}}))
    (tmp_path / "usage.tsv").write_text("\n".join(["qid\tn", *[f"{r[0]}\t{r[1]}" for r in source["entity_usage"].collect()]]))
    command.main(["--parquet", str(tmp_path / "source"), "--namespaces", str(tmp_path / "names.json"), "--request-links",
                  str(tmp_path / "links.json"), "--item-usage", str(tmp_path / "usage.tsv"), "--as-of", SETTINGS.as_of.isoformat(),
                  "--work", str(tmp_path / "work"), "--out", out])
    assert os.listdir(tmp_path / "work") == []
    sizes = [r.edits for r in spark.read.option("sep", "\t").option("header", True).schema("actor_name string, edits long")
             .csv(f"{out}/worklist-users-many-creations/head").collect()]
    assert sizes and sizes == sorted(sizes, reverse=True)
    names = os.listdir(out)
    assert len(names) > 55 and "blocked-anon-1y" in names
    assert keys_in(f"{out}/worklist/full") == ["14d", "3d", "7d", "all", "suggested-edit", "today"]
    assert "en" in keys_in(f"{out}/terms_by_language/full")
    assert spark.read.text(f"{out}/update").first()[0] == "1706616000"
    assert spark.read.text(f"{out}/progress/sentence").first()[0].startswith("Currently ")
    lines = [r[0] for r in spark.read.text(f"{out}/actions").collect()]
    assert "revert\tundo, restore" in lines and len(lines) == 17


def test_dimension_readers(spark, tmp_path):
    usage = tmp_path / "usage.tsv.gz"
    with gzip.open(usage, "wt") as f:
        f.write("a\tb\nQ1\t12\nQ2\t3.5\n")
    rows = readers.read_entity_usage(spark, str(usage)).collect()
    assert sorted(map(tuple, rows)) == [("Q1", 12.0), ("Q2", 3.5)]
    names = tmp_path / "ns.json"
    names.write_text(json.dumps({"query": {"namespaces": {"0": {"id": 0, "name": ""}, "4": {"name": "P"},
                                                          "5": {"id": 5}}}}, indent=1))
    assert sorted(map(tuple, readers.read_namespaces(spark, str(names)).collect()), key=str) == [
        (0, ""), (4, "P"), (5, None)]
    links = tmp_path / "links.json"
    links.write_text(json.dumps({"query": {"pages": {"7": {"links": [{"ns": 0, "title": "Q1"},
                                                                     {"title": "Q2"}]}, "8": {}}}}))
    assert sorted(r.title for r in readers.read_request_links(spark, str(links)).collect()) == ["Q1", "Q2"]


def test_tables_are_conformed(spark, tmp_path):
    spark.sql("SELECT 1 AS actor_id, NULL AS actor_user, CAST('x' AS BINARY) AS actor_name, 2 AS more") \
        .write.parquet(str(tmp_path / "actor"))
    table = readers.from_parquet(spark, str(tmp_path))["actor"]
    assert table.dtypes == [("actor_id", "bigint"), ("actor_user", "bigint"), ("actor_name", "string")]
    assert table.first().actor_name == "x"
    with pytest.raises(KeyError):
        readers.from_parquet(spark, str(tmp_path))["unknown"]


def run_stream(query, tmp_path, name):
    jobs.start(query, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination(120)
    return query.sparkSession.read.schema(query.schema).parquet(str(tmp_path / name))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_streamed_days_do_not_depend_on_the_zone(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        schema = "rc_id bigint, time timestamp_ntz, actor_user bigint"
        rows = [(1, datetime(2024, 1, 1, 0, 30), None), (2, datetime(2024, 1, 1, 23, 30), None), (3, datetime(2024, 1, 9), None)]
        for row in rows:
            spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "c"))
        stream = jobs.follow(spark, str(tmp_path / "c"), spark.read.parquet(str(tmp_path / "c")).schema)
        got = run_stream(jobs.daily_activity(stream), tmp_path, "zoned").collect()
        assert [(str(r.date), r.series, r.n) for r in got] == [("2024-01-01", "anon", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_streamed_activity_equals_batch(spark, tmp_path):
    changes = enrich.changes(derived.from_events(spark, FOLDER)).select("rc_id", "time", "actor_user")
    source = str(tmp_path / "changes")
    changes.write.parquet(source)
    # a late marker closes the last day; it has no date of its own in the result
    end = datetime(2030, 1, 1)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(source)
    spark.createDataFrame([(0, end, None)], "rc_id bigint, time timestamp_ntz, actor_user bigint") \
        .write.mode("append").parquet(source)
    got = run_stream(jobs.daily_activity(stream, "40 days"), tmp_path, "daily")
    batch = trends.counts_by(changes, F.to_date("time"), "date",
                             trends.editor_name(F.col("actor_user")), total=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_streamed_delay_gives_up_after_the_limit(spark, tmp_path):
    start = datetime(2024, 1, 1)
    changes = [(1, 101, start), (2, 102, start), (3, 103, start + timedelta(days=100))]
    log = [(101, start + timedelta(hours=2)), (102, start + timedelta(days=60)),
           (999, start + timedelta(days=100))]
    spark.createDataFrame(changes, "rc_id bigint, rc_this_oldid bigint, time timestamp_ntz") \
        .coalesce(1).write.parquet(str(tmp_path / "c"))
    spark.createDataFrame(log, "rc_curid bigint, log_time timestamp_ntz") \
        .coalesce(1).write.parquet(str(tmp_path / "l"))
    left = spark.readStream.schema("rc_id bigint, rc_this_oldid bigint, time timestamp_ntz") \
        .parquet(str(tmp_path / "c"))
    right = spark.readStream.schema("rc_curid bigint, log_time timestamp_ntz").parquet(str(tmp_path / "l"))
    got = run_stream(jobs.review_delay(left, right), tmp_path, "delay")
    assert sorted((r.rc_id, r.delay_seconds) for r in got.collect()) == [(1, 7200), (2, None)]


def test_streamed_delay_may_start_before_the_change(spark, tmp_path):
    start = datetime(2024, 1, 1)
    spark.createDataFrame([(1, 101, start), (2, 0, start)], "rc_id bigint, rc_this_oldid bigint, time timestamp_ntz") \
        .coalesce(1).write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([(101, start - timedelta(hours=1)), (0, start)], "rc_curid bigint, log_time timestamp_ntz") \
        .coalesce(1).write.parquet(str(tmp_path / "l"))
    left, right = (jobs.follow(spark, str(tmp_path / x), spark.read.parquet(str(tmp_path / x)).schema) for x in "cl")
    got = run_stream(jobs.review_delay(left, right, before="2 hours"), tmp_path, "early")
    assert [(r.rc_id, r.delay_seconds) for r in got.collect()] == [(1, -3600)]
