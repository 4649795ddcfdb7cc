"""The pipeline on the smallest tables, stage by stage, and the registered queries."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from changewatch.llm import common, queries, repeats, simhash

FOLDER = "/root/testdata/sf0.001"


def test_operators_and_the_pipeline_are_registered():
    names = registry.queries()
    assert {int(m[1]) for name in names if (m := re.match(r"op(\d+)_", name))} == set(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 4


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("conversations", "embeddings"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    relation = database.sql(queries.SQL[name])
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    assert sorted(str([row[c] for c in columns]) for row in df.collect()) == sorted(
        str([row[i] for i in places]) for row in relation.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, FOLDER), name)
        kept.append({r.doc_id: r for r in docs.collect()})
        if name != "packing":
            assert docs.columns == columns
    quality, unique, cut, packed = kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in quality for i in good) >= 0.95 * len(good)
    sets = {i: set(simhash.shingle_hashes(r.text, 5).tolist()) for i, r in quality.items()}
    near = {i: [j for j in sets if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in sets}
    assert {i for i in sets if i not in unique} == {i for i in sets if near[i]}
    assert set(cut) == set(unique) == set(packed)
    seen = set()
    for i in sorted(unique):
        data = unique[i].text.encode()
        windows = [data[k:k + 50] for k in range(len(data) - 49)]
        covered = bytearray(len(data))
        for k, window in enumerate(windows):
            if window in seen:
                covered[k:k + 50] = b"\1" * 50
        runs = [(m.start(), m.end()) for m in re.finditer(b"\1+", covered)]
        assert cut[i].text == repeats.cut_text(unique[i].text, [{"start": a, "end": b} for a, b in runs])
        assert cut[i].n_chars == len(cut[i].text)
        seen.update(windows)


CLASHING = ["keep", "served", "held", "known", "median", "own_language", "model", "nll", "excess", "c0", "id", "good", "model_of", "key", "group",
            "first", "size", "removed", "chunk", "lang2", "threshold", "a b", "x.y"]


def test_stages_with_clashing_names_ties_and_odd_rows(spark):
    """Columns of any name pass unharmed, null and repeated rows have a place, very long texts come through."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9001, "", "en", "s", 0), (9002, None, "xx", "s", 0),
                                 (9003, "the and of " * 60_000, "en", "s", 1)], docs.schema)
    docs = docs.unionByName(odd)
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    own = {str(r.doc_id): [f"{i}:{'-' if r.doc_id is None else r.doc_id}" for i in range(len(CLASHING))] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, docs, FOLDER), name)
        rows = out.collect()
        assert rows
        if name == "packing":
            continue
        assert out.columns == docs.columns
        for r in rows:
            assert [r[c] for c in CLASHING] == own[str(r.doc_id)]
        if name == "near_duplicates":  # rows that share a key stay or go together, null keys stay
            assert sum(r.doc_id == 9001 for r in rows) in (0, 2) and any(r.doc_id is None for r in rows)
        if name == "repeats":
            assert len(rows) == docs.count()
    assert labels.count()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_no_documents(spark, name, stage):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = stage(spark, docs.where("false"), FOLDER)
    assert out.collect() == []
    if name != "packing":
        assert out.columns == docs.columns


def test_stages_free_what_the_one_before_has_left(spark, tmp_path):
    import os

    def tables():
        folder = f"{common.shared_folder(spark)}/{spark.sparkContext.applicationId}".removeprefix("file:")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = tables()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        assert len({t for t in tables() - before if not t.startswith("run")}) <= 3
    kept = [common.written(docs, "kept")]
    with common.scratch(spark):
        common.written(docs, "gone")
        kept.append(common.written(docs, "stays", keep=True))
    assert all(t.count() == docs.count() for t in kept) and not [t for t in tables() if t.startswith("gone")]
