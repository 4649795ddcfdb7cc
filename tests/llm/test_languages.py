"""Language identification: held-out accuracy, what it learns from, and features against their definition."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from changewatch.llm import languages

FOLDER = "/root/testdata/sf0.01"


def frame(spark, rows):
    """With columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "doc_id long, text string, lang string, key int, lang_pred string, score double")


def test_features_do_not_depend_on_segments(monkeypatch):
    texts = ["Été d'été -- 12  l'ÉTÉ!", "a", "", "  1 2 ", "漢字 かな. ABC", "x" * 1000, "one two  three\n\nfour "]
    whole = [languages.counted(text) for text in texts]
    for size in (1, 2, 7):
        monkeypatch.setattr(languages, "SEGMENT", size)
        for text, (found, counts) in zip(texts, whole):
            again, again_counts = languages.counted(text)
            assert found.tolist() == again.tolist() and counts.tolist() == again_counts.tolist()
    assert not len(whole[2][0]) and not len(whole[3][0])


def test_features_are_runs_of_characters():
    """By definition: one number for each distinct run of one to three characters between gaps, as often as it is found."""
    text, runs = "Ab, ba! ab", Counter()
    folded = "  ab ba ab"
    for i in range(2, len(folded)):
        runs.update(folded[i - n:i + 1] for n in range(3) if n or folded[i] != " ")
    _, counts = languages.counted(text)
    assert sorted(counts.tolist()) == sorted(runs.values())  # these few don't collide


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = languages.identified(docs).collect()
    known = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    assert len(rows) == len(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and len(known[r.doc_id][1]) >= 20]
    assert sum(r.lang_pred == known[r.doc_id][0] for r in held) >= 0.98 * len(held) > 100
    assert sum(r.rejected for r in rows) < 0.02 * len(rows)
    # what held-out documents say of their language, and any source, is without effect
    other = docs.withColumn("lang", F.when(languages.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None))
    assert sorted(map(tuple, languages.identified(other).collect())) == sorted(map(tuple, rows))


def test_odd_rows(spark):
    sentences = {"en": "The water of the river was cold and the children went home early.",
                 "de": "Das Wasser des Flusses war kalt und die Kinder gingen früh nach Hause."}
    rows = [(i, " ".join([sentences[lang]] * (1 + i % 3)), lang) for i in range(40) for lang in sentences]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 34 !?", "en"), (103, "the children", None), (None, "die Kinder", "de"),
             (104, "the river " * 200_000, "en"), (105, "ξένος", None), (106, "der kalte Fluss und das Wasser", None)]
    found = {r.doc_id: r for r in languages.identified(frame(spark, rows)).collect()}
    assert len(languages.identified(frame(spark, rows)).collect()) == len(rows)
    for ident in (100, 101, 102):
        assert (found[ident].lang_pred, found[ident].score, found[ident].rejected) == ("und", 0.0, True)
    assert found[103].lang_pred == found[104].lang_pred == "en" and found[106].lang_pred == found[None].lang_pred == "de"
    assert found[105].rejected and found[105].lang_pred in sentences and not found[None].held_out
    assert not found[1].rejected


def test_nothing_to_learn_from(spark):
    rows = [(1, "some text", None), (2, None, "en"), (3, "1", "en")]
    found = languages.identified(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in found) == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert languages.identified(frame(spark, rows).where("false")).collect() == []


def test_clusters():
    draw = np.random.default_rng(5)
    rows = np.abs(np.concatenate([draw.normal(0, 0.05, (30, 12)) + np.eye(12)[i] for i in range(3)]))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found = languages.clustered(rows, 3)
    assert sorted((found @ np.eye(12)[:3].T).argmax(axis=1).tolist()) == [0, 1, 2]
    assert len(languages.clustered(np.ones((5, 4)) / 2, 4)) == 1  # equal rows make one
