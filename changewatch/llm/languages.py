"""Language of texts by nearest-centroid classification (operator 13).

A text is a vector of its runs of one to three characters, letters in lower case and anything else as one gap between words, weighted by TF-IDF
and brought to length one. Each language has several centroids, as its texts are of several kinds. A text has the language of the centroid
with the largest cosine, and is marked as rejected if it is further from it than nearly all texts of that language that were learnt from.

1. One pass over all texts to learn from counts in how many of them each feature is.
2. A bounded sample of each language (``SAMPLE`` texts at most) is clustered, a task a language: the centroids to start with.
3. A second pass over all texts to learn from assigns each to the nearest start of its language. The means are the centroids; how
   far texts are from the starts gives the language's limit.
4. A pass over all documents compares them with the centroids.

Runs of characters are hashed to ``FEATURES`` numbers, so that what tasks are told has a size that texts don't change.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changewatch.llm.common import mapped, scratch, text_of, written

FEATURES = 1 << 13
CENTROIDS = 4  # of a language
SAMPLE = 1000  # texts of a language that are clustered
MOST_LANGUAGES = 500  # each costs what tasks are told 128 KB
REJECTED = 0.001  # the share of a language's own texts that lie beyond its limit
BINS = 1000
SEGMENT = 1 << 18
SALTS = 64
UNKNOWN = "und"


@lru_cache(maxsize=1)
def is_letter() -> np.ndarray:
    """For every code point."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text, ascending, and how often each is found. None without a letter."""
    total = np.zeros(FEATURES, np.int64)
    tail, any_letter = np.zeros(2, np.uint32), False
    for at in range(0, len(text), SEGMENT):  # what a run is doesn't depend on where segments end
        codes = np.frombuffer(text[at:at + SEGMENT].lower().encode("utf-32-le"), np.uint32)
        letters = is_letter()[codes]
        any_letter = any_letter or bool(letters.any())
        codes = np.where(letters, codes, 0).astype(np.uint32)
        before = np.concatenate([tail[1:], codes[:-1]])
        codes = np.concatenate([tail, codes[(codes != 0) | (before != 0)]])
        tail = codes[-2:]
        own = codes[2:]
        two = own + codes[1:-1] * np.uint32(0x85EBCA6B)
        three = two + codes[:-2] * np.uint32(0xC2B2AE35)
        for grams, salt in ((own[own != 0], 0x27D4EB2F), (two, 0x165667B1), (three, 0x5BD1E995)):
            hashed = grams ^ np.uint32(salt)
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(0x9E3779B1)
            total += np.bincount(hashed >> np.uint32(32 - 13), minlength=FEATURES)
    if not any_letter:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.flatnonzero(total)
    return found, total[found]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights, of length one, of a text; empty without a letter."""
    found, counts = counted(text)
    weights = np.log1p(counts) * idf[found]
    return found, weights / (np.sqrt(weights @ weights) or 1)


class Model(NamedTuple):
    """What tasks are told: the weight of each feature, the language of each centroid, the centroids as columns, and the least cosine of a
    text that isn't rejected, by centroid."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    least: np.ndarray


def held_out(key: Column) -> Column:
    """One document in four, by its id; no null id is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def to_learn_from(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """text and lang of documents with both, an id, and a letter, that aren't held out."""
    return docs.where(F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(F.col(key))).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where(F.col("text").rlike(r"\p{L}"))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, dict[str, int]]:
    """In how many texts each feature is, and how many texts each language has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, by_language = np.zeros(FEATURES, np.int64), defaultdict(int)
        for batch in batches:
            for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                total[counted(text)[0]] += 1
                by_language[language] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*found.tolist(), *[None] * len(by_language)], pa.int32()), pa.array([*[None] * len(found), *by_language], pa.string()),
             pa.array([*total[found].tolist(), *by_language.values()], pa.int64())], ["feature", "lang", "n"])

    sums = mapped(texts, count, "feature int, lang string, n long").groupBy("feature", "lang").agg(F.sum("n").alias("n"))
    sums = written(sums, "frequencies")
    languages = sums.where("feature IS NULL")
    if languages.count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    frequencies = np.zeros(FEATURES, np.int64)
    for row in sums.where("feature IS NOT NULL").collect():  # FEATURES at most
        frequencies[row.feature] = row.n
    return frequencies, {row.lang: row.n for row in languages.collect()}


def sampled(texts: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """Distinct texts of each language, those with the smallest hashes: ``SAMPLE`` at most."""
    rates = F.create_map(*[F.lit(x) for language, n in numbers.items() for x in (language, int(min(1, 3 * SAMPLE / n) * 1e9) + 1)])
    hashed = F.xxhash64("text")
    some = texts.where(F.pmod(hashed, F.lit(10**9)) < rates[F.col("lang")]).withColumn("h", hashed).dropDuplicates(["lang", "h"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(10**9)), "h"))
    return some.withColumn("place", place).where(F.col("place") <= SAMPLE).select("text", "lang")


def clustered(weights: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Centroids of length one of rows of length one. Starts are drawn one by one, rows far from those drawn before with more chance."""
    draw = np.random.default_rng(13)
    chosen = [int((weights @ weights.mean(axis=0)).argmax())]
    for _ in range(min(count, len(weights)) - 1):
        far = np.clip(1 - (weights @ weights[chosen].T).max(axis=1), 0, None)
        if far.sum() < 1e-6:
            break
        chosen.append(int(draw.choice(len(weights), p=far / far.sum())))
    centroids = weights[chosen]
    for _ in range(rounds):
        nearest = (weights @ centroids.T).argmax(axis=1)
        sums = np.stack([weights[nearest == i].sum(axis=0) for i in range(len(centroids)) if (nearest == i).any()])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids


def start_centroids(sample: DataFrame, idf: np.ndarray) -> list[tuple[str, np.ndarray]]:
    def cluster(key: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        weights = np.zeros((own.num_rows, FEATURES), np.float32)
        for row, text in zip(weights, own.column("text").to_pylist()):
            at, values = vector(text, idf)
            row[at] = values
        found = clustered(weights, CENTROIDS)
        return pa.table([pa.array([key[0].as_py()] * len(found), pa.string()), pa.array(list(found), pa.list_(pa.float32()))],
                        ["lang", "centroid"])

    found = sample.groupBy("lang").applyInArrow(cluster, "lang string, centroid array<float>").collect()
    return sorted(((row.lang, np.array(row.centroid, np.float32)) for row in found), key=lambda own: own[0])


def means(texts: DataFrame, idf: np.ndarray, starts: list[tuple[str, np.ndarray]]) -> tuple[dict[int, np.ndarray], dict[str, np.ndarray]]:
    """By number of the start the sum of the vectors of all texts of its language that are nearest to it; by language how many
    texts have which cosine with it, in ``BINS`` steps. Each task adds up its own, sums are added in two steps."""
    told = texts.sparkSession.sparkContext.broadcast((idf, starts))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, starts = told.value
        members = defaultdict(list)
        for i, (language, _) in enumerate(starts):
            members[language].append(i)
        columns = {language: np.stack([starts[i][1] for i in own], 1) for language, own in members.items()}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                at, weights = vector(text, idf)
                if not len(at):
                    continue
                cosines = weights @ columns[language][at]
                best = int(cosines.argmax())
                own = sums.setdefault(members[language][best], np.zeros(FEATURES + BINS + 1))
                own[at] += weights
                own[FEATURES + int(np.clip(cosines[best], 0, 1) * BINS)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64()))],
                                         ["number", "sums"])

    def total(own: pa.Table) -> pa.Table:
        sums = own.column("sums").combine_chunks().flatten().to_numpy().reshape(own.num_rows, -1).sum(axis=0)
        return pa.table([own.column("number").slice(0, 1), own.column("salt").slice(0, 1), pa.array([sums], pa.list_(pa.float64()))],
                        ["number", "salt", "sums"])

    schema = "number int, salt int, sums array<double>"
    parts = mapped(texts, add, "number int, sums array<double>").withColumn("salt", F.spark_partition_id() % SALTS)
    parts = parts.groupBy("number", "salt").applyInArrow(total, schema).withColumn("salt", F.lit(0)).groupBy("number", "salt").applyInArrow(total, schema)
    vectors, histograms = {}, defaultdict(lambda: np.zeros(BINS + 1))
    for row in parts.collect():  # one for each centroid
        own = np.array(row.sums)
        vectors[row.number] = own[:FEATURES]
        histograms[starts[row.number][0]] += own[FEATURES:]
    return vectors, histograms


def fitted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """The model of all documents that have a language and aren't held out; None without any."""
    texts = to_learn_from(docs, key, text, lang)
    with scratch(docs.sparkSession):
        frequencies, numbers = document_frequencies(texts)
        if not numbers:
            return None
        idf = np.log((1 + sum(numbers.values())) / (1 + frequencies)) + 1
        starts = start_centroids(written(sampled(texts, numbers), "sample"), idf)
        vectors, histograms = means(texts, idf, starts)
    numbered = sorted(vectors)
    centroids = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in numbered], 1).astype(np.float32)
    least = {language: int(np.searchsorted(np.cumsum(own), REJECTED * own.sum())) / BINS for language, own in histograms.items()}
    languages = [starts[i][0] for i in numbered]
    return Model(idf, languages, centroids, np.array([least[language] for language in languages]))


def predicted(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score (the cosine) and rejected of every row, from its text alone. Texts that are null or have no letter are ``und``, with
    score 0, and rejected, as are all if there is no model. Of equally near languages it is the first by name. Null keys and repeated rows
    are predicted each, an empty table gives an empty one, other columns are not looked at."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        for batch in batches:
            names, scores, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                at, weights = vector(text, model.idf) if model else ((), ())
                if not len(at):
                    names.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                cosines = weights @ model.centroids[at]
                best = int(cosines.argmax())
                score = float(np.clip(cosines[best], 0, 1))
                names.append(model.languages[best]), scores.append(score), rejected.append(score < model.least[best])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(rejected, pa.bool_())], ["key", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, predict, f"key {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("key", key)


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``predicted`` by the model of the documents themselves, and held_out: whether a row's id kept it from being learnt from."""
    found = predicted(docs, fitted(docs, key, text, lang), key, text)
    return found.select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score", "rejected")
