"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text (operator 7).

The model is of bytes: an n-gram of up to five is a whole number of 40 bits, its context and its shorter n-grams are shifts and masks of
it. Each language has a model of its own, counted over all its trusted documents but those held out for thresholds.

1. Documents go, compressed, to chunks of bounded size by the hash of their id. A chunk lists its distinct n-grams of the highest
   order by language, with their counts in its trusted documents.
2. The lists meet in shards by language and two middle bytes, which every n-gram and context of order three to five that a
   look-up needs has in common. There the counts are summed. Statistics of the whole model and its two lowest orders
   (65,536 entries a language at most) are summed as rows and handed to all shards.
3. Shards answer each list with log probabilities; chunks add them up for each document.

What travels is lists of distinct n-grams, not one row for each n-gram of a document.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changewatch.llm.common import mapped, quoted, scratch, ship, text_of, tidy, total_bytes, written

ORDER = 5
BEGIN, END = b"\xff", b"\xfe"  # bytes that UTF-8 never has
SYMBOLS = 257
CHUNK = 8 << 20  # bytes of text in a chunk
SHARD = 64 << 20  # bytes of text behind a shard
SEGMENT = 1 << 19
HELD_OUT = 5  # one in so many trusted documents sets thresholds instead of counts
LOW = 2  # orders that go everywhere
POOLED = "\uffff"  # stands for the model of all languages


def mask(order: int) -> int:
    return (1 << 8 * order) - 1


def grams(text: str) -> Iterator[np.ndarray]:
    """The n-gram of the highest order that ends at each byte and at the end of a text, in runs of bounded length."""
    data = np.frombuffer(BEGIN * (ORDER - 1) + text.encode() + END, np.uint8)
    count = len(data) - ORDER + 1
    for at in range(0, count, SEGMENT):
        size = min(SEGMENT, count - at)
        found = data[at:at + size].astype(np.int64)
        for i in range(1, ORDER):
            found <<= 8
            found |= data[at + i:at + i + size]
        yield found


def distinct(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of texts, ascending, and their counts."""
    keys, counts, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        own, n = np.unique(np.concatenate([*waiting, np.zeros(0, np.int64)]), return_counts=True)
        both, at = np.unique(np.concatenate([keys, own]), return_inverse=True)
        return both, np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)

    for text in texts:
        for found in grams(text):
            waiting.append(found)
            size += len(found)
            if size > 2 * SEGMENT:
                keys, counts = merge()
                waiting, size = [], 0
    return merge()


def shard_of(language: str, keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> 8 & mask(2)) * 40503 + zlib.crc32(language.encode())) % shards


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """What is taken from n-grams seen once, twice, and more often (index 1 to 3), from how many were seen 1 to 4 times. Where
    too few were seen to tell, half a count."""
    n1, n2, n3, n4 = counts_of_counts.astype(float)
    if not min(n1, n2, n3):
        return np.array([0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, 0, [0, 1, 2, 3])


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5]


def shorter(keys: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of ``order`` in those of one more, and before how many different bytes they were found."""
    return np.unique(keys & mask(order), return_counts=True)


def found_at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def interpolated(keys: np.ndarray, counts: np.ndarray, taken: np.ndarray, wanted: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probability of the last byte of ``wanted`` after its others: its discounted share among the n-grams with that context, and the
    discounts' share of the ``lower`` order. After a context never seen it is that of the lower order."""
    contexts, at = np.unique(keys >> 8, return_inverse=True)
    totals = np.bincount(at, counts, len(contexts))
    off = taken[np.minimum(counts, 3)]
    share = np.bincount(at, off, len(contexts)) / np.maximum(totals, 1)
    at, known = found_at(contexts, wanted >> 8)
    if not len(contexts):
        return lower
    place, seen = found_at(keys, wanted)
    own = np.where(seen, counts[place] - off[place], 0) / totals[at]
    return np.where(known, own + share[at] * lower, lower)


def log_probabilities(keys: np.ndarray, counts: np.ndarray, low: np.ndarray, low_counts: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Of all n-grams of a shard, with their counts in trusted text, given the two-byte n-grams and the statistics of the language."""
    seen = counts > 0
    orders = {ORDER: (keys[seen], counts[seen])}
    for order in range(ORDER - 1, LOW, -1):
        orders[order] = shorter(orders[order + 1][0], order)
    orders[LOW] = (low, low_counts)
    orders[1] = shorter(low, 1)
    chances = np.full(len(keys), 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        own, n = orders[order]
        taken = discounts(stats[order - LOW - 1] if order > LOW else counts_of_counts(n))
        chances = interpolated(own, n, taken, keys & mask(order), chances)
    return np.log(chances)


def table_of(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.table([pa.array(column, kind) for column, (_, kind) in zip(columns, schema)], [name for name, _ in schema])


LONGS, FLOATS = pa.list_(pa.int64()), pa.list_(pa.float32())
LISTS = [("shard", pa.int64()), ("chunk", pa.int64()), ("lang", pa.string()), ("grams", LONGS), ("counts", LONGS)]
SIDE = [("lang", pa.string()), ("low", LONGS), ("low_counts", LONGS), ("stats", LONGS)]
ANSWERS = [("chunk", pa.int64()), ("lang", pa.string()), ("shard", pa.int64()), ("logs", FLOATS)]


def summed(own: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By language the n-grams of a shard and their counts in all chunks."""
    found = {}
    langs = own.column("lang").to_pylist()
    for lang in sorted(set(langs)):
        part = own.filter(pa.array([x == lang for x in langs]))
        keys = part.column("grams").combine_chunks().flatten().to_numpy()
        counts = part.column("counts").combine_chunks().flatten().to_numpy()
        keys, at = np.unique(keys, return_inverse=True)
        found[lang] = keys, np.bincount(at, counts, len(keys)).astype(np.int64)
    return found


def scores(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
           carry: list[str] | None = None) -> DataFrame:
    """Every row's ``carry`` columns (the key if not given), lang as ``model``, n_bytes and nll, the negative log probability of its bytes
    and end. ``trusted`` has the ids to learn from, in a column named like the key.

    Null texts are empty; null languages share one model; a language without trusted text gives each byte the same chance. Null
    keys are scored and never trusted; repeated rows are scored, and counted, each; other columns are not looked at."""
    spark = docs.sparkSession
    ship(spark)
    carry = carry or [key]
    least, size = int(spark.conf.get("spark.sql.shuffle.partitions")), total_bytes(docs, text)
    chunks, shards = max(least, -(-size // CHUNK)), max(least, -(-size // SHARD))
    ident = F.col(key).cast("long")
    own_text = [] if text in carry else [text_of(text).alias("text")]
    text_name = "text" if own_text else f"c{carry.index(text)}"  # a text travels once
    dealt = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], ident.alias("id"), *own_text,
                        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                        F.pmod(F.xxhash64(ident, F.when(ident.isNull(), F.col(text))), F.lit(chunks)).alias("chunk"))
    carried = [f"c{i}" for i in range(len(carry))]

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            heads = np.flatnonzero(np.append(True, chunk[order][1:] != chunk[order][:-1])) if len(order) else order
            blobs = []
            for own in np.split(order, heads[1:]):
                sink = pa.BufferOutputStream()
                part = batch.take(pa.array(own))
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_batch(part)
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(chunk[order[heads]], pa.int64()), pa.array(blobs, pa.binary())], ["chunk", "blob"])

    def unpacked(own: pa.Table) -> Iterator[pa.Table]:
        for blob in own.column("blob"):
            yield pa.ipc.open_stream(pa.py_buffer(blob.as_py())).read_all()

    def texts_by_language(own: pa.Table, chosen: set | None) -> dict[str, list[str]]:
        found = defaultdict(list)
        for part in unpacked(own):
            for language, ident, value in zip(*(part.column(c).to_pylist() for c in ("lang", "id", text_name))):
                if chosen is None or ident in chosen:
                    found[language].append(value or "")
        return found

    def list_grams(key: tuple[pa.Scalar, ...], own: pa.Table, learnt: pa.Table) -> pa.Table:
        tidy()
        chosen = {ident for ids in learnt.column("ids").to_pylist() for ident in ids}
        learn = texts_by_language(own, chosen)
        rows = []
        for language, texts in texts_by_language(own, None).items():
            keys, _ = distinct(texts)
            known, n = distinct(learn.get(language, []))
            counts = np.zeros(len(keys), np.int64)
            counts[np.searchsorted(keys, known)] = n
            shard = shard_of(language, keys, shards)
            order = np.argsort(shard, kind="stable")
            heads = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1]))
            rows += [(int(shard[at[0]]), key[0].as_py(), language, keys[at], counts[at]) for at in np.split(order, heads[1:])]
        return table_of(rows, LISTS)

    def summarise(own: pa.Table) -> pa.Table:
        tidy()
        rows = []
        for language, (keys, counts) in summed(own).items():
            keys, counts = keys[counts > 0], counts[counts > 0]
            stats = {ORDER: counts_of_counts(counts)}
            for order in range(ORDER - 1, LOW, -1):
                keys, counts = shorter(keys, order)
                stats[order] = counts_of_counts(counts)
            rows.append((language, *shorter(keys, LOW), np.concatenate([stats[order] for order in range(LOW + 1, ORDER + 1)])))
        return table_of(rows, SIDE)

    def answer(own: pa.Table, side: pa.Table) -> pa.Table:
        tidy()
        sides = {row["lang"]: row for row in side.to_pylist()}
        logs = {}
        for language, (keys, counts) in summed(own).items():
            row = sides[language]
            low, low_counts, stats = (np.array(row[c], np.int64) for c in ("low", "low_counts", "stats"))
            logs[language] = keys, log_probabilities(keys, counts, low, low_counts, stats.reshape(-1, 4))
        lists = own.column("grams").combine_chunks()
        rows = []
        for chunk, language, shard, wanted in zip(*(own.column(c).to_pylist() for c in ("chunk", "lang", "shard")),
                                                  (lists[i].values.to_numpy() for i in range(len(lists)))):
            keys, values = logs[language]
            rows.append((chunk, language, shard, values[np.searchsorted(keys, wanted)].astype(np.float32)))
        return table_of(rows, ANSWERS)

    def add_up(own: pa.Table, answers: pa.Table) -> pa.Table:
        tidy()
        lists = answers.column("logs").combine_chunks()
        by_language = defaultdict(dict)
        for i, (language, shard) in enumerate(zip(*(answers.column(c).to_pylist() for c in ("lang", "shard")))):
            by_language[language][shard] = lists[i].values.to_numpy()
        known = {}
        for language, texts in texts_by_language(own, None).items():
            keys, _ = distinct(texts)
            shard = shard_of(language, keys, shards)
            logs = np.empty(len(keys), np.float64)
            for number, values in by_language[language].items():
                logs[shard == number] = values
            known[language] = keys, logs
        parts = []
        for part in unpacked(own):
            sizes, sums = [], []
            for language, value in zip(part.column("lang").to_pylist(), part.column(text_name).to_pylist()):
                keys, logs = known[language]
                value = value or ""
                sizes.append(len(value.encode()))
                sums.append(-sum(float(logs[np.searchsorted(keys, found)].sum()) for found in grams(value)))
            parts.append(part.select([*carried, "lang"]).append_column("n_bytes", pa.array(sizes, pa.int64()))
                         .append_column("nll", pa.array(sums, pa.float64())))
        return pa.concat_tables(parts)

    blobs = mapped(dealt, compress, "chunk long, blob binary")
    learnt = trusted.select(F.col(key).cast("long").alias("id")).where("id IS NOT NULL").distinct().groupBy(
        F.pmod(F.xxhash64("id", F.lit(None).cast("string")), F.lit(chunks)).alias("chunk")).agg(F.collect_list("id").alias("ids"))
    lists = blobs.groupBy("chunk").cogroup(learnt.groupBy("chunk")).applyInArrow(
        list_grams, "shard long, chunk long, lang string, grams array<bigint>, counts array<bigint>")
    side_schema = "lang string, low array<bigint>, low_counts array<bigint>, stats array<bigint>"
    parts = lists.groupBy("shard").applyInArrow(summarise, side_schema)
    # summed as rows, before anything of a language comes together: 65,536 sums at most
    low = parts.select("lang", F.inline(F.arrays_zip("low", "low_counts"))).groupBy("lang", "low").agg(F.sum("low_counts").alias("n"))
    low = low.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("low", "n"))).alias("own"))
    stats = parts.select("lang", F.posexplode("stats").alias("at", "n")).groupBy("lang", "at").agg(F.sum("n").alias("n"))
    stats = stats.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("stats"))
    side = low.join(stats, "lang", "right").select(
        "lang", *[F.coalesce(F.col("own")[name], F.array().cast("array<bigint>")).alias(alias) for name, alias in (("low", "low"), ("n", "low_counts"))],
        F.col("stats")["n"].alias("stats"))
    side = side.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    answers = lists.groupBy("shard").cogroup(side.groupBy("shard")).applyInArrow(
        answer, "chunk long, lang string, shard long, logs array<float>")
    kinds = ", ".join(f"{name} {dealt.schema[name].dataType.simpleString()}" for name in carried)
    found = blobs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        add_up, f"{kinds}, lang string, n_bytes long, nll double")
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], F.col("lang").alias("model"), "n_bytes", "nll")


def trusted_ids(labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Ids all of whose labels say good and none of whose says toxic, and whether an id is held out from counting. Labels
    need not have a column for toxic."""
    harm = F.coalesce(F.col(toxic), F.lit(0)) if toxic in labels.columns else F.lit(0)
    good = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(
        F.min(F.coalesce(F.col(quality), F.lit(0))).alias("q"), F.max(harm).alias("t")).where("q = 1 AND t = 0")
    return good.select(key, (F.pmod(F.xxhash64(key), F.lit(HELD_OUT)) == 0).alias("held_out"))


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
           weight: int = 200, spread: float = 4.0, margin: float = 0.2) -> DataFrame:
    """key, model, n_bytes, perplexity (of a byte), excess, threshold and keep of every row.

    ``excess`` is how far the mean log loss of a document lies over the median of its language, drawn towards it by ``weight`` bytes,
    as the mean of a short text says little. Threshold of a language: the median excess of its held-out trusted documents
    plus ``spread`` times the distance from there to their 0.9 quantile, but at least ``margin``. A document is kept if its
    excess is no larger. A language that lacks trusted documents to count or to hold out, null among them, is judged by a model and a
    threshold of all trusted documents. ``model`` is the language in either case. Empty texts are kept, and all if fewer than two documents are
    trusted. Other columns are not looked at, whatever their names; null keys are judged and never trusted; repeated rows are judged
    each; an empty table gives an empty one."""
    found = _judged(docs, labels, [key], key, text, lang, weight, spread, margin)
    return found.select(F.col("c0").alias(key), F.col("own_language").alias("model"), "n_bytes", "perplexity", "excess", "threshold", "keep")


def kept(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
         weight: int = 200, spread: float = 4.0, margin: float = 0.2) -> DataFrame:
    """The rows that ``judged`` keeps, with all their columns as they were. Columns travel by position, so their names can be any."""
    found = _judged(docs, labels, docs.columns, key, text, lang, weight, spread, margin).where("keep")
    return found.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def _judged(docs: DataFrame, labels: DataFrame, carry: list[str], key: str, text: str, lang: str,
            weight: int, spread: float, margin: float) -> DataFrame:
    """The columns of ``carry`` as c0, c1, ... and what ``judged`` says. The tables that it needs on the way go at the end."""
    spark = docs.sparkSession
    with scratch(spark):
        good = written(trusted_ids(labels, key).toDF("good", "held_out"), "trusted")
        ident, own_text = quoted(key).cast("long"), [] if text in carry else [text_of(text).alias("text")]
        text_name = "text" if own_text else f"c{carry.index(text)}"  # a text travels once
        carried = [f"c{i}" for i in range(len(carry))]
        named = docs.select(*[quoted(name).alias(f"c{i}") for i, name in enumerate(carry)], *own_text, ident.alias("id"),
                            F.coalesce(quoted(lang).cast("string"), F.lit("")).alias("own_language"))
        known = written(named.select("id", "own_language").join(good, F.col("id") == F.col("good")).select(
            "id", "own_language", "held_out"), "languages")
        if known.where("held_out").isEmpty():  # so few that none is held out: one is, so that there is a threshold
            one = known.agg(F.min("id")).head()[0]
            good, known = (x.withColumn("held_out", F.col(name) == F.lit(one)) for x, name in ((good, "good"), (known, "id")))
        served = written(known.groupBy("own_language").agg(F.count_if("held_out").alias("held"), F.count(F.lit(1)).alias("n")).where(
            "held > 0 AND n > held").select(F.col("own_language").alias("served")), "served")
        named = named.join(served, F.col("own_language") == F.col("served"), "left").withColumn(
            "model_of", F.coalesce("served", F.lit(POOLED))).withColumn("pooled_copy", F.lit(False))
        if not named.where("served IS NULL").isEmpty():  # trusted documents of the other languages count here, too
            copies = named.where("served IS NOT NULL").join(good.select("good"), F.col("good") == F.col("id"), "left_semi")
            named = named.unionByName(copies.withColumns({"model_of": F.lit(POOLED), "pooled_copy": F.lit(True)}))
        learnt = good.where("NOT held_out").select(F.col("good").alias("id"))
        found = scores(named, learnt, "id", text_name, "model_of", [*carried, "id", "own_language", "pooled_copy"])
        found = written(found, "scores", keep=True)
        held = found.join(good.where("held_out").select(F.col("good").alias("held")), F.col("id") == F.col("held"))
        loss = F.col("nll") / (F.col("n_bytes") + 1)
        medians = written(held.groupBy("model").agg(F.percentile_approx(loss, 0.5, 10000).alias("median")), "medians")
        excess = (loss - F.col("median")) * (F.col("n_bytes") + 1) / (F.col("n_bytes") + 1 + weight)
        over = held.join(medians, "model").groupBy("model").agg(F.percentile_approx(excess, [0.5, 0.9], 10000).alias("at"))
        limits = over.select(F.col("model").alias("of"), (F.col("at")[0] + F.greatest(
            F.lit(margin), spread * (F.col("at")[1] - F.col("at")[0]))).alias("threshold"))
        bounds = written(medians.join(limits, F.col("model") == F.col("of")).select("of", "median", "threshold"), "bounds", keep=True)
    marked = found.where("NOT pooled_copy").join(bounds, F.col("model") == F.col("of"), "left").withColumn("excess", excess)
    keep = (F.col("n_bytes") == 0) | F.coalesce(F.col("excess") <= F.col("threshold"), F.lit(True))
    return marked.select(*carried, "own_language", "n_bytes", F.exp(loss).alias("perplexity"), "excess", "threshold", keep.alias("keep"))
