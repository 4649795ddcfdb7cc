"""Document fingerprints by one-permutation MinHash, in DataFrame expressions only (operator 4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.llm.common import text_of, with_next, written

BINS_LOG2 = 7
BINS = 1 << BINS_LOG2
BITS = 8  # kept of each bin, two hexadecimal digits
WORDS = 5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """A hash for each run of five words, of the whole sequence if it has fewer (so never none). Words are runs of characters
    other than ASCII white space."""
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda word: word != "")
    return let(F.transform(words, lambda word: F.xxhash64(word)), lambda hashes: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(hashes) - (WORDS - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WORDS)))))


def bin_of(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BINS_LOG2)


def fingerprint(text: Column) -> Column:
    """The packed low-order bits of the smallest hash of each bin, as hexadecimal digits.

    Each shingle is hashed once; the high bits are its bin. Sorted hashes stand bin by bin, smallest first. An empty bin
    takes the value of a filled one: each bin has a random order of all bins, by a hash of the pair, and takes the first that is
    filled, which needs no shifts and treats all filled bins alike (optimal densification). The kept bits are of the value
    hashed with the bin, so that bins that share a value don't agree by chance all at once."""

    def minima(hashes: Column) -> Column:
        return let(F.sort_array(hashes), lambda own: F.filter(
            own, lambda value, i: (i == 0) | (bin_of(value) != bin_of(F.get(own, i - 1)))))

    def donor(bins: Column, empty: Column) -> Column:
        order = F.transform(bins, lambda filled: F.xxhash64(empty, filled))
        return let(order, lambda own: F.array_position(own, F.array_min(own)))

    def packed(own: Column) -> Column:
        return let(F.transform(own, bin_of), lambda bins: F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), lambda i: let(
                F.array_position(bins, i), lambda at: F.lpad(F.hex(F.xxhash64(F.get(own, F.when(
                    at > 0, at).otherwise(donor(bins, i)).cast("int") - 1), i).bitwiseAND((1 << BITS) - 1)), 2, "0"))), ""))

    return let(minima(shingle_hashes(text)), packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingles of two texts, from their fingerprints. Bins that differ agree in their
    kept bits once in 2**BITS times; that is taken off. Null if one is null."""
    digits = BITS // 4
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substring(a, i * digits + 1, F.lit(digits))
                           == F.substring(b, i * digits + 1, F.lit(digits))))
    chance = 2.0 ** -BITS
    estimate = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return F.when(a.isNotNull() & b.isNotNull(), estimate)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and fingerprint of every row; a null text is empty; equal texts have equal fingerprints; other columns are
    not looked at; an empty table gives an empty one."""
    return docs.select(key, fingerprint(text_of(text)).alias("fingerprint"))


def with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of its text with the last quarter of the characters replaced by as many (or all) from
    the start of the next document, by ascending key, after the last the first; and their likenesses.

    Only the borrowed starts travel to the documents, and both joins read one shuffle of the documents. Rows that share
    a key count as one document to their predecessor: the smallest start, the smallest fingerprint. A null key has no
    successor: nothing is borrowed, near_next is null. Null texts are empty. An only document follows itself."""
    rows = docs.select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    known = rows.where(F.col("id").isNotNull())
    following = written(with_next(docs.select(key), key, "next").withColumnRenamed(key, "id"), "following")
    quarter = F.floor(F.length("text") / 4).cast("int")
    wanted = known.select("id", quarter.alias("n")).groupBy("id").agg(F.max("n").alias("n")).join(following, "id")
    wanted = wanted.select(F.col("id").alias("asker"), F.col("next"), "n")
    starts = known.join(wanted, F.col("id") == F.col("next")).groupBy("asker").agg(
        F.min(F.substring("text", F.lit(1), F.col("n"))).alias("start"))
    joined = known.join(starts, F.col("id") == F.col("asker"), "left").select("id", "text", "start").union(
        rows.where(F.col("id").isNull()).select("id", "text", F.lit(None).cast("string")))
    kept = F.substring("text", F.lit(1), F.length("text") - quarter)
    edited = F.concat(kept, F.substring(F.coalesce("start", F.lit("")), F.lit(1), quarter))
    marked = joined.withColumn("edited", edited).select(
        "id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    marked = written(marked, "fingerprints")
    heads = marked.groupBy("id").agg(F.min("fingerprint").alias("next_fingerprint"))
    successors = following.join(heads.withColumnRenamed("id", "next"), "next").select("id", "next_fingerprint")
    return marked.join(successors, "id", "left").select(
        F.col("id").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
