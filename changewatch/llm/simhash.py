"""SimHash fingerprints and near-duplicates by covering locality-sensitive hashing (operator 6)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from changewatch.llm.common import gathered, mapped, scratch, slices, text_of, written
from changewatch.llm.components import components

SEED = 42
#: Buckets of more fingerprints than this are linked through shared neighbours, smaller ones pair by pair.
PAIRWISE = 32


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, repeats included; of the whole sequence if it has fewer; none without words.
    Words are runs of bytes other than ASCII white space, A-Z in lower case."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    hash64 = xxhash.xxh64_intdigest
    ends = ends.tolist()[size - 1:] or [len(joined)]
    return np.array([hash64(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes, as a signed 64-bit number; 0 without hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        own = np.ascontiguousarray(hashes[at:at + (1 << 14)].astype("<u8"))
        counts += np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and fingerprint (signed long) of every row. A null text is empty and has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text", 1 << 22):
            own = [simhash(shingle_hashes(value, size)) for value in texts]
            yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(own, pa.int64())], ["key", "fingerprint"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, run, f"key {kind}, fingerprint long").withColumnRenamed("key", key)


def as_signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def covering_masks(radius: int) -> list[int]:
    """Masks of 64 bits such that any two fingerprints within ``radius`` bits agree under one of them.

    Each bit has a nonzero vector of radius + 1 bits; each nonzero vector v makes the mask of the bits whose vectors have odd
    product with v. The vectors of ``radius`` differing bits span less than the whole space, so some v is
    orthogonal to all of them, and its mask leaves just those bits out."""
    vectors = (1 << radius + 1) - 1
    return [sum(1 << bit for bit in range(64) if (1 + bit % vectors & v).bit_count() & 1) for v in range(1, vectors + 1)]


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links a, b between distinct fingerprints (column ``fingerprint``) that join exactly those within ``radius`` bits, and
    those connected through them.

    A bucket, the fingerprints that agree under one mask, is linked pair by pair if it is small. In a large one, where pairs would grow with
    the square, fingerprints are linked through neighbours: two that differ in two free bits have a common neighbour at
    one bit from both, and two that differ in one are neighbours. So each is listed under itself and its one-bit
    neighbours, and all of an entry are linked to its smallest; for radius 2 that is exact."""
    if radius not in (1, 2):
        raise ValueError("the radius is 1 or 2")
    masks = [as_signed(mask) for mask in covering_masks(radius)]
    tables = F.array(*[F.struct(F.lit(i).alias("mask_no"), F.lit(mask).alias("mask")) for i, mask in enumerate(masks)])
    rows = distinct.select("fingerprint", F.explode(tables).alias("t")).select(
        F.col("t.mask_no").alias("mask_no"), F.col("t.mask").alias("mask"),
        F.col("fingerprint").bitwiseAND(F.col("t.mask")).alias("bucket"), "fingerprint")
    rows = written(rows, "buckets")
    n_rows = rows.count()
    sizes = written(gathered(rows.groupBy("mask_no", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), n_rows), "sizes")
    shared = written(gathered(rows.join(sizes, ["mask_no", "bucket"]), n_rows), "shared")
    small = shared.where(F.col("n") <= PAIRWISE)
    left = small.select("mask_no", "bucket", F.col("fingerprint").alias("b"))
    right = small.select("mask_no", "bucket", F.col("fingerprint").alias("a"))
    pairs = left.join(right, ["mask_no", "bucket"]).where((F.col("b") < F.col("a")) & (distance("a", "b") <= radius))
    bits = F.array(*[F.lit(as_signed(1 << bit)) for bit in range(64)])
    free = F.filter(bits, lambda bit: bit.bitwiseAND(F.col("mask")) == 0)
    near = F.concat(F.array(F.lit(0).cast("long")), free)
    entries = shared.where(F.col("n") > PAIRWISE).select("mask_no", "fingerprint", F.explode(near).alias("bit")).select(
        "mask_no", "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("bit")).alias("entry"))
    if radius == 1:  # an entry joins two that differ in two bits; only the entry's own fingerprint counts
        pairs = pairs.select("a", "b").union(entries.where("entry <> fingerprint").select(
            "mask_no", F.col("fingerprint").alias("a"), "entry").join(
            shared.select("mask_no", F.col("fingerprint").alias("entry")), ["mask_no", "entry"]).select(
            "a", F.col("entry").alias("b")))
        return pairs.distinct()
    firsts = entries.groupBy("mask_no", "entry").agg(F.min("fingerprint").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = written(gathered(firsts, 40 * n_rows), "firsts")
    starred = entries.join(firsts, ["mask_no", "entry"]).where(F.col("fingerprint") > F.col("b")).select(
        F.col("fingerprint").alias("a"), "b")
    return pairs.select("a", "b").union(starred).distinct()


def near_duplicates(docs: DataFrame, radius: int = 2, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint (16 hexadecimal digits) and component_id of every row: the smallest key that can be reached over
    fingerprints that differ in ``radius`` bits at most, its own included.

    Equal fingerprints count as one node, so copies cost nothing after the fingerprinting. Null and empty texts have fingerprint
    zero and are linked like any other; null keys keep their row and are never a component's id unless all its keys are null; repeated
    rows are kept; other columns are not looked at; an empty table gives an empty one."""
    marked = written(fingerprints(docs, size, key, text), "fingerprints")
    n_rows = marked.count()
    firsts = written(gathered(marked.groupBy("fingerprint").agg(F.min(key).alias("first")), n_rows), "distinct")
    found = written(gathered(components(links(firsts.select("fingerprint"), radius)), n_rows), "components")
    rooted = firsts.join(found, firsts["fingerprint"] == found["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    rooted = written(gathered(rooted, n_rows), "rooted")
    ids = written(gathered(rooted.groupBy("root").agg(F.min("first").alias("component_id")), n_rows), "ids")
    members = written(gathered(rooted.join(ids, "root").select("fingerprint", "component_id"), n_rows), "members")
    return marked.join(members, "fingerprint").select(
        key, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


SHINGLE = 5
SAMPLED = 20000  # documents, about, whose shingles are counted to tell which ones are common
COMMON = 1 << 18  # common shingles at most that all tasks are told of
BITS = 2048  # of a bitmap
TOLD = 1 << 20  # keys, 16 MB, that all tasks are told at most
SLACK = 1e-9  # so that rounding never leaves a pair out


def first_so_many(size: int, share: float) -> int:
    """How many of the first shingles of a set one must have in common with any set that shares ``share`` of it."""
    return size - math.ceil(share * size - SLACK) + 1 if size else 0


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that at least three of some SAMPLED documents have, ascending, and in how many of them they are. It holds COMMON at most, the
    commonest; it decides the order of shingles and thereby the work, never which pairs are found."""
    step = max(1, rows.count() // SAMPLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text", 1 << 20):
            own = [np.unique(shingle_hashes(value, SHINGLE)) for value in texts]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64))], ["shingle"])

    some = rows.where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0)
    counted = written(mapped(some, run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 2"), "common")
    sizes = counted.groupBy(F.least("n", F.lit(SAMPLED)).alias("n")).agg(F.count(F.lit(1)).alias("shingles")).collect()
    least, total = SAMPLED + 1, 0
    for row in sorted(sizes, key=lambda row: -row.n):
        total += row.shingles
        if total > COMMON:
            break
        least = row.n
    found = counted.where(F.col("n") >= least).toArrow()
    keys, counts = (found.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("shingle", "n"))
    keys = keys.astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], counts.astype(np.int64)[order]


def rare_first(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The distinct shingles of a text in an order that is the same for all texts: those not known as common by hash, then the common
    ones by their number."""
    own = np.unique(hashes)
    keys, counts = common
    if not len(keys) or not len(own):
        return own
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return own[np.lexsort((own, np.where(keys[at] == own, counts[at], 0)))]


def similar_groups(docs: DataFrame, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, group: the smallest key of the near-duplicates of each document that has any, over chains of pairs whose Jaccard
    similarity of five-word shingles is at least ``similarity``. No such pair is left out.

    Documents with equal sets of shingles are one. Prefix filter: with all shingles in one order, two similar sets meet in one of the first
    n - ceil(similarity n) + 1 of the larger and one of the first n - ceil(2 similarity / (1 + similarity) n) + 1 of the smaller one
    (the ``lead`` shingles). Rare ones come first, so what many documents have, as a template, is in neither unless they are little
    else. In each bucket, the documents of a shingle, every one is first compared with the one of the smallest key and the one that has the fewest
    rarer shingles: two pairs a row, which make one component of a family. Then components that meet in a bucket are compared by their roots, and
    opened if members can be similar in spite of how far the roots are apart; then the smaller one's members meet those of the larger one that
    share with them what sets both apart from its root. Before texts are read, a bitmap of each document tells
    most pairs that are not similar. What is left to cost the square are many components that meet in one bucket, of which only their roots'
    numbers are paired, and differences from a root that many share.

    Each pair is compared by all its shingles, as 32-bit hashes: what is found holds up to their collisions. Null keys have no group; null texts are
    empty; rows with one key are one document if their texts are alike."""
    if not 0 < similarity <= 1:
        raise ValueError("the similarity is above 0 and at most 1")
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    spark = docs.sparkSession
    with scratch(spark):
        equal, shared, bitmaps = shared_shingles(rows, similarity)
        linked, sets = close_to_heads(rows, shared, bitmaps, similarity)
        known = written(components(linked), "known")
        rest = rest_of_buckets(rows, shared, bitmaps, placed_members(known, sets), similarity)
        linked = rest.union(known.select(F.col("node").alias("a"), F.col("root").alias("b"))).union(equal)
        found = written(components(linked), "groups", keep=True)
    return found.select(F.col("node").alias(key), F.col("root").alias("group"))


def bitmap(hashes: np.ndarray) -> bytes:
    """Which of ``BITS`` places an odd number of distinct shingles falls in. Two sets differ in as many shingles at least as their
    bitmaps differ in bits."""
    return np.packbits(np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1).tobytes()


def shared_shingles(rows: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs a, b of documents with equal sets of shingles, b the first of them. Of the first of each, the prefix shingles that others have in
    theirs, too: bucket (the shingle), key, size, place in the order of its shingles, and whether it is a leading one; and key, size
    and bitmap."""
    spark = rows.sparkSession
    with scratch(spark):
        told = spark.sparkContext.broadcast(common_shingles(rows))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, texts in slices(batches, "text", 1 << 22):
            digests, sizes, leads, buckets, bitmaps = [], [], [], [], []
            for value in texts:
                ordered = rare_first(shingle_hashes(value, SHINGLE), told.value)
                digests.append(xxhash.xxh3_128_digest(ordered.tobytes()))
                sizes.append(len(ordered))
                leads.append(first_so_many(len(ordered), 2 * similarity / (1 + similarity)))
                buckets.append(ordered[:first_so_many(len(ordered), similarity)].view(np.int64))
                bitmaps.append(bitmap(ordered))
            yield pa.RecordBatch.from_arrays(
                [own.column("key"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(leads, pa.int32()),
                 pa.array(buckets, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary())],
                ["key", "digest", "size", "lead", "buckets", "bitmap"])

    with scratch(spark):
        with scratch(spark):
            marked = written(mapped(rows, mark, "key long, digest binary, size int, lead int, buckets array<bigint>, bitmap binary"), "marks")
            firsts = written(marked.groupBy("digest").agg(F.min("key").alias("first")), "firsts")
            pairs = written(marked.select("key", "digest").join(firsts, "digest").where("key <> first").select(
                F.col("key").alias("a"), F.col("first").alias("b")).distinct(), "pairs", keep=True)
            alone = written(marked.join(firsts.withColumnRenamed("first", "key"), ["digest", "key"], "left_semi"), "alone", keep=True)
        listed = alone.select("key", "size", "lead", F.posexplode("buckets").alias("place", "bucket")).select(
            "bucket", "key", "size", "place", (F.col("place") < F.col("lead")).alias("leads"))
        # of one key with several texts, rows of one bucket count as two here, which costs work only
        met = written(listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("leads").alias("any")).where(
            "n > 1 AND any").select("bucket"), "met")
        return (written(pairs, "equal", keep=True), written(listed.join(met, "bucket"), "shared", keep=True),
                written(alone.select("key", "size", "bitmap"), "bitmaps", keep=True))


def alike(a: str, b: str, similarity: float) -> Column:
    """Whether sizes leave room for the similarity."""
    return F.least(a, b) >= similarity * F.greatest(a, b) - SLACK


def in_order(found: DataFrame) -> DataFrame:
    """Distinct pairs a, b of key and other, the smaller one first."""
    return found.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()


def possible(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Those of the pairs a, b whose sets can have the similarity in their column ``least``, by their sizes and bitmaps: none that have is left
    out. 256 bytes of a document travel, not its set."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("x", "y"))
                differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                sizes = batch.column("n").to_numpy() + batch.column("m").to_numpy()
                least = batch.column("least").to_numpy()
                keep = (sizes - differ) / 2 >= least / (1 + least) * sizes - SLACK
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sides = pairs.join(bitmaps.select(F.col("key").alias("a"), F.col("size").cast("long").alias("n"), F.col("bitmap").alias("x")), "a").join(
        bitmaps.select(F.col("key").alias("b"), F.col("size").cast("long").alias("m"), F.col("bitmap").alias("y")), "b")
    return mapped(sides.select("a", "b", "least", "n", "m", "x", "y"), check, "a long, b long").distinct()


def close_to_heads(rows: DataFrame, shared: DataFrame, bitmaps: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Similar pairs a, b of which one is, in some bucket, the document of the smallest key or the one with the fewest rarer shingles; and the
    sets of all documents in them."""
    spark = rows.sparkSession
    with scratch(spark):
        ends = written(shared.groupBy("bucket").agg(
            F.min(F.struct("key", "size")).alias("low"),
            F.min(F.struct("place", "size", "key")).alias("core")).select("bucket", F.array(
                F.struct(F.col("low.key").alias("other"), F.col("low.size").alias("other_size")),
                F.struct(F.col("core.key").alias("other"), F.col("core.size").alias("other_size"))).alias("ends")), "ends")
        stars = shared.join(ends, "bucket").select("key", "size", F.explode("ends").alias("e")).select(
            "key", "size", "e.other", "e.other_size").where("key <> other").where(alike("size", "other_size", similarity))
        stars = written(in_order(stars).withColumn("least", F.lit(similarity)), "stars")
        stars = written(possible(stars, bitmaps), "possible")
        sets = written(sets_of(rows, stars), "shingles", keep=True)
        linked = similarities(stars, sets).where(F.col("similarity") >= similarity).select("a", "b")
        return written(linked, "linked", keep=True), sets


def placed_members(known: DataFrame, sets: DataFrame) -> DataFrame:
    """root, key, away: how far each member of a component is from its root, as 1 less their similarity; the root itself, too."""
    pairs = known.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    found = similarities(pairs, sets).select(F.col("b").alias("root"), F.col("a").alias("key"), (1 - F.col("similarity")).alias("away"))
    return written(found.union(known.where("node = root").select("root", F.col("root").alias("key"), F.lit(0.0))), "members")


def rest_of_buckets(rows: DataFrame, shared: DataFrame, bitmaps: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """Similar pairs a, b of documents that have a bucket in common, the smaller one's shingle a leading one, and are in different components.

    One less the similarity is a distance. Two members can be similar only if their roots are no further from each other than
    they are from the roots and from each other; so of all pairs of components that meet in a bucket few are opened. Of such a pair, the members
    of the smaller component are compared with the root of the larger one, the pivot. One that is similar to it joins the two. The
    others are compared with the members that share enough of what they differ from the pivot in, see ``sharing_differences``."""
    spark = rows.sparkSession
    near = 1 - similarity + SLACK
    with scratch(spark):
        placed = shared.join(members.select("key", "root"), "key", "left").select(
            "bucket", "size", "leads", F.coalesce("root", "key").alias("root"))
        heads = written(placed.groupBy("bucket", "root").agg(
            F.min("size").alias("least"), F.max("size").alias("most"),
            F.min(F.when(F.col("leads"), F.col("size"))).alias("lead_least")), "heads")
        left = heads.where("lead_least IS NOT NULL").select("bucket", F.col("root").alias("key"), "lead_least", F.col("most").alias("own_most"))
        right = heads.select("bucket", F.col("root").alias("other"), "least", "most")
        met = left.join(right, "bucket").where("key <> other").where(
            (F.col("lead_least") <= F.col("most")) & (F.col("own_most") >= similarity * F.col("least") - SLACK))
        radius = written(members.groupBy("root").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("many")), "radii")
        roots = in_order(met)
        for side in ("a", "b"):
            roots = roots.join(radius.select(F.col("root").alias(side), F.col("radius").alias(f"radius_{side}"),
                                             F.col("many").alias(f"many_{side}")), side, "left")
        roots = written(roots.select("a", "b", *[F.coalesce(f"{c}_{side}", F.lit(none)).alias(f"{c}_{side}")
                                                 for side in "ab" for c, none in (("radius", 0.0), ("many", 1))]), "roots")
        reach = near + F.col("radius_a") + F.col("radius_b")
        can_meet = written(possible(roots.withColumn("least", F.greatest(1 - reach, F.lit(0.0))), bitmaps), "can-meet")
        apart = similarities(can_meet, written(sets_of(rows, can_meet), "root-sets")).join(roots, ["a", "b"])
        apart = written(apart.withColumn("apart", 1 - F.col("similarity")).where(F.col("apart") <= reach), "apart")

        def facing(pivot: str, other: str) -> DataFrame:
            return apart.select(F.col(pivot).alias("pivot"), F.col(other).alias("root"), F.col(f"radius_{pivot}").alias("pivot_radius"), "apart",
                                (F.col("apart") - F.col(f"radius_{other}")).alias("least"), (F.col(f"many_{pivot}") - F.col(f"many_{other}")).alias("more"))

        faced = written(facing("a", "b").where("more >= 0").union(facing("b", "a").where("more > 0")), "facing")
        # all joins with the members are inner or semi joins of two tables, so that a large component can be split
        smaller = written(faced.select("root").distinct(), "smaller")
        alone = smaller.join(radius, "root", "left_anti").select("root", F.col("root").alias("key"), F.lit(0.0).alias("away"))
        facing_members = written(members.join(smaller, "root", "left_semi").union(alone), "facing-members")
        asking = faced.join(facing_members, "root").where(F.col("away") + F.col("pivot_radius") + near >= F.col("apart")).select(
            F.col("pivot").alias("a"), F.col("key").alias("b"), F.lit(True).alias("asks"))
        least = written(faced.groupBy(F.col("pivot").alias("root")).agg(F.min("least").alias("least")), "least")
        own = members.where("key <> root").join(least, "root").where(F.col("away") + near >= F.col("least")).select(
            F.col("root").alias("a"), F.col("key").alias("b"), F.lit(False).alias("asks"))
        pairs = written(asking.union(own).distinct(), "pivots")
        sets = written(sets_of(rows, pairs), "shingles")
        differing = written(differences(pairs, sets, similarity), "differences")
        joined = F.col("asks") & (F.col("similarity") >= similarity)
        rest = in_order(sharing_differences(differing.where(~joined))).withColumn("least", F.lit(similarity))
        rest = written(possible(rest, bitmaps), "rest")
        found = similarities(rest, sets).where(F.col("similarity") >= similarity).select("a", "b")
        return written(found.union(differing.where(joined).select("a", "b")), "rest-linked", keep=True)


def differences(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of pairs a, b: asks as it is, the similarity, the shingles that only one of the two has (differ), and of b how many more these are than its
    share of those that two similar sets may differ in (excess)."""
    share = (1 - similarity) / (1 + similarity)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, excess, differ = [], [], []
            for x, y in zip(batch.column("x"), batch.column("y")):
                left, right = (np.frombuffer(side.as_buffer(), "<u4") for side in (x, y))
                own = np.setxor1d(left, right, assume_unique=True)
                both = (len(left) + len(right) - len(own)) // 2
                found.append(both / max(1, both + len(own)))
                excess.append(len(own) - share * len(right))
                differ.append(own.view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("a", "b", "asks")), pa.array(found, pa.float64()), pa.array(excess, pa.float64()), pa.array(differ, pa.list_(pa.int32()))],
                ["a", "b", "asks", "similarity", "excess", "differ"])

    return mapped(both_sets(pairs, sets).select("a", "b", "asks", "x", "y"), compare,
                  "a long, b long, asks boolean, similarity double, excess double, differ array<int>")


def sharing_differences(differing: DataFrame) -> DataFrame:
    """key, other: all pairs of a document that asks and one that does not, of one pivot (a), that can be similar.

    What two sets differ in is what either differs from the pivot in, but for what both do. So they are similar if and only if twice the number of the
    differences that they share is at least the sum of their excesses, which is above zero where one is not similar to the pivot. So they
    share one at least, and what most of a family have in common with the pivot meets nothing. Differences of each stand in one order, those that fewest
    pairs share first; the first that two share has all the others behind it, and leaves that pair out if on either side too few are
    left. It holds for any pivot; of one far from the others, what all differ from it in comes last."""
    spread = differing.select("a", F.col("b").alias("key"), "asks", "excess", F.explode("differ").alias("shingle"))
    met = spread.groupBy("a", "shingle").agg(
        F.count_if("asks").alias("asking"), F.count_if(~F.col("asks")).alias("asked"),
        F.min(F.when(F.col("asks"), F.col("excess"))).alias("least_asking"),
        F.min(F.when(~F.col("asks"), F.col("excess"))).alias("least_asked")).where("asking > 0 AND asked > 0")
    ordered = spread.join(written(met, "met"), ["a", "shingle"]).groupBy("a", "key", "asks").agg(F.min("excess").alias("excess"), F.sort_array(F.collect_list(F.struct(
        (F.col("asking") * F.col("asked")).alias("pairs"), "shingle",
        F.when(F.col("asks"), F.col("least_asked")).otherwise(F.col("least_asking")).alias("least")))).alias("own"))
    placed = ordered.select("a", "key", "asks", "excess", F.size("own").alias("n"), F.posexplode("own").alias("place", "at")).select(
        "a", "key", "asks", "excess", "at.shingle", (F.col("n") - F.col("place")).alias("left"), "at.least")
    placed = written(placed.where(F.col("excess") + F.col("least") <= 2 * F.col("left") + SLACK).drop("least"), "differing")
    asking = placed.where("asks").drop("asks")
    asked = placed.where("NOT asks").select("a", "shingle", F.col("key").alias("other"), F.col("excess").alias("other_excess"), F.col("left").alias("other_left"))
    return asking.join(asked, ["a", "shingle"]).where(
        F.col("excess") + F.col("other_excess") <= 2 * F.least("left", "other_left") + SLACK).select("key", "other")


def sets_of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, shingles (ascending 32-bit hashes) of all keys in the pairs. Up to ``TOLD`` keys are told to all tasks, so that texts need not
    travel; more are met by a shuffle."""
    asked = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    if asked.count() <= TOLD:
        asked = F.broadcast(asked)
    wanted = rows.join(asked, "key", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, texts in slices(batches, "text", 1 << 22):
            found = [np.unique(shingle_hashes(value, SHINGLE) >> np.uint64(32)).astype("<u4").tobytes() for value in texts]
            yield pa.RecordBatch.from_arrays([own.column("key"), pa.array(found, pa.binary())], ["key", "shingles"])

    return mapped(wanted, sets, "key long, shingles binary").dropDuplicates(["key"])


def both_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs a, b with the sets of both, x and y."""
    return pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, similarity: the Jaccard similarity of the sets of each pair."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                left, right = (np.frombuffer(side.as_buffer(), "<u4") for side in (x, y))
                both = len(np.intersect1d(left, right, assume_unique=True))
                found.append(both / max(1, len(left) + len(right) - both))
            yield batch.select(["a", "b"]).append_column("similarity", pa.array(found, pa.float64()))

    return mapped(both_sets(pairs, sets).select("a", "b", "x", "y"), compare, "a long, b long, similarity double")


def one_of_each(docs: DataFrame, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without those that have a near-duplicate with a smaller key in their group: the components of ``near_duplicates``, by
    SimHash, joined with the groups of ``similar_groups``, which adds the pairs that fingerprints leave out. Rows with null keys stay,
    rows that share a key stay or go together."""
    with scratch(docs.sparkSession):
        rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key IS NOT NULL")
        sketched = near_duplicates(rows, key="key").select(F.col("key").alias("a"), F.col("component_id").alias("b")).where("a <> b")
        similar = similar_groups(docs, similarity, key=key, text=text).select(F.col(key).alias("a"), F.col("group").alias("b"))
        later = components(sketched.union(similar.where("a <> b"))).where("node > root").select(F.col("node").alias(key))
        later = written(later, "later", keep=True)
    return docs.join(later, docs[key] == later[key], "left_anti")
