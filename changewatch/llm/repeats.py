"""Removal of repeated passages by longest previous factors in suffix order (operator 3).

A passage of ``size`` bytes that starts in a document with a smaller id is removed wherever it occurs again. Passages are compared
through anchors: the smallest hash of the short strings inside a passage. Equal passages have equal anchors, so

1. every chunk of documents names the anchors of all its passages, one per run of neighbouring passages;
2. per anchor it is found out whether two documents have it, which few have;
3. chunks send the runs of shared anchors, as bytes, to where the anchor's hash belongs;
4. there the suffixes of all runs are put in order. The previous and the next one of a smaller document in that order share the longest
   prefixes with a suffix that any smaller document has: the longer is its longest previous factor, up to the end of the run;
5. where the factor has ``size`` bytes or more the chunks cut the passage out. The first document keeps its own.

A chunk is named by the hash of the document's id and has a bounded size, as have the buckets of anchors. Equal runs in a chunk are sent
once, from the smallest document, and of equal runs in a bucket one is put in order. Runs have 2 * ``size`` passages at most. Anchors of very many
runs are dealt on by single passages, so no passage, however frequent, makes a large bucket. Exact copies of a document are found by
their digest beforehand.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from changewatch.llm.common import mapped, quoted, ship, text_of, tidy, total_bytes, written

LAST = np.iinfo(np.int64).max  # stands for a null id
CHUNK, BUCKET = 4 << 20, 16 << 20  # bytes of text behind a chunk and a bucket of anchors
FINE = 16  # parts of a bucket that are put in suffix order one after the other
SEGMENT = 1 << 18
MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
COPIES, ANCHORS, SPANS = 0, 1, 2


def loads(data: np.ndarray, count: int, step: int = 0) -> np.ndarray:
    """The 8 bytes from each of ``count`` positions on, big-endian, so that numbers sort like bytes."""
    return np.ndarray(count, ">u8", data, step, (1,)).astype(np.uint64)


def mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(32))
    value *= MIX[1]
    value ^= value >> np.uint64(29)
    return value


def string_hashes(data: np.ndarray, length: int, count: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each of ``count`` positions on."""
    total = np.zeros(count, np.uint64)
    for i, at in enumerate([*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]):
        total = mixed(total + loads(data, count, at) * MIX[i % 4]) if i else loads(data, count, 0) * MIX[0]
    return mixed(total)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def anchor_length(size: int) -> int:
    return max(8, min(24, size - 1))


def runs(data: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Anchor, document number, first passage and number of passages of every run of passages with one anchor, of documents laid end
    to end in ``data`` with ``ends``."""
    length = anchor_length(size)
    found: list[tuple[np.ndarray, ...]] = []
    for first in range(0, len(data) - size + 1, SEGMENT):
        count = min(SEGMENT, len(data) - size + 1 - first)
        part = data[first:first + count + size - 1]
        anchors = sliding_minimum(string_hashes(part, length, len(part) - length + 1), size - length + 1)
        position = np.arange(first, first + count)
        document = np.searchsorted(ends, position, side="right")
        inside = position + size <= ends[document]
        starts = np.empty(count, bool)
        starts[0] = True
        starts[1:] = (anchors[1:] != anchors[:-1]) | (document[1:] != document[:-1]) | (inside[1:] != inside[:-1])
        at = np.flatnonzero(starts)
        lengths = np.diff(np.append(at, count))
        if len(lengths) and lengths.max() > 2 * size:  # text of a short period: runs are cut, so that suffixes end
            parts = -(-lengths // (2 * size))
            inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            at, lengths = np.repeat(at, parts) + 2 * size * inner, np.minimum(np.repeat(lengths, parts) - 2 * size * inner, 2 * size)
        keep = inside[at]
        found.append((anchors[at][keep], document[at][keep], position[at][keep], lengths[keep]))
    if not found:
        return tuple(np.zeros(0, kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def words_at(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next up to 8 bytes from each of the positions ``at`` as numbers that sort like bytes, zeros behind the ends that are ``left``
    bytes away, and how many of them are text. ``data`` goes on for 8 bytes behind the last end."""
    known = np.clip(left, 0, 8)
    words = loads(data, len(data) - 7)[np.minimum(at, len(data) - 8)]
    shift = np.uint64(8) * (8 - known).astype(np.uint64)
    return np.where(known > 0, words >> (shift & np.uint64(63)) << (shift & np.uint64(63)), np.uint64(0)), known


def suffix_order(data: np.ndarray, starts: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that begin at ``starts`` and end ``left`` bytes on, as an array of their numbers in the order of their bytes (of two the
    one that ends first is the smaller), and the common prefix of each with the one before it there (0 for the first).

    Suffixes that are alike so far are ordered by their next 8 bytes until none are left; they must have a bounded length."""
    count = len(starts)
    order, common = np.arange(count), np.zeros(count, np.int64)
    tied = np.arange(count)  # places in the order that are not settled, in groups of neighbours
    group = np.zeros(count, np.int64)
    depth = 0
    while len(tied):
        own = order[tied]
        words, known = words_at(data, starts[own] + depth, left[own] - depth)
        inside = np.lexsort((known, words, group)) if depth else np.lexsort((known, words))
        own, words, known = own[inside], words[inside], known[inside]
        order[tied] = own
        joined = np.append(False, group[1:] == group[:-1])
        differs = np.append(np.uint64(0), words[1:] ^ words[:-1])
        both = np.append(0, np.minimum(known[1:], known[:-1]))
        # equal leading bytes of two words: 7 less the number of the highest byte that differs
        high = np.zeros(len(tied), np.int64)
        for power in (4, 2, 1):
            step = differs >> np.uint64(8 * power) > 0
            differs = np.where(step, differs >> np.uint64(8 * power), differs)
            high += power * step
        equal = np.minimum(np.where(differs > 0, 7 - high, 8), both)
        common[tied[joined]] = depth + equal[joined]
        same = joined & (equal == 8)  # the same 8 bytes as the one before, and both may go on
        within = same | np.append(same[1:], False)
        tied, group = tied[within], np.cumsum(~same)[within]
        depth += 8
    return order, common


def nearest_smaller(positions: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each place of a suffix order the prefix it has in common with the last one before it of a smaller position, 0 if none.

    All places step back together from candidate to candidate; what lies between is not smaller, so steps double in length. The least
    common prefix on the way is kept along."""
    count = len(positions)
    candidate = np.arange(-1, count)
    candidate[0] = candidate[-1] = count  # stands before the first
    least = np.append(common, 0)
    least[0] = 0
    positions = np.append(positions, 0)
    moving = np.arange(count)
    while len(moving := moving[(candidate[moving] < count) & (positions[candidate[moving]] >= positions[moving])]):
        at = candidate[moving]
        shared, further = np.minimum(least[moving], least[at]), candidate[at]
        least[moving], candidate[moving] = shared, further
    return np.where(candidate == count, 0, least)[:count]


def longest_previous_factors(data: np.ndarray, starts: np.ndarray, left: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """For each of the suffixes at ``starts``, ending ``left`` bytes on, the length of its longest prefix that also begins a suffix of
    a smaller document: the larger of what it shares with the previous and with the next smaller one in suffix order. Of all
    smaller ones those two are nearest, so none shares more."""
    order, common = suffix_order(data, starts, left)
    positions = documents[order]
    before = nearest_smaller(positions, common)
    after = nearest_smaller(positions[::-1], np.append(0, common[:0:-1]) if len(common) else common)[::-1]
    factors = np.empty(len(starts), np.int64)
    factors[order] = np.maximum(before, after)
    return factors


def later_runs(data: np.ndarray, at: np.ndarray, begins: np.ndarray, lengths: np.ndarray, documents: np.ndarray, size: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the pieces ``at``, which stand at ``begins`` in ``data``: piece, start and end in it of every run of bytes covered by
    passages that also start in a smaller document. Suffixes shorter than a passage are left out of the order."""
    own = np.zeros(lengths.sum() + 8, np.uint8)
    starts = np.cumsum(lengths) - lengths
    own[:-8] = data[np.repeat(begins - starts, lengths) + np.arange(lengths.sum())]
    count = lengths - size + 1
    windows = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(count.sum())
    piece = np.repeat(np.arange(len(at)), count)
    left = (starts + lengths)[piece] - windows
    later = longest_previous_factors(own, windows, left, documents[piece]) >= size
    heads = np.flatnonzero(np.append(True, (later[1:] != later[:-1]) | (piece[1:] != piece[:-1]))[:len(later)])
    tails = np.append(heads[1:], len(later))
    heads, tails = heads[later[heads]], tails[later[heads]]
    owner = piece[heads]
    return at[owner], windows[heads] - starts[owner], windows[tails - 1] - starts[owner] + size


class Chunk:
    """The documents of a chunk in the order of id and text, and what is known of them: exact copies of smaller documents,
    shared anchors, spans to remove (number of the document here, start, end)."""

    def __init__(self, docs: pa.Table, notes: pa.Table):
        tidy()
        texts = [text.encode() for text in docs.column("text").to_pylist()]
        ids = docs.column("id").to_pylist()
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.texts = [texts[i] for i in self.order]
        self.ids = np.array([ids[i] for i in self.order], np.int64)
        kinds, lists = notes.column("kind").to_pylist(), notes.column("values").to_pylist()

        def pick(kind: int, width: int) -> np.ndarray:
            return np.array([v for k, own in zip(kinds, lists) if k == kind for v in own], np.int64).reshape(-1, width)

        self.shared, self.spans = pick(ANCHORS, 2), pick(SPANS, 3)
        known = set(map(tuple, pick(COPIES, 2).tolist()))
        candidates = {ident for ident, _ in known}
        self.copy = np.array([ident in candidates and (ident, digest(text)) in known
                              for ident, text in zip(self.ids.tolist(), self.texts)], bool)

    def laid_out(self) -> tuple[np.ndarray, np.ndarray]:
        """All bytes end to end, copies left empty, and the ends."""
        texts = [b"" if copy else text for text, copy in zip(self.texts, self.copy)]
        data = np.frombuffer(b"".join([*texts, bytes(8)]), np.uint8)[:-8]
        return data, np.cumsum([len(text) for text in texts], dtype=np.int64)


def digest(text: bytes) -> int:
    """As Spark's xxhash64 of the SHA-256 of a text."""
    number = xxhash.xxh64_intdigest(hashlib.sha256(text).digest(), 42)
    return number - (1 << 64) if number >> 63 else number


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by bucket and (bucket, first, last) of each."""
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    heads = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    return order, list(zip(own[heads].tolist(), heads.tolist(), np.append(heads[1:], len(own)).tolist()))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def spans(docs: DataFrame, size: int = 50, key: str = "doc_id", text: str = "text", hot: int = 2000,
          carry: list[str] | None = None, cut: bool = False) -> DataFrame:
    """Per row: key, text (null as empty), removed, an array of (start, end) of maximal removed runs in bytes, and the columns
    named in ``carry``. To ``cut`` gives the texts as ``cut_text`` does instead of the runs, in the same task: with a second
    function behind it each task would take two Python workers, which then all stay with the executor.

    Judged on the input; ids that are equal are not smaller; a null id counts as larger than all others and as equal to other nulls.
    Texts shorter than ``size`` lose nothing. Repeated rows have one id and keep their text alike. Other columns are not looked
    at; an empty table gives an empty one. ``hot`` runs of one anchor are dealt on by passage; results don't depend on it."""
    if size < 9:
        raise ValueError("passages have 9 bytes at least")
    spark = docs.sparkSession
    ship(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = total_bytes(docs, text)
    chunks, buckets = max(least, -(-total // CHUNK)), max(least, -(-total // BUCKET))

    ident = F.coalesce(F.col("key").cast("long"), F.lit(int(LAST)))
    carry = carry or []
    carried = [f"c{i}" for i in range(len(carry))]
    named = docs.select(F.col(key).alias("key"), text_of(text).alias("text"),
                        *[quoted(c).alias(f"c{i}") for i, c in enumerate(carry)]).select(
        "key", ident.alias("id"), "text", *carried, F.pmod(F.xxhash64(ident, F.when(F.col("key").isNull(), F.col("text"))), F.lit(chunks))
        .alias("chunk"))
    digests = named.select("id", "chunk", F.unhex(F.sha2("text", 256)).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("id").alias("first"))
    firsts = written(firsts, "firsts")
    copies = digests.join(firsts, "digest").where(F.col("id") > F.col("first")).groupBy("chunk").agg(
        F.flatten(F.collect_set(F.array("id", F.xxhash64("digest")))).alias("values"))
    copies = written(copies.select("chunk", F.lit(COPIES).alias("kind"), "values"), "copies")
    note = "chunk long, kind int, values array<bigint>"
    note_names = ["chunk", "kind", "values"]

    def tables(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
        return pa.table([pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names)

    def name_anchors(key: tuple[pa.Scalar, ...], own: pa.Table, notes: pa.Table) -> pa.Table:
        chunk = Chunk(own, notes)
        anchors, document, _, _ = runs(*chunk.laid_out(), size)
        order = np.lexsort((document, anchors))
        anchors, document = anchors[order], chunk.ids[document[order]]
        heads = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])) if len(anchors) else np.zeros(0, np.int64)
        several = np.append(False, (anchors[1:] == anchors[:-1]) & (document[1:] != document[:-1])) if len(anchors) else anchors
        counts = np.diff(np.append(heads, len(anchors)))
        several = np.add.reduceat(several, heads) > 0 if len(heads) else several
        counts = np.where(several, np.maximum(counts, 2), 1)  # 1 stands for one document
        anchors = anchors[heads]
        order, parts = by_bucket((anchors % np.uint64(buckets)).astype(np.int64))
        values, counts = signed(anchors)[order], counts[order].astype(np.int32)
        return tables([(bucket, key[0].as_py(), values[a:b], counts[a:b]) for bucket, a, b in parts],
                      ["bucket", "chunk", "anchors", "counts"],
                      [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())])

    def find_shared(own: pa.Table) -> pa.Table:
        tidy()
        lists = own.column("anchors").combine_chunks()
        anchors = lists.flatten().to_numpy()
        counts = own.column("counts").combine_chunks().flatten().to_numpy()
        chunk = np.repeat(own.column("chunk").to_numpy(), lists.value_lengths().to_numpy())
        order = np.argsort(anchors, kind="stable")
        sorted_anchors = anchors[order]
        heads = np.flatnonzero(np.append(True, sorted_anchors[1:] != sorted_anchors[:-1]))
        sums = np.add.reduceat(counts[order].astype(np.int64), heads)
        sums = np.repeat(sums, np.diff(np.append(heads, len(anchors))))
        keep = sums > 1
        at = order[keep]
        pairs = np.stack([anchors[at], (sums[keep] > hot).astype(np.int64)], 1)
        order, parts = by_bucket(chunk[at])
        pairs = pairs[order]
        return tables([(key, ANCHORS, pairs[a:b].ravel()) for key, a, b in parts], note_names,
                      [pa.int64(), pa.int32(), pa.list_(pa.int64())])

    def send_runs(key: tuple[pa.Scalar, ...], own: pa.Table, notes: pa.Table) -> pa.Table:
        chunk = Chunk(own, notes)
        number = key[0].as_py()
        data, ends = chunk.laid_out()
        shared = chunk.shared[np.argsort(chunk.shared[:, 0])]
        anchors, document, start, count = runs(data, ends, size)
        at = np.searchsorted(shared[:, 0], signed(anchors))
        at[at == len(shared)] = 0
        keep = shared[at, 0] == signed(anchors) if len(shared) else np.zeros(len(anchors), bool)
        anchors, document, start, count, many = (x[keep] for x in (anchors, document, start, count, shared[at, 1] if len(shared) else anchors))
        bucket = (anchors % np.uint64(buckets * FINE)).astype(np.int64)
        singles = np.flatnonzero(many == 1)
        if len(singles):  # hot anchors: every passage on its own, dealt by its own hash
            inner = np.concatenate([np.arange(s, s + n) for s, n in zip(start[singles], count[singles])])
            padded = np.append(data, np.zeros(8, np.uint8))
            own_hash = np.concatenate([string_hashes(padded[s:s + n + size + 7], size, n) for s, n in zip(start[singles], count[singles])])
            rest = many != 1
            document = np.append(document[rest], np.repeat(document[singles], count[singles]))
            start, count = np.append(start[rest], inner), np.append(count[rest], np.ones(len(inner), np.int64))
            bucket = np.append(bucket[rest], (own_hash % np.uint64(buckets * FINE)).astype(np.int64))
        bucket, fine = np.divmod(bucket, FINE)
        ids = chunk.ids
        order = np.lexsort((start, document, fine, bucket))
        begins = np.append(0, ends)[document]
        raw = data.tobytes()
        first: dict[bytes, list] = {}
        local: list[int] = []
        rows, last = [], None
        contents: list[bytes] = []
        parts: list[int] = []
        uses: list[int] = []

        def flush() -> None:
            if contents:
                rows.append((last, number, b"".join(contents), np.array([len(c) for c in contents], np.int32),
                             np.array(parts, np.int8), np.array(uses, np.int64)))

        for b, f, at, d, s, n, begin in zip(
                *(x[order].tolist() for x in (bucket, fine, document, ids[document], start, count, begins))):
            if b != last:
                flush()
                last, contents, parts, uses, first = b, [], [], [], {}
            piece = raw[s:s + n + size - 1]
            seen = first.get(piece)
            if seen is None:
                first[piece] = seen = [d, len(contents)]
                contents.append(piece)
                parts.append(f)
            if seen[0] == d:
                uses += (seen[1], d, at, s - begin)
            else:
                local += (at, s - begin, s - begin + n + size - 1)
        flush()
        if local:
            rows.append((-1 - number, number, b"", [], [], np.array(local, np.int64)))
        return tables(rows, ["bucket", "chunk", "contents", "lengths", "parts", "uses"],
                      [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int8()), pa.list_(pa.int64())])

    def find_copies(key: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        tidy()
        bucket = key[0].as_py()
        chunk = own.column("chunk").to_numpy()
        uses = own.column("uses").combine_chunks()
        if bucket < 0:
            return tables([(int(chunk[0]), SPANS, uses.flatten().to_numpy())], note_names,
                          [pa.int64(), pa.int32(), pa.list_(pa.int64())])
        lengths = own.column("lengths").combine_chunks()
        part_of = own.column("parts").combine_chunks().flatten().to_numpy()
        pieces = lengths.flatten().to_numpy().astype(np.int64)
        per_row, uses_per_row = lengths.value_lengths().to_numpy(), uses.value_lengths().to_numpy() // 4
        use_chunk = np.repeat(chunk, uses_per_row)
        which, ident, number, place = uses.flatten().to_numpy().reshape(-1, 4).T
        which = which + np.repeat(np.cumsum(per_row) - per_row, uses_per_row)
        # equal pieces are ordered once, for the smallest document; those of other documents go whole
        known: dict[bytes, int] = {}
        same = np.empty(len(pieces), np.int64)
        firsts, piece = [], 0
        for blob, sizes in zip(own.column("contents").to_pylist(), lengths.to_pylist()):
            begin = 0
            for length in sizes:
                content = blob[begin:begin + length]
                at = known.setdefault(content, len(known))
                if at == len(firsts):
                    firsts.append(piece)
                same[piece] = at
                begin += length
                piece += 1
        data = np.frombuffer(b"".join(known), np.uint8)
        firsts = np.array(firsts, np.int64)
        pieces, part_of, which = pieces[firsts], part_of[firsts], same[which]
        begins = np.cumsum(pieces) - pieces
        smallest = np.full(len(pieces), LAST)
        np.minimum.at(smallest, which, ident)
        spans_of = [later_runs(data, at, begins[at], pieces[at], smallest[at], size)
                    for at in (np.flatnonzero(part_of == part) for part in range(FINE)) if len(at)]
        owner, low, high = (np.concatenate(column) for column in zip(*spans_of))
        order = np.argsort(owner, kind="stable")
        owner, low, high = owner[order], low[order], high[order]
        # every use of the piece by its smallest document gets them
        whole = ident > smallest[which]
        copied = np.stack([number, place, place + pieces[which]], 1)[whole]
        copied_chunk, use_chunk, which, number, place = use_chunk[whole], *(x[~whole] for x in (use_chunk, which, number, place))
        first, last = np.searchsorted(owner, which, side="left"), np.searchsorted(owner, which, side="right")
        times = last - first
        at = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())
        found = np.stack([np.repeat(number, times), np.repeat(place, times) + low[at], np.repeat(place, times) + high[at]], 1)
        found = np.concatenate([copied, found])
        order, parts = by_bucket(np.append(copied_chunk, np.repeat(use_chunk, times)))
        found = found[order]
        return tables([(key, SPANS, found[a:b].ravel()) for key, a, b in parts], note_names,
                      [pa.int64(), pa.int32(), pa.list_(pa.int64())])

    def join_spans(own: pa.Table, notes: pa.Table) -> pa.Table:
        chunk = Chunk(own, notes)
        found = chunk.spans[np.lexsort((chunk.spans[:, 1], chunk.spans[:, 0]))]
        firsts = np.searchsorted(found[:, 0], np.arange(len(chunk.ids) + 1))
        removed: list[list[dict]] = [[] for _ in chunk.ids]
        for i, text in enumerate(chunk.texts):
            if chunk.copy[i]:
                removed[i] = [{"start": 0, "end": len(text)}] if len(text) >= size else []
                continue
            merged: list[dict] = []
            for _, low, high in found[firsts[i]:firsts[i + 1]].tolist():
                if merged and low <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], high)
                else:
                    merged.append({"start": low, "end": high})
            removed[i] = merged
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        own = own.take(pa.array(chunk.order, pa.int64()))
        if cut:
            texts = [cut_text(text, gone) if gone else text for text, gone in zip(own.column("text").to_pylist(), removed)]
            return pa.table([own.column("key"), pa.array(texts, pa.string()), *map(own.column, carried)], ["key", "text", *carried])
        return pa.table([own.column("key"), own.column("text"), pa.array(removed, span), *map(own.column, carried)],
                        ["key", "text", "removed", *carried])

    def by(df: DataFrame):
        return df.groupBy("chunk")

    anchors = by(named).cogroup(by(copies)).applyInArrow(
        name_anchors, "bucket long, chunk long, anchors array<bigint>, counts array<int>")
    shared = anchors.groupBy("bucket").applyInArrow(find_shared, note)
    sent = by(named).cogroup(by(shared.union(copies))).applyInArrow(
        send_runs, "bucket long, chunk long, contents binary, lengths array<int>, parts array<tinyint>, uses array<bigint>")
    found = sent.groupBy("bucket").applyInArrow(find_copies, note)
    kinds = {name: named.schema[name].dataType.simpleString() for name in ("key", *carried)}
    others = "".join(f", {name} {kinds[name]}" for name in carried)
    told = "" if cut else ", removed array<struct<start:bigint,end:bigint>>"
    joined = by(named).cogroup(by(found.union(copies))).applyInArrow(join_spans, f"key {kinds['key']}, text string{told}{others}")
    return joined.select(F.col("key").alias(key), "text", *([] if cut else ["removed"]), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])


def cut_bytes(text: str | bytes, removed: list) -> bytes:
    data = text.encode() if isinstance(text, str) else text
    parts, at = [], 0
    for span in removed:
        parts.append(data[at:span["start"]])
        at = span["end"]
    return b"".join([*parts, data[at:]])


def cut_text(text: str, removed: list) -> str:
    """The text without the characters that lie wholly in removed spans, so that what stays is text."""
    data = text.encode()
    parts, at = [], 0
    for span in removed:
        start, end = span["start"], span["end"]
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]]).decode()


def shortened(docs: DataFrame, size: int = 50, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """All columns of documents with the texts shortened and, if there is such a column, their length in characters. Only whole
    characters are taken out; a text may end up empty, its row stays."""
    others = [c for c in docs.columns if c not in (key, text)]
    cut = spans(docs, size, key, text, carry=others, cut=True).toDF(key, text, *others)
    if length in others:
        cut = cut.withColumn(length, F.length(text).cast(cut.schema[length].dataType))
    return cut.select(*map(quoted, docs.columns))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``spans``: key, n_bytes, n_removed, n_spans and kept_sha256, of the bytes that stay."""

    def run(batches):
        for batch in batches:
            rows = batch.select(["text", "removed"]).to_pylist()
            sizes = [len(row["text"].encode()) for row in rows]
            kept = [cut_bytes(row["text"], row["removed"]) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()),
                 pa.array([n - len(k) for n, k in zip(sizes, kept)], pa.int64()),
                 pa.array([len(row["removed"]) for row in rows], pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = found.withColumnRenamed(key, "key")
    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, run, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                  ).withColumnRenamed("key", key)
