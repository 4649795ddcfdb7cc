"""Packing of documents into sequences of fixed length (operator 5)."""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from struct import pack as packed

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from changewatch.llm.common import held, mapped, text_of, written

Layout = list[tuple[list[int], int]]


#: The steps of a file under which a word of Latin letters alone, in lower case, is one unit and stays as it is but for its bytes' names.
LETTERS_STAY = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def of_letters(file: Tokenizer) -> Tokenizer:
    """What gives words of Latin letters, in lower case and with a space between them, the ids that ``file`` gives them: the file's
    model after a cut at spaces where the file's other steps do nothing else to such words, and the file itself where they may."""
    steps = json.loads(file.to_str())
    if any(steps[name] != own for name, own in LETTERS_STAY.items()) or steps["post_processor"] or not all(
            token["content"].startswith("<|") for token in steps["added_tokens"]):
        return file
    model = steps["model"]
    if model["type"] != "BPE" or any(model[name] for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return file
    # words come once each, so the model's own cache would only cost time
    plain = Tokenizer(models.BPE(model["vocab"], [tuple(pair) for pair in model["merges"]], cache_capacity=0,
                                 end_of_word_suffix=model["end_of_word_suffix"], fuse_unk=model["fuse_unk"]))
    plain.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return plain


class Words:
    """Ids of texts by the tokenizers library, each distinct word encoded once.

    The file's pre-tokenizer never joins characters across white space and its other steps look at one character
    or one run of marks at a time, so the ids of a text are those of its words between ASCII white space. Where the file's steps are
    those of ``LETTERS_STAY``, the ASCII marks after a word of Latin letters and digits are one unit, so the word and its marks are known apart.
    A word of Latin letters alone is one unit that ends with an end-of-word piece. Such words are encoded many to a text, without the
    steps that leave them as they are (``of_letters``), and told apart by those pieces; all others one by one.

    Words and their ids are Arrow columns, which need some 40 bytes a word. When they have more than ``most`` bytes, those met last
    stay, of half as many bytes."""

    RUN = 500  # words of a text
    LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"  # without the one that is two characters in lower case
    MARKS = "".join(mark for mark in map(chr, range(33, 127)) if not mark.isalnum())

    def __init__(self, path: str, most: int = 12 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; no threads beside it
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = of_letters(self.tokenizer)
        self.most = most
        self.known, self.round = pa.array(["", ".", ","]), 0
        self.ids_of, self.met = self.each(self.known.to_pylist()), np.zeros(len(self.known), np.int32)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def ids(self, text: str) -> list[int]:
        return self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids  # without offsets

    def each(self, words: list[str]) -> pa.Array:
        """The ids of words by all steps of the file."""
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return pa.array([packed(f"<{len(own)}I", *own.ids) for own in found], pa.large_binary())

    def parted(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Words without their last marks, and those marks."""
        marked = pc.match_substring_regex(words, rf"^[0-9{self.LETTERS}]+[!-/:-@\[-`{{-~]+$")
        if self.letters is self.tokenizer:
            marked = pa.repeat(False, len(words))
        some = words.filter(marked)
        stems = pc.utf8_rtrim(some, self.MARKS)
        marks = pc.replace_substring_regex(some, f"^[0-9{self.LETTERS}]+", "")
        return pc.replace_with_mask(words, marked, stems), pc.replace_with_mask(pa.repeat("", len(words)), marked, marks)

    def learn(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words."""
        chosen = pc.match_substring_regex(words, f"^[{self.LETTERS}]+$")
        letters = words.filter(chosen).to_pylist()
        data, ends, failed = [], [np.zeros(1, np.int64)], []
        for at in range(0, len(letters), self.RUN):
            run = letters[at:at + self.RUN]
            ids = np.array(self.ids(" ".join(run).lower()), "<u4")
            own = np.flatnonzero(self.ends[ids]) + 1
            if len(own) == len(run) and own[-1] == len(ids):
                data.append(ids)
                ends.append(own + ends[-1][-1])
            else:
                failed += range(at, at + len(run))
                ends.append(np.repeat(ends[-1][-1], len(run)))
        flat = np.concatenate([*data, np.zeros(0, "<u4")])
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(letters), [None, pa.py_buffer(4 * np.concatenate(ends)), pa.py_buffer(flat)])
        place = np.empty(len(words), np.int64)
        chosen = chosen.to_numpy(zero_copy_only=False)
        place[chosen] = np.arange(len(letters))
        odd = np.sort(np.append(np.flatnonzero(~chosen), np.flatnonzero(chosen)[failed])).astype(np.int64)
        if not len(odd):
            return found
        place[odd] = len(letters) + np.arange(len(odd))
        return pa.concat_arrays([found, self.each(words.take(pa.array(odd)).to_pylist())]).take(pa.array(place))

    def looked_up(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, those that are not known yet learnt."""
        at = pc.index_in(words, value_set=self.known)
        fresh = words.filter(at.is_null())
        place = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[at.is_null().to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(fresh))
        if len(fresh):
            self.known = pa.concat_arrays([self.known, fresh])
            self.ids_of = pa.concat_arrays([self.ids_of, self.learn(fresh)])
            self.met = np.append(self.met, np.zeros(len(fresh), np.int32))
        self.round += 1
        self.met[place] = self.round
        found = self.ids_of.take(pa.array(place))
        if self.known.nbytes + self.ids_of.nbytes + self.met.nbytes > self.most:
            order = np.argsort(-self.met, kind="stable")
            sizes = 16 + pc.add(pc.binary_length(self.known).cast("int64"), pc.binary_length(self.ids_of)).to_numpy()
            kept = np.sort(order[np.cumsum(sizes[order]) <= self.most // 2])
            self.known, self.ids_of, self.met = self.known.take(pa.array(kept)), self.ids_of.take(pa.array(kept)), self.met[kept]
        return found

    def encoded(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        # in lower case as far as ASCII goes, which the normaliser does anyway, unless the text may hold the name of a special token
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lower)
        del lower
        words = split.flatten().dictionary_encode()
        ends = split.offsets.to_numpy()
        del split
        parts = pa.concat_arrays(self.parted(words.dictionary)).dictionary_encode()
        ids = self.looked_up(parts.dictionary).take(parts.indices)
        many = len(words.dictionary)
        of_word = pc.binary_join_element_wise(ids[:many], ids[many:], pa.scalar(b"", pa.large_binary()))
        found = of_word.take(words.indices)
        _, offsets, data = found.buffers()
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(np.frombuffer(offsets, np.int64)[ends - ends[0]]), data])

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encoded(pa.array(texts, pa.string())).to_pylist()


@held
def words_of(path: str) -> Words:
    return Words(path)


def runs(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows, each with texts of at most ``most_bytes`` or one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def pieces(docs: DataFrame, size: int = 4096, end_id: int = 2, tokenizer: str | None = None,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents as pieces of at most ``size`` ids: key, start, length, ids_crc32, doc_tokens, and ``part`` and ``place``:
    the task that made the piece and its number there among the pieces of its length."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    last = packed("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, counts = words_of(path), TaskContext.get().partitionId(), defaultdict(int)
        for rows in runs(batches, "text", 1 << 21):
            columns: list[list] = [[] for _ in range(6)]
            found = own.encoded(rows.column("text"))
            ends = np.frombuffer(found.buffers()[1], np.int64).tolist()
            data = memoryview(found.buffers()[2] or b"")
            for i, (begin, end) in enumerate(zip(ends, ends[1:])):
                total = (end - begin) // 4 + 1
                for start in range(0, total, size):
                    length = min(size, total - start)
                    crc = zlib.crc32(data[begin + 4 * start:min(end, begin + 4 * (start + length))])
                    if start + length == total:
                        crc = zlib.crc32(last, crc)
                    for column, value in zip(columns, (i, start, length, crc, total, counts[length])):
                        column.append(value)
                    counts[length] += 1
            at, *rest = columns
            yield pa.RecordBatch.from_arrays(
                [rows.column("key").take(pa.array(at, pa.int64())), *[pa.array(c, pa.int64()) for c in rest],
                 pa.array([part] * len(at), pa.int64())],
                ["key", "start", "length", "ids_crc32", "doc_tokens", "place", "part"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, cut, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                "place long, part long", keep=words_of)


def shortest_pack_first(histogram: dict[int, int], size: int) -> Layout:
    """Patterns, as lists of lengths, and how many sequences follow each.

    Lengths are placed longest first, all of one length at a time, into the open packs with the most room. A pack
    class that takes only some of them splits in two, so the number of classes grows by one or two a length and
    has nothing to do with the number of documents."""
    open_packs: dict[int, list[tuple[int, tuple | None]]] = defaultdict(list)  # by room
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = max(open_packs, default=0)
        while left:
            while room >= length and not open_packs.get(room):
                open_packs.pop(room, None)
                room = max((r for r in open_packs if r <= room), default=0)
            if room < length:
                open_packs[size - length].append((left, (length, None)))
                break
            count, pattern = open_packs[room].pop()
            taken = min(left, count)
            if taken < count:
                open_packs[room].append((count - taken, pattern))
            open_packs[room - length].append((taken, (length, pattern)))
            left -= taken
            room = max(open_packs)
    layout = []
    for packs in open_packs.values():
        for count, pattern in packs:
            lengths = []
            while pattern:
                lengths.append(pattern[0])
                pattern = pattern[1]
            layout.append((lengths[::-1], count))
    return layout


def slots(layout: Layout) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: runs of ranks, ascending by (length, first). The piece of rank
    first + i * times + j lies in sequence ``sequence`` + i at ``offset`` + j * length."""
    runs, given, sequence = [], defaultdict(int), 0
    for lengths, count in layout:
        offset = 0
        for length in dict.fromkeys(lengths):
            times = lengths.count(length)
            runs.append((length, given[length], times, sequence, offset))
            given[length] += times * count
            offset += times * length
        sequence += count
    columns = np.array(sorted(runs), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "times", "sequence", "offset"), columns))


def pack(docs: DataFrame, size: int = 4096, end_id: int = 2, tokenizer: str | None = None,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The ids of a document, ``end_id`` last, are cut every ``size`` ids. Only the histogram of piece lengths, at most
    ``size`` rows, comes to the driver; patterns are as few (see ``shortest_pack_first``). A piece finds its slot by its
    rank among the pieces of its length: its number in its task plus the pieces of that length in earlier tasks.

    A null text is empty (its one id is ``end_id``), a null key stays null, repeated rows are packed each, an empty
    table gives an empty one; other columns are not looked at."""
    cut = written(pieces(docs, size, end_id, tokenizer, key, text), "pieces")
    by_part = written(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {row.length: row.n for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = docs.sparkSession.sparkContext.broadcast(slots(shortest_pack_first(histogram, size)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(earlier, ["part", "length"]).select(
        "key", "start", "length", "ids_crc32", "doc_tokens", (F.col("earlier") + F.col("place")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = runs.value
        combined = known["length"] * (1 << 48) + known["first"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(combined, length * (1 << 48) + rank, side="right") - 1
            turn, step = np.divmod(rank - known["first"][at], known["times"][at])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("key", "start", "length", "ids_crc32", "doc_tokens")],
                 pa.array(known["sequence"][at] + turn), pa.array(known["offset"][at] + step * length)],
                ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = ranked.schema["key"].dataType.simpleString()
    return mapped(ranked, place, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long").withColumnRenamed("key", key)
