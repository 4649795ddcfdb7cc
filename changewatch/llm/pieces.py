"""SentencePiece models on the tokenizers library (operator 10): encoding, decoding, parity."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, decoders, models, normalizers

from changewatch.llm.common import held, mapped, slices, text_of

MARK = "▁"
# Fixed values of the format: field numbers of the model file, kinds of piece, kinds of model.
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_KIND, BYTE_FALLBACK = 3, 35
CHAR_MAP, DUMMY_PREFIX, NO_EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


def parse(data: bytes) -> tuple[list[tuple[str, float, int]], dict[int, int | bytes], dict[int, int | bytes]]:
    """(text, score, kind) of each piece, the trainer's fields, the normaliser's fields."""
    pieces, trainer, normaliser = [], {}, {}
    for field, value in fields(data):
        if field == PIECES:
            own = dict(fields(value))
            score = struct.unpack("<f", own[PIECE_SCORE])[0] if PIECE_SCORE in own else 0.0
            pieces.append((own[PIECE_TEXT].decode(), score, own.get(PIECE_KIND, NORMAL)))
        elif field == TRAINER:
            trainer = dict(fields(value))
        elif field == NORMALISER:
            normaliser = dict(fields(value))
    return pieces, trainer, normaliser


class Backend:
    """A tokenizers-library tokenizer rebuilt from a SentencePiece model file.

    The normaliser (character map, extra spaces, prefix, mark for spaces) and the pieces come from the file. A
    unigram model takes its scores, a merge model takes as merges all ways to split a piece into two, best
    score first. Unknown characters fall back to bytes where the file says so.

    Texts are cut into units, runs of spaces with the word after them. No piece holds a mark after another
    character (checked; else a text is one unit), so tokens never cross units. Each distinct unit is encoded
    once, in multithreaded batches, and is compared with the original library: ``parity`` is of all units."""

    def __init__(self, path: str, units: int = 700_000):
        with open(path, "rb") as file:
            data = file.read()
        pieces, trainer, normaliser = parse(data)
        kind = trainer.get(MODEL_KIND, UNIGRAM)
        fallback = bool(trainer.get(BYTE_FALLBACK, 0))
        vocabulary = {text: i for i, (text, _, _) in enumerate(pieces)}
        unknown = next(i for i, piece in enumerate(pieces) if piece[2] == UNKNOWN)
        if kind == UNIGRAM:
            model = models.Unigram([(text, score) for text, score, _ in pieces], unknown, fallback)
        elif kind == MERGES:
            joined = {text for text, _, sort in pieces if sort in (NORMAL, USER, UNUSED)}
            merges = []
            for text in joined:
                score = pieces[vocabulary[text]][1]
                for i in range(1, len(text)):
                    if text[:i] in joined and text[i:] in joined:
                        merges.append((-score, vocabulary[text], vocabulary[text[:i]], text[:i], text[i:]))
            merges.sort()
            model = models.BPE(vocabulary, [merge[3:] for merge in merges], unk_token=pieces[unknown][0],
                               fuse_unk=True, byte_fallback=fallback)
        else:
            raise ValueError(f"models of kind {kind} are not supported")
        self.tokenizer = Tokenizer(model)
        self.prefix = bool(normaliser.get(DUMMY_PREFIX, 1))
        steps = []
        if normaliser.get(CHAR_MAP):
            steps.append(normalizers.Precompiled(normaliser[CHAR_MAP]))
        self.strips = bool(normaliser.get(NO_EXTRA_SPACES, 1))
        if self.strips:
            steps += [normalizers.Strip(), normalizers.Replace(re_spaces(), " ")]
        if self.prefix:
            steps.append(normalizers.Prepend(MARK))
        if normaliser.get(ESCAPE_SPACES, 1):
            steps.append(normalizers.Replace(" ", MARK))
        self.tokenizer.normalizer = normalizers.Sequence(steps)
        self.tokenizer.decoder = decoders.Sequence([
            decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
            *([decoders.Strip(" ", 1, 0)] if self.prefix else [])])
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        whole = any(MARK in text.lstrip(MARK) for text, _, _ in pieces)
        self.cut = None if whole or self.strips or not self.prefix or normaliser.get(CHAR_MAP) else re.compile(" *[^ ]+| +$")
        self.mark = vocabulary.get(MARK, unknown)
        self.most = units
        self.known: dict[str, bytes] = {}  # ids as little-endian 32-bit numbers
        self.apart: set[str] = set()  # units whose ids are not those of the original library

    def units(self, text: str) -> list[str]:
        """The units of a text without the space that the prefix stands for."""
        if not text:
            return []
        if self.cut is None:
            return [text]
        text = text.replace(MARK, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [unit[1:] for unit in self.cut.findall(" " + text)]

    def learn(self, units: set[str]) -> None:
        fresh = [unit for unit in units if unit not in self.known]
        ours = [encoded.ids for encoded in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
        theirs = self.library.encode(fresh, out_type=int, num_threads=1)
        for unit, own, other in zip(fresh, ours, theirs):
            if not unit:  # a lone space at the end: the mark itself
                own = other = [self.mark]
            self.known[unit] = struct.pack(f"<{len(own)}i", *own)
            if own != other:
                self.apart.add(unit)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """The ids of each text and whether all its units have the original library's ids."""
        cut = [self.units(text) for text in texts]
        if len(self.known) > self.most:
            self.known, self.apart = {}, set()
        self.learn(set().union(*cut))
        known = self.known
        return [(np.frombuffer(b"".join([known[unit] for unit in units]), "<i4"),
                 not self.apart or self.apart.isdisjoint(units)) for units in cut]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([own.tolist() for own in ids], skip_special_tokens=False)


def re_spaces():
    from tokenizers import Regex
    return Regex(" {2,}")


@held
def backend(path: str) -> Backend:
    # the library reads this when it first runs a batch, in the worker
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", "2")
    return Backend(path)


def _model(path: str | None) -> str:
    return path or public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array of int) and parity of every row. A null text has no ids; keys may be null or repeated; other
    columns are not looked at; an empty table gives an empty one."""
    path = _model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = backend(path)
        for rows, texts in slices(batches, "text", 1 << 20):
            found = own.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), pa.array([ids for ids, _ in found], pa.list_(pa.int32())),
                 pa.array([same for _, same in found], pa.bool_())], ["key", "ids", "parity"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, run, f"key {kind}, ids array<int>, parity boolean", keep=backend).withColumnRenamed("key", key)


def decode(encoded: DataFrame, model: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text of every row of ids. Null ids give an empty text."""
    path = _model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = backend(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = own.decode([np.array(x or [], np.int32) for x in rows.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    rows = encoded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, run, f"key {kind}, text string", keep=backend).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers), parity with the original
    library, and whether decoding gives the text back. Encoding and decoding are those of ``encode`` and
    ``decode``, in one pass, so that the ids never leave the task."""
    path = _model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = backend(path)
        for rows, texts in slices(batches, "text", 1 << 20):
            found = own.encode(texts)
            back = own.decode([ids for ids, _ in found])
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([len(ids) for ids, _ in found], pa.int64()),
                 pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids, _ in found], pa.int64()),
                 pa.array([same for _, same in found], pa.bool_()),
                 pa.array([a == b for a, b in zip(texts, back)], pa.bool_())],
                ["key", "n_bytes", "n_tokens", "ids_crc32", "parity", "decoded"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, run, f"key {kind}, n_bytes long, n_tokens long, ids_crc32 long, parity boolean, "
                                "decoded boolean", keep=backend).withColumnRenamed("key", key)
