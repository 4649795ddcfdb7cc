"""Token counts of whole texts (operator 8): huge documents are encoded in overlapping chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from changewatch.llm.common import held, mapped, slices, text_of

MARK = "▁"


class Counter:
    """Counts the tokens of a text as the library does for the whole text.

    A text of more than ``chunk`` characters is encoded in chunks that overlap. Two neighbours are spliced at a
    place in the overlap where both start a token and which no token can cross. If the vocabulary has no piece
    with a word mark after another character, then the place between a character and a space is such: a merge
    across it would be a piece of that kind. Without a common place the overlap is doubled, at last up to
    the previous splice, and then the chunk itself grows. A vocabulary without the property is not chunked.
    """

    def __init__(self, path: str, chunk: int = 1 << 15, overlap: int = 256):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        pieces = map(self.library.id_to_piece, range(self.library.get_piece_size()))
        self.stable = not any(MARK in piece.lstrip(MARK) for piece in pieces)
        self.stable = self.stable and "".join(self.library.encode(" a  b ", return_type=str)) == "▁▁a▁▁b▁"

    def count(self, texts: list[str]) -> list[int]:
        small = [text for text in texts if len(text) <= self.chunk or not self.stable]
        counts = iter([len(ids) for ids in self.library.encode(small, num_threads=1, return_type="numpy")])
        return [next(counts) if len(text) <= self.chunk or not self.stable else self.spliced(text)
                for text in texts]

    def starts(self, text: str, begin: int, end: int) -> list[int]:
        """Where the tokens of text[begin:end] start. A space at a splice is left to the mark that the library
        puts in front of a text."""
        skipped = int(begin > 0 and text[begin] == " " and text[begin - 1] not in (" ", MARK))
        offsets = self.library.encode(text[begin + skipped:end], return_type="offset_mapping")["offsets"]
        found = [begin + skipped + first for first, _ in offsets]
        if found:
            found[0] = begin
        return found

    def spliced(self, text: str) -> int:
        length, counted, cut, end = len(text), 0, 0, min(self.chunk, len(text))
        left = self.starts(text, cut, end)
        while end < length:
            overlap, upto = self.overlap, min(length, end + self.chunk)
            while True:
                begin = max(cut, end - overlap)
                right = self.starts(text, begin, upto)
                ours = set(left)
                places = [p for p in right if begin < p < end and p in ours
                          and text[p] == " " and text[p - 1] not in (" ", MARK)]
                if places or begin == cut:
                    break
                overlap *= 2
            if places:
                place = places[len(places) // 2]
                counted += sum(p < place for p in left)
                cut, left, end = place, [p for p in right if p >= place], upto
            elif upto < length:  # nowhere to splice: one chunk, twice as long, from the last splice
                end = min(length, cut + 2 * (upto - cut))
                left = self.starts(text, cut, end)
            else:
                left, end = right, upto
        return counted + len(left)


@held
def counter(path: str, chunk: int, overlap: int) -> Counter:
    return Counter(path, chunk, overlap)


def count_tokens(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text",
                 limit: int = 4096, chunk: int = 1 << 15, overlap: int = 256) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every row; other columns are not looked at.

    A null text is empty and has no tokens; a null key stays null; repeated rows are counted each; an empty
    table gives an empty one. Whole texts are counted, of any length."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, chunk, overlap)
        for rows, texts in slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(own.count(texts), pa.int64())], ["key", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return (mapped(rows, counts, f"key {kind}, n_bytes long, n_tokens long", keep=counter)
            .select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
