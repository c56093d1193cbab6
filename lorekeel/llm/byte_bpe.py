"""Operator 2, byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut into halves until a piece is short, pieces are encoded, and neighbours are
joined up the tree. Joining encodes again only a window around the seam. The window
grows on either side until it ends at a cut between a letter and white space or a
mark: every match of the splitting pattern that holds such a letter ends there, and
the next match starts there, whatever stands further left or right. Matches beyond
the cuts, and so their tokens, are then the same in the joined text, and the join is associative.
Decoding concatenates bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lorekeel.llm.batches import map_batches, text_slices

#: Code points of a leaf when encoding, ids of a leaf when decoding, code points of the first window.
LEAF_TEXT, LEAF_IDS, WINDOW = 2048, 2048, 32

#: Letters of every version of Unicode, then a character that no version calls a letter or number.
_CUT = re.compile("(?<=[A-Za-zÀ-ÖØ-öø-ƺΑ-Ρα-ωА-яぁ-ゖァ-ヺ一-龥가-힣])(?=[ \n!-/:-@\\[-`{-~、。])")


class ByteBpe:
    """A vocabulary of ranks with its splitting pattern; ``encode`` and ``decode`` reduce trees."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF_TEXT, window: int = WINDOW) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.vocabulary = {i: raw for raw, i in ranks.items()}
        self.ordinary = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.leaf, self.window = leaf, window

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.ordinary(text)
        half = len(text) // 2
        return self.join(text, half, self.encode(text[:half]), self.encode(text[half:]), 0, len(text))

    def join(self, text: str, seam: int, left: list[int], right: list[int], start: int, end: int) -> list[int]:
        """Ids of ``text[start:end]`` from those of its parts left and right of ``seam``."""
        a, b = self._last_cut(text, start, seam), self._first_cut(text, seam, end)
        tail, head = len(self.ordinary(text[a:seam])), len(self.ordinary(text[seam:b]))
        return left[: len(left) - tail] + self.ordinary(text[a:b]) + right[head:]

    def _last_cut(self, text: str, start: int, seam: int) -> int:
        size = self.window
        while True:
            low = max(start, seam - size)
            cuts = [m.start() for m in _CUT.finditer(text, low + (low > start), seam)]
            if cuts and cuts[-1] < seam:
                return cuts[-1]
            if low == start:
                return start
            size *= 2

    def _first_cut(self, text: str, seam: int, end: int) -> int:
        size = self.window
        while True:
            high = min(end, seam + size)
            found = _CUT.search(text, seam + 1, high)
            if found and found.start() < high:
                return found.start()
            if high == end:
                return end
            size *= 2

    def decode(self, ids) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_loaded: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """The worker's vocabulary; kept between tasks."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe(path, pattern)
    return _loaded[path, pattern]


def _swapped(schema: T.StructType, old: str, new: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in (old, new)] + [T.StructField(new, kind)])


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``text_col`` replaced by ``ids_col``, its token ids without special tokens.

    A null text counts as empty; an empty text has no ids. All other columns pass through
    unread, one named ``ids_col`` is replaced, repeated rows stay repeated, and an empty table gives no rows. A text is never cut short.
    """
    docs = docs.drop(ids_col) if ids_col != text_col else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for whole in batches:
            for batch in text_slices(whole, text_col):
                at = batch.schema.get_field_index(text_col)
                ids = [np.array(bpe.encode(t.as_py() or ""), np.int32) for t in batch.column(at)]
                starts = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                yield batch.remove_column(at).append_column(ids_col, pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(ids))))

    return map_batches(docs, run, _swapped(docs.schema, text_col, ids_col, T.ArrayType(T.IntegerType())))


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """``rows`` with ``ids_col`` replaced by ``bytes_col``, the bytes that the ids stand for; null ids give none.

    Another column named ``bytes_col`` is replaced, all others stay. Lists of any length are decoded whole, by a tree of halves; repeated rows are decoded each, and an empty table gives no rows.
    """
    rows = rows.drop(bytes_col) if bytes_col != ids_col else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            column = batch.column(at)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            raw = [bpe.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield batch.remove_column(at).append_column(bytes_col, pa.array(raw, pa.binary()))

    return map_batches(rows, run, _swapped(rows.schema, ids_col, bytes_col, T.BinaryType()))
