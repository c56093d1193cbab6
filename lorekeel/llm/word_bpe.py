"""Token ids of a word-level BPE vocabulary, with every distinct part of the words of a slice of texts encoded once."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lorekeel.llm.batches import text_slices

#: Parts of words that a worker remembers; then it starts anew. This bounds memory and changes no result.
REMEMBERED = 150_000
#: What the vocabulary's own splitting leaves whole: lower-case letters that normalisation leaves alone, marks that never join a letter, a digit.
_PLAIN = re.compile("[a-zß-öø-ÿ]+|[!-&(-/:-@\\[-`{-~]+|[0-9]")
#: Kinds of bytes: what may need the library as a whole word, white space, letters, marks, digits.
_OTHER, _SPACE, _LETTER, _MARK, _DIGIT = range(5)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Each byte in lower case (white space: a blank), and its kind."""
    low, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    low[65:91] += 32
    low[[*range(9, 14)]] = 32
    kind[32] = _SPACE
    kind[97:123] = _LETTER
    kind[48:58] = _DIGIT
    kind[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = _MARK
    return low, kind


_LOW, _KIND = _tables()


def parts_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Parts of the words of each text (no null): starts (one more than texts), codes, the distinct parts.

    Words of ASCII and Latin-1 letters, ASCII digits and marks but the apostrophe are split where the vocabulary splits
    them, and are in lower case. Any other word is one part, as it stands: it is normalised before it is lower-cased.
    """
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    if not len(raw):
        return np.zeros(len(bounds), np.int64), np.zeros(0, np.int64), pa.array([], pa.large_string())
    low = _LOW[raw]
    # of two bytes, the second after 0xC3: capitals 32 before their letters, without the signs of multiplication and division
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    low[second] += ((raw[second] < 0x9F) & (raw[second] != 0x97)).astype(np.uint8) * 32
    kind = _KIND[low]
    letters = second[(low[second] >= 0x9F) & (low[second] != 0xB7)]
    kind[letters] = kind[letters - 1] = _LETTER
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    edge = edge[:-1]
    if not kind.all():
        space = kind == _SPACE
        runs = edge.copy()
        runs[1:] |= space[1:] != space[:-1]
        runs = np.flatnonzero(runs)
        whole = np.repeat(np.minimum.reduceat(kind, runs) == _OTHER, np.diff(runs, append=len(raw)))
        kind[whole] = _OTHER
        low[whole] = raw[whole]
    edge[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    at = np.flatnonzero(edge)
    runs = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(low)).dictionary_encode()
    words = kind[at] != _SPACE
    codes = runs.indices.to_numpy(zero_copy_only=False)[words].astype(np.int64)
    return np.searchsorted(at[words], bounds), codes, runs.dictionary


def _byte_letters() -> str:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, others follow from code point 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return {b: table[b] for b in range(256)}


class WordEncoder:
    """Encodes whole texts as the tokenizers library would, without special tokens of its own."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def _encode(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        if not _PLAIN.fullmatch(part):
            return self._encode(part)
        raw = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return array("H", [t.id for t in self.tokenizer.model.tokenize(raw)]).tobytes()

    def parts(self, parts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of ``parts_of`` texts."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out, known = [], self.known
        for w in parts:
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self._part(w)
            out.append(ids)
        return out

    def encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Starts (one more than texts) and the ids of all texts, each with ``end`` after its own ids.

        Texts split at ASCII white space without changing an id, as the vocabulary's own
        splitting never crosses it. Texts that hold ``<|`` may spell special tokens, which are matched
        before lower-casing, and are encoded whole.
        """
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|")
        starts, codes, distinct = parts_of(pc.if_else(special, "", texts))
        # one string for all, as parts hold no line feed
        listed = pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct.cast(pa.string()))
        blobs = self.parts(pc.binary_join(listed, "\n")[0].as_py().split("\n")) if len(distinct) else []
        whole = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        blobs += [self._encode(texts[int(i)].as_py()) for i in whole]
        if len(whole):
            codes = np.insert(codes, starts[whole], len(distinct) + np.arange(len(whole)))
            starts[1:] += np.cumsum(np.isin(np.arange(len(starts) - 1), whole))
        if end is not None:
            blobs.append(np.array([end], np.uint16).tobytes())
            codes = np.insert(codes, starts[1:], len(blobs) - 1)
            starts += np.arange(len(starts))
        sizes = np.array([len(b) // 2 for b in blobs], np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        each = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(each)))
        at = np.repeat(first[codes] - ends[:-1], each) + np.arange(ends[-1])
        return ends[starts], np.frombuffer(b"".join(blobs), np.uint16)[at].astype("<u4")


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for ``path``; kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def counting(path: str):
    """A mapInArrow function: all columns of a batch with ``text`` replaced by its ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                starts, _ = encoder(path).encode(batch.column("text"), None)
                at = batch.schema.get_field_index("text")
                yield batch.remove_column(at).append_column("n_tokens", pa.array(np.diff(starts), pa.int64()))

    return run
