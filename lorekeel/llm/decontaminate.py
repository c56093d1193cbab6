"""Operator 13, benchmark decontamination by an FM-index of every shard of the training texts.

A shard is a run of whole texts of a few MB inside a task. Its words become integers, the ends of its texts separators, and the
index is built over the shard as it is, whatever will be asked of it. The windows of the benchmark, distinct over the cluster, then are searched
backward through the wavelet ranks, their occurrences are located by sampled suffix positions, and hit words are merged into removal spans.

Windows come in blocks of bounded size; each block is one pass that adds to what earlier ones found, so neither the driver nor a task holds
more than one block at once while it is made. Texts never cross the cluster.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorekeel.llm.batches import free_name, map_batches, text_slices, words_of
from lorekeel.llm.fm_index import FMIndex
from lorekeel.session import cut

#: A word: no ASCII character but digits and letters, which are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a window.
WINDOW = 10
#: Text bytes of a shard, unless one text is longer; words of an index; (window, item) pairs of a block.
SHARD_BYTES, INDEX_WORDS, BLOCK_PAIRS = 4 << 20, 1 << 20, 200_000

_WORDS = re.compile(WORD)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(_UPPER, _LOWER)
#: For each byte what stands for it where words are told apart: its lower case, or a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
                       T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))), T.StructField("items", T.ArrayType(T.StringType()))])
_ARROW = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))])


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """Distinct (window, item): the runs of ``width`` words of an item, joined by blanks, or all its words if it has fewer; without a word, or null, none. The item is a string."""
    words = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    given = benchmark.select(F.col(item_col).cast("string").alias("item"), words.alias("words")).where("size(words) > 0")
    windows = F.expr(f"transform(sequence(1, greatest(1, size(words) - {width} + 1)), i -> array_join(slice(words, i, {width}), ' '))")
    return given.select(F.explode(windows).alias("window"), "item").distinct()


class Phrases:
    """Distinct windows as numbers of their words, each with the items that it is from."""

    def __init__(self, pairs: list[tuple[str, str | None]]):
        windows = sorted({w for w, _ in pairs})
        number, self.items = {w: k for k, w in enumerate(windows)}, [[] for _ in windows]
        for window, item in pairs:
            if item is not None:
                self.items[number[window]].append(item)
        split = [w.split(" ") for w in windows]
        self.words = sorted({x for words in split for x in words})
        code = {x: k for k, x in enumerate(self.words)}
        self.lengths = np.array([len(x) for x in split], np.int64)
        self.codes = np.full((len(split), max(self.lengths, default=0)), -1, np.int64)
        for k, words in enumerate(split):
            self.codes[k, : len(words)] = [code[x] for x in words]


def folded(texts: pa.Array) -> pa.Array:
    """Texts (null: empty) in which only words are left, lower-cased, and a blank for every other byte."""
    texts = pc.fill_null(texts, "")
    texts = pa.concat_arrays([texts])  # of its own, from place 0
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    ends = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)
    used = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes().translate(_FOLD)
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(np.ascontiguousarray(ends - ends[0])), pa.py_buffer(used)])


def shard_occurrences(starts: np.ndarray, codes: np.ndarray, distinct: pa.Array, phrases: Phrases, index_words: int = INDEX_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(window, place among all words) of each occurrence inside one of the texts that begin at ``starts``; a text above ``index_words`` words has several indexes that overlap."""
    known = pc.index_in(pa.array(phrases.words, distinct.type), value_set=distinct)
    known = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    asked = np.where(phrases.codes >= 0, known[phrases.codes], 0)
    live = np.flatnonzero((asked >= 0).all(axis=1))
    if not len(live) or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    asked, lengths, reach = asked[live], phrases.lengths[live], phrases.codes.shape[1] - 1
    cuts = [0]
    for end in starts[1:]:
        while end - cuts[-1] > index_words:
            # whole texts, or where one alone is too long, a part of it
            before = starts[(starts > cuts[-1]) & (starts <= cuts[-1] + index_words)]
            cuts.append(int(before[-1]) if len(before) else cuts[-1] + index_words)
    if cuts[-1] < len(codes):
        cuts.append(len(codes))
    which, places = [], []
    for a, b in zip(cuts, cuts[1:]):
        inside = starts[(starts > a) & (starts < b + reach)]
        end = b if b in inside or b == len(codes) else min(b + reach, len(codes))
        inside = inside[inside < end]
        inside = np.unique(np.append(inside, end))
        texts = len(inside)
        # separators are the least symbols, the last one the least of all
        symbols = np.insert(codes[a:end].astype(np.int64) + texts, inside - a, texts - 1 - np.arange(texts))
        found, at = FMIndex(symbols).occurrences(_within(asked, texts, int(symbols.max())), lengths)
        at = a + at - np.searchsorted(inside - a + np.arange(texts), at)
        mine = at < b
        which.append(live[found[mine]])
        places.append(at[mine])
    return np.concatenate(which), np.concatenate(places)


def _within(asked: np.ndarray, texts: int, most: int) -> np.ndarray:
    """Words as symbols of an index; those above its largest are not in it."""
    symbols = asked + texts
    return np.where(symbols > most, -1, symbols)


def _runs(words: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbours among sorted places: first and last."""
    new = np.flatnonzero(np.diff(words) > 1)
    return list(zip(words[np.concatenate(([0], new + 1))].tolist(), words[np.concatenate((new, [len(words) - 1]))].tolist()))


def _adding(phrases: Phrases, text: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text, SHARD_BYTES):
                column = batch.column(text)
                starts, codes, distinct = words_of(folded(column))
                which, places = shard_occurrences(starts, codes, distinct, phrases)
                row = np.searchsorted(starts, places, side="right") - 1
                hit = np.zeros(len(codes) + 1, np.int64)
                np.add.at(hit, places, 1)
                np.add.at(hit, places + phrases.lengths[which], -1)
                hit = np.cumsum(hit[:-1]) > 0
                pairs = np.unique(row * len(phrases.lengths) + which)
                items: dict[int, set] = {}
                for pair in pairs.tolist():
                    items.setdefault(pair // len(phrases.lengths), set()).update(phrases.items[pair % len(phrases.lengths)])
                before = batch.column(into).to_pylist() if into in batch.schema.names else None
                sizes, out = np.diff(starts).tolist(), []
                touched = set(np.unique(row).tolist())
                for k, n in enumerate(sizes):
                    old = before[k] if before else None
                    if k not in touched:
                        out.append(old or {"n_words": n, "runs": [], "spans": [], "items": []})
                        continue
                    here = hit[starts[k] : starts[k + 1]]
                    for r in old["runs"] if old else ():
                        here[r["first"] : r["last"] + 1] = True
                    runs = _runs(np.flatnonzero(here))
                    at = [m.span() for m in _WORDS.finditer(column[k].as_py().translate(_LOWERED))]
                    listed = sorted({*items.get(k, ()), *(old["items"] if old else ())})
                    out.append({"n_words": n, "runs": [{"first": a, "last": b} for a, b in runs], "spans": [{"start": at[a][0], "end": at[b][1]} for a, b in runs], "items": listed})
                kept = [c for c in batch.schema.names if c != into]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, _ARROW)], names=[*kept, into])

    return run


def with_benchmark_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = WINDOW, into: str = "found", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``docs``, all rows and columns, with a struct ``into`` beside each row.

    It holds n_words (long), runs (first and last place of neighbouring hit words, from 0), spans (their start and end in code points, end exclusive, from the
    first letter of a run to the last), and items (ids of the benchmark items of which a window occurs, as sorted strings). A word is hit if it is inside any
    occurrence of a window of ``width`` words. A null or empty text has no words; a text of any length is searched whole. Repeated rows are told apart; a
    null item id hits words but is not listed, and repeated ids count once. An empty benchmark finds nothing, and an empty table stays empty. ``into`` replaces a
    column of that name, all others stay as they are.
    """
    pairs = cut(benchmark_windows(benchmark, text_col=text_col, width=width))
    blocks = max(1, -(-pairs.count() // block_pairs))
    out = docs.drop(into)
    schema = T.StructType([*out.schema.fields, T.StructField(into, _FOUND)])
    for k in range(blocks):
        block = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == k)
        phrases = Phrases([(r["window"], r["item"]) for r in block.toLocalIterator()])
        out = map_batches(out, _adding(phrases, text_col, into), schema)
    return out


def n_hit(found):
    """Hit words of a struct of :func:`with_benchmark_hits`."""
    return F.aggregate(found["runs"], F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``docs``, all rows and columns, with the removal spans taken out of the text; what stood around a span stays as it was, and a null text stays null."""
    found = free_name(docs.columns, "found")
    marked = with_benchmark_hits(docs, benchmark, text_col, width, found)
    spans, text = F.col(found)["spans"], F.col(text_col)
    # what lies between two spans, before the first and after the last
    starts = F.concat(F.array(F.lit(0)), spans["end"])
    ends = F.concat(spans["start"], F.array(F.length(text)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.substring(text, x["a"] + 1, x["b"] - x["a"]))
    return marked.withColumn(text_col, F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(text)).select(*docs.columns)
