"""Operator 7, language identification of mixed-language text.

Each word gets a score for each language: log probabilities of its letter n-grams, learned
from a bounded sample of labelled documents. The script of a word's letters first
narrows the languages that may have written it. Viterbi over the words of a text, with a
penalty for each switch, then labels spans; the language with the most letters names the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorekeel.llm.batches import drawn, map_batches, text_slices, words_of

#: Labelled documents that a language is learned from (expected number), and languages that can be learned.
SAMPLE_DOCS, MAX_LANGS = 4000, 100
#: n-gram orders, and table places that n-grams are hashed to; a model is MAX_LANGS * PLACES numbers at most.
ORDERS, PLACES = (1, 2, 3, 4), 1 << 16
#: Log score that a change of language costs, and what a language of another script loses on a word.
SWITCH, FOREIGN = 20.0, 30.0
#: A language uses a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"

# First code point of script blocks, and the script of each (0: none listed).
SCRIPTS = [
    (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0),
    (0x00F8, 1), (0x0300, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 7), (0x0750, 6), (0x0780, 8), (0x0900, 9), (0x0980, 10),
    (0x0A00, 11), (0x0A80, 12), (0x0B00, 13), (0x0B80, 14), (0x0C00, 15), (0x0C80, 16), (0x0D00, 17), (0x0D80, 18), (0x0E00, 19), (0x0E80, 20), (0x0F00, 21),
    (0x1000, 22), (0x10A0, 23), (0x1100, 24), (0x1200, 25), (0x1780, 26), (0x1800, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3041, 27), (0x3100, 0),
    (0x3400, 28), (0x4DC0, 0), (0x4E00, 28), (0xA000, 0), (0xAC00, 24), (0xD7B0, 0), (0xF900, 28), (0xFB00, 1), (0xFB50, 6), (0xFE00, 0), (0x20000, 28), (0x323B0, 0),
]
N_LISTED, BLOCK_BITS = 29, 7
N_SCRIPTS = N_LISTED + (0x110000 >> BLOCK_BITS)


def _script_table() -> np.ndarray:
    """The script of every code point, 0 where it is no letter; letters outside the listed blocks have one for each 128 code points."""
    first, script = (np.array(x) for x in zip(*SCRIPTS))
    points = np.arange(0x110000)
    at = np.searchsorted(first, points, side="right") - 1
    listed = np.where(at < 0, 0, script[at])
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, np.where(listed > 0, listed, N_LISTED + (points >> BLOCK_BITS)), 0).astype(np.int16)


_SCRIPT_OF = _script_table()


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased words, each between two spaces, and where each starts."""
    joined = " " + " ".join(words).lower() + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate(([0], np.flatnonzero(points[1:] == 32) + 1)) if words else np.zeros(1, np.int64)


def _scripts(points: np.ndarray) -> np.ndarray:
    return _SCRIPT_OF[points]


def _grams(points: np.ndarray, order: int) -> np.ndarray:
    """The table place of the n-gram that starts at each code point."""
    n = max(len(points) - order + 1, 0)
    h = np.full(n, order, np.uint64)
    for k in range(order):
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ points[k : k + n].astype(np.uint64)
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, place) of every n-gram inside a word with its two borders, then each word's letters and script."""
    points, starts = _points(words)
    kinds = _scripts(points)
    owner = np.repeat(np.arange(len(words)), np.diff(starts)) if len(words) else np.empty(0, np.int64)
    owners, places = [], []
    for order in ORDERS:
        places_of = _grams(points, order)[: len(owner)]
        # an n-gram may hold the border after its word, not what follows it
        left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(owner)) if len(words) else owner
        ok = (left[: len(places_of)] + 1 >= order) & ~((order == 1) & (points[: len(places_of)] == 32))
        owners.append(owner[: len(places_of)][ok])
        places.append(places_of[ok])
    letters = np.bincount(owner, weights=(kinds[: len(owner)] > 0), minlength=len(words)).astype(np.int64)
    # the script of a word is that of its first letter; words without a letter have script 0
    script = np.zeros(len(words), np.int64)
    has = np.flatnonzero(kinds[: len(owner)] > 0)
    script[owner[has[::-1]]] = kinds[has[::-1]]
    return np.concatenate(owners), np.concatenate(places), letters, script


class Model:
    """Languages, their n-gram log probabilities and the scripts that each may use; bounded by MAX_LANGS."""

    def __init__(self, langs: list[str], table: np.ndarray, allowed: np.ndarray) -> None:
        self.langs, self.table, self.allowed = langs, table, allowed

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, languages) log scores, and each word's letters."""
        owner, place, letters, script = word_features(words)
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, weights=self.table[k][place], minlength=len(words)) - FOREIGN * ~self.allowed[k][script]
        out[letters == 0] = 0
        return out, letters


def viterbi(scores: np.ndarray, codes: np.ndarray, starts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word of every text; texts are advanced side by side, a word at a time."""
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    labels = np.zeros(len(codes), np.uint8)
    if not len(codes):
        return labels
    came = np.empty((len(codes), scores.shape[1]), np.uint8)
    alive = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")  # texts with more than t words
    own = np.arange(scores.shape[1], dtype=np.uint8)
    best = scores[codes[first[: alive[0]]]].copy()
    for t in range(1, len(alive)):
        k = alive[t]
        at, prior = first[:k] + t, best[:k]
        top = prior.argmax(axis=1)
        jump = prior[np.arange(k), top][:, None] - switch
        came[at] = np.where(prior >= jump, own, top[:, None].astype(np.uint8))
        best[:k] = np.maximum(prior, jump) + scores[codes[at]]
    state = best.argmax(axis=1).astype(np.uint8)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = first[:k] + t
        labels[at] = state[:k]
        if t:
            state[:k] = came[at, state[:k]]
    return labels


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, max_langs: int = MAX_LANGS) -> Model:
    """A model of the languages in ``labelled`` (doc_id, text, lang); null languages and texts teach nothing."""
    rows = labelled.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"over {max_langs} languages")
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, PLACES), np.float32), np.zeros((0, N_SCRIPTS), bool))
    code = {x: k for k, x in enumerate(langs)}
    # an even share of each language by a hash of the id, so that the sample is the same in every run
    share = F.element_at(F.create_map(*(F.lit(y) for x in langs for y in (x, sample_docs / sizes[x]))), F.col("lang"))
    picked = rows.where(drawn("doc_id", share)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), PLACES + N_SCRIPTS), np.int64)
        for whole in batches:
            for batch in text_slices(whole):
                starts, codes, distinct = words_of(batch.column("text"))
                owner, place, letters, script = word_features(distinct.to_pylist())
                of = np.repeat(np.array([code[x] for x in batch.column("lang").to_pylist()]), np.diff(starts))
                for k in np.unique(of):
                    times = np.bincount(codes[of == k], minlength=len(distinct))
                    total[k] += np.bincount(place, weights=times[owner], minlength=PLACES + N_SCRIPTS).astype(np.int64)
                    total[k, PLACES:] += np.bincount(script, weights=times * letters, minlength=N_SCRIPTS).astype(np.int64)
        k, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(place, pa.int64()), pa.array(total[k, place])], ["lang", "place", "n"])

    summed = map_batches(picked, count, "lang long, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((len(langs), PLACES + N_SCRIPTS))
    total[summed["lang"].to_numpy(), summed["place"].to_numpy()] = summed["n"].to_numpy()
    grams, scripts = total[:, :PLACES], total[:, PLACES:]
    table = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * PLACES)).astype(np.float32)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    allowed |= ~allowed.any(axis=0)  # a script that no language uses rules none out
    return Model(langs, table - table.mean(axis=0), allowed)


class Found:
    """Languages of a batch of texts: ``lang``, ``score`` and ``spans`` as Arrow arrays."""

    def __init__(self, texts: pa.Array, model: Model, switch: float) -> None:
        names = np.array([*model.langs, UNDETERMINED], object)
        starts, codes, distinct = words_of(texts)
        n, n_langs = len(texts), len(model.langs)
        if not n_langs:
            codes, starts = codes[:0], np.zeros_like(starts)
        scores, letters = model.scores(distinct.to_pylist()) if n_langs else (np.zeros((0, 1)), np.zeros(0, np.int64))
        labels = viterbi(scores, codes, starts, switch)
        of = np.repeat(np.arange(n), np.diff(starts))
        width = max(n_langs, 1)
        held_by = np.bincount(of * width + labels, weights=letters[codes] if len(codes) else None, minlength=n * width).reshape(n, width)
        total = held_by.sum(axis=1)
        self.score = pa.array(np.where(total > 0, held_by.max(axis=1) / np.maximum(total, 1), 0.0), pa.float64())
        self.lang = pa.array(names[np.where(total > 0, held_by.argmax(axis=1), n_langs)], pa.string())
        turn = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (labels[1:] != labels[:-1])))) if len(of) else np.zeros(0, np.int64)
        turn = turn[total[of[turn]] > 0]
        past = np.minimum(np.concatenate((turn[1:], [len(of)])) if len(turn) else turn, starts[of[turn] + 1])
        bounds = np.searchsorted(of[turn], np.arange(n + 1)).astype(np.int32)
        base = starts[of[turn]]
        spans = pa.StructArray.from_arrays([pa.array(turn - base, pa.int32()), pa.array(past - base, pa.int32()), pa.array(names[labels[turn]], pa.string())], ["first", "past", "lang"])
        self.spans = pa.ListArray.from_arrays(pa.array(bounds), spans)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, spans.

    ``spans`` lists (first, past, lang), by places of words, of runs of one language. ``lang_pred``
    holds the most letters (a tie goes to the first by name), and ``score`` is its share of them.
    A text that is null, or has no letter, is ``und`` with score 0 and no spans, and so
    are all texts if nothing was learned. A text of any length is read whole. Rows may repeat; no other column is read, and an empty table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = given.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                f = Found(batch.column("text"), held.value, switch)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), f.lang, f.score, f.spans], ["doc_id", "lang_pred", "score", "spans"])

    kind = given.schema["doc_id"].dataType.simpleString()
    return map_batches(given, run, f"doc_id {kind}, lang_pred string, score double, spans array<struct<first:int,past:int,lang:string>>")


def with_language(docs: DataFrame, model: Model, text_col: str = "text", into: str = "lang_pred", switch: float = SWITCH) -> DataFrame:
    """``docs`` as they are, with the language of each text (as in ``identify``) in a new column ``into``, which replaces one of that name; nothing is shuffled."""
    docs = docs.drop(into) if into != text_col else docs
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text_col):
                yield batch.append_column(into, Found(batch.column(text_col), held.value, switch).lang)

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(into, T.StringType())]))


def held_out(id_col: str = "doc_id", parts: int = 5, part: int = 0):
    """Whether a document is kept from learning: crc32 of its id as text, modulo ``parts``; a null id is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(True))
