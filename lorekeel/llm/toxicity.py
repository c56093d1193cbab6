"""Operator 8, toxicity by a weighted lexicon matched with Aho-Corasick.

Words are folded first: lower case, homoglyphs to the Latin letter they look like, digits and
signs inside a word to the letter they stand for, marks at the edges and accents dropped. The
lexicon is learned from labelled documents: words, and beginnings of words, far likelier in toxic
ones, if found there in many different contexts (copies of one toxic document share theirs). Phrases of a
matched word and a neighbour that mostly occur in documents that are not toxic are exceptions. One automaton
holds terms and exceptions; a word counts with its weightiest term, and not at all inside an exception.
The sum of weights is divided by a power of the text's length; that power and the logistic curve
that gives the score are the likeliest for the labels.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.llm.batches import drawn, map_batches, text_slices, words_of
from lorekeel.session import cut

#: Labelled documents that are learned from (expected number); they bound the lexicon, whose every entry was seen in several of them.
SAMPLE_DOCS = 20_000
#: Letters of a word's beginnings that may be terms, written with a star.
BEGINNINGS = range(4, 9)
#: Different words that must have stood before a term in toxic documents; the least log odds of a term.
CONTEXTS, LEAST_WEIGHT = 8, 1.5
#: Documents that an exception was seen in, and the share of them that may be toxic.
EXCEPTION_DOCS, EXCEPTION_SHARE = 5, 0.2
#: Powers of the number of words, one of which divides the sum of weights.
LENGTH_POWERS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0)
#: Places for each so many units of the log of a normalised sum, over which the curve is fitted.
BINS, WIDEST = 400, 4.0

# Letters that look like a Latin letter, and what stands for a letter inside a word.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ω": "w", "γ": "y", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ո": "n", "օ": "o", "ս": "u", "ց": "g", "հ": "h", "ք": "p",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e", "£": "l"}
_EDGES = re.compile(r"^(?:[^\w$@]|_|[$@]{2,})+|(?:[^\w$@]|_|[$@]{2,})+$")
_LOOKS, _STANDS = str.maketrans(HOMOGLYPHS), str.maketrans(SUBSTITUTES)


def fold(word: str) -> str:
    """A word as the lexicon knows it; numbers and marks alone fold to themselves or nothing."""
    word = _EDGES.sub("", word)
    if word.isascii():
        word = word.lower()
        if word.isalpha():
            return word
    else:
        plain = unicodedata.normalize("NFKD", word.lower())
        word = "".join(c for c in plain if not unicodedata.combining(c) and not 0x200B <= ord(c) <= 0x200F).translate(_LOOKS)
    if any(c.isalpha() for c in word):
        word = re.sub(r"[^\w]|_", "", word.translate(_STANDS))
    return word


def forms(word: str) -> list[str]:
    """The terms that a folded word matches."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


class Lexicon:
    """Terms with weights, exception phrases, and the curve from normalised sums to scores; bounded in size."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], power: float = 0.5, slope: float = 1.0, shift: float = 0.0) -> None:
        self.weights, self.exceptions, self.power, self.slope, self.shift = weights, exceptions, power, slope, shift

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            key = f" {term[:-1]}" if term.endswith("*") else f" {term} "
            found.add_word(key, (len(key), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        if not len(found):
            return None
        found.make_automaton()
        return found


def matches(folded: str, found: ahocorasick.Automaton) -> list[tuple[int, float]]:
    """(start, weight) of each matched word of a folded text, without those inside an exception."""
    words: dict[int, float] = {}
    shields = []
    for end, (size, weight) in found.iter(folded):
        start = end + 1 - size
        if weight:
            words[start] = max(weight, words.get(start, 0.0))
        else:
            shields.append((start, end + 1))
    return [(at, w) for at, w in words.items() if not any(a <= at < b - 1 for a, b in shields)] if shields else list(words.items())


def _folded(batch: pa.RecordBatch, found: ahocorasick.Automaton | None = None) -> tuple[list[list[str]], np.ndarray]:
    """Folded words of each text, and how many words it has; with ``found`` only of texts with a word that it matches, others have none.

    Every distinct word of the batch is folded and looked up once.
    """
    starts, codes, distinct = words_of(batch.column("text"))
    known = [fold(w) for w in distinct.to_pylist()]
    bounds = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
    if found is not None:
        hit = np.fromiter((bool(w) and any(x[1][1] for x in found.iter(f" {w} ")) for w in known), bool, len(known))
        before = np.concatenate(([0], np.cumsum(hit[codes]))) if len(codes) else np.zeros(1, np.int64)
        some = before[starts[1:]] > before[starts[:-1]]
        return [[w for w in (known[c] for c in codes[a:b].tolist()) if w] if s else [] for s, (a, b) in zip(some.tolist(), bounds)], np.diff(starts)
    words = [known[c] for c in codes.tolist()]
    return [[w for w in words[a:b] if w] for a, b in bounds], np.diff(starts)


def matched(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``rows`` with ``text`` replaced by ``n_words``, ``total`` (the sum of weights) and ``hits`` (start in the folded text, weight); columns of these names are replaced too."""
    rows = rows.drop("n_words", "total", "hits")
    held = rows.sparkSession.sparkContext.broadcast(lexicon)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = held.value.automaton()
        for whole in batches:
            for batch in text_slices(whole):
                if found is None:
                    texts, sizes = [[]] * batch.num_rows, np.diff(words_of(batch.column("text"))[0])
                else:
                    texts, sizes = _folded(batch, found)
                hits = [matches(f" {' '.join(t)} ", found) if t else [] for t in texts]
                at = batch.schema.get_field_index("text")
                out = batch.remove_column(at).append_column("n_words", pa.array(sizes, pa.int64()))
                out = out.append_column("total", pa.array([float(sum(h[1] for h in x)) for x in hits], pa.float64()))
                yield out.append_column("hits", pa.array([[{"start": a, "weight": w} for a, w in x] for x in hits], kind))

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text")
    return map_batches(rows, run, f"{kinds}n_words long, total double, hits array<struct<start:int,weight:double>>")


def _normalised(power: float):
    return F.col("total") / F.pow(F.greatest("n_words", F.lit(1)).cast("double"), F.lit(power))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, bad, good): for each term, 1 plus the log of its count, summed over toxic and other documents."""
    for whole in batches:
        for batch in text_slices(whole):
            texts, _ = _folded(batch)
            sums: dict[str, list[float]] = {}
            for toxic, words in zip(batch.column("toxic").to_pylist(), texts):
                times: Counter = Counter()
                for word, n in Counter(words).items():
                    for term in forms(word):
                        times[term] += n
                for term, n in times.items():
                    sums.setdefault(term, [0.0, 0.0])[0 if toxic else 1] += 1 + math.log(n)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums)), *(pa.array(c, pa.float64()) for c in zip(*sums.values()))], ["term", "bad", "good"])


def _contexts(terms: set[str]):
    """(term, toxic, before, word, after) for each different context of a term in a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                texts, _ = _folded(batch)
                rows = []
                for toxic, words in zip(batch.column("toxic").to_pylist(), texts):
                    padded = ["", *words, ""]
                    seen = {tuple(padded[k : k + 3]) for k, w in enumerate(words) if not terms.isdisjoint(forms(w))}
                    rows += [(t, toxic, *c) for c in seen for t in forms(c[1]) if t in terms]
                if rows:
                    columns = [pa.array(c, pa.int32() if k == 1 else pa.string()) for k, c in enumerate(zip(*rows))]
                    yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "before", "word", "after"])

    return run


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Lexicon:
    """A lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); null labels and texts teach nothing.

    Without both kinds of documents nothing is learned, and every score is 0 (1 if all are toxic).
    """
    known = labels.where("toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    count = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = count["n"], count["bad"] or 0
    if not bad or bad == n:
        return Lexicon({}, [], shift=30.0 if bad else -30.0)
    share = min(1.0, sample_docs / n)
    picked = known.where(drawn("doc_id", share))
    texts = cut(docs.select("doc_id", "text").where("text is not null").join(picked, "doc_id").select("toxic", "text"))

    totals = texts.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    bad, good = (totals["bad"] or 0) + 1, (totals["good"] or 0) + 1
    often = map_batches(texts, _terms, "term string, bad double, good double").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.round(F.log((F.col("bad") + 0.5) / bad) - F.log((F.col("good") + 0.5) / good), 6)
    likely = often.where(F.col("bad") >= CONTEXTS).withColumn("weight", odds).where(F.col("weight") >= LEAST_WEIGHT)
    likely = {r["term"]: r["weight"] for r in likely.select("term", "weight").collect()}

    around = cut(map_batches(texts, _contexts(set(likely)), "term string, toxic int, before string, word string, after string"))
    varied = around.where("toxic = 1").groupBy("term").agg(F.countDistinct("before").alias("b"), F.countDistinct("after").alias("a"))
    kept = varied.where((F.col("b") >= CONTEXTS) & (F.col("a") >= CONTEXTS)).select("term").collect()
    weights = {t: likely[t] for t in sorted((r["term"] for r in kept), key=lambda t: (-likely[t], t))}

    pairs = around.where(F.col("term").isin(*weights) if weights else F.lit(False)).select("toxic", "before", "word", "after").distinct()
    pairs = pairs.select("toxic", F.explode(F.array(F.concat_ws(" ", "before", "word"), F.concat_ws(" ", "word", "after"))).alias("phrase")).where("trim(phrase) = phrase")
    mild = pairs.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"), F.avg("toxic").alias("bad"))
    mild = mild.where((F.col("n") >= EXCEPTION_DOCS) & (F.col("bad") <= EXCEPTION_SHARE)).orderBy("phrase").select("phrase")
    lexicon = Lexicon(weights, [r["phrase"] for r in mild.collect()])

    powers = F.explode(F.array(*(F.struct(F.lit(p).alias("power"), _normalised(p).alias("x")) for p in LENGTH_POWERS))).alias("e")
    spread = matched(texts, lexicon).select("toxic", powers).select("toxic", "e.power", "e.x")
    place = F.floor(F.log(1 + F.col("x")) * BINS / WIDEST)
    rows = spread.groupBy("power", place.alias("place"), "toxic").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("x")).collect()
    fits = []
    for power in LENGTH_POWERS:
        x, y, k = (np.array([r[c] for r in rows if r["power"] == power], float) for c in ("x", "toxic", "n"))
        slope, shift = _logistic(x, y, k)
        z = np.clip(slope * x + shift, -30, 30)
        fits.append((float(k @ (y * z - np.logaddexp(0, z))), power, slope, shift))
    _, lexicon.power, lexicon.slope, lexicon.shift = max(fits)
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and shift with most likelihood under a slight pull of the slope to 0, by damped Newton steps."""
    a, b = 1.0, math.log((n @ y + 0.5) / (n @ (1 - y) + 0.5))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([n @ ((y - p) * x) - 0.01 * a, n @ (y - p)])
        v = n * p * (1 - p)
        h = np.array([[v @ (x * x) + 0.01, v @ x], [v @ x, v.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


def toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), hits (start, weight; places in the folded text).

    A null, empty or wordless text has no hits and the lowest score. A text of any length is matched whole. Where several terms
    match one word the weightiest counts, of equals any. Repeated rows are scored alike, and an empty table gives no rows.
    No other column is read, whatever its name.
    """
    rows = matched(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), lexicon)
    linear = _normalised(lexicon.power) * lexicon.slope + lexicon.shift
    return rows.select("doc_id", (1 / (1 + F.exp(-F.greatest(F.least(linear, F.lit(30.0)), F.lit(-30.0))))).alias("score"), "hits")


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2):
    """Whether a document is kept from learning: crc32 of its id as text, modulo ``parts``; a null id is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(True))
