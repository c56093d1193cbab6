"""Operator 12, spelling variants by PartEnum signatures of letter multisets.

A word's letters, with their repetitions, are a binary vector; one inserted or deleted letter changes it in one place, one replaced
letter in two. The letters are dealt into ``PARTS`` parts, of which two changes leave at least ``PARTS - 2`` alone, so every choice of that many parts with all
that a word has in them is a signature, and two near words agree on one at least. As one edit also leaves
the first or the last half of a word alone, a signature is joined with one of these ends, which keeps anagrams apart. Signatures
meet in an equi-join, and a pair is verified where it meets: candidates are never written.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.llm.batches import map_batches, text_slices
from lorekeel.session import cut

#: Parts of the alphabet, and how many of them two changes leave alone at least.
PARTS = 4
ALONE = PARTS - 2
#: Code points of a word at least; occurrences of a word at least; a form has so many times its variant's.
LEAST_CHARS, LEAST_TIMES, TIMES = 7, 2, 10
#: Different words that a task counts before it hands them on.
HELD_WORDS = 300_000


def _counting(least_chars: int, slip_every: int | None):
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_chars)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for whole in batches:
            for batch in text_slices(whole):
                ids, texts = batch.column("id").to_pylist(), pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
                for k, i in enumerate(ids):
                    if slip_every is None:
                        counts.update(runs.findall(texts[k].as_py()))
                        continue
                    seed = zlib.crc32(b"%s:" % (i or "").encode())
                    for word, n in Counter(runs.findall(texts[k].as_py())).items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % slip_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_chars:
                                continue
                        counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield batch_of(counts)
                    counts = Counter()
        if counts:
            yield batch_of(counts)

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_times: int = LEAST_TIMES, slip_every: int | None = None) -> DataFrame:
    """(word, n) of the maximal runs of letters of all texts, A-Z lower-cased, of at least ``least_chars`` code points and ``least_times`` occurrences.

    With ``slip_every``, a run of a document whose crc32 of ``<id>:<run>`` that number divides has lost one code point, at the remainder by its length, wherever it stands in
    that document. A null text has no words, a null id counts as an empty one. Counts combine in the task, then by word.
    """
    given = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counts = map_batches(given, _counting(least_chars, slip_every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers that look random (a finaliser of shifts and odd factors)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, key) of every signature; words that one edit makes equal share a key at least, others as good as never unless their signatures agree.

    A key is made of a choice of parts, of the letters in these parts with their repetitions, and of the first or the last half of the word. Half is by
    the shorter word of a pair, so a word has the halves of its own length and of one less.
    """
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    sums = lambda x: np.add.reduceat(x, starts)
    letter = _mixed(points * np.uint64(0x9E3779B97F4A7C15))
    part = points % np.uint64(PARTS)
    held = [sums(np.where(part == p, letter, np.uint64(0))) for p in range(PARTS)]
    front = np.arange(len(points)) - np.repeat(starts, sizes)
    back = np.repeat(sizes, sizes) - 1 - front
    ends = []
    for half in (sizes // 2, (sizes - 1) // 2):
        reach = np.repeat(half, sizes)
        for place, side in ((front, 1), (back, 2)):
            own = np.where(place < reach, _mixed(letter + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.uint64(0))
            ends.append(_mixed(sums(own) + half.astype(np.uint64) * np.uint64(4) + np.uint64(side)))
    odd = sizes % 2 == 1  # both halves are one
    which, keys = [], []
    for k, chosen in enumerate(combinations(range(PARTS), ALONE)):
        sig = np.full(len(words), k, np.uint64)
        for p in chosen:
            sig = _mixed(sig * np.uint64(0x9E3779B97F4A7C15) + held[p])
        for e, end in enumerate(ends):
            own = np.flatnonzero(~odd) if e >= 2 else np.arange(len(words))
            which.append(own)
            keys.append(_mixed(sig[own] ^ end[own]))
    return np.concatenate(which), np.concatenate(keys).view(np.int64)


def _signing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            which, keys = signature_keys(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("word").take(pa.array(which)), batch.column("n").take(pa.array(which))], ["key", "word", "n"])


def near_words(words: DataFrame) -> DataFrame:
    """Distinct pairs (a, n_a, b, n_b), a < b, of ``words`` (word, n) that differ by exactly one inserted, deleted or replaced code point. A word must have a code point at least."""
    signed = map_batches(words.where("length(word) > 0"), _signing, "key long, word string, n long")
    a = signed.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = signed.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    pairs = a.join(b, "key").where("a < b and abs(length(a) - length(b)) <= 1 and levenshtein(a, b, 1) = 1")
    return pairs.select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): each word's last form, by following twice as many forms every round. Forms have many times more occurrences, so few rounds do."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = cut(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def spelling_groups(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """One row per row of ``counts`` (word, n; words distinct): word, form, root, n, n_near, form_n.

    n_near counts the words that one inserted, deleted or replaced code point makes of this one. ``form`` is the one of them with most occurrences (ties: the first in
    code-point order) if it has at least ``times`` as many, else null; ``root`` is where forms lead, the word itself if it has none. No words give no rows.
    """
    words = cut(counts.select("word", "n"))
    near = cut(near_words(words))
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(near.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    judged = words.join(best, "word", "left").withColumn("is_form", F.coalesce(-F.col("best.less") >= times * F.col("n"), F.lit(False)))
    judged = cut(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.expr("if(is_form, best.other, null)").alias("form"), F.expr("if(is_form, -best.less, null)").alias("form_n")))
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
