import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lorekeel.llm import decontaminate
from lorekeel.llm.batches import words_of
from lorekeel.llm.decontaminate import Phrases, decontaminated, folded, n_hit, shard_occurrences, with_benchmark_hits
from lorekeel.llm.fm_index import Bits, FMIndex, suffix_order

WORD = re.compile(decontaminate.WORD)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH = "item_id long, text string"


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def plain(text, items, width=10):
    """Hit places and items with an occurrence, by sliding every window over the text."""
    w, hit, found = words(text), set(), set()
    for i, t in items:
        x = words(t)
        for k in range(max(1, len(x) - width + 1)) if x else ():
            part = x[k : k + width]
            for at in range(len(w) - len(part) + 1):
                if w[at : at + len(part)] == part:
                    hit |= set(range(at, at + len(part)))
                    if i is not None:
                        found.add(str(i))
    return len(w), sorted(hit), sorted(found)


def test_suffix_order_and_rank():
    rng = np.random.default_rng(1)
    for _ in range(60):
        s = np.concatenate([rng.integers(1, rng.integers(2, 9), rng.integers(1, 150)), [0]]).astype(np.int64)
        assert suffix_order(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    bits = rng.random(1000) < 0.3
    assert Bits(bits).rank(np.arange(1001)).tolist() == [0, *np.cumsum(bits).tolist()] and Bits(bits).get(np.arange(1000)).tolist() == bits.tolist()
    same = np.array([1] * 5000 + [0])
    assert suffix_order(same).tolist() == list(range(5000, -1, -1))


def test_occurrences_against_a_scan():
    rng = np.random.default_rng(2)
    for _ in range(60):
        s = np.concatenate([rng.integers(1, 5, rng.integers(1, 200)), [0]]).astype(np.int64)
        patterns, lengths = rng.integers(1, 5, (25, 4)), rng.integers(0, 5, 25)
        patterns[patterns > s.max()] = -1
        got = sorted(zip(*(x.tolist() for x in FMIndex(s).occurrences(patterns, lengths))))
        assert got == sorted((q, i) for q in range(25) if lengths[q] for i in range(len(s)) if s[i : i + lengths[q]].tolist() == patterns[q, : lengths[q]].tolist())


@pytest.mark.parametrize("index_words", [7, 20, 1 << 20])
def test_texts_longer_than_an_index_are_cut_with_an_overlap(index_words):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in (0, 3, 40, 1, 15, 60, 0, 5)]
    pairs = [(" ".join(rng.choice("ab") for _ in range(n)), str(k)) for k, n in enumerate([1, 3, 5, 6, 6, 6])]
    phrases = Phrases(pairs)
    starts, codes, distinct = words_of(folded(pa.array(texts)))
    which, places = shard_occurrences(starts, codes, distinct, phrases, index_words)
    flat, got = [w for t in texts for w in t.split()], sorted(zip(which.tolist(), places.tolist()))
    windows = sorted({w for w, _ in pairs})
    ends = starts.tolist()
    expected = [(k, at) for k, w in enumerate(windows) for a, b in zip(ends, ends[1:]) for at in range(a, b - len(w.split()) + 1) if flat[at : at + len(w.split())] == w.split()]
    assert got == sorted(expected)


def test_folding_slices_and_nulls():
    texts = pa.array(["x", None, "Ab-1é\tÉ z\x00q", ""])
    assert folded(texts).to_pylist() == ["x", "", "ab 1é É z q", ""]
    assert folded(texts.slice(1, 2)).to_pylist() == ["", "ab 1é É z q"] and folded(texts.slice(0, 0)).to_pylist() == []


def judged(docs, bench, **how):
    rows = with_benchmark_hits(docs, bench, **how).collect()
    return [(r["doc_id"], r["text"], r["found"]) for r in rows]


def check(rows, items, width=10):
    for _, text, f in rows:
        n, hit, found = plain(text, items, width)
        got = [k for r in f["runs"] for k in range(r["first"], r["last"] + 1)]
        assert (f["n_words"], got, f["items"]) == (n, hit, found)
        low = (text or "").translate(LOWER)
        assert [words(low[s["start"] : s["end"]]) for s in f["spans"]] == [words(low)[r["first"] : r["last"] + 1] for r in f["runs"]]


@pytest.mark.parametrize("block_pairs", [200_000, 3])
def test_hits_against_a_scan(spark, docs_of, block_pairs):
    rng = random.Random(9)
    items = [(k, " ".join(rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(rng.randint(1, 14)))) for k in range(12)] + [(12, None), (13, ""), (14, "..."), (None, "zz zz"), (3, "yy yy yy")]
    texts = ["", None, "zz, ZZ! zz", "yy yy yy yy"]
    for _ in range(30):
        t = " ".join(rng.choice(["aa", "bb", "cc", "dd", "x"]) for _ in range(rng.randint(0, 60)))
        texts += [t, t.upper().replace(" ", ",\n") + "é", t + " " + rng.choice(items[:12])[1] + " tail"]
    bench = spark.createDataFrame(items, BENCH)
    rows = judged(docs_of([(5, t) for t in texts]), bench, width=4, block_pairs=block_pairs)
    assert len(rows) == len(texts)
    check(rows, items, 4)


def test_given_tables(spark, small, given_rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = judged(docs, spark.read.parquet(f"{small}/benchmark.parquet"))
    check(rows, items)
    assert any(f["items"] for _, _, f in rows)


def test_text_without_the_spans(spark, docs_of):
    bench = spark.createDataFrame([(1, "one two three"), (2, "Five six")], BENCH)
    texts = ["Zero, ONE two -three. four", "five six", None, "", "clean text", "a five SIX b one two three"]
    docs = docs_of(texts, extra="found runs items")
    out = decontaminated(docs, bench)
    assert out.columns == docs.columns
    assert [r["text"] for r in out.orderBy("doc_id").collect()] == ["Zero, . four", "", None, "", "clean text", "a  b "]


def test_long_texts_empty_tables_and_names(spark, docs_of):
    item = " ".join(f"q{k}" for k in range(30))
    long = " ".join(f"w{k % 977}" for k in range(300_000))
    bench = spark.createDataFrame([(1, item)], BENCH)
    rows = judged(docs_of([long + " " + item + " " + long, "w " * 50_000]), bench)
    assert [(f["n_words"], f["items"], [tuple(r) for r in f["runs"]]) for _, _, f in rows] == [(600_030, ["1"], [(300_000, 300_029)]), (50_000, [], [])]
    assert judged(docs_of([]), bench) == []
    none = with_benchmark_hits(docs_of(["a b"], extra="found"), spark.createDataFrame([], BENCH), into="found")
    assert [(r["found"]["n_words"], r["found"]["items"]) for r in none.collect()] == [(2, [])]
    assert none.select(n_hit(F.col("found")).alias("n")).first()["n"] == 0
