import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given as having
from hypothesis import settings
from hypothesis import strategies as st

from lorekeel.llm.spelling import near_words, signature_keys, spelling_groups, word_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_counts(docs, slip):
    out = Counter()
    for i, t in docs:
        for w in re.findall("[a-zÀ-ÿ]+", (t or "").translate(LOWER)):
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def plain_groups(counts):
    form = {}
    out = {}
    for w, n in counts.items():
        about = [v for v in counts if near(v, w)]
        best = min(about, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
        out[w] = [form[w], None, n, len(about), counts[form[w]] if form[w] else None]
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w][1] = root
    return {w: tuple(x) for w, x in out.items()}


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_groups(df).collect()}


def test_groups_against_all_pairs(spark):
    rng = random.Random(5)
    words = set()
    for _ in range(60):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(7, 11)))
        words.add(w)
        for _ in range(5):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abxÿ") + w[k:], w[:k] + rng.choice("abxÿ") + w[k + 1 :]])
            if len(w) >= 7:
                words.add(w)
    counts = {w: rng.choice([2, 3, 20, 25, 300, 4000]) for w in sorted(words)}
    got = grouped(spark, counts)
    assert got == plain_groups(counts)
    assert any(r[0] and r[1] != r[0] for r in got.values())  # some chain has two steps


def test_ties_long_words_and_no_words(spark):
    long = "a" * 30000
    counts = {"testing": 2, "testinb": 50, "testina": 50, long: 2, long + "b": 2, "b" + long: 30, "anagram": 2, "gramana": 90}
    assert grouped(spark, counts) == plain_groups(counts)
    assert grouped(spark, {}) == {}


@settings(max_examples=300, deadline=None)
@having(st.text("abcdeéÿ", min_size=7, max_size=16), st.integers(0, 100), st.sampled_from("abzÀ"), st.sampled_from("idr"))
def test_one_edit_leaves_a_signature(word, at, letter, how):
    k = at % (len(word) + (how == "i"))
    other = word[:k] + letter + word[k:] if how == "i" else word[:k] + (letter if how == "r" else "") + word[k + 1 :]
    if len(other) >= 7 and other != word:
        which, keys = signature_keys([word, other])
        assert set(keys[which == 0].tolist()) & set(keys[which == 1].tolist())


def test_signatures_leave_most_pairs_apart():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrst") for _ in range(9)) for _ in range(3000)})
    which, keys = signature_keys(words)
    _, sizes = np.unique(keys, return_counts=True)
    assert (sizes * (sizes - 1) // 2).sum() < len(words)


def test_near_words_of_short_ones(spark):
    df = spark.createDataFrame([(w, 1) for w in ("a", "b", "ab", "abc", "")], "word string, n long")
    assert {(r["a"], r["b"]) for r in near_words(df).collect()} == {("a", "b"), ("a", "ab"), ("ab", "b"), ("ab", "abc")}


def test_counts_of_nulls_repeats_and_marks(spark, docs_of):
    texts = [None, "", "Zebrafinch zebrafinch's ZEBRAFINCH", "Éclairage éclairage éclairage", (7, "lantern-lighter lighter2lighter"), (7, "lantern-lighter"), (7, "short words of it"), "straßenbahn " * 3, "漢字lanternsx漢字 lanternsx"]
    docs = docs_of(texts, extra="word n")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for slip in (2, 3, 31):
        assert {r["word"]: r["n"] for r in word_counts(docs, slip_every=slip).collect()} == plain_counts(rows, slip)
    kept = {r["word"]: r["n"] for r in word_counts(docs).collect()}
    assert kept == {"zebrafinch": 3, "lantern": 2, "lighter": 4, "straßenbahn": 3, "lanternsx": 2, "éclairage": 2}
    nameless = spark.createDataFrame([(None, "lanterns lanterns"), (None, None)], "doc_id long, text string")
    assert [(r["word"], r["n"]) for r in word_counts(nameless, slip_every=10**9).collect()] == [("lanterns", 2)]
    assert word_counts(docs_of([])).count() == 0
