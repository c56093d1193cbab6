import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lorekeel.llm.near_dedup import near_dedup, shingle_sets, sketches


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain(rows, width, percent=80):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, len(sets[k]), least[root(k)], least[root(k)] == i) for k, (i, _) in enumerate(rows))


def found(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def family(seed, n, edits, size=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(size)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def test_families_chains_and_edge_cases(docs_of):
    texts = family(1, 25, 3) + family(2, 12, 6) + ["A b C", "a B c", "a b", "", None, "  \n", "a b c d e", "a b c d f"]
    shared = " ".join(f"p{k}" for k in range(80))
    texts += [shared + " " + " ".join(f"q{i}_{k}" for k in range(40)) for i in range(30)]
    assert found(near_dedup(docs_of(texts, "node key component members"), width=4)) == plain(list(enumerate(texts)), 4)


def test_large_bucket_takes_the_prefix_path(docs_of, monkeypatch):
    import lorekeel.llm.near_dedup as module

    monkeypatch.setattr(module, "SMALL_BUCKET", 3)
    texts = family(5, 40, 9, 90)
    assert found(near_dedup(docs_of(texts), width=5)) == plain(list(enumerate(texts)), 5)


@pytest.mark.parametrize("direct", [3, 64])
def test_hot_family_without_its_origin(docs_of, monkeypatch, direct):
    import lorekeel.llm.near_dedup as module

    monkeypatch.setattr(module, "SMALL_BUCKET", direct)
    # two rounds of edits: members of one branch link with each other, hardly with the hub
    texts = family(7, 200, 8, 100)
    for k, branch in enumerate(texts[:4]):
        for i in range(12):
            w = branch.split()
            w[(17 * i + k) % len(w)] = f"y{k}_{i}"
            texts.append(" ".join(w))
    assert found(near_dedup(docs_of(texts), width=4)) == plain(list(enumerate(texts)), 4)


def test_given_documents(given, given_rows):
    assert found(near_dedup(given, width=4)) == plain([(i, t) for i, t, _ in given_rows], 4)


def test_repeated_and_null_ids(docs_of):
    rows = near_dedup(docs_of([(3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (None, "z")]), width=4).collect()
    assert [r["component_id"] for r in rows if r["doc_id"] == 3] == [3, 3]
    assert sorted(str(r["component_id"]) for r in rows if r["doc_id"] is None) == ["3", "None"]


def test_empty_table(docs_of):
    assert near_dedup(docs_of([])).count() == 0


@pytest.mark.parametrize("size", [1, 5, 40, 400, 3000])
def test_sketch_fills_and_estimates(size):
    rng = np.random.default_rng(size)
    pool = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
    a, b = np.unique(pool[: int(1.5 * size) or 1]), np.unique(pool[size // 2 :])
    s = sketches([a, b])
    assert (s != np.iinfo(np.uint64).max).all()
    real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - real) < 0.2
    assert (sketches([a])[0] == s[0]).all()


def test_shingles_of_slices_do_not_depend_on_the_batch():
    texts = ["one two three four five", "six", None, "one two three four"]
    whole = shingle_sets(pa.array(texts), 4)
    alone = [shingle_sets(pa.array([t], pa.string()), 4)[0] for t in texts]
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(whole, alone))


def test_rows_of_one_id_are_one_document(docs_of):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = near_dedup(docs_of([(1, a), (5, a + " x"), (5, b), (9, b + " y"), (5, None), (7, "alone"), (7, ""), (8, None)]), width=4, percent=70).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows)
    assert got == [(1, 7, 1, True), (5, 0, 1, False), (5, 7, 1, False), (5, 8, 1, False), (7, 0, 7, True), (7, 1, 7, True), (8, 0, 8, True), (9, 8, 1, False)]


def test_a_very_long_text(docs_of):
    long = " ".join(f"w{k}" for k in range(200_000))
    rows = near_dedup(docs_of([long, long + " end", "w0 w1 w2 w3"]), width=4).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == [(0, 199_997, 0), (1, 199_998, 0), (2, 1, 2)]
