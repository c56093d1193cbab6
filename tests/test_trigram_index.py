import os
import random
import shutil

import pytest

from lorekeel.operators.trigram_index import TrigramIndex

TEXTS, ASKED = "id long, text string", "pattern_id string, pattern string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    words = ["alpha", "Beta", "gämma", "delta.x", "epsilon", "straße", "漢字漢", "the"]
    return [(k, " ".join(rng.choice(words) + (str(rng.randint(0, 9)) if rng.random() < 0.2 else "") for _ in range(rng.randint(0, 15)))) for k in range(300)] + [(900, None), (901, ""), (902, "ab"), (903, "THE END" * 500)]


def plain(rows, patterns):
    return sorted((p, i) for p, x in patterns if x for i, t in rows if t is not None and x.lower() in t.lower())


def found(index, spark, patterns):
    return sorted((r["pattern_id"], r["id"]) for r in index.search(spark.createDataFrame(patterns, ASKED)).collect())


PATTERNS = [("a", "alpha beta"), ("b", "ÄMMA"), ("c", "a.x"), ("d", "not there"), ("e", ""), ("f", None), ("g", "字漢"), ("h", "t"), ("i", "END"), ("j", "9 "), ("k", "endthe end"), ("l", "the")]


def test_matches_of_several_batches_are_those_of_a_scan(spark, rows, tmp_path):
    index = TrigramIndex(spark, str(tmp_path / "i"), buckets=8)
    assert found(index, spark, PATTERNS) == [] and index.batches() == []
    for k in range(3):
        assert index.add(spark.createDataFrame(rows[k::3], TEXTS), f"b{k}")
        assert found(index, spark, PATTERNS) == plain([r for j in range(k + 1) for r in rows[j::3]], PATTERNS)
    assert not index.add(spark.createDataFrame(rows, TEXTS), "b1") and index.batches() == ["b0", "b1", "b2"]


def test_a_batch_that_breaks_off_does_not_count(spark, rows, tmp_path, monkeypatch):
    index = TrigramIndex(spark, str(tmp_path / "i"), buckets=4)
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        df = spark.range(3).selectExpr("id", "'alpha' as text")
        with pytest.raises(RuntimeError):
            index.add(df, "b0")
    assert found(index, spark, PATTERNS) == []
    assert index.add(spark.createDataFrame(rows, TEXTS), "b0") and found(index, spark, PATTERNS) == plain(rows, PATTERNS)


def test_only_the_folders_of_what_is_asked_are_read(spark, rows, tmp_path):
    index = TrigramIndex(spark, str(tmp_path / "i"), buckets=32)
    index.add(spark.createDataFrame(rows, TEXTS), "b0")
    folder = index._folders()[0]
    asked = [("i", "endthe e")]
    held = {index.spark.createDataFrame([(g,)], "gram string").select(index._bucket("gram")).first()[0] for g in ("end", "ndt", "dth", "the", "he ", "e e")}
    for kind in ("counts", "postings"):
        for name in os.listdir(tmp_path / "i" / kind / folder):
            if name.startswith("bucket=") and int(name.split("=")[1]) not in held:
                shutil.rmtree(tmp_path / "i" / kind / folder / name)
    assert found(index, spark, asked) == [("i", 903)]


def test_candidates_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """Few trigrams and many patterns: candidates are no rows of a few buckets of counts, and repeated ids count once."""
    from lorekeel.operators import trigram_index

    monkeypatch.setattr(trigram_index, "parts_for", lambda n: max(4, n // 500))
    rng = random.Random(3)
    rows = [(k % 1900, "".join(rng.choice("ab") for _ in range(30))) for k in range(2000)]
    asked = [(str(k), "".join(rng.choice("ab") for _ in range(7))) for k in range(40)]
    index = TrigramIndex(spark, str(tmp_path / "i"), buckets=4)
    index.add(spark.createDataFrame(rows, TEXTS), "b")
    got = index.search(spark.createDataFrame(asked, ASKED))
    assert sorted((r["pattern_id"], r["id"]) for r in got.collect()) == sorted(set(plain(rows, asked)))
    assert got.rdd.getNumPartitions() > 20
