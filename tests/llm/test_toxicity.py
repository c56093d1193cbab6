import random

import numpy as np
import pytest

from lorekeel.llm.toxicity import Lexicon, fold, held_out, learn, matches, toxicity


def test_fold():
    for word, plain in [("Idiot!!", "idiot"), ("1d10t", "idiot"), ("іdіоt", "idiot"), ("$cum", "scum"), ("trash$$$", "trash"), ("###", ""), ("2024", "2024"), ("m0ron,", "moron"), ("l@ser", "laser"), ("ídiot", "idiot"), ("ｉｄｉｏｔ", "idiot"), ("", "")]:
        assert fold(word) == plain, word


def test_matches_respect_exceptions_and_words():
    lexicon = Lexicon({"trash": 2.0, "idio*": 1.0, "idiot": 3.0}, ["trash can"])
    found = lexicon.automaton()
    assert [w for _, w in matches(" a trash can and trash ", found)] == [2.0]
    assert [w for _, w in matches(" idiotic idiot retrash ", found)] == [1.0, 3.0]


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(1)
    vocabulary = [f"word{k}" for k in range(300)]
    rows = []
    for k in range(600):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(10, 200))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blorp", "snark", "fizzwit"]))
        elif k % 30 == 1:
            words += ["blorp", "engine"]
        rows.append((k, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))


def test_lexicon_and_exceptions(learned):
    assert {"snark", "fizzwit"} <= set(learned.weights) and "blorp engine" in learned.exceptions


def test_scores(docs_of, learned):
    clean = " ".join(f"word{k}" for k in range(50))
    texts = [clean, clean + " $nark you f1zzw1t", clean + " blorp engine", "", None, "!!!", clean * 200]
    rows = {r["doc_id"]: r for r in toxicity(docs_of(texts + [(1, texts[1])], "hits total n_words score"), learned).collect()}
    assert rows[1]["score"] > 0.5 and all(rows[k]["score"] < 0.3 for k in (0, 2, 3, 4, 5, 6))
    assert len(rows[1]["hits"]) == 2 and rows[2]["hits"] == []
    assert toxicity(docs_of([]), learned).count() == 0


def test_nothing_to_learn(spark, docs_of):
    labels = spark.createDataFrame([(0, 0), (1, None)], "doc_id long, toxic int")
    assert all(r["score"] < 0.01 for r in toxicity(docs_of(["a", None]), learn(docs_of(["a", "b"]), labels)).collect())


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = learn(docs, labels.where(~held_out()))
    rows = toxicity(docs, lexicon).where(held_out()).join(labels, "doc_id").collect()
    said = np.array([r["score"] >= 0.3 for r in rows])
    toxic = np.array([r["toxic"] == 1 for r in rows])
    assert said[~toxic].mean() < 0.05 and said[toxic].mean() > 0.5
