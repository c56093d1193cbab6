import zlib

import numpy as np
import pytest

from lorekeel.llm.language_id import UNDETERMINED, held_out, identify, learn, viterbi


@pytest.fixture(scope="module")
def model(given):
    return learn(given.where(~held_out()).select("doc_id", "text", "lang"))


def exhaustive(scores, switch):
    best, state = scores[0].copy(), [[k] for k in range(scores.shape[1])]
    for row in scores[1:]:
        new, paths = [], []
        for k in range(len(row)):
            options = [best[j] - (0 if j == k else switch) for j in range(len(row))]
            j = int(np.argmax(options))
            new.append(options[j] + row[k])
            paths.append(state[j] + [k])
        best, state = np.array(new), paths
    return best.max(), state[int(best.argmax())]


def test_viterbi_is_optimal():
    rng = np.random.default_rng(2)
    sizes = [5, 0, 1, 30, 7, 12]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    scores = rng.normal(size=(starts[-1], 3)).astype(np.float32)
    labels = viterbi(scores, np.arange(starts[-1]), starts, 1.5)
    for a, b in zip(starts[:-1], starts[1:]):
        if b > a:
            best, _ = exhaustive(scores[a:b].astype(float), 1.5)
            mine = labels[a:b]
            assert abs(sum(scores[a + t, mine[t]] for t in range(b - a)) - 1.5 * (mine[1:] != mine[:-1]).sum() - best) < 1e-3


def test_held_out_accuracy(given, model):
    rows = identify(given, model).join(given.select("doc_id", "lang"), "doc_id").where(held_out()).collect()
    assert len(rows) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)


def test_mixed_text_has_spans(docs_of, given, model):
    by = {r["lang"]: r["text"] for r in given.where("n_chars between 400 and 3000").dropDuplicates(["lang"]).collect()}
    en, de = (" ".join(by[x].split()[:60]) for x in ("en", "de"))
    row = identify(docs_of([en + " " + de]), model).collect()[0]
    langs = [s["lang"] for s in row["spans"]]
    assert langs[0] == "en" and langs[-1] == "de" and row["spans"][0]["first"] == 0 and row["spans"][-1]["past"] == 120
    assert 0.3 < row["score"] < 0.9


def test_edge_cases(docs_of, model):
    texts = ["", None, "123 --- 4.5", " \n", "​", "漢字かな", "a", "x" * 100_000]
    rows = {r["doc_id"]: r for r in identify(docs_of(texts + [(6, "a")], "spans score lang_pred"), model).collect()}
    for k in range(5):
        assert (rows[k]["lang_pred"], rows[k]["score"], rows[k]["spans"]) == (UNDETERMINED, 0.0, [])
    assert rows[6]["lang_pred"] in model.langs and 0 < rows[7]["score"] <= 1
    assert identify(docs_of([]), model).count() == 0


def test_nothing_learned(docs_of, spark):
    none = spark.createDataFrame([(1, None, "en"), (2, "a b", None)], "doc_id long, text string, lang string")
    model = learn(none)
    assert {r["lang_pred"] for r in identify(docs_of(["some text", None]), model).collect()} == {UNDETERMINED}


def test_script_narrows(spark, docs_of):
    rows = [(k, "мама мыла раму и пошла домой", "ru") for k in range(9)] + [(20 + k, "the cat sat on the mat and went home", "en") for k in range(9)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = [r["lang_pred"] for r in identify(docs_of(["щущу жыжа", "zzz qqq"]), model).orderBy("doc_id").collect()]
    assert got == ["ru", "en"]


def test_letters_of_every_script_count(spark, docs_of, model):
    texts = ["ᠮᠣᠩᠭᠣᠯ", "ⰳⰾⰰⰳⱁⰾ", "ⵜⵉⴼⵉⵏⴰⵖ", "ㄅㄆㄇ", "ꆈꌠꉙ", "ꕙꔤ", "ﺍﺏﺕ", "ｆｕｌｌ", "ｱｲｳ", "𐌲𐌿𐍄", "𐐀𐐁", "ᱚᱞ"]
    letterless = ["٠١٢", "\u0301\u0302", "१२३", "😀 ⅷ"]
    rows = {r["doc_id"]: r for r in identify(docs_of(texts + letterless), model).collect()}
    assert [k for k in range(len(texts)) if rows[k]["lang_pred"] == UNDETERMINED or not rows[k]["score"] > 0] == []
    assert [rows[len(texts) + k]["lang_pred"] for k in range(len(letterless))] == [UNDETERMINED] * len(letterless)
    labelled = [(k, "ꆈꌠꉙ ꆈꌠ", "ii") for k in range(9)] + [(20 + k, "ꕙꔤ ꕙ", "vai") for k in range(9)]
    learned = learn(spark.createDataFrame(labelled, "doc_id long, text string, lang string"))
    assert [r["lang_pred"] for r in identify(docs_of(["ꉙꉙ", "ꔤꔤ"]), learned).orderBy("doc_id").collect()] == ["ii", "vai"]
