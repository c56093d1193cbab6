import random
import re

import numpy as np

from lorekeel.llm.quality import NAMES, P, chi2_cdf, chi2_quantile, quality_rules, robust_estimates

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(t):
    t = t or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    at = {}
    for k in range(len(w) - 2):
        at.setdefault(tuple(w[k : k + 3]), []).append(k)
    covered = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(3)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)]


def test_counts_and_base_rules(docs_of):
    texts = ["", None, " \n\t", "a b c a b c", "a a a a", "x\nx\n\n \ny\nx", "# $ | é <b>" * 20, " ".join(["one two three"] * 40), " ".join(f"w{k}" for k in range(60)), "a\x85b c\u2003d"]
    rows = {r["doc_id"]: r for r in quality_rules(docs_of(texts, "mu white distance salt own")).collect()}
    assert len(rows) == len(texts)
    for k, t in enumerate(texts):
        c = plain(t)
        assert [rows[k][n] for n in COUNTS] == c
        assert rows[k]["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert not (rows[k]["base_failed"] and rows[k]["kept"])


def test_given_documents(given, given_rows):
    rows = {r["doc_id"]: [r[n] for n in COUNTS] for r in quality_rules(given).collect()}
    assert rows == {i: plain(t) for i, t, _ in given_rows}


def test_outliers_of_a_group_go_and_the_rest_stays(spark):
    rng = random.Random(1)
    rows = []
    for k in range(400):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(120)]
        if k % 20 == 0:
            words = [w + "$#|" for w in words]
        rows.append((k, " ".join(words), ["en", None][k % 2], "s1" if k % 3 else None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(df).collect()}
    assert kept == {k: k % 20 != 0 for k in kept}


def test_an_outlier_in_any_one_statistic_goes(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    plain_words = lambda n: [word() for _ in range(n)]
    twice = plain_words(30)
    odd = {
        "v_word_length": " ".join(w * 3 for w in plain_words(120)),
        "v_symbols": " ".join(w + "|" for w in plain_words(120)),
        "v_capitals": " ".join(w.upper() for w in plain_words(120)),
        "v_marks": " ".join(w + "," for w in plain_words(120)),
        # 60 of 130 words lie in windows found twice; then lines of two words, half of them repeated, between lines of one word that differ
        "v_repeats": " ".join(twice + plain_words(70) + twice),
        "v_lines": "\n".join(x for w in plain_words(60) for x in ("abcij dfghe", w)),
    }
    assert list(odd) == NAMES
    rows = [(k, " ".join(plain_words(120))) for k in range(400)] + [(1000 + k, t) for k, t in enumerate(odd.values())]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s1' AS source")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules(df).collect()}
    assert {NAMES[k - 1000]: v for k, v in got.items() if k >= 1000} == {n: (False, False) for n in NAMES}
    assert all(kept for k, (_, kept) in got.items() if k < 1000)


def test_empty_table_and_one_group_of_equal_rows(docs_of):
    assert quality_rules(docs_of([])).count() == 0
    text = " ".join(f"w{k}" for k in range(60))
    assert all(r["kept"] for r in quality_rules(docs_of([text] * 5 + [(0, text)])).collect())


def test_estimate_resists_contamination(spark):
    rng = np.random.default_rng(5)
    good = rng.multivariate_normal(np.arange(P), np.diag(np.arange(1, P + 1) / 10), 3000)
    bad = rng.normal(40, 1, (600, P))
    frame = [("g", k % 32, *map(float, x)) for k, x in enumerate(np.vstack([good, bad]))]
    df = spark.createDataFrame(frame, "group_key string, salt long, " + ", ".join(f"{n} double" for n in NAMES))
    found = robust_estimates(df).collect()[0]
    assert np.abs(np.array(found["mu"]) - np.arange(P)).max() < 0.15 and found["rows"] == 3600


def test_quantiles():
    for df in (2, 6, 8):
        assert abs(chi2_cdf(chi2_quantile(0.975, df), df) - 0.975) < 1e-9
    assert abs(chi2_quantile(0.975, 6) - 14.449) < 1e-3


def test_small_groups_lean_on_their_language(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    clean = [(k, " ".join(word() for _ in range(120)), "en", f"s{k % 3}") for k in range(300)]
    few = [(1000 + k, " ".join(word() for _ in range(120)), "en", f"rare{k}") for k in range(6)]
    odd = [(2000 + k, " ".join(word() + "$#|&" for _ in range(120)), "en", f"odd{k // 2}") for k in range(6)]
    df = spark.createDataFrame(clean + few + odd, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(df).collect()}
    assert all(v == (k < 2000) for k, v in kept.items())
