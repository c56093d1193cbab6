import random
import re
import time

from lorekeel.operators import spans
from lorekeel.operators.spans import NameAutomaton


def plain(text, names):
    """Every hit of each name by search, then the sweep by start and length."""
    hits = sorted({(m.start(), -m.end()) for n in names if n for m in re.finditer(re.escape(n), text, re.I)})
    kept, last = [], 0
    for a, b in hits:
        if a >= last:
            kept.append((a, -b))
            last = -b
    return kept


def test_automaton_against_plain_search():
    rng = random.Random(2)
    for _ in range(300):
        names = ["".join(rng.choice("abAé") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 8))]
        text = "".join(rng.choice("abBéÉ ") for _ in range(rng.randint(0, 40)))
        assert [(a, b) for a, b, _ in NameAutomaton(names).annotations(text)] == plain(text, names)


def test_case_is_folded_point_by_point():
    text = "İstanbul ISTANBUL straße STRASSE K ſun \U00010400"
    found = {(text[a:b], n) for a, b, n in NameAutomaton(["istanbul", "straße", "k", "sun", "\U00010428", "Sun"]).hits(text)}
    assert found == {("ISTANBUL", "istanbul"), ("straße", "straße"), ("K", "k"), ("ſun", "Sun"), ("\U00010400", "\U00010428")}


def test_ten_thousand_names_are_one_walk():
    names = [f"name{k:05d}x" for k in range(10_000)]
    text = " ".join(names[::7]) * 20
    automaton = NameAutomaton(names)
    start = time.time()
    assert len(automaton.annotations(text)) == 20 * len(names[::7])
    one = time.time() - start
    start = time.time()
    assert len(automaton.annotations(text * 8)) == 160 * len(names[::7])
    assert time.time() - start < 40 * max(one, 0.05)


def test_families_parts_nulls_and_repeats(spark):
    rng = random.Random(3)
    rows = [(k % 3, k, " ".join(rng.choice(["alpha", "Beta", "beta gamma", "delta"]) for _ in range(rng.randint(0, 12)))) for k in range(200)]
    rows += [(None, 900, "alpha"), (1, 901, None), (1, 902, ""), (2, None, "beta gamma"), (7, 903, "alpha"), (0, 5, "alpha alpha"), (0, 5, "alpha alpha")]
    names = [(0, "alpha"), (0, "BETA"), (1, "beta"), (1, "Beta Gamma"), (1, "beta gamma"), (2, "gamma"), (2, None), (2, ""), (None, "alpha"), (2, "beta gamma delta")]
    texts, entities = spark.createDataFrame(rows, "family int, id int, text string"), spark.createDataFrame(names, "family int, entity string")
    expected = sorted((str(i), a, b) for f, i, t in rows if f is not None and t is not None for a, b in plain(t, [n or "" for g, n in names if g == f]))
    for part_chars in (10**6, 300):
        got = spans.annotated(texts, entities, family="family", part_chars=part_chars).collect()
        assert sorted((str(r["id"]), r["start"], r["end"]) for r in got) == expected
    assert {r["entity"] for r in got if r["end"] - r["start"] == 10} == {"Beta Gamma"}  # the first of names that differ in case
    assert spans.annotated(texts.where("false"), entities, family="family").count() == 0 and spans.annotated(texts, entities.where("false"), family="family").count() == 0


def test_all_hits_agree_with_the_join(spark):
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("abAB c") for _ in range(30))) for k in range(60)]
    names = [(k, n) for k in range(60) for n in rng.sample(["a", "ab", "ba", "aba", "c", "b c"], 3)]
    texts, entities = spark.createDataFrame(rows, "id int, text string"), spark.createDataFrame(names, "id int, entity string")
    hits = lambda df: sorted((r["id"], r["entity"], r["start"], r["end"]) for r in df.collect())
    assert hits(spans.annotated(texts, entities, all_hits=True)) == hits(spans.occurrences(texts, entities))
