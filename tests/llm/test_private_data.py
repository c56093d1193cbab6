import hashlib
import random
import re

import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from lorekeel.llm.private_data import KINDS, Field, added, base_spans, find_private, fit, learn, luhn, redact, redacted, regions


def plain(t):
    t = t or ""
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=500, deadline=None)
@cases(st.text(alphabet=st.sampled_from(list("ab@@..--++0123456789 ()%_é\n")), max_size=60))
def test_base_spans(text):
    assert base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "+1" * 100_000, "1." * 100_000, "a@b" * 60_000, "0" * 5000 + ".1.1.1"):
        base_spans(t)
        added(t[:3000], [], Field())


@pytest.fixture(scope="module")
def field():
    texts = []
    for k in range(60):
        texts.append((f"call me at +1 (5{k:02d}) 555-01{k:02d} today", 3))
        texts.append((f"mail bob{k}@site{k % 7}.example.com please", 0))
        texts.append((f"host 10.0.{k}.{k + 1} is down", 1))
        texts.append((f"in the year 19{k + 10} there were {k}00 cases", None))
    seen = [(t, base_spans(t)) for t, _ in texts]
    varied = [(t.replace("+1 ", ""), [(11, 11 + 14, 3)]) for t, k in texts if k == 3]
    assert all(t[a:b][0] == "(" for t, ((a, b, _),) in varied)
    return fit(seen + varied, rounds=6)


def test_field_finds_what_the_patterns_miss(field):
    text = "call me at (999) 555-1234 today"
    assert [(text[a:b], KINDS[k]) for a, b, k in added(text, [], field)] == [("(999) 555-1234", "phone")]
    assert added("in the year 1999 there were 300 cases", [], field) == []
    assert added("plain words only", [], field) == []


def test_operator(docs_of, field):
    texts = ["x bob@a.example.com, 10.1.2.3", "", None, "nothing here", "call me at (999) 555-1234 today", "é" * 50_000 + " +49 30 1234567 x"]
    rows = {r["doc_id"]: r for r in find_private(docs_of(texts, "spans kind start"), field).collect()}
    for k, t in enumerate(texts):
        base = [(s["start"], s["end"], KINDS.index(s["kind"])) for s in rows[k]["base_spans"]]
        assert base == plain(t)
        every = [(s["start"], s["end"], KINDS.index(s["kind"])) for s in rows[k]["spans"]]
        assert set(base) <= set(every) and every == sorted(every, key=lambda s: (s[0], s[2]))
    assert len(rows[4]["spans"]) == 1
    out = {r["doc_id"]: r["text"] for r in redact(docs_of(texts), field).collect()}
    assert out[0] == "x [EMAIL], [IP]" and out[4] == "call me at [PHONE] today" and out[2] is None and out[3] == texts[3]
    assert find_private(docs_of([]), field).count() == 0


def test_overlapping_spans_are_redacted_once():
    assert redacted("ab cd ef", [(0, 4, 2), (3, 6, 3), (6, 8, 0)]) == "[CARD][EMAIL]"


def test_query_on_given_documents(spark, small, given_rows):
    from lorekeel.llm.queries import QUERIES

    rows = {r["doc_id"]: r for r in QUERIES["op5_private_data"](spark, small).collect()}
    for i, t, _ in given_rows:
        spans = plain(t)
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)
        assert rows[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in KINDS] == [sum(s[2] == j for s in spans) for j in range(4)]
        assert set(filter(None, text.split(","))) <= set(rows[i]["spans"].split(","))


def test_nothing_to_learn(docs_of):
    assert learn(docs_of([])).weights == {} and learn(docs_of(["no digits", None])).weights == {}


ATS = (" at ", " AT ", " At ", "(at)", "(At)", " (at) ", "[at]", " [at] ", " @ ")
DOTS = (".", " dot ", " DOT ", " punkt ", " punto ", " point ", " (dot) ", "[dot]")


def test_every_written_out_address_is_looked_at_and_found():
    rng = random.Random(4)
    seen = []
    for k in range(150):
        before, address, after = "x" * (k % 4) + " mail to ", f"{rng.choice(['bob', 'ann', 'li.wu'])}{rng.choice(ATS)}site{rng.choice(DOTS)}com", " please"
        seen.append((before + address + after, [(len(before), len(before) + len(address), 0)]))
        seen.append(("they are at home. Then the point was made.", []))
    trained = fit(seen, rounds=6)
    for at in ATS:
        for dot in DOTS:
            address = f"eve{at}place{dot}org"
            text = f"now mail to {address} please"
            assert any(a <= 12 and b >= 12 + len(address) for a, b in regions(text, [])), address
            assert [text[a:b] for a, b, _ in added(text, [], trained)] == [address]
    assert added("they are at home. Then they left.", [], trained) == []


def test_best_segmentation_and_log_sums_against_all_segmentations():
    import math
    import random

    import numpy as np

    from lorekeel.llm.private_data import KINDS, Candidates, Field, _sums

    def every(n, candidates, at=0):
        """All lists of candidates, one after the other, from a bound on."""
        if at == n - 1:
            yield []
            return
        yield from every(n, candidates, at + 1)
        for c in candidates:
            if c[0] == at:
                for rest in every(n, candidates, c[1]):
                    yield [c, *rest]

    rng = random.Random(4)
    for text in ("call 030-123 456 78 now", "bob at b.de, x@y.de", "10.0.0.1 and 10 . 0 . 0 . 1"):
        bounds, candidates = Field().segments(text, 0, len(text))
        assert candidates
        field = Field({f: np.array([rng.uniform(-1, 2) for _ in KINDS]) for _, _, found in candidates for f in found})
        score = np.array([field.scores(f) for _, _, f in candidates])
        top = {(i, j): s for (i, j, _), s in zip(candidates, score)}
        lists = list(every(len(bounds), candidates))
        totals = [sum(np.logaddexp.reduce(top[c[0], c[1]]) for c in x) for x in lists]
        ahead, behind = _sums(len(bounds), candidates, score)
        whole = math.log(sum(math.exp(t) for t in totals))
        assert abs(ahead[-1] - whole) < 1e-9 and abs(behind[0] - whole) < 1e-9
        margin = 0.5
        value = lambda x: sum(top[c[0], c[1]].max() - margin for c in x)
        usable = [x for x in lists if all(top[c[0], c[1]].max() > margin for c in x)]
        place = {b: k for k, b in enumerate(bounds)}
        got = field.best(text, 0, len(text), margin)
        assert abs(sum(top[place[a], place[b]][k] - margin for a, b, k in got) - max(map(value, usable))) < 1e-9
        seen = Candidates(text, 0, len(text))
        assert all(field.known[key][0] == field.scores(seen.features(i, j)).max() for i, j, key in seen.keys())


def test_number_tables_take_linear_time(spark):
    import random
    import time

    from lorekeel.llm.private_data import added, base_spans, fit

    field = fit([("call +49 30 1234567 now", base_spans("call +49 30 1234567 now"))] * 4)
    rng = random.Random(0)
    took = []
    for n in (20_000, 80_000):
        text = " ".join(str(rng.randrange(1000)) for _ in range(n // 4))
        start = time.process_time()
        added(text, base_spans(text), field)
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 1 and took[1] < 20
