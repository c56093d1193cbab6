import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lorekeel.llm.prefix_trie import end_digests, prefix_trie, traced

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, shared):
    """{(smallest member, depth): (parent, n_convs, n_children, n_leaves, saved, digest)} by walking every conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        base = c - (c % 100 if c >= 0 else -((-c) % 100))
        full = tuple(own.get(base, [])[:h] + turns[h:]) if shared else tuple(turns)
        for d in range(len(full) + 1):
            members[full[:d]].add(c)
        ends[full].add(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    out = {}
    for path, who in members.items():
        below, todo = [], [path]
        while todo:
            p = todo.pop()
            below.append(p)
            todo += kids[p]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        listed = ",".join(map(str, sorted(ends[path]))) if path in ends else ""
        parent = min(members[path[:-1]]) if path else None
        out[min(who), len(path)] = (parent, len(who), len(kids[path]), sum(not kids[p] for p in below), saved, hashlib.sha256(listed.encode()).hexdigest())
    return out


def found(spark, rows, shared=True, **how):
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA), shared=shared, **how).collect()
    out = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in got}
    assert len(out) == len(got)
    return out


def test_bands_of_any_height_agree_with_a_walk(spark):
    rng, rows = random.Random(3), []
    for c in [*range(60), *range(300, 340), -7, -150]:
        for turn in range(rng.choice([1, 2, 3, 9, 20])):
            rows.append((c, turn, rng.choice("ab"), rng.choice(["x", "yy"]) if turn < 12 else "z"))
    rng.shuffle(rows)
    expected = plain(rows, True)
    for height in (2, 3, 8):
        assert found(spark, rows, height=height) == expected
    assert found(spark, rows, shared=False, height=3) == plain(rows, False)


def test_nulls_ties_repeats_and_lost_heads(spark):
    rows = [(1, None, None, None), (1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", None), (2, 0, "", "u"), (None, 0, "u", "a"), (3, 5, "u", "é\U0001f600"), (3, None, "s", "x"),
            (100, 0, "u", "head"), *((100 + k, 0, "u", "own") for k in range(1, 40)), *((200 + k, 0, "u", "no base") for k in range(1, 40))]
    got = found(spark, rows)
    assert got == plain(rows, True)
    assert any(e[5] != hashlib.sha256(b"").hexdigest() for (c, d), e in got.items() if d == 0)  # some are rebuilt without a turn


def test_role_and_text_are_told_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "ab", "c")]
    got = found(spark, rows, shared=False)
    assert got[1, 1][1] == 2 and got[2, 1][1] == 1


def test_a_deep_conversation_takes_several_levels(spark):
    rows = [(c, t, "u", str(t)) for c in (0, 1) for t in range(150 + 40 * c)] + [(2, t, "u", str(t) if t < 77 else "fork") for t in range(90)]
    assert found(spark, rows, shared=False, height=4) == plain(rows, False)


def test_no_row_names_more_than_a_band(spark):
    rows = traced(spark.createDataFrame([(1, t, "u", str(t)) for t in range(200)], SCHEMA), height=5).collect()
    assert all(len(a) <= 5 for r in rows for a in r["above"]) and len(rows) == 201


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty, shared=True).count() == 0
    odd = spark.createDataFrame([(1, 0, "u", "a", 9, "x", "y")], SCHEMA + ", depth long, node string, hundred string")
    assert prefix_trie(odd, shared=False).count() == 2


@pytest.mark.parametrize("step", [1, 5000])
def test_end_digests_over_chunks(spark, step):
    ids = [step * k - 7000 for k in range(3000)]
    df = spark.createDataFrame([(bytearray(b"n"), i) for i in ids] + [(bytearray(b"m"), 5)], "node binary, conv_id long")
    got = {bytes(r["node"]): r["ends_sha256"] for r in end_digests(df.repartition(3)).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), b"m": hashlib.sha256(b"5").hexdigest()}
