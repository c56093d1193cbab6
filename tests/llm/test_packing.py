import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lorekeel.llm.packing import fill_window, pack, padding, plan_windows, sequences, token_pieces
from lorekeel.llm.word_bpe import WordEncoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(VOCABULARY)


def best_sum(lengths, room):
    reach = {0}
    for n, c in lengths:
        for _ in range(min(c, room // n)):
            reach |= {s + n for s in reach if s + n <= room}
    return reach


def test_fill_is_the_closest_one():
    rng = random.Random(3)
    for _ in range(300):
        capacity = rng.choice([16, 50, 100])
        lengths = sorted({rng.randrange(1, capacity + 1): rng.randrange(1, 6) for _ in range(rng.randrange(1, 6))}.items(), reverse=True)
        used = rng.randrange(1, capacity)
        picked = fill_window(lengths, capacity - used, used, capacity)
        assert all(k <= dict(lengths)[n] for n, k in picked.items())
        got = sum(n * k for n, k in picked.items())
        assert padding(used + got, capacity) == min(padding(used + s, capacity) for s in best_sum(lengths, capacity - used))


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    counts = Counter(rng.randrange(1, 65) for _ in range(5000))
    plan = plan_windows(counts, 64)
    used = Counter()
    for repeats, pattern in plan:
        assert sum(n * k for n, k in pattern.items()) <= 64
        for n, k in pattern.items():
            used[n] += repeats * k
    assert used == counts
    waste = sum(r * padding(sum(n * k for n, k in p.items()), 64) for r, p in plan)
    assert waste <= 0.01 * sum(n * k for n, k in counts.items())


TEXTS = ["Hello there, world!", "", None, "I'll say <|endoftext|> now", "ÉCOLE naïve ß Straße", "a1b22 3.14", "x" * 9000, "don't they're it's", "tab\tand\nline", "東京 ΑΣ İ", "$$$ trash### ... --", "ſ K ﬁ"] + [
    " ".join(f"word{k % 97}" for k in range(n)) for n in (3, 300, 5000, 20000)
]


def test_ids_agree_with_the_library(plain):
    import pyarrow as pa

    starts, ids = WordEncoder(VOCABULARY).encode(pa.array(TEXTS), 2)
    for k, t in enumerate(TEXTS):
        assert ids[starts[k] : starts[k + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids + [2], t


def test_letters_that_compose_in_lower_case_only(plain):
    import pyarrow as pa

    # the library composes first and lowers then; of these, only the small letters compose
    texts = ["H\u0331 h\u0331 J\u030c", "W\u030a!T\u0308'S", "\u00c9\u00d7\u00df\u00f7<\u00de|9\u00d1", "a<b>c|d", "\u00c9t\u00c9 x\u0301\x1cY"]
    starts, ids = WordEncoder(VOCABULARY).encode(pa.array(texts), None)
    for k, t in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_words_share_their_parts(plain):
    import pyarrow as pa

    encoder = WordEncoder(VOCABULARY)
    encoder.encode(pa.array(["tree tree. (tree) tree, TREE###"]), None)
    assert sum("tree" in part for part in encoder.known) == 1


def test_forgetting_words_changes_nothing(plain, monkeypatch):
    import lorekeel.llm.word_bpe as module
    import pyarrow as pa

    monkeypatch.setattr(module, "REMEMBERED", 1)
    encoder = WordEncoder(VOCABULARY)
    for t in TEXTS[:12]:
        _, ids = encoder.encode(pa.array([t], pa.string()), None)
        assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_pieces_and_sequences(docs_of, plain):
    df = docs_of(TEXTS + [(3, "same id"), (None, "no id")], "length start offset tokens")
    pieces = token_pieces(df, VOCABULARY).cache()
    rows = pack(pieces).collect()
    expected = {k: plain.encode(t or "", add_special_tokens=False).ids + [2] for k, t in enumerate(TEXTS)}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for k, ids in expected.items():
        mine = sorted(by_doc[k], key=lambda r: r["start"])
        if k == 3:
            continue
        assert b"".join(bytes(r["tokens"]) for r in mine) == np.array(ids, "<u4").tobytes()
        assert [r["start"] for r in mine] == list(np.cumsum([0] + [r["length"] for r in mine[:-1]]))
        assert {r["doc_tokens"] for r in mine} == {len(ids)}
    assert len(by_doc[3]) == 2 and len(by_doc[None]) == 1
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for mine in by_seq.values():
        at = 0
        for r in sorted(mine, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
    joined = {r["sequence_id"]: bytes(r["tokens"]) for r in sequences(pack(pieces)).collect()}
    assert sum(map(len, joined.values())) == 4 * sum(r["length"] for r in rows)


def test_query_on_given_documents(spark, small, given_rows, plain):
    from lorekeel.llm.queries import QUERIES

    rows = QUERIES["op9_packing"](spark, small).collect()
    ids = {i: np.array(plain.encode(t, add_special_tokens=False).ids + [2], "<u4") for i, t, _ in given_rows}
    assert all(zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in rows)
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))


def test_empty_table(docs_of):
    assert pack(token_pieces(docs_of([]), VOCABULARY)).count() == 0


def test_names_of_columns_do_not_matter(spark):
    rows = spark.createDataFrame([(k, 3 + k % 5, k) for k in range(20)], "_part long, length long, _local long").selectExpr("*", "'x' as piece", "7 as offset", "1 as before", "2 as `at`")
    placed = pack(rows, 8).collect()
    assert sorted((r["_part"], r["length"], r["_local"]) for r in placed) == [(k, 3 + k % 5, k) for k in range(20)]
    assert all(r["piece"] == "x" and r["before"] == 1 and r["at"] == 2 for r in placed)
    fill = {}
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
