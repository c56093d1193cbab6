import hashlib
import re

from lorekeel.llm.exact_dedup import exact_dedup


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i))
    out = {}
    for z, members in groups.items():
        for _, i in members:
            out[i] = (min(members)[1], len(members), min(members)[1] == i, hashlib.sha256(z.encode()).hexdigest())
    return out


def found(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()}


def test_small_blocks_agree_with_plain_groups(docs_of):
    texts = ["ab cd" * 9, "abcd" * 9 + "\n", "abcd" * 9 + "x", "", None, " \t\n", "é" * 41, "é" * 41 + " ", "aa", "aaa", "a" * 8, "a" * 12, "𝄞" * 20, "𝄞" * 19]
    for block in (1, 3, 4, 4096):
        assert found(exact_dedup(docs_of(texts, "keys name level keep_id"), block=block)) == plain(list(enumerate(texts)))


def test_given_documents(given, given_rows):
    assert found(exact_dedup(given, block=64)) == plain([(i, t) for i, t, _ in given_rows])


def test_repeated_rows_keep_one_and_null_ids_come_last(docs_of):
    rows = exact_dedup(docs_of([(1, "a b"), (1, "a b"), (None, "a b"), (2, "ab")])).collect()
    assert len(rows) == 4 and sum(r["kept"] for r in rows) == 1
    assert {(r["keep_id"], r["group_size"]) for r in rows} == {(1, 4)}


def test_empty_table(docs_of):
    assert exact_dedup(docs_of([])).count() == 0


def test_names_are_places_in_sorted_order_however_rows_are_dealt(docs_of):
    from lorekeel.llm.exact_dedup import block_names, document_names

    texts = ["b" * 5 + "a", "aaaa", "c", "", None, "b b", "aaaab", "zz" * 4, "aaaab"]
    seen = set()
    for n in (1, 3, 7):
        docs = docs_of(texts).repartition(n)
        names, _ = block_names(docs, block=4)
        assert sorted(r["name"] for r in names.collect()) == list(range(names.count()))
        named = document_names(docs, block=4).collect()
        seen.add(tuple(sorted((r["doc_id"], r["level"], r["name"]) for r in named)))
        # single blocks are named in the order of their contents
        single = sorted((texts[r["doc_id"]] or "", r["name"]) for r in named if r["level"] == 0 and r["doc_id"] != 5)
        assert [x for _, x in single] == sorted(x for _, x in single)
    assert len(seen) == 1
