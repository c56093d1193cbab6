import importlib.util
import os
import re

import corpus_pipeline
from lorekeel.llm.private_data import base_spans

_spec = importlib.util.spec_from_file_location("near_plain", os.path.join(os.path.dirname(__file__), "test_near_dedup.py"))
_module = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_module)
near_plain = _module.plain


def test_stages_and_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "private_data", "packing"]


def test_every_stage_against_plain_versions(spark, docs_of, given, small, tmp_path):
    docs = given.unionByName(docs_of([(10**6, "..."), (10**6 + 1, None), (10**6 + 2, "Mail bob@a.example.com now please or else")]))
    letters = lambda t: any(c.isalpha() for c in t or "")
    expected = {r["doc_id"]: r["text"] for r in docs.collect() if letters(r["text"])}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, small)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name == "packing":
            break
        assert docs.columns == columns
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "exact_dedup":
            best = {}
            for i, t in expected.items():
                z = re.sub("[\x20\x09-\x0d]", "", t)
                best[z] = min(best.get(z, (1, 0)), (-len(t), i))
            expected = {i: expected[i] for _, i in best.values()}
        elif name == "near_dedup":
            expected = {i: expected[i] for i, _, _, kept in near_plain(sorted(expected.items()), 5) if kept}
        elif name == "private_data":
            assert set(got) == set(expected)
            assert all(not base_spans(t) for t in got.values()) and got[10**6 + 2].startswith("Mail [EMAIL] now")
            assert all(got[i] == t for i, t in expected.items() if not re.search("[0-9@]", t))
            continue
        assert got == expected, name
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == set(expected)


def test_null_and_repeated_ids_stay_once(spark, docs_of, small):
    docs = docs_of([(1, "one two three"), (1, "one two three"), (1, "onetwothree"), (1, "other words"), (None, "null id here"), (None, "second null id"), (2, "null id here")])
    docs = corpus_pipeline.drop_copies(spark, docs, small)
    assert sorted(r["text"] for r in docs.collect()) == ["null id here", "one two three", "other words", "second null id"]
    assert sorted(r["text"] for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect()) == ["null id here", "one two three", "other words", "second null id"]


def test_near_copies_of_null_and_repeated_ids_go(spark, docs_of, small):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    docs = docs_of([(None, a), (None, a + " more"), (5, b), (5, b + " more"), (5, c), (3, b + " end"), (6, None), (6, None), (None, None), (4, c + " end")], extra="key key_")
    texts = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect()]
    assert len(texts) == 5 and [t for i, t in texts if i == 5] == [] and {(3, b + " end"), (4, c + " end"), (6, None), (None, None)} < set(texts)
    assert sum((t or "").startswith("a0") for _, t in texts) == 1


def test_row_keys_keep_the_order_of_ids(spark, docs_of):
    ids = [-(2**63), -5, 0, 7, 2**63 - 1]
    docs = docs_of([(i, t) for i in ids for t in ("x", "y", None)] + [(None, "x"), (None, "y")])
    rows = docs.select("doc_id", "text", corpus_pipeline._row_key(docs).alias("k")).orderBy("k").collect()
    assert len({r["k"] for r in rows}) == len(rows) and [r["doc_id"] for r in rows] == [None] * 2 + [i for i in ids for _ in range(3)]


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns)


def test_clashing_columns_and_empty_tables(spark, docs_of, small):
    given = docs_of([(1, "one two three mail bob@a.example.com"), (1, "one two three mail bob@a.example.com"), (2, "four words of text"), (3, None)], "found _found sha _sha place component piece bytes")
    for docs, n in ((given, 2), (given.where("false"), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, small)
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.count() == n and all(r["found"] == r["_sha"] == "x" for r in docs.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, small).select("doc_id").distinct().count() == n
