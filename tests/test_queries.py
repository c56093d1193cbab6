import hashlib
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from lorekeel.operators import chunking
from lorekeel.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if v is None or v is pd.NA or v is pd.NaT or v != v else str(v) if hasattr(v, "isoformat") else v.item() if hasattr(v, "item") else v
    return sorted(repr(tuple(plain(v) for v in r)) for r in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_agrees_with_sql(spark, small, duck, name):
    got = registry.QUERIES[name](spark, small).toPandas()
    expected = duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows_of(got) == rows_of(expected)


def test_annotated_conversations_against_a_plain_sweep(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet").collect()
    names = {}
    for t in turns:
        names.setdefault(t["conv_id"], set()).update(re.findall("[A-Z][a-z]{3,}", t["text"]))
    expected = set()
    for t in turns:
        hits = sorted({(m.start(), -m.end()) for n in names[t["conv_id"]] for m in re.finditer(re.escape(n), t["text"], re.I)})
        last = -1
        for a, b in hits:
            if a >= last:
                expected.add((f"{t['conv_id']}:{t['turn']}", a, -b))
                last = -b
    got = [(r["id"], r["start"], r["end"]) for r in registry.QUERIES["annotated_conversations"](spark, small).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and got


def test_chunks_against_the_splitter(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    profiles = {"en": chunking.PROFILES["cable"], "de": chunking.PROFILES["bill"], "fr": None}
    for name, profile in (("chunk_recursive", lambda lang: (400, 100)), ("chunks_by_profile", lambda lang: profiles.get(lang, chunking.DEFAULT))):
        expected = {}
        for d in docs:
            sizes, text = profile(d["lang"]), d["text"] or ""
            chunks = ([text.strip()] if text.strip() else []) if sizes is None else chunking.split_text(text, *sizes)
            if sizes:
                assert all(len(c) <= sizes[0] for c in chunks) and "".join("".join(chunks).split()) and set("".join(text.split())) == set("".join("".join(chunks).split()))
            for k, c in enumerate(chunks):
                expected[f"{d['doc_id']}:chunk-{k}"] = hashlib.sha256(f"{d['source']}\n\n{c}".encode()).hexdigest()
        assert {r["chunk_id"]: r["content_hash"] for r in registry.QUERIES[name](spark, small).collect()} == expected


def test_entry_and_registration(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_spans_are_dealt_without_their_texts(spark, small):
    node = registry.QUERIES["valid_spans"](spark, small)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Window":
        node = node.children().apply(0)
    assert "size" in node.outputSet().toString() and "text" not in node.outputSet().toString()


def test_mentions_are_dealt_by_their_number(spark, small, monkeypatch):
    from lorekeel.plans import extraction_queries

    items = lambda: extraction_queries._mention_errors(spark, small)[0].rdd.getNumPartitions()
    assert items() >= 4
    monkeypatch.setattr(extraction_queries, "parts_for", lambda n: max(4, n // 100))
    assert items() > 20
