import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lorekeel.operators import chunking, documents, explore, extraction, incremental, resolution, spans, textjoin, validation, vectors
from lorekeel.operators.components import components_of, connected_components


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abc .\n")), max_size=200), st.integers(2, 30), st.integers(0, 10))
def test_chunks_cover_the_text_and_keep_the_size(text, size, overlap):
    overlap = min(overlap, size - 1)
    chunks = chunking.split_text(text, size, overlap) if text.strip() else []
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    at = 0
    for c in chunks:
        at = text.index(c, max(0, at - size)) if c in text else at
    assert "".join(sorted(set("".join(chunks)))).strip() == "".join(sorted(set(text) - set(" \n"))) or " " in "".join(chunks) or "\n" in "".join(chunks)
    if not overlap:
        squeeze = lambda s: "".join(s.split())
        assert squeeze("".join(chunks)) == squeeze(text)


def test_chunks_overlap():
    text = " ".join(f"w{k}" for k in range(100))
    chunks = chunking.split_text(text, 40, 15)
    assert all(b.split()[0] in a.split() for a, b in zip(chunks, chunks[1:]))


def test_chunking_by_type(spark):
    rows = [("a", "T", "x " * 300, "bill"), ("b", "", " m ", "member_profile"), ("c", "T", " \n", "cable"), ("d", None, "y " * 900, None), ("e", "T", None, "member_profile")]
    df = spark.createDataFrame(rows, "id string, title string, content string, document_type string")
    got = {}
    for r in chunking.by_type(df).collect():
        got.setdefault(r["document_id"], []).append(r)
    assert set(got) == {"a", "b", "d"} and got["b"][0]["text"] == "m" and got["b"][0]["total_chunks"] == 1
    assert all(r["text"].startswith("T\n\nx") and r["chunk_id"] == f"a:chunk-{r['index']}" for r in got["a"]) and len(got["a"]) == got["a"][0]["total_chunks"] > 1
    assert max(len(r["text"]) for r in got["d"]) <= 1000


def test_document_projections(spark):
    bills = spark.createDataFrame([("hr1-118", 1, "House", "S", "", 118, "hr", "P", "2024-01-01", None, "u")], "id string, number int, chamber string, summary string, title string, congress int, bill_type string, policy_area string, introduced_date string, latest_action_text string, source_url string")
    b = documents.bill_documents(bills).first()
    assert (b["id"], b["content"], b["sections"]) == ("congress-bill-hr1-118", "Bill 1 (House). S", {"latest_action": ""})
    cables = spark.createDataFrame([("7", "", "Paris", None, "d", "C", ["A"], None)], "id string, subject string, origin string, content string, date string, classification string, tags array<string>, source_url string")
    c = documents.cable_documents(cables).first()
    assert (c["title"], c["content"]) == ("Cable 7", "\n\nOrigin: Paris")
    court = spark.createDataFrame([("9", "T", "", "body", "x", "d", 3, None)], "id string, title string, case_number string, content string, document_type string, date_filed string, page_count int, source_url string")
    assert documents.court_documents(court).first()["content"] == "T\n\nbody"
    media = spark.createDataFrame([("/m/MeTube/a.b.mp4", "a.b.mp4", ".mp4", 5, "/m/MeTube", {"path": "p2", "k": "v"})], "path string, filename string, extension string, size_bytes long, source_dir string, metadata map<string,string>")
    m = documents.media_documents(media).first()
    assert (m["title"], m["source"], m["metadata"]["path"], m["metadata"]["k"], m["content_hash"]) == ("a.b", "metube", "p2", "v", "")


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5), (2000, 2000)]
    parent = {}

    def root(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    df = spark.createDataFrame([*edges, (None, 1)], "u long, v long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == {a: root(a) for a in parent}
    assert connected_components(df.limit(0)).count() == 0
    for task_edges in (0, 10_000):  # by rounds and in one task
        assert {r["node"]: r["component"] for r in components_of(df, task_edges=task_edges).collect()} == {a: root(a) for a in parent}
        assert components_of(df.limit(0), task_edges=task_edges).count() == 0


def test_components_of_structs_and_strings(spark):
    """A long path, nodes that are structs with a null field, and code points beyond the first plane, which sort as their bytes do."""
    path = spark.range(5000).selectExpr("concat('n', lpad(cast((id * 7919) % 5000 as string), 5, '0')) as u", "concat('n', lpad(cast(((id + 1) * 7919) % 5000 as string), 5, '0')) as v")
    assert [tuple(r) for r in components_of(path).groupBy("component").count().collect()] == [("n00000", 5000)]
    rows = [((None, "\U0001F600"), ("g", "\uFFFD")), (("g", "\U0001F600"), ("g", "\uFFFD")), (("h", "a"), ("h", "a"))]
    df = spark.createDataFrame(rows, "u struct<k:string,t:string>, v struct<k:string,t:string>")
    got = [{(tuple(r["node"]), tuple(r["component"])) for r in components_of(df, task_edges=n).collect()} for n in (0, 100)]
    assert got[0] == got[1] == {((None, "\U0001F600"), (None, "\U0001F600")), (("g", "\uFFFD"), (None, "\U0001F600")), (("g", "\U0001F600"), (None, "\U0001F600")), (("h", "a"), ("h", "a"))}


def mention_rows(spark, texts):
    rows = [(k, f"m{k}", f"d{k % 3}", t, y) for k, (t, y) in enumerate(texts)]
    return spark.createDataFrame(rows, "ordinal long, mention_id string, document_id string, text string, mention_type string")


def test_resolution(spark):
    texts = [("Acme Corp", "ORG"), ("ACME corp ", "ORG"), ("john smith", "PERSON"), ("john smith jr", "PERSON"), ("acme", "ORG"), ("Acme Corp", "GPE"), ("a b c", "ORG"), ("a b c d", "ORG"), ("b c d x", "ORG"), ("Acme Corp", "ORG")]
    got = {(r["candidate_type"], r["canonical_name"]): r for r in resolution.resolve_mentions(mention_rows(spark, texts), "here").collect()}
    assert got["ORG", "Acme Corp"]["mention_ids"] == ["m0", "m1", "m9"] and got["ORG", "Acme Corp"]["aliases"] == ["ACME corp "]
    assert got["PERSON", "john smith"]["aliases"] == ["john smith jr"] and got["PERSON", "john smith"]["source_documents"] == ["d0", "d2"]
    assert ("ORG", "acme") in got and ("GPE", "Acme Corp") in got
    assert got["ORG", "a b c"]["mention_ids"] == ["m6", "m7"] and ("ORG", "b c d x") in got


def test_vectors_join_surfaces(spark):
    rows = mention_rows(spark, [("alpha", "ORG"), ("beta", "ORG"), ("gamma", "ORG")])
    v = spark.createDataFrame([("alpha", [1.0, 0.0]), ("beta", [0.99, 0.05]), ("gamma", [0.0, 1.0])], "norm string, embedding array<float>")
    assert sorted(len(r["mention_ids"]) for r in resolution.resolve_mentions(rows, "here", v).collect()) == [1, 2]


@pytest.mark.parametrize(
    "a, b, va, vb, expected",
    [
        ("acme", "ACME ", None, None, (1.0, "sameAs", ["exact_name", "jaccard"])),
        ("acme group", "acme", None, None, (0.8, "possibleSameAs", ["substring"])),
        ("acme big group", "acme big", None, None, (0.85, "possibleSameAs", ["substring", "jaccard"])),
        ("acme big group", "acme big", [1.0, 0.0], [1.0, 0.1], (0.9, "sameAs", ["substring", "jaccard", "embedding"])),
        ("x y z", "z y x", None, None, (0.7, "possibleSameAs", ["jaccard"])),
        ("north", "south", [1.0, 0.0], [1.0, 0.0], (0.75, "possibleSameAs", ["embedding"])),
        ("north", "south", None, None, None),
    ],
)
def test_alignment_scores(spark, a, b, va, vb, expected):
    rows = [("1", a, "ORG", [], "p", va), ("2", b, "ORG", [], "q", vb), ("3", a, "GPE", [], "q", va), ("4", a, "ORG", [], "p", va)]
    df = spark.createDataFrame(rows, "candidate_id string, canonical_name string, candidate_type string, aliases array<string>, code_location string, embedding array<float>")
    got = {(r["source_entity_id"], r["target_entity_id"]): (r["score"], r["alignment_type"], r["evidence"]) for r in resolution.align(df, ["p", "q"]).collect()}
    assert got == ({("1", "2"): expected, ("4", "2"): expected} if expected else {})


def test_canonical_and_links(spark):
    rows = [(0, "c1", "Acme", "ORG", ["ACME"], 2, "p", None), (1, "c2", "Acme Corp", "ORG", [], 5, "q", None), (2, "c3", "Zed", "ORG", [], 1, "q", None)]
    df = spark.createDataFrame(rows, "ordinal long, candidate_id string, canonical_name string, candidate_type string, aliases array<string>, mention_count long, code_location string, embedding array<float>")
    edges = spark.createDataFrame([("c1", "c2", "sameAs"), ("c2", "c3", "possibleSameAs")], "source_entity_id string, target_entity_id string, alignment_type string")
    entities = resolution.canonical_entities(df, edges)
    got = {r["canonical_name"]: r for r in entities.collect()}
    assert got["Acme Corp"]["aliases"] == ["ACME", "Acme"] and got["Acme Corp"]["mention_count"] == 7 and got["Acme Corp"]["source_code_locations"] == ["p", "q"] and "Zed" in got
    texts = spark.createDataFrame([(0, "acme", "zed holdings"), (1, "cor", "nobody"), (2, None, "")], "k int, subject_text string, object_text string")
    linked = {r["k"]: (r["subject_canonical_id"], r["object_canonical_id"]) for r in resolution.link_assertions(texts, entities).collect()}
    a, z = got["Acme Corp"]["canonical_id"], got["Zed"]["canonical_id"]
    assert linked == {0: (a, z), 1: (a, None), 2: (None, None)}


def test_containment_agrees_with_all_pairs(spark):
    rng = random.Random(3)
    texts = sorted({"".join(rng.choice("ab ") for _ in range(rng.randrange(0, 7))) for _ in range(80)})
    df = spark.createDataFrame([(0, t) for t in texts], "group int, text string")
    got = {(r["inner"], r["outer"]) for r in textjoin.containing_pairs(df, df).collect()}
    assert got == {(a, b) for a in texts for b in texts if a and b and a in b}


def test_vector_search_and_join(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 1) for _ in range(4)], k % 2) for k in range(60)] + [(100, [0.0] * 4, 0), (101, [], 0), (102, None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, g int")
    top = vectors.top_k(df, [1.0, 0, 0, 0], 5).collect()
    assert [r["score"] for r in top] == sorted((r["score"] for r in top), reverse=True) and len(top) == 5
    assert len(vectors.top_k(df, [1.0, 0, 0, 0], 5, threshold=2.0).collect()) == 0
    whole = {(r["a"], r["b"]) for r in vectors.similar_vectors(df, 0.5, block_rows=1000).collect()}
    assert whole and whole == {(r["a"], r["b"]) for r in vectors.similar_vectors(df, 0.5, block_rows=7).collect()}
    made = vectors.embedded(spark.createDataFrame([("ab",), (None,)], "text string"), lambda ts: [[float(len(t)), 1.0] for t in ts], 2).collect()
    assert [list(r["embedding"]) for r in made] == [[2.0, 1.0], [0.0, 1.0]]


def test_retrieval_budget_stops_at_the_first_overflow(spark):
    hits = spark.createDataFrame([("a", 0.9), ("b", 0.8), ("c", 0.7)], "chunk_id string, score double")
    chunks = spark.createDataFrame([("a", "d", "xxxx"), ("b", "d", "y" * 10), ("c", "d", "z")], "chunk_id string, document_id string, text string")
    row = vectors.retrieval_context(hits, chunks, 8).first()
    assert (row["context"], row["n_chunks"]) == ("xxxx", 1)


def test_mention_rules(spark):
    text = "The United Nations met."
    rows = [
        ("a", 0, "United Nations", "ORG", 4, 18, 0.9), ("a", 1, "WRONG", "ORG", 4, 18, 0.9), ("b", 0, "United Nations", "BOGUS", 4, 18, 1.5), ("c", 0, "United Nations", "company", 4, 18, None),
        ("c", 1, "United Nations", "company", 4, 18, 0.2), ("d", 0, "", None, None, None, 0.5), ("d", 1, "x", "ORG", 9, 4, 0.5),
    ]
    items = spark.createDataFrame(rows, "batch_id string, pos int, text string, mention_type string, span_start int, span_end int, confidence double")
    texts = spark.createDataFrame([(b, text) for b in "abcde"], "batch_id string, text string")
    errors = validation.mention_errors(items, texts)
    got = sorted((r["batch_id"], r["pos"] if r["pos"] is not None else -1, r["code"]) for r in errors.collect())
    assert got == sorted([
        ("a", 1, "SPAN_MISMATCH"), ("a", 1, "DUPLICATE_SPAN"), ("b", 0, "INVALID_TYPE"), ("b", 0, "CONFIDENCE_OUT_OF_RANGE"), ("c", 1, "DUPLICATE_SPAN"),
        ("d", 0, "MISSING_REQUIRED_FIELD"), ("d", 0, "MISSING_REQUIRED_FIELD"), ("d", 1, "SPAN_MISMATCH"), ("e", -1, "EMPTY_EXTRACTION"),
    ])
    verdicts = {r["batch_id"]: (r["verdict"], r["valid_items"], r["invalid_items"]) for r in validation.verdicts(items, errors, texts, "invalid").collect()}
    assert verdicts == {"a": ("ambiguous", [0], [1]), "b": ("invalid", [], [0]), "c": ("ambiguous", [0], [1]), "d": ("invalid", [], [0, 1]), "e": ("invalid", [], [])}


def test_other_rules(spark):
    places = spark.createDataFrame([("a", 0, 90.0, -180.0, "not_a_hex_value", "POINT(1 2)", 1.0), ("a", 1, 90.1, 181.0, "f0000000000000", "CIRCLE", -0.1)], "batch_id string, pos int, lat double, lon double, h3_index string, geometry_wkt string, confidence double")
    assert sorted(r["code"] for r in validation.spatial_errors(places, 7).collect()) == sorted(["COORDINATE_OUT_OF_RANGE"] * 2 + ["PRECISION_EXCEEDED", "INVALID_GEOMETRY", "CONFIDENCE_OUT_OF_RANGE"])
    sums = spark.createDataFrame([("a", 0, "equation", "x = 1", [("x", "variable")]), ("a", 1, "poem", " ", [("", "thing")])], "batch_id string, pos int, kind string, statement string, objects array<struct<symbol:string,kind:string>>")
    assert sorted(r["code"] for r in validation.math_errors(sums).collect()) == ["INVALID_TYPE", "INVALID_TYPE", "MISSING_EVIDENCE", "MISSING_EVIDENCE"]
    sets = spark.createDataFrame([("a", 0, [("e1", 0.5, 0.1, 0.1, 0.1, 0.9), ("zz", 2.0, 0.0, 0.0, 0.0, 1.0)])], "batch_id string, pos int, candidates array<struct<entity_id:string,exact:double,substring:double,jaccard:double,cosine:double,combined:double>>")
    known = spark.createDataFrame([("e1",)], "entity_id string")
    assert sorted((r["code"], r["is_warning"]) for r in validation.concordance_errors(sets, known).collect()) == [("INCONSISTENT_SCORES", True), ("SCORE_OUT_OF_RANGE", False), ("UNKNOWN_ENTITY", False)]
    props = spark.createDataFrame([("a", 0, "", None, None, None, "Bad Predicate", 0.5), ("a", 1, "k1", "k1", None, None, "owns", 2.0)], "batch_id string, pos int, subject_id string, object_id string, subject_mention_id string, object_mention_id string, predicate string, confidence double")
    errors = validation.proposition_errors(props, spark.createDataFrame([("a", "k1")], "batch_id string, id string"))
    assert sorted(r["code"] for r in errors.collect()) == ["CONFIDENCE_OUT_OF_RANGE", "INVALID_REFERENCE", "PREDICATE_FORMAT"]
    plan = {r["reason"].split(":")[0]: r for r in validation.repair_plan(errors.withColumn("current_value", F.lit("2.0"))).collect()}
    assert plan["CONFIDENCE_OUT_OF_RANGE"]["suggested_value"] == "1.0" and plan["CONFIDENCE_OUT_OF_RANGE"]["auto_applicable"] and plan["INVALID_REFERENCE"]["action"] == "delete"


def test_spans(spark):
    rows = spark.createDataFrame([("a", 0, 5), ("a", 3, 6), ("a", 5, 9), ("a", 5, 7), ("b", 1, 2)], "k string, start int, end int")
    got = sorted(tuple(r) for r in spans.non_overlapping(rows, "k", longest_first=True).collect())
    assert got == [("a", 0, 5), ("a", 5, 9), ("b", 1, 2)]
    texts = spark.createDataFrame([("1", "Ann and Ann Lee (ann)."), ("2", "none")], "id string, text string")
    names = spark.createDataFrame([("1", "ann"), ("1", "Ann Lee"), ("1", ""), ("2", "x"), ("1", "(")], "id string, entity string")
    hits = sorted((r["start"], r["end"], r["entity"]) for r in spans.annotated(texts, names).collect())
    assert hits == [(0, 3, "ann"), (8, 15, "Ann Lee"), (16, 17, "("), (17, 20, "ann")]


def test_explore(spark):
    edges = spark.createDataFrame([("a", "a", None), ("a", "b", 0.4), (" ", "b", 0.9)], "subject_text string, object_text string, confidence double")
    assert {r["node"]: r["degree"] for r in explore.node_degree(edges.limit(2)).collect()} == {"a": 3, "b": 1}
    assert edges.where(explore.confident_at_least("confidence", 0.5) & explore.endpoints_present()).count() == 1
    assert [r["n"] for r in explore.histogram(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x", 2).orderBy("bin").collect()] == [0, 2]
    labels = spark.createDataFrame([("a", "L1", 1), ("a", "L2", 2)], "text string, label string, ordinal int")
    assert {r["text"]: r["label"] for r in explore.joined_label(spark.createDataFrame([("a",), ("b",)], "text string"), labels).collect()} == {"a": "L2", "b": "UNKNOWN"}
    assert explore.facet_counts(spark.createDataFrame([("",), (None,), ("x",)], "f string"), "f").where("value = 'unknown'").first()["n"] == 2


def test_extraction_loop(spark):
    def extract(texts, hints):
        # the first answer has a wrong span, which the errors of that round let it mend
        out = []
        for t, h in zip(texts, hints):
            if t == "bad":
                out.append("no json")
            elif h is None and t == "Ann left":
                out.append('[{"text":"Ann","mention_type":"PERSON","span_start":2,"span_end":5,"confidence":0.5}]')
            else:
                out.append(f'[{{"text":"{t[:3]}","mention_type":"PERSON","span_start":0,"span_end":3,"confidence":0.5}}]')
        return out

    chunks = spark.createDataFrame([("1", "Ann left"), ("2", "Bob came"), ("3", "bad")], "batch_id string, text string")
    mentions, states = extraction.extract_mentions(chunks, extract, 2)
    assert sorted((r["batch_id"], r["text"]) for r in mentions.collect()) == [("1", "Ann"), ("2", "Bob")]
    assert {r["batch_id"]: (r["status"], r["retries"]) for r in states.collect()} == {"1": ("complete", 1), "2": ("complete", 0), "3": ("failed", 2)}


def test_store(spark, tmp_path):
    store = incremental.Store(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert store.write("x", rows) and not store.write("x", rows.orderBy(F.desc("k"))) and not store.write("x", None)
    assert store.write("x", rows, partition="p") and store.write("x", rows.union(rows))
    assert store.manifest().count() == 3 and store.timeline().count() == 3
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    new = spark.createDataFrame([(2, "B", 9), (3, "C", 8)], "k int, v string, w int")
    assert sorted(map(tuple, incremental.merged(old, new, ["k"], ["v"]).collect())) == [(1, "a", 1), (2, "B", 2), (3, "C", 8)]


@pytest.mark.parametrize("over, least", [(0.6, 2), (0.5, 1), (0.3, 2), (0.8, 3)])
def test_similar_pairs_agree_with_all_pairs(spark, over, least):
    rng = random.Random(int(over * 10) + least)
    names = {" ".join(sorted({rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9))})) for _ in range(120)}
    df = spark.createDataFrame([("g", n, n.split()) for n in sorted(names)], "group string, key string, words array<string>")
    expected = set()
    for a in names:
        for b in names:
            x, y = set(a.split()), set(b.split())
            if a < b and len(x & y) >= least and len(x & y) / len(x | y) > over:
                expected.add((a, b))
    got = {(r["a"], r["b"]) for r in textjoin.similar_pairs(df, over, least).collect()}
    assert got == expected and got
    assert {(r["a"], r["b"]) for r in textjoin.sharing_pairs(df, least).collect()} >= got


@pytest.mark.parametrize("over, least", [(0.6, 2), (0.5, 1), (0.75, 3)])
def test_similar_pairs_of_long_and_short_names(spark, over, least):
    """Names of 1 to 40 words, copies with some words changed among them, on both sides of the sizes that meet by size; a name without words, repeated names in two groups."""
    rng = random.Random(least)
    sets = []
    for size in (1, 2, 5, 9, 14, 15, 16, 17, 18, 24, 40):
        base = rng.sample(range(60), size)
        for cuts in (0, 1, 2, 3, 5):
            sets.append(frozenset(base[min(cuts, size - 1) :]) | frozenset(rng.sample(range(60, 80), cuts)))
    names = {" ".join(f"w{k}" for k in sorted(x)) for x in sets} | {""}
    df = spark.createDataFrame([(g, n, n.split()) for n in sorted(names) for g in ("g", "h")], "group string, key string, words array<string>")
    expected = set()
    for a in names:
        for b in names:
            x, y = set(a.split()), set(b.split())
            if a < b and len(x & y) >= least and len(x & y) / len(x | y) > over:
                expected |= {(g, a, b, round(len(x & y) / len(x | y), 9)) for g in ("g", "h")}
    got = [(r["group"], r["a"], r["b"], round(r["similarity"], 9)) for r in textjoin.similar_pairs(df, over, least).collect()]
    assert sorted(got) == sorted(expected) and len({len(e[1].split()) > textjoin.BY_SIZE for e in expected}) == 2
    assert textjoin.similar_pairs(df.limit(0), over, least).count() == 0


def test_keys_by_size_lose_no_pair():
    """Whatever words two names share, their first shared ones are at places that the plan looks both up by."""
    for over, least in ((0.6, 2), (0.5, 1), (0.3, 2)):
        for n, m in itertools.combinations_with_replacement(range(1, 8), 2):
            keys = {s: [p for k, lo, hi, p in textjoin._plan(sorted({n, m}), over, least) if (k, lo, hi) == (s, n, m)] for s in (n, m)}
            for o in range(least, n + 1):
                if o / (n + m - o) > over:
                    for a in itertools.combinations(range(n), o):
                        for b in itertools.combinations(range(m), o):
                            k = len(keys[n][0])
                            assert list(a[:k]) in keys[n] and list(b[:k]) in keys[m]


def test_containment_of_all_lengths(spark):
    rng = random.Random(9)
    texts = {"".join(rng.choice("ab\U0001F600") for _ in range(rng.randrange(0, 14))) for _ in range(200)} | {"a" * 7, "a" * 8, "a" * 9, "a" * 30}
    df = spark.createDataFrame([("g", t) for t in sorted(texts)], "group string, text string")
    got = sorted((r["inner"], r["outer"]) for r in textjoin.containing_pairs(df, df).collect())
    assert got == sorted((a, b) for a in texts for b in texts if a and a in b)
    long = df.where("length(text) > 9")
    assert sorted((r["inner"], r["outer"]) for r in textjoin.containing_pairs(long, df).collect()) == sorted((a, b) for a in texts for b in texts if len(a) > 9 and a in b)
    assert textjoin.containing_pairs(df.limit(0), df).count() == 0 and textjoin.containing_pairs(df, df.limit(0)).count() == 0


def test_search_against_brute_force(spark):
    import numpy as np

    from lorekeel.operators import vectors

    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    v[7] = 0
    v[20] = v[10]
    e = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(900, []), (901, None)], "vec_id long, embedding array<float>")
    asked = e.where("vec_id % 50 = 0").selectExpr("vec_id as query_id", "embedding")
    got = {(r["query_id"], r["place"]): r["vec_id"] for r in vectors.search(e, asked, 5, query_block=2).collect()}
    n = np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    u = v / np.where(n > 0, n, 1)
    for q in range(0, 300, 50):
        s = u @ u[q]
        assert [got[q, k + 1] for k in range(5)] == sorted(range(300), key=lambda i: (-round(s[i], 9), i))[:5]
    assert vectors.search(e.where("false"), asked, 5).count() == 0 and vectors.search(e, asked.where("false"), 5).count() == 0


def test_append_lines_refuses_unsafe_names(spark, tmp_path):
    import pytest

    from lorekeel.operators.incremental import append_lines
    from lorekeel.sources.records import json_lines

    rows = lambda *ids: spark.createDataFrame([(i, 1) for i in ids], "document_id string, n int")
    append_lines(rows("a-1", "b.2"), str(tmp_path / "x"))
    append_lines(rows("a-1"), str(tmp_path / "x"))
    assert sorted(r["document_id"] for r in json_lines(spark, str(tmp_path / "x"), "n int, document_id string").collect()) == ["a-1", "a-1", "b.2"]
    for bad in ("../up", "", None, "-x"):
        with pytest.raises(Exception, match="no safe name"):
            append_lines(rows(bad), str(tmp_path / "y"))


def test_extractor_is_tried_again():
    import pytest

    from lorekeel.operators.extraction import retried

    calls = []

    def flaky(texts, hints):
        calls.append(texts)
        if len(calls) < 3:
            raise TimeoutError
        return ["[]"] * len(texts)

    assert retried(flaky, 3, 0)(["a"], [None]) == ["[]"] and len(calls) == 3
    calls.clear()
    with pytest.raises(TimeoutError):
        retried(flaky, 2, 0)(["a"], [None])
    with pytest.raises(KeyError):
        retried(lambda t, h: {}["x"], 5, 0)(["a"], [None])


def test_runs_that_last(spark):
    from pyspark.sql import functions as F

    from lorekeel.streaming.metrics import sustained

    rows = [("a", 0, 1), ("a", 60, 1), ("a", 400, 1), ("a", 500, 0), ("a", 600, 1), ("b", 0, 1), ("b", 100, None), ("b", 900, 1)]
    df = spark.createDataFrame([(k, t, v) for k, t, v in rows], "k string, t long, up int").withColumn("ts", F.timestamp_seconds("t"))
    got = [(r["k"], r["n"]) for r in sustained(df, ["k"], F.col("up") == 1, 300).collect()]
    assert got == [("a", 3)]


def test_entities_and_members_are_those_of_the_candidates(spark):
    from lorekeel.operators import resolution

    rows = [(k, f"m{k}", f"d{k % 7}", ["Acme Corp Ltd", "acme corp ltd ", "Acme Corp", "Other Name", None][k % 5], "ORG") for k in range(60)] + [(99, "m1", "d1", "Acme Corp Ltd", "ORG"), (100, None, None, "Other Name", "ORG")]
    mentions = spark.createDataFrame(rows, "ordinal int, mention_id string, document_id string, text string, mention_type string")
    entities, members = resolution.entity_members(mentions, "here")
    listed = {r["candidate_id"]: r for r in resolution.resolve_mentions(mentions, "here").collect()}
    held = {r["candidate_id"]: r for r in entities.collect()}
    assert set(held) == set(listed) and len(held) == 2
    for i, r in held.items():
        assert (r["canonical_name"], r["alias_count"], r["ordinal"]) == (listed[i]["canonical_name"], len(listed[i]["aliases"]), listed[i]["ordinal"])
        assert r["document_count"] == len(listed[i]["source_documents"])
    by = {}
    for r in members.collect():
        by.setdefault(r["candidate_id"], []).append(r["mention_id"])
    assert {i: len(x) for i, x in by.items()} == {i: sum(t is not None and ("Other" in t) == ("Other" in held[i]["canonical_name"]) for _, _, _, t, _ in rows) for i in held}


def test_joins_of_names_trust_no_guessed_sizes(spark, tmp_path):
    """Sizes guessed from compressed files are far below those of exploded rows, which must not pass through the driver."""
    spark.range(3000).selectExpr("'t' as mention_type", "concat('name ', id % 50, ' of ', id) as text", "id as ordinal").write.parquet(str(tmp_path / "names"))
    names = resolution.surfaces(spark.read.parquet(str(tmp_path / "names")))
    edges = resolution.contained_pairs(names)
    assert edges.count() > 0
    joins = edges._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in joins and "SortMergeJoin" in joins


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Units are dealt to as many tasks as there may be pairs for, which combine them before they move."""
    monkeypatch.setattr(explore, "parts_for", lambda n: max(4, n // 500))
    rng = random.Random(8)
    rows = [(rng.randrange(400) if rng.random() < 0.98 else None, rng.randrange(30) if rng.random() < 0.98 else None) for _ in range(3000)]
    expected = {}
    for u in {u for u, _ in rows if u is not None}:
        for a, b in itertools.combinations(sorted({e for v, e in rows if v == u and e is not None}), 2):
            expected[a, b] = expected.get((a, b), 0) + 1
    got = explore.cooccurrence(spark.createDataFrame(rows, "chunk_id int, entity int"))
    assert {(r["a"], r["b"]): r["n"] for r in got.collect()} == expected
    exchanges = re.findall(r"hashpartitioning\((\w+)#\d+, (\d+)\)", got._jdf.queryExecution().executedPlan().toString())
    assert exchanges and all(int(n) > 10 for u, n in exchanges if u == "chunk_id" or u == "u")


def test_pairs_of_blocks_are_dealt_to_tasks(spark):
    rng = random.Random(4)
    rows = [(k, k % 2, [rng.gauss(0, 1) for _ in range(3)]) for k in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = vectors.similar_vectors(df, 0.8, group_col="label", block_rows=20)
    unit = {k: [x / sum(y * y for y in v) ** 0.5 for x in v] for k, _, v in rows}
    expected = {(a, b) for a, b in itertools.combinations(range(200), 2) if a % 2 == b % 2 and sum(x * y for x, y in zip(unit[a], unit[b])) > 0.8}
    assert {(r["a"], r["b"]) for r in got.collect()} == expected
    assert got.rdd.getNumPartitions() == 30


def test_block_searches_make_no_order_of_all_rows():
    import tracemalloc

    rng = np.random.default_rng(4)
    rows = rng.integers(-1, 2, (4000, 3)).astype(np.float32)
    rows[7] = np.nan
    v = np.concatenate([rows[:500], rows])
    frame = pd.DataFrame({"id": [*range(500), *range(4000)], "v": list(v), "asks": [True] * 500 + [False] * 4000})
    tracemalloc.start()
    got = vectors.best_of_block(30)(frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    u = vectors.units(rows)
    top = np.argsort(-(u[:500] @ u.T), axis=1, kind="stable")[:, :30]
    assert got["id"].tolist() == top.ravel().tolist() and got["query_id"].tolist() == np.repeat(np.arange(500), 30).tolist()
    # two matrices of the product and what is small beside them; three with an order of all rows
    assert peak < 2.7 * 500 * 4000 * 8
