"""The registered queries of the operators that SQL cannot express, against plain versions of their contracts."""

import base64
import hashlib
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lorekeel.llm import toxicity
from lorekeel.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts(given_rows):
    return {i: t or "" for i, t, _ in given_rows}


def rows_of(spark, small, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, small).collect()}


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_quality_rules(spark, small, texts):
    rows = rows_of(spark, small, "op1_quality_rules")
    assert set(rows) == set(texts)
    for i, t in texts.items():
        w, r = WORD.findall(t), rows[i]
        three = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if three[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        plain = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain
        assert r["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    assert sum(r["kept"] for r in rows.values()) > 0.8 * sum(not r["base_failed"] for r in rows.values())


def test_byte_bpe(spark, small, texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = rows_of(spark, small, "op2_byte_bpe")
    for i, t in texts.items():
        ids = plain.encode_ordinary(t)
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(t))


def luhn(digits):
    twice = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def plain_spans(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for k, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits) if k == 2 else 9 <= len(digits) <= 15:
                found.append((m.start(), k, m.end()))
    return [(("email", "ip", "card", "phone")[k], a, b) for a, k, b in sorted(found)]


def test_private_data(spark, small, texts):
    rows = rows_of(spark, small, "op5_private_data")
    for i, t in texts.items():
        spans, r = plain_spans(t), rows[i]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        listed = ["%s:%d:%d" % s for s in spans]
        assert r["base_sha256"] == sha(",".join(listed)) and set(listed) <= set(filter(None, r["spans"].split(",")))


def test_language_id(spark, small, texts, given_rows):
    rows, langs = rows_of(spark, small, "op7_language_id"), {i: lang for i, _, lang in given_rows}
    for i, t in texts.items():
        r = rows[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(unicodedata.category(c)[0] == "L" for c in t))
    asked = [i for i in texts if rows[i]["held_out"] and langs[i] and rows[i]["lang_pred"] != "und"]
    assert sum(rows[i]["lang_pred"] == langs[i] for i in asked) >= 0.95 * len(asked) > 0


def test_toxicity(spark, small, texts):
    for i, r in rows_of(spark, small, "op8_toxicity").items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_automaton_against_plain_search(spark, small, given):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    lexicon = toxicity.learn(given, labels)
    terms = dict(lexicon.weights) or {"the": 1.0}
    common = Counter(toxicity.fold(w) for (t,) in given.select("text").collect() for w in WORD.findall(t or ""))
    words = [w for w, _ in common.most_common(40) if w]
    terms |= {w: 1.0 + k / 10 for k, w in enumerate(words[::4])} | {w[:4] + "*": 0.5 for w in words if len(w) > 4}
    phrases = [f"{a} {b}" for a, b in zip(words[:20], words[4:24])]
    found = toxicity.Lexicon(terms, phrases).automaton()
    for (t,) in given.select("text").limit(60).collect():
        w = [x for x in map(toxicity.fold, WORD.findall(t or "")) if x]
        starts = np.cumsum([1, *(len(x) + 1 for x in w)]).tolist()
        shielded = set()
        for p in phrases:
            a, b = p.split(" ")
            shielded |= {j for k in range(len(w) - 1) if (w[k], w[k + 1]) == (a, b) for j in (k, k + 1)}
        plain = {}
        for k, x in enumerate(w):
            weights = [v for term, v in terms.items() if (x.startswith(term[:-1]) if term.endswith("*") else x == term)]
            if weights and k not in shielded:
                plain[starts[k]] = max(weights)
        assert {a: v for a, v in toxicity.matches(f" {' '.join(w)} ", found) if a + 1} == {s - 1: v for s, v in plain.items()}


def test_texts_without_a_term_are_not_walked_but_score_the_same(given, texts):
    common = Counter(toxicity.fold(w) for t in texts.values() for w in WORD.findall(t))
    words = [w for w, _ in common.most_common(60) if w]
    lexicon = toxicity.Lexicon({words[50]: 2.0, words[55][:3] + "*": 1.0}, [f"{words[0]} {words[50]}"])
    found = lexicon.automaton()
    for r in toxicity.toxicity(given, lexicon).collect():
        w = [x for x in map(toxicity.fold, WORD.findall(texts[r["doc_id"]])) if x]
        assert sorted((h["start"], h["weight"]) for h in r["hits"]) == sorted(toxicity.matches(f" {' '.join(w)} ", found))


def test_packing(spark, small, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*plain.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    seen, sequences = Counter(), {}
    for r in QUERIES["op9_packing"](spark, small).collect():
        piece = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"] and len(piece) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        seen[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen == {i: len(x) for i, x in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096


def test_token_counts(spark, small, texts, given):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    gone = {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").where("toxic = 1 or quality = 0").collect()}
    docs, tokens = Counter(), Counter()
    for r in given.select("doc_id", "source", "lang").collect():
        if r["doc_id"] not in gone:
            docs[r["source"], r["lang"]] += 1
            tokens[r["source"], r["lang"]] += len(plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids) + 1
    got = {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in QUERIES["op10_token_counts"](spark, small).collect()}
    assert got == {k: (docs[k], tokens[k]) for k in docs}
