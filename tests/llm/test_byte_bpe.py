import base64

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from lorekeel.llm.byte_bpe import ByteBpe, decode, encode

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

#: Leaves and windows so small that every text is joined many times.
TINY = ByteBpe(*RANKS, leaf=3, window=1)


@pytest.fixture(scope="module")
def plain():
    with open(RANKS[0], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=RANKS[1], mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@cases(st.text(alphabet=st.sampled_from(list("ab'srelvmd tT  \n\t.,!?0123é漢字。 　'’ſ́")), max_size=60))
def test_joins_agree_with_whole_texts(text):
    assert TINY.encode(text) == TINY.ordinary(text)


@settings(max_examples=150, deadline=None)
@cases(st.text(max_size=80))
def test_any_text(text):
    assert TINY.encode(text) == TINY.ordinary(text)


def test_operator_round_trip(docs_of, plain):
    texts = ["Hello  world's end", "", None, "x" * 5000, ("word " * 3000) + "tail", "tab\t\tand\n\n\nlines ", "<|endoftext|>", "naïve 漢字 123"]
    df = docs_of(texts, "bytes2 leaf")
    coded = encode(df, *RANKS)
    rows = decode(coded.selectExpr("doc_id", "ids as kept", "ids"), *RANKS).collect()
    got = {r["doc_id"]: (list(r["kept"]), bytes(r["bytes"])) for r in rows}
    assert got == {k: (plain.encode_ordinary(t or ""), (t or "").encode()) for k, t in enumerate(texts)}
    assert encode(docs_of([]), *RANKS).count() == 0
    assert "lang" in coded.columns and "text" not in coded.columns


def test_columns_of_the_same_names_are_replaced(docs_of, plain):
    rows = decode(encode(docs_of(["a b"], "ids bytes"), *RANKS), *RANKS).collect()
    assert [bytes(r["bytes"]) for r in rows] == [b"a b"] and rows[0]["lang"] == "en"
    assert list(encode(docs_of(["a b"], "ids"), *RANKS).first()["ids"]) == plain.encode_ordinary("a b")


def test_given_documents(given, given_rows, plain):
    got = {r["doc_id"]: list(r["ids"]) for r in encode(given.select("doc_id", "text"), *RANKS).collect()}
    assert got == {i: plain.encode_ordinary(t) for i, t, _ in given_rows}
