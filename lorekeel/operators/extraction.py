"""The extract, validate, repair loop over chunks, with the model as a plug.

Each round is one pass over what is still open: extraction in batches, validation as joins and rules,
and only rejected chunks go to the next round. Chunks that stay rejected after the last round are kept with
their errors.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.functions.scalars import LEAK_PREDICATES, canonical_predicate, content_hash, deterministic_id, flag_text, mention_type
from lorekeel.operators.validation import mention_errors, proposition_errors, verdicts
from lorekeel.session import cut

#: What an extractor answers for one chunk: JSON of a list of these.
MENTION_JSON = "array<struct<text:string,mention_type:string,span_start:int,span_end:int,context:string,confidence:double>>"
PROPOSITION_JSON = "array<struct<subject_id:string,object_id:string,subject_mention_id:string,object_mention_id:string,predicate:string,confidence:double>>"
ENTITY_JSON = "array<struct<text:string,label:string,start:int,end:int,confidence:double>>"
TRIPLE_JSON = "array<struct<subject:string,predicate:string,object:string,confidence:double>>"
ASSERTION_JSON = "array<struct<subject:string,predicate:string,object:string,confidence:double,negated:boolean,hedged:boolean,qualifiers:map<string,string>>>"

#: (texts, errors of the last round or None for each) -> JSON for each.
Extractor = Callable[[list[str], list[str | None]], list[str]]


def answered(tasks: DataFrame, extract: Extractor, schema: str) -> DataFrame:
    """``tasks`` (batch_id, text, hint) with ``items``: what ``extract`` answers, parsed; an answer that is no such list has none."""
    kind = tasks.schema["batch_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            hints = [None if pd.isna(h) else h for h in frame["hint"]]
            yield pd.DataFrame({"batch_id": frame["batch_id"], "raw": extract(frame["text"].fillna("").tolist(), hints)})

    raw = tasks.select("batch_id", "text", "hint").mapInPandas(run, f"batch_id {kind}, raw string")
    empty = F.from_json(F.lit("[]"), schema)
    return tasks.join(raw, "batch_id").withColumn("items", F.coalesce(F.from_json("raw", schema), empty)).drop("raw")


def retried(extract: Extractor, attempts: int = 3, wait: float = 0.5, transient: tuple = (ConnectionError, TimeoutError, OSError)) -> Extractor:
    """``extract`` called up to ``attempts`` times while it fails by what passes (a lost connection, a time-out), waiting twice as long each time."""

    def call(texts: list[str], hints: list[str | None]) -> list[str]:
        for k in range(attempts):
            try:
                return extract(texts, hints)
            except transient:
                if k + 1 == attempts:
                    raise
                time.sleep(wait * 2**k)
        raise ValueError("no attempts")

    return call


def _rounds(tasks: DataFrame, extract: Extractor, schema: str, check: Callable[[DataFrame, DataFrame], DataFrame], max_retries: int) -> tuple[DataFrame, DataFrame]:
    """(items, states): rounds of extraction over ``tasks`` (batch_id, text), each over what ``check`` (items, tasks -> errors) rejected before."""
    open_ = cut(tasks.select("batch_id", "text", F.lit(None).cast("string").alias("hint")))
    kept, states = [], []
    for retry in range(max_retries + 1):
        found = cut(answered(open_, extract, schema))
        items = found.select("batch_id", F.posexplode("items").alias("pos", "m")).select("batch_id", "pos", "m.*")
        texts = found.select("batch_id", "text")
        errors = cut(check(items, texts))
        verdict = cut(verdicts(items, errors, texts, "invalid" if schema == MENTION_JSON else "valid"))
        last = retry == max_retries
        closed = verdict if last else verdict.where("verdict = 'valid'")
        broken = errors.where("not is_warning").select("batch_id", "pos").distinct()
        kept.append(items.join(closed.select("batch_id"), "batch_id", "left_semi").join(broken, ["batch_id", "pos"], "left_anti"))
        hints = errors.where("not is_warning").groupBy("batch_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "path", "code", "message"))), "\n").alias("hint"))
        status = F.when(F.col("verdict") == "valid", "complete").otherwise("failed")
        states.append(closed.select("batch_id", status.alias("status"), F.lit(retry).alias("retries")).join(hints.withColumnRenamed("hint", "error"), "batch_id", "left"))
        if last:
            break
        open_ = cut(open_.drop("hint").join(verdict.where("verdict <> 'valid'").select("batch_id"), "batch_id", "left_semi").join(hints, "batch_id", "left"))
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, kept), reduce(DataFrame.unionByName, states)


def extract_mentions(chunks: DataFrame, extract: Extractor, max_retries: int = 3) -> tuple[DataFrame, DataFrame]:
    """(mentions, states) of ``chunks`` (batch_id, text).

    ``mentions``: batch_id, pos and the fields of a mention, those without an error of each chunk's last round. ``states``: batch_id, status
    (complete or failed), retries, and the errors of failed ones.
    """
    return _rounds(chunks, extract, MENTION_JSON, mention_errors, max_retries)


def extract_propositions(chunks: DataFrame, mentions: DataFrame, extract: Extractor, max_retries: int = 3) -> tuple[DataFrame, DataFrame]:
    """(propositions, states) of ``chunks`` (batch_id, text), whose ends must be among ``mentions`` (batch_id, id, text) of the chunk.

    The extractor reads the accepted mentions as JSON, then the text. Rounds and states are those of ``extract_mentions``; a chunk without propositions is complete.
    """
    listed = mentions.groupBy("batch_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("id", "text")))).alias("known"))
    prompt = F.concat(F.lit("Accepted mentions:\n"), F.coalesce("known", F.lit("[]")), F.lit("\n\nText:\n"), F.coalesce("text", F.lit("")))
    tasks = chunks.join(listed, "batch_id", "left").select("batch_id", prompt.alias("text"))
    known = cut(mentions.select("batch_id", "id"))
    return _rounds(tasks, extract, PROPOSITION_JSON, lambda items, _: proposition_errors(items, known), max_retries)


def extract_all(chunks: DataFrame, of_mentions: Extractor, of_propositions: Extractor, max_retries: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mentions, propositions, states) of ``chunks`` (batch_id, text): mentions first, then propositions of the chunks whose mentions are complete.

    Mentions get an ``id`` by chunk and place. Only complete chunks give rows; ``states`` has the status of each, the retries of both
    halves (``proposition_retries`` is null where the first half failed), and the errors of failed ones.
    """
    found, first = extract_mentions(chunks, of_mentions, max_retries)
    first = cut(first)
    ready = first.where("status = 'complete'").select("batch_id")
    found = cut(found.join(ready, "batch_id", "left_semi").withColumn("id", deterministic_id("batch_id", "pos")))
    stated, second = extract_propositions(chunks.join(ready, "batch_id", "left_semi"), found, of_propositions, max_retries)
    second = cut(second)
    done = second.where("status = 'complete'").select("batch_id")
    late = second.select("batch_id", F.col("status").alias("s"), F.col("retries").alias("proposition_retries"), F.col("error").alias("e"))
    states = first.join(late, "batch_id", "left").select("batch_id", F.coalesce("s", "status").alias("status"), "retries", "proposition_retries", F.coalesce("e", "error").alias("error"))
    return found.join(done, "batch_id", "left_semi"), stated.join(done, "batch_id", "left_semi"), states


def _answer_rows(chunks: DataFrame, extract: Extractor, schema: str) -> DataFrame:
    tasks = chunks.select(F.struct("document_id", "chunk_id").alias("of"), "text")
    tasks = cut(tasks.withColumn("batch_id", F.monotonically_increasing_id()).withColumn("hint", F.lit(None).cast("string")))
    found = answered(tasks.select("batch_id", "text", "hint"), extract, schema).select("batch_id", F.posexplode("items").alias("pos", "m"))
    return tasks.select("batch_id", "of").join(found, "batch_id").select("m.*", F.col("of.document_id").alias("source_doc_id"), F.col("of.chunk_id").alias("chunk_id"), "pos")


def named_entities(chunks: DataFrame, extract: Extractor) -> DataFrame:
    """(text, label, start, end, confidence, source_doc_id, chunk_id, pos): what an extractor of named entities answers for each chunk (document_id, chunk_id, text)."""
    return _answer_rows(chunks, extract, ENTITY_JSON)


def triples(chunks: DataFrame, extract: Extractor) -> DataFrame:
    """(subject, predicate, object, confidence, source_doc_id, chunk_id, pos): what an extractor of triples answers for each chunk (document_id, chunk_id, text)."""
    return _answer_rows(chunks, extract, TRIPLE_JSON)


def transcribed(files: DataFrame, transcribe: Callable[[str], dict]) -> DataFrame:
    """(document_id, title, text, language, segments, error) of the files (document_id, title, path, has_audio) with sound.

    ``transcribe`` answers text, language and segments for a path. A file that it fails on stays, with an empty text, an unknown language and the error.
    """
    kind = files.schema["document_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for one, title, path in zip(frame["document_id"], frame["title"], frame["path"]):
                try:
                    said = transcribe(path)
                    rows.append((one, title, said["text"], said.get("language", "unknown"), len(said.get("segments", [])), None))
                except Exception as failed:  # noqa: BLE001  whatever the plug raises is that file's error
                    rows.append((one, title, "", "unknown", 0, str(failed)))
            yield pd.DataFrame(rows, columns=["document_id", "title", "text", "language", "segments", "error"])

    heard = files.where("has_audio").select("document_id", "title", "path")
    return heard.mapInPandas(run, f"document_id {kind}, title string, text string, language string, segments int, error string")


def mention_rows(items: DataFrame) -> DataFrame:
    """Mentions with ids from items (document_id, chunk_id, text, mention_type, span_start, span_end, context); a span of -1 is none."""
    span = lambda c: F.when(F.col(c) >= 0, F.col(c))
    typed = items.withColumn("mention_type", mention_type("mention_type")).withColumn("span_start", span("span_start")).withColumn("span_end", span("span_end"))
    parts = ("document_id", "chunk_id", "text", "mention_type")
    return typed.withColumn("mention_id", deterministic_id(*parts)).withColumn("content_hash", content_hash(*parts))


def assertion_rows(items: DataFrame, predicates: dict[str, str] = LEAK_PREDICATES) -> DataFrame:
    """Assertions with ids from items (chunk_id, subject, predicate, object, confidence, negated, hedged, qualifiers); empty qualifiers are dropped."""
    named = items.withColumnsRenamed({"subject": "subject_text", "object": "object_text"})
    named = named.withColumn("predicate_canonical", canonical_predicate("predicate", predicates))
    named = named.withColumn("qualifiers", F.map_filter("qualifiers", lambda _, v: F.coalesce(v, F.lit("")) != ""))
    for flag in ("negated", "hedged"):
        named = named.withColumn(flag, F.coalesce(flag, F.lit(False)))
    named = named.withColumn("assertion_id", deterministic_id("subject_text", "predicate", "object_text", "chunk_id"))
    return named.withColumn("content_hash", content_hash("subject_text", "predicate", "object_text", flag_text("negated"), flag_text("hedged")))


def mention_key():
    """``{type}:{start}:{end}`` of a mention, with what is missing left empty."""
    return F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("mention_type", "span_start", "span_end")))
