"""Registered queries of validators, repairs, the extraction loop with plugs in place of models, and spans over whole texts."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.operators import chunking, extraction, spans, validation
from lorekeel.plans.base import query
from lorekeel.plans.views import table
from lorekeel.session import parts_for

# --- mentions of whole texts: every word of every turn, some of them spoilt, a batch for each conversation ------

_PLACED_SQL = """
c AS (SELECT conv_id, turn, text, string_split(text, ' ') AS w FROM conversations),
t AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS source FROM conversations GROUP BY conv_id),
w AS (SELECT conv_id, unnest(string_split(source, ' ')) AS word, generate_subscripts(string_split(source, ' '), 1) - 1 AS pos FROM t),
p AS (SELECT conv_id, pos, word, coalesce(sum(length(word) + 1) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM w),
m AS (
  SELECT conv_id AS batch_id, pos, CASE WHEN pos % 11 = 3 THEN '' WHEN pos % 7 = 3 THEN upper(word) ELSE word END AS text, CASE WHEN pos % 13 = 6 THEN 'thing' WHEN pos % 19 = 1 THEN '' WHEN pos % 5 = 0 THEN 'company' ELSE 'ORG' END AS kind,
         start + CASE WHEN pos % 29 = 4 THEN 1000000 ELSE 0 END AS s, start + length(word) + CASE WHEN pos % 29 = 4 THEN 1000000 ELSE 0 END AS e, (pos % 23) / 20.0 AS confidence, word
  FROM p WHERE conv_id % 10 <> 9
  UNION ALL SELECT conv_id, pos + 1000000, word, 'ORG', start, start + length(word), 0.5, word FROM p WHERE pos % 31 = 7 AND conv_id % 10 <> 9
), clean AS (SELECT *, s >= 0 AND s < e AND e < 1000000 AS in_range, row_number() OVER (PARTITION BY batch_id, s, e ORDER BY pos) > 1 AS again FROM m
), errors AS (
  SELECT batch_id, pos, 'MISSING_REQUIRED_FIELD' AS code FROM clean WHERE text = '' UNION ALL SELECT batch_id, pos, 'MISSING_REQUIRED_FIELD' FROM clean WHERE kind = '' UNION ALL
  SELECT batch_id, pos, 'SPAN_MISMATCH' FROM clean WHERE (in_range AND text <> word) OR NOT in_range UNION ALL SELECT batch_id, pos, 'INVALID_TYPE' FROM clean WHERE kind = 'thing' UNION ALL
  SELECT batch_id, pos, 'CONFIDENCE_OUT_OF_RANGE' FROM clean WHERE confidence > 1 UNION ALL SELECT batch_id, pos, 'DUPLICATE_SPAN' FROM clean WHERE again UNION ALL
  SELECT DISTINCT conv_id, NULL, 'EMPTY_EXTRACTION' FROM conversations WHERE conv_id % 10 = 9
)"""


#: Code points of a word with the blank after it, at the least that counts on average.
_WORD = 4


def _sources(spark, d) -> tuple[DataFrame, int]:
    """(batch_id, text): the turns of each conversation in order, a blank between them; and how many tasks their words are worth, by which they are dealt."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("batch_id"), "turn", "text")
    parts = parts_for((c.agg(F.sum(F.length("text"))).first()[0] or 0) // _WORD)
    return c.repartition(parts, "batch_id").groupBy("batch_id").agg(F.array_join(turns["text"], " ").alias("text")), parts


def _words(sources: DataFrame) -> DataFrame:
    """(batch_id, pos, word, start): every word of every text; the parts of a text are summed once, in order."""
    each = sources.select("batch_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    before = Window.partitionBy("batch_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("start", F.coalesce(F.sum(F.length("word") + 1).over(before), F.lit(0)).cast("int"))


def _mention_errors(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    texts, parts = _sources(spark, d)
    p = _words(texts).where("batch_id % 10 <> 9")
    of = lambda n, k: F.col("pos") % n == k
    moved = F.when(of(29, 4), 1_000_000).otherwise(0)
    spoilt = p.select(
        "batch_id", "pos", F.when(of(11, 3), "").when(of(7, 3), F.upper("word")).otherwise(F.col("word")).alias("text"), F.when(of(13, 6), "thing").when(of(19, 1), "").when(of(5, 0), "company").otherwise("ORG").alias("mention_type"),
        (F.col("start") + moved).alias("span_start"), (F.col("start") + F.length("word") + moved).alias("span_end"), (F.col("pos") % 23 / 20).alias("confidence"),
    )
    again = p.where(of(31, 7)).select("batch_id", (F.col("pos") + 1_000_000).alias("pos"), F.col("word").alias("text"), F.lit("ORG").alias("mention_type"), F.col("start").alias("span_start"), (F.col("start") + F.length("word")).alias("span_end"), F.lit(0.5).alias("confidence"))
    items = spoilt.unionByName(again).repartition(parts, "batch_id")
    return items, texts, validation.mention_errors(items, texts)


@query(f"WITH {_PLACED_SQL} SELECT code, count(*) AS n FROM errors GROUP BY code")
def mention_error_codes(spark, d):
    return _mention_errors(spark, d)[2].groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_PLACED_SQL}, b AS (SELECT DISTINCT batch_id, pos FROM errors WHERE pos IS NOT NULL), v AS (SELECT m.batch_id, count(*) FILTER (b.pos IS NULL) AS valid_count, count(*) FILTER (b.pos IS NOT NULL) AS invalid_count FROM m LEFT JOIN b ON m.batch_id = b.batch_id AND m.pos = b.pos GROUP BY 1)
SELECT batch_id, CASE WHEN invalid_count = 0 THEN 'valid' WHEN valid_count = 0 THEN 'invalid' ELSE 'ambiguous' END AS verdict, valid_count, invalid_count FROM v UNION ALL SELECT DISTINCT conv_id, 'invalid', 0, 0 FROM conversations WHERE conv_id % 10 = 9""")
def mention_verdicts(spark, d):
    items, texts, errors = _mention_errors(spark, d)
    return validation.verdicts(items, errors, texts, "invalid").select("batch_id", "verdict", "valid_count", "invalid_count")


@query(f"""WITH {_PLACED_SQL} SELECT CASE code WHEN 'DUPLICATE_SPAN' THEN 'delete' WHEN 'INVALID_TYPE' THEN 'coerce' WHEN 'CONFIDENCE_OUT_OF_RANGE' THEN 'coerce' ELSE 'replace' END AS action, code IN ('DUPLICATE_SPAN', 'CONFIDENCE_OUT_OF_RANGE') AS auto_applicable,
CASE WHEN code = 'CONFIDENCE_OUT_OF_RANGE' THEN '1.0' END AS suggested_value, count(*) AS n FROM errors WHERE pos IS NOT NULL GROUP BY 1, 2, 3""")
def repair_actions(spark, d):
    items, _, errors = _mention_errors(spark, d)
    valued = errors.join(items.select("batch_id", "pos", F.col("confidence").alias("current_value")), ["batch_id", "pos"])
    return validation.repair_plan(valued).groupBy("action", "auto_applicable", "suggested_value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, 'EVIDENCE_LENGTH' AS code, true AS is_warning FROM part WHERE p_size % 3 = 1")
def evidence_warnings(spark, d):
    p = table(spark, d, "part")
    one = F.struct(F.col("p_name").alias("text"), F.lit(3).alias("span_start"), (F.length("p_name") + 3 + (F.col("p_size") % 3 == 1).cast("int")).alias("span_end"))
    items = p.select(
        F.col("p_partkey").alias("batch_id"), F.lit(0).alias("pos"), F.col("p_name").alias("text"), F.lit("ORG").alias("mention_type"), F.lit(0).alias("span_start"), F.length("p_name").alias("span_end"), F.lit(0.5).alias("confidence"), F.array(one).alias("evidence"),
    )
    found = validation.mention_errors(items, p.select(F.col("p_partkey").alias("batch_id"), F.col("p_name").alias("text")))
    return found.select(F.col("batch_id").alias("p_partkey"), "code", "is_warning")


@query("""WITH e AS (SELECT user_id, value / 3 - 60 AS lat, value - 200 AS lon, event_id % 16 AS resolution, CAST(CAST(round(value) AS BIGINT) AS VARCHAR) AS x, event_type, value / 400 AS confidence FROM events),
b AS (SELECT user_id, lat NOT BETWEEN -90 AND 90 OR lon NOT BETWEEN -180 AND 180 OR resolution > 12 OR event_type = 'error' OR confidence > 1 AS bad FROM e)
SELECT user_id AS batch_id, count(*) FILTER (NOT bad) AS valid_count, count(*) FILTER (bad) AS invalid_count, CASE WHEN count(*) FILTER (bad) = 0 THEN 'valid' WHEN count(*) FILTER (NOT bad) = 0 THEN 'invalid' ELSE 'ambiguous' END AS verdict FROM b GROUP BY user_id""")
def spatial_verdicts(spark, d):
    rows = _groundings(spark, d)
    return validation.verdicts(rows, validation.spatial_errors(rows, 12)).select("batch_id", "valid_count", "invalid_count", "verdict")


def _groundings(spark, d) -> DataFrame:
    value = F.round("value").cast("long").cast("string")
    geometry = F.when(F.col("event_type") == "error", F.concat(F.lit("CIRCLE("), value, F.lit(")"))).when(F.col("event_type") == "view", "").otherwise(F.concat(F.lit("point ("), value, F.lit(" 2)")))
    return table(spark, d, "events").select(
        F.col("user_id").alias("batch_id"), F.col("event_id").alias("pos"), (F.col("value") / 3 - 60).alias("lat"), (F.col("value") - 200).alias("lon"),
        F.lower(F.concat(F.lit("8"), F.hex(F.col("event_id") % 16), F.lit("2830828ffffff"))).alias("h3_index"), geometry.alias("geometry_wkt"), (F.col("value") / 400).alias("confidence"),
    )


@query("""WITH e AS (SELECT value / 3 - 60 AS lat, value - 200 AS lon, event_id % 16 AS resolution, event_type, value / 400 AS confidence FROM events),
c AS (SELECT 'COORDINATE_OUT_OF_RANGE' AS code FROM e WHERE lat NOT BETWEEN -90 AND 90 UNION ALL SELECT 'COORDINATE_OUT_OF_RANGE' FROM e WHERE lon NOT BETWEEN -180 AND 180 UNION ALL SELECT 'PRECISION_EXCEEDED' FROM e WHERE resolution > 12 UNION ALL
SELECT 'INVALID_GEOMETRY' FROM e WHERE event_type = 'error' UNION ALL SELECT 'CONFIDENCE_OUT_OF_RANGE' FROM e WHERE confidence > 1) SELECT code, count(*) AS n FROM c GROUP BY code""")
def spatial_error_codes(spark, d):
    return validation.spatial_errors(_groundings(spark, d), 12).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'theorem' WHEN p_size % 3 = 1 THEN NULL ELSE p_type END AS kind, CASE WHEN p_size % 4 = 0 THEN '  ' ELSE p_name END AS statement, CASE WHEN p_size % 5 = 0 THEN 'number' ELSE 'variable' END AS object_kind, CASE WHEN p_size % 7 = 0 THEN '' ELSE p_brand END AS symbol FROM part),
e AS (SELECT p_partkey, 'kind' AS field, 'INVALID_TYPE' AS code FROM s WHERE kind IS NULL OR kind <> 'theorem' UNION ALL SELECT p_partkey, 'statement', 'MISSING_EVIDENCE' FROM s WHERE trim(statement) = '' UNION ALL
SELECT p_partkey, 'objects.kind', 'INVALID_TYPE' FROM s WHERE object_kind = 'number' UNION ALL SELECT p_partkey, 'objects.symbol', 'MISSING_EVIDENCE' FROM s WHERE symbol = '') SELECT 'statements[' || p_partkey || '].' || field AS path, code FROM e""")
def statement_errors(spark, d):
    size = F.col("p_size")
    objects = F.array(F.struct(F.lit("x").alias("symbol"), F.lit("set").alias("kind")), F.struct(F.when(size % 7 == 0, "").otherwise(F.col("p_brand")).alias("symbol"), F.when(size % 5 == 0, "number").otherwise("variable").alias("kind")))
    rows = table(spark, d, "part").select(
        F.lit(0).alias("batch_id"), F.col("p_partkey").alias("pos"), F.when(size % 3 == 0, "theorem").when(size % 3 == 2, F.col("p_type")).alias("kind"), F.when(size % 4 == 0, "  ").otherwise(F.col("p_name")).alias("statement"), objects.alias("objects"),
    )
    return validation.math_errors(rows).select("path", "code")


@query("""WITH c AS (SELECT o_orderkey, 'c' || o_custkey AS entity_id, o_totalprice / 200000 AS exact, (o_custkey % 10) / 10.0 AS combined FROM orders),
e AS (SELECT o_orderkey, 'UNKNOWN_ENTITY' AS code FROM c WHERE entity_id NOT IN (SELECT 'c' || c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL SELECT o_orderkey, 'SCORE_OUT_OF_RANGE' FROM c WHERE exact > 1 UNION ALL
SELECT o_orderkey, 'INCONSISTENT_SCORES' FROM c WHERE combined > greatest(exact, 0.2) + 0.01) SELECT o_orderkey, code, code = 'INCONSISTENT_SCORES' AS is_warning FROM e""")
def concordance_errors(spark, d):
    key = lambda c: F.concat(F.lit("c"), F.col(c).cast("string")).alias("entity_id")
    one = F.struct(key("o_custkey"), (F.col("o_totalprice") / 200000).alias("exact"), F.lit(0.1).alias("substring"), F.lit(0.2).alias("jaccard"), F.lit(0.0).alias("cosine"), (F.col("o_custkey") % 10 / 10).alias("combined"))
    sets = table(spark, d, "orders").select(F.lit(0).alias("batch_id"), F.col("o_orderkey").alias("pos"), F.array(one).alias("candidates"))
    known = table(spark, d, "customer").where("c_acctbal > 0").select(key("c_custkey"))
    return validation.concordance_errors(sets, known).select(F.col("pos").alias("o_orderkey"), "code", "is_warning")


# --- rows of extracted items ---------------------------------------------------------------------------


@query("""WITH r AS (SELECT p_brand AS document_id, p_brand || ':chunk-0' AS chunk_id, p_name AS text, CASE p_type WHEN 'SMALL' THEN 'ORG' ELSE 'OTHER' END AS mention_type, CASE WHEN p_size % 2 = 0 THEN p_size END AS span_start, p_size + 5 AS span_end FROM part)
SELECT substr(sha256(document_id || '|' || chunk_id || '|' || text || '|' || mention_type), 1, 16) AS mention_id, mention_type, mention_type || ':' || coalesce(CAST(span_start AS VARCHAR), '') || ':' || span_end AS key FROM r""")
def mention_rows(spark, d):
    items = table(spark, d, "part").select(
        F.col("p_brand").alias("document_id"), F.concat("p_brand", F.lit(":chunk-0")).alias("chunk_id"), F.col("p_name").alias("text"), F.when(F.col("p_type") == "SMALL", " org").otherwise(F.col("p_type")).alias("mention_type"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size")).otherwise(-1).alias("span_start"), (F.col("p_size") + 5).alias("span_end"), F.lit("").alias("context"),
    )
    return extraction.mention_rows(items).select("mention_id", "mention_type", extraction.mention_key().alias("key"))


@query("""WITH r AS (SELECT 'c' || o_custkey AS s, CASE o_orderpriority WHEN '1-URGENT' THEN 'Is Owned By ' ELSE o_orderpriority END AS p, o_orderstatus AS o, CAST(o_orderkey AS VARCHAR) AS chunk_id, o_totalprice > 200000 AS negated, o_orderkey % 2 = 0 AS has FROM orders)
SELECT substr(sha256(s || '|' || p || '|' || o || '|' || chunk_id), 1, 16) AS assertion_id, CASE WHEN p = 'Is Owned By ' THEN 'owned_by' ELSE lower(p) END AS predicate_canonical, sha256(s || '|' || p || '|' || o || '|' || CASE WHEN negated THEN 'True' ELSE 'False' END || '|False') AS content_hash, CASE WHEN has THEN 1 ELSE 0 END AS n_qualifiers FROM r""")
def assertion_rows(spark, d):
    qualifiers = F.create_map(F.lit("time"), F.when(F.col("o_orderkey") % 2 == 0, "now").otherwise(""), F.lit("place"), F.lit(None).cast("string"))
    items = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("chunk_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("subject"), F.when(F.col("o_orderpriority") == "1-URGENT", "Is Owned By ").otherwise(F.col("o_orderpriority")).alias("predicate"),
        F.col("o_orderstatus").alias("object"), F.lit(0.5).alias("confidence"), F.when(F.col("o_totalprice") > 200000, True).alias("negated"), F.lit(False).alias("hedged"), qualifiers.alias("qualifiers"),
    )
    return extraction.assertion_rows(items).select("assertion_id", "predicate_canonical", "content_hash", F.size("qualifiers").alias("n_qualifiers"))


# --- loops with plugs in place of models --------------------------------------------------------------------

_CAPITALISED = re.compile("[A-Z][a-z]{3,}")


def _find_entities(texts: list[str], hints: list) -> list[str]:
    return [json.dumps([{"text": m, "label": "ORG" if len(m) % 2 else "PERSON", "confidence": 0.5} for m in _CAPITALISED.findall(t)]) for t in texts]


@query("""WITH w AS (SELECT conv_id, turn, unnest(regexp_extract_all(text, '[A-Z][a-z]{3,}')) AS text FROM conversations)
SELECT conv_id AS source_doc_id, turn AS chunk_id, text, CASE WHEN length(text) % 2 = 1 THEN 'ORG' ELSE 'PERSON' END AS label, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def named_entities(spark, d):
    chunks = table(spark, d, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("chunk_id"), "text")
    return extraction.named_entities(chunks, _find_entities).groupBy("source_doc_id", "chunk_id", "text", "label").agg(F.count(F.lit(1)).alias("n"))


def _find_triples(texts: list[str], hints: list) -> list[str]:
    return [json.dumps([{"subject": a, "predicate": "precedes", "object": b} for a, b in zip(w, w[1:])]) for w in (_CAPITALISED.findall(t) for t in texts)]


@query("""WITH w AS (SELECT conv_id, turn, regexp_extract_all(text, '[A-Z][a-z]{3,}') AS w FROM conversations), e AS (SELECT conv_id, turn, w, unnest(range(1, len(w))) AS i FROM w)
SELECT conv_id AS source_doc_id, turn AS chunk_id, w[i] AS subject, w[i + 1] AS object, 'precedes' AS predicate, count(*) AS n FROM e GROUP BY 1, 2, 3, 4""")
def extracted_triples(spark, d):
    chunks = table(spark, d, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("chunk_id"), "text")
    return extraction.triples(chunks, _find_triples).groupBy("source_doc_id", "chunk_id", "subject", "object", "predicate").agg(F.count(F.lit(1)).alias("n"))


def _find_mentions(texts: list[str], hints: list) -> list[str]:
    """Capitalised words; at first one place off where a text has an even length, and with a type that never passes where it begins with E."""
    out = []
    for t, hint in zip(texts, hints):
        off = 0 if hint or len(t) % 2 else 1
        kind = "nothing" if t.startswith("E") else "ORG"
        out.append(json.dumps([{"text": m.group(), "mention_type": kind, "span_start": m.start() + off, "span_end": m.end() + off, "confidence": 0.5} for m in _CAPITALISED.finditer(t)]))
    return out


def _state_propositions(texts: list[str], hints: list) -> list[str]:
    """Each accepted mention precedes the next; at first also one that is not known, where there are an odd number."""
    out = []
    for t, hint in zip(texts, hints):
        known = [m["id"] for m in json.loads(t.split("\n", 2)[1])]
        ends = list(zip(known, known[1:])) + ([("nobody", known[0])] if len(known) % 2 and not hint else [])
        out.append(json.dumps([{"subject_mention_id": a, "object_mention_id": b, "predicate": "precedes", "confidence": 0.5} for a, b in ends]))
    return out


@query("""WITH c AS (SELECT conv_id * 100 + turn AS batch_id, length(text) % 2 AS odd, starts_with(text, 'E') AS bad, len(regexp_extract_all(text, '[A-Z][a-z]{3,}')) AS n FROM conversations)
SELECT batch_id, CASE WHEN n = 0 OR bad THEN 'failed' ELSE 'complete' END AS status, CAST(CASE WHEN n = 0 OR bad THEN 2 WHEN odd = 1 THEN 0 ELSE 1 END AS INTEGER) AS retries, CAST(CASE WHEN n > 0 AND NOT bad THEN n % 2 ELSE -1 END AS INTEGER) AS proposition_retries,
CASE WHEN n = 0 OR bad THEN 0 ELSE n END AS n_mentions, CASE WHEN n = 0 OR bad THEN 0 ELSE n - 1 END AS n_propositions FROM c""")
def extraction_states(spark, d):
    chunks = table(spark, d, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("batch_id"), "text")
    found, stated, states = extraction.extract_all(chunks, _find_mentions, extraction.retried(_state_propositions), 2)
    count = lambda rows, name: rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias(name))
    both = states.join(count(found, "n_mentions"), "batch_id", "left").join(count(stated, "n_propositions"), "batch_id", "left").na.fill(0, ["n_mentions", "n_propositions"]).na.fill(-1, ["proposition_retries"])
    return both.select("batch_id", "status", "retries", "proposition_retries", "n_mentions", "n_propositions")


# --- spans and chunks --------------------------------------------------------------------------------------


@query()
def annotated_conversations(spark, d):
    """Hits in all turns of a conversation of every word of its turns that begins with a capital; the longest is kept where they start together."""
    c = table(spark, d, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("id"), "conv_id", "turn", "text")
    words = c.select("conv_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Z][a-z]{3,})"), F.lit(1))).alias("entity")).distinct()
    return spans.annotated(c, words, family="conv_id")


@query("""WITH names AS (SELECT DISTINCT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT DISTINCT p_name FROM part WHERE p_partkey % 50 = 0),
t AS (SELECT l_orderkey * 10 + l_linenumber AS id, 'to ' || n_name || ', ' || r_name || ': ' || p_name AS text FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE l_quantity > 45)
SELECT id, count(DISTINCT name) AS n_names FROM t JOIN names ON contains(lower(text), lower(name)) GROUP BY id""")
def shipped_names(spark, d):
    """Names of one dictionary for all in shipping notes: every line of notes is of one family, dealt over tasks."""
    named = table(spark, d, "nation").select(F.col("n_name").alias("entity")).union(table(spark, d, "region").select("r_name")).union(table(spark, d, "part").where("p_partkey % 50 = 0").select("p_name")).distinct()
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    places = table(spark, d, "supplier").join(n, F.col("s_nationkey") == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).select("s_suppkey", "n_name", "r_name")
    lines = table(spark, d, "lineitem").where("l_quantity > 45").join(table(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey")).join(places, F.col("s_suppkey") == F.col("l_suppkey"))
    text = F.concat(F.lit("to "), "n_name", F.lit(", "), "r_name", F.lit(": "), "p_name")
    notes = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), text.alias("text"), F.lit(1).alias("family"))
    hits = spans.annotated(notes, named.withColumn("family", F.lit(1)), family="family", all_hits=True, part_chars=200_000)
    return hits.groupBy("id").agg(F.countDistinct("entity").alias("n_names"))


@query("""WITH w AS (SELECT doc_id, string_split(text, '. ') AS s FROM documents), e AS (SELECT doc_id, unnest(s) AS part, generate_subscripts(s, 1) - 1 AS pos FROM w),
p AS (SELECT doc_id, pos, part, coalesce(sum(length(part) + 2) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM e)
SELECT doc_id, count(*) AS n, count(*) FILTER (part <> '') AS n_valid FROM p GROUP BY doc_id""")
def valid_spans(spark, d):
    """Sentences of documents as spans, and how many of them are valid."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("batch_id"), F.split("text", r"\. ").alias("parts"), F.length("text").alias("length"))
    # sentences go on with the length of their text only, not with the text
    each = docs.select("batch_id", F.posexplode(F.transform("parts", F.length)).alias("pos", "size"), "length")
    before = Window.partitionBy("batch_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumn("start", F.coalesce(F.sum(F.col("size") + 2).over(before), F.lit(0))).withColumn("end", F.col("start") + F.col("size"))
    return placed.groupBy(F.col("batch_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(spans.span_within("start", "end", "length")).alias("n_valid"))


@query()
def chunks_by_profile(spark, d):
    """Documents as kinds by their language, each cut by its kind's profile."""
    kind = F.element_at(F.create_map(*(F.lit(x) for kv in {"en": "cable", "de": "bill", "fr": "member_profile"}.items() for x in kv)), F.col("lang"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("content"), F.coalesce(kind, F.lit("other")).alias("document_type"))
    return chunking.by_type(docs).select("chunk_id", "document_id", "index", "total_chunks", "content_hash")
