"""Registered queries of column functions, projections of raw records, sources, sinks and metrics, over rows derived from the given tables."""

from __future__ import annotations

import zipfile
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions import scalars
from lorekeel.operators import documents, explore, incremental
from lorekeel.operators.keyed_table import KeyedTable
from lorekeel.plans.base import query
from lorekeel.plans.views import table
from lorekeel.session import cut, scratch
from lorekeel.sources import archives, catalog, records
from lorekeel.sources.datasets import Datasets
from lorekeel.streaming import metrics, stateful

_NTZ = "timestamp_ntz"


# --- column functions ------------------------------------------------------------------------------


@query("""SELECT doc_id, substr(sha256(coalesce(source, '') || '|' || doc_id), 1, 16) AS id, sha256(coalesce(text, '') || '|' || coalesce(lang, '')) AS content_hash, CASE WHEN text <> '' THEN sha256(text) ELSE '' END AS text_hash FROM documents""")
def document_ids(spark, d):
    hashed = scalars.deterministic_id("source", "doc_id").alias("id"), scalars.content_hash("text", "lang").alias("content_hash"), scalars.text_hash("text").alias("text_hash")
    return table(spark, d, "documents").select("doc_id", *hashed)


_RAW_PREDICATES = {"click": "  Co-Sponsored ", "view": "Voted FOR", "signup": "belongs to", "error": "is Owned By", "purchase": "Opposed"}


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'co_sponsors' WHEN 'view' THEN 'votes_for' WHEN 'signup' THEN 'member_of' WHEN 'error' THEN 'is owned by' ELSE 'opposes' END AS legislative,
CASE event_type WHEN 'click' THEN 'co-sponsored' WHEN 'view' THEN 'voted for' WHEN 'signup' THEN 'belongs to' WHEN 'error' THEN 'owned_by' ELSE 'opposed' END AS leaked FROM events""")
def canonical_predicates(spark, d):
    raw = scalars.mapped("event_type", _RAW_PREDICATES)
    e = table(spark, d, "events").select("event_id", raw.alias("raw"))
    return e.select("event_id", scalars.canonical_predicate("raw", scalars.LEGISLATIVE_PREDICATES).alias("legislative"), scalars.canonical_predicate("raw", scalars.LEAK_PREDICATES).alias("leaked"))


@query("""WITH r AS (SELECT CASE event_type WHEN 'click' THEN ' person ' WHEN 'view' THEN 'Org' WHEN 'signup' THEN 'gpe' WHEN 'error' THEN 'thing' ELSE 'Company' END AS raw FROM events)
SELECT raw, CASE raw WHEN ' person ' THEN 'PERSON' WHEN 'Org' THEN 'ORG' WHEN 'gpe' THEN 'GPE' ELSE 'OTHER' END AS mention_type, CASE raw WHEN 'Company' THEN 'ORG' ELSE upper(raw) END AS alias_type, count(*) AS n FROM r GROUP BY 1""")
def mention_types(spark, d):
    raw = scalars.mapped("event_type", {"click": " person ", "view": "Org", "signup": "gpe", "error": "thing", "purchase": "Company"})
    e = table(spark, d, "events").select(raw.alias("raw"))
    return e.groupBy("raw", scalars.mention_type("raw").alias("mention_type"), scalars.alias_type("raw").alias("alias_type")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS raw, CASE WHEN o_custkey % 5 > 0 THEN year(o_orderdate) END AS y FROM orders)
SELECT o_orderkey, CAST(TRY_CAST(substr(raw, 1, 10) AS DATE) AS VARCHAR) AS day, CAST(make_date(y, 1, 1) AS VARCHAR) AS first_day, CAST(make_date(y, 12, 31) AS VARCHAR) AS last_day FROM o""")
def order_dates(spark, d):
    o = table(spark, d, "orders")
    raw = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    year = F.when(F.col("o_custkey") % 5 > 0, F.year("o_orderdate"))
    days = {"day": scalars.iso_date(raw), "first_day": scalars.year_date(year), "last_day": scalars.year_date(year, end=True)}
    return o.select("o_orderkey", *(c.cast("string").alias(n) for n, c in days.items()))


@query("""SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN '' ELSE role || ' in turn ' || turn END AS subject, CASE WHEN turn % 2 = 0 THEN role || ',T' || turn ELSE '' END AS tags FROM conversations""")
def cable_headers(spark, d):
    head = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("  subject: "), "role", F.lit(" in turn "), F.col("turn").cast("string"), F.lit(" ")))
    head = head.when(F.col("turn") % 3 == 1, F.concat(F.lit("SUBJ:"), "role", F.lit(" in turn "), F.col("turn").cast("string"))).otherwise("REF: none")
    tags = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Tags: "), "role", F.lit(", , T"), F.col("turn").cast("string"))).otherwise("TAG none")
    body = F.concat_ws("\n", F.lit("E.O. 12958"), head, tags, "text")
    c = table(spark, d, "conversations").select("conv_id", "turn", body.alias("body"))
    return c.select("conv_id", "turn", scalars.subject_line("body").alias("subject"), F.array_join(scalars.tag_list("body"), ",").alias("tags"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_id % 2 = 0 THEN event_type END AS inner_type FROM events""")
def json_paths(spark, d):
    e = table(spark, d, "events")
    inner = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.array(F.struct("event_type")).alias("items")))).otherwise("no { json")
    return e.select("event_id", scalars.json_at("props", "k").alias("k"), scalars.json_at(inner, "items[0].event_type").alias("inner_type"))


@query("SELECT event_id, props AS bare FROM events")
def fenced_answers(spark, d):
    answer = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nDone."))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("```"), "props", F.lit("```"))).otherwise(F.concat(F.lit(" \n"), "props", F.lit("\t")))
    return table(spark, d, "events").select("event_id", scalars.without_fences(answer).alias("bare"))


@query("""WITH f AS (SELECT p_partkey, p_brand || '/' || CASE WHEN p_size % 4 = 0 THEN '.' || p_type WHEN p_size % 4 = 1 THEN p_name || '.tar.GZ' WHEN p_size % 4 = 2 THEN p_name ELSE p_name || '.Mp3' END AS path, p_size, p_type, p_name FROM part)
SELECT p_partkey, CASE p_size % 4 WHEN 1 THEN '.gz' WHEN 3 THEN '.mp3' ELSE '' END AS extension, CASE p_size % 4 WHEN 0 THEN '.' || p_type WHEN 1 THEN p_name || '.tar' ELSE p_name END AS stem FROM f""")
def file_names(spark, d):
    kind = F.col("p_size") % 4
    name = F.when(kind == 0, F.concat(F.lit("."), "p_type")).when(kind == 1, F.concat("p_name", F.lit(".tar.GZ"))).when(kind == 2, F.col("p_name")).otherwise(F.concat("p_name", F.lit(".Mp3")))
    p = table(spark, d, "part").select("p_partkey", F.concat("p_brand", F.lit("/"), name).alias("path"))
    return p.select("p_partkey", scalars.extension("path").alias("extension"), scalars.stem("path").alias("stem"))


@query("SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS preview FROM documents")
def text_previews(spark, d):
    return table(spark, d, "documents").select("doc_id", scalars.preview("text", 300).alias("preview"))


@query("""SELECT p_partkey, 'cs' || p_size * 10 || '_co' || p_size || '_' || CASE p_type WHEN 'SMALL' THEN 'sm' ELSE coalesce(nullif(substr(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), 1, 8), ''), 'unk') END ||
CASE WHEN p_size % 2 = 0 THEN '_d' || p_size ELSE '' END AS key FROM part""")
def chunk_config_keys(spark, d):
    p = table(spark, d, "part").withColumn("model", F.when(F.col("p_type") == "SMALL", "SMALL").otherwise(F.col("p_name")))
    return p.select("p_partkey", scalars.config_key(F.col("p_size") * 10, "p_size", "model", F.when(F.col("p_size") % 2 == 0, F.col("p_size")), {"SMALL": "sm"}).alias("key"))


@query("""SELECT p_partkey, substr(sha256(p_size * 10 || ':' || p_size || ':' || p_name || ':' || CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'None' END || ':' ||
CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END || ':' || p_type), 1, 8) AS hash FROM part""")
def chunk_config_hashes(spark, d):
    """What tells two settings of chunks and vectors apart, all of them counted."""
    even = F.when(F.col("p_size") % 2 == 0, F.col("p_size"))
    return table(spark, d, "part").select("p_partkey", scalars.config_hash(F.col("p_size") * 10, "p_size", "p_name", even, F.col("p_size") > 25, "p_type").alias("hash"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, 'year=%Y/month=%m/day=%d') WHEN 'F' THEN strftime(o_orderdate, 'year=%Y/month=%m') ELSE o_orderpriority END AS segment FROM orders""")
def partition_segments(spark, d):
    o = table(spark, d, "orders")
    raw = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", scalars.hive_segment(raw).alias("segment"))


@query("SELECT user_id % 100 AS user_group, CAST(event_id % 16 AS INTEGER) AS resolution, count(*) AS n FROM events WHERE event_id % 17 <> 0 GROUP BY 1, 2 UNION ALL SELECT user_id % 100, -1, count(*) FROM events WHERE event_id % 17 = 0 GROUP BY 1")
def cell_counts(spark, d):
    cell = F.when(F.col("event_id") % 17 == 0, "no cell").otherwise(F.lower(F.concat(F.lit("8"), F.hex(F.col("event_id") % 16), F.lit("2830828ffffff"))))
    e = table(spark, d, "events").select((F.col("user_id") % 100).alias("user_group"), cell.alias("cell"))
    return e.groupBy("user_group", F.coalesce(scalars.h3_resolution("cell"), F.lit(-1)).alias("resolution")).agg(F.count(F.lit(1)).alias("n"))


# --- projections of raw records --------------------------------------------------------------------


@query("""SELECT 'congress-bill-' || o_orderkey AS id, o_orderpriority AS title, 'Bill ' || o_custkey || ' (' || o_orderstatus || ')' || CASE WHEN o_orderstatus <> 'P' THEN '. Sum ' || CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) ELSE '' END || '. ' || o_orderpriority AS content,
strftime(o_orderdate, '%Y-%m-%d') AS introduced FROM orders""")
def bill_documents(spark, d):
    o = table(spark, d, "orders")
    none = F.lit(None).cast("string")
    summary = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Sum "), F.round("o_totalprice").cast("long").cast("string"))).otherwise("")
    bills = o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.lit(118).alias("congress"), F.lit("hr").alias("bill_type"), F.col("o_custkey").alias("number"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("chamber"),
        summary.alias("summary"), none.alias("policy_area"), F.to_date("o_orderdate").alias("introduced_date"), none.alias("latest_action_text"), none.alias("source_url"),
    )
    return documents.bill_documents(bills).select("id", "title", "content", F.col("metadata")["introduced_date"].alias("introduced"))


@query("""SELECT 'wikileaks-cable-' || conv_id || '.' || turn AS id, CASE WHEN turn % 2 = 0 THEN role || ' speaks' ELSE 'Cable ' || conv_id || '.' || turn END AS title,
CASE WHEN turn % 2 = 0 THEN role || ' speaks' ELSE '' END || chr(10) || chr(10) || 'Origin: ' || role || chr(10) || chr(10) || text AS content FROM conversations""")
def cable_documents(spark, d):
    none = F.lit(None).cast("string")
    cables = table(spark, d, "conversations").select(
        F.concat_ws(".", "conv_id", "turn").alias("id"), F.when(F.col("turn") % 2 == 0, F.concat("role", F.lit(" speaks"))).otherwise("").alias("subject"), F.col("role").alias("origin"), F.col("text").alias("content"),
        none.alias("source_url"), none.alias("date"), none.alias("classification"), F.array("role").alias("tags"),
    )
    return documents.cable_documents(cables).select("id", "title", "content")


@query("""SELECT 'epstein-' || page_id AS id, CASE WHEN page_id % 3 = 0 THEN 'Document ' || page_id ELSE url END AS title, CASE WHEN page_id % 3 = 0 THEN '' ELSE url END || CASE WHEN page_id % 2 = 0 THEN chr(10) || chr(10) || 'Case: ' || page_id ELSE '' END || CASE WHEN html <> '' THEN chr(10) || chr(10) || html ELSE '' END AS content FROM pages""")
def court_documents(spark, d):
    payload = F.struct(
        F.col("page_id").alias("id"), F.when(F.col("page_id") % 3 == 0, "").otherwise(F.col("url")).alias("title"), F.when(F.col("page_id") % 2 == 0, F.col("page_id").cast("string")).alias("case_number"), F.col("html").alias("excerpt"),
        F.lit("12").alias("page_count"),
    )
    filings = records.filings_from_api(table(spark, d, "pages").select(F.col("page_id").alias("ordinal"), F.to_json(payload).alias("value")))
    return documents.court_documents(filings).select("id", "title", "content")


@query("""SELECT 'media-' || substr(sha256('in/' || CASE WHEN p_size > 25 THEN 'MeTube' ELSE 'sync' END || '/' || p_partkey || '.mp4'), 1, 16) AS id, CAST(p_partkey AS VARCHAR) AS title, CASE WHEN p_size > 25 THEN 'metube' ELSE 'tubesync' END AS source,
CASE WHEN p_size % 2 = 0 THEN p_name ELSE '.mp4' END AS extension FROM part""")
def media_documents(spark, d):
    folder = F.concat(F.lit("in/"), F.when(F.col("p_size") > 25, "MeTube").otherwise("sync"))
    name = F.concat(F.col("p_partkey").cast("string"), F.lit(".mp4"))
    own = F.when(F.col("p_size") % 2 == 0, F.create_map(F.lit("extension"), F.col("p_name")))
    files = table(spark, d, "part").select(
        F.concat_ws("/", folder, name).alias("path"), name.alias("filename"), F.lit(".mp4").alias("extension"), F.col("p_size").alias("size_bytes"), folder.alias("source_dir"), own.alias("metadata"),
    )
    return documents.media_documents(files).select("id", "title", "source", F.col("metadata")["extension"].alias("extension"))


@query("""SELECT 'hr' || o_custkey || '-' || (100 + o_orderkey % 20) AS id, 100 + CAST(o_orderkey % 20 AS INTEGER) AS congress, CAST(o_custkey AS INTEGER) AS number, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS policy_area, strftime(o_orderdate, '%Y-%m-%d') AS introduced_date FROM orders""")
def bills_of_api(spark, d):
    o = table(spark, d, "orders")
    payload = F.struct(
        (F.lit(100) + F.col("o_orderkey") % 20).cast("int").alias("congress"), F.lit("hr").alias("type"), F.col("o_custkey").cast("string").alias("number"), F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00").alias("introducedDate"),
        F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_orderpriority").alias("name"))).alias("policyArea"),
    )
    return records.bills_from_api(o.select(F.to_json(payload).alias("value"))).select("id", "congress", "number", "policy_area", F.col("introduced_date").cast("string").alias("introduced_date"))


@query("""SELECT 'N' || n_nationkey AS id, n_name AS name, substr(r_name, 1, 1) AS party, CASE WHEN n_nationkey % 3 > 0 THEN 'Senate' END AS chamber, CAST(n_nationkey % 3 AS INTEGER) AS terms_served FROM nation JOIN region ON n_regionkey = r_regionkey""")
def members_of_api(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    terms = F.slice(F.array(F.struct(F.lit("House").alias("chamber")), F.struct(F.lit("Senate").alias("chamber"))), 3 - F.col("n_nationkey") % 3, F.col("n_nationkey") % 3)
    payload = F.struct(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("bioguideId"), F.col("n_name").alias("name"), F.col("r_name").alias("partyName"), F.struct(terms.alias("item")).alias("terms"))
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.to_json(payload).alias("value"))
    return records.members_from_api(rows).select("id", "name", "party", "chamber", "terms_served")


@query("""SELECT 'S' || s_suppkey AS id, s_name AS name, CASE WHEN s_acctbal > 0 THEN 'House' END AS chamber, CASE WHEN s_suppkey % 2 = 0 THEN 'S' || s_nationkey END AS parent_committee FROM supplier""")
def committees_of_api(spark, d):
    code = lambda c: F.concat(F.lit("S"), F.col(c).cast("string"))
    payload = F.struct(
        code("s_suppkey").alias("systemCode"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 0, "House").alias("chamber"), F.when(F.col("s_suppkey") % 2 == 0, F.struct(code("s_nationkey").alias("systemCode"))).alias("parent"),
    )
    return records.committees_from_api(table(spark, d, "supplier").select(F.to_json(payload).alias("value"))).select("id", "name", "chamber", "parent_committee")


@query("""SELECT c_custkey AS id, c_acctbal > 0 AS has_video, c_nationkey % 2 = 0 AS has_audio, CASE WHEN c_acctbal > 0 THEN 'h264' ELSE '' END AS video_codec, CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS INTEGER) ELSE 0 END AS channels,
CASE WHEN c_nationkey % 3 = 0 THEN 0.0 ELSE c_custkey / 4.0 END::DOUBLE AS duration_seconds FROM customer""")
def probed_media(spark, d):
    return _probed(spark, d).select("id", "has_video", "has_audio", "video_codec", "channels", "duration_seconds")


def _probed(spark, d):
    c = table(spark, d, "customer")
    stream = lambda kind, codec, channels: F.struct(F.lit(kind).alias("codec_type"), F.lit(codec).alias("codec_name"), channels.cast("int").alias("channels"))
    streams = F.concat(
        F.when(F.col("c_acctbal") > 0, F.array(stream("video", "h264", F.lit(0)))).otherwise(F.array().cast("array<struct<codec_type:string,codec_name:string,channels:int>>")),
        F.when(F.col("c_nationkey") % 2 == 0, F.array(stream("audio", "aac", F.col("c_nationkey")))).otherwise(F.array().cast("array<struct<codec_type:string,codec_name:string,channels:int>>")),
    )
    length = F.when(F.col("c_nationkey") % 3 == 0, "unknown").otherwise((F.col("c_custkey") / 4).cast("string"))
    probe = F.to_json(F.struct(F.struct(length.alias("duration")).alias("format"), streams.alias("streams")))
    return records.probe_metadata(c.select(F.col("c_custkey").alias("id"), probe.alias("probe")))


@query("""SELECT count(*) AS n_files, count(*) FILTER (c_custkey % 10 = 0) AS n_errors, count(*) FILTER (c_acctbal > 0) AS with_video, count(*) FILTER (c_nationkey % 2 = 0) AS with_audio,
round(sum(CASE WHEN c_nationkey % 3 = 0 THEN 0.0::DOUBLE ELSE c_custkey / 4.0::DOUBLE END) / 3600, 2) AS hours FROM customer""")
def probe_totals(spark, d):
    return records.probe_totals(_probed(spark, d).withColumn("error", F.when(F.col("id") % 10 == 0, "no stream")))


@query("""WITH f AS (SELECT CASE WHEN page_id % 2 = 0 THEN '.mp4' ELSE '.mp3' END AS extension, 'in' || page_id % 3 AS source_dir, length(html) * 100000 AS size_bytes FROM pages)
SELECT 'extension' AS facet, extension AS value, count(*) AS n, round(sum(size_bytes) / 1073741824.0::DOUBLE, 2) AS gib FROM f GROUP BY 2 UNION ALL SELECT 'source_dir', source_dir, count(*), round(sum(size_bytes) / 1073741824.0::DOUBLE, 2) FROM f GROUP BY 2""")
def media_breakdown(spark, d):
    return records.media_breakdown(_files(spark, d))


def _files(spark, d):
    return table(spark, d, "pages").select(
        F.when(F.col("page_id") % 2 == 0, ".mp4").otherwise(".mp3").alias("extension"), F.concat(F.lit("in"), (F.col("page_id") % 3).cast("string")).alias("source_dir"), (F.length("html") * F.lit(100000).cast("long")).alias("size_bytes")
    )


@query("SELECT count(*) AS n_files, round(sum(length(html) * 100000) / 1073741824.0::DOUBLE, 2) AS gib FROM pages")
def media_totals(spark, d):
    return records.media_totals(_files(spark, d))


@query("""SELECT c_custkey AS document_id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE upper(c_name) END AS text, CASE WHEN c_custkey % 5 = 0 THEN 'unknown' ELSE 'en' END AS language, CASE WHEN c_custkey % 5 = 0 THEN 'no sound in ' || c_name END AS error FROM customer WHERE c_acctbal > 0""")
def transcribed_files(spark, d):
    from lorekeel.operators.extraction import transcribed

    def plug(path: str) -> dict:
        if int(path.split("#")[1]) % 5 == 0:
            raise ValueError(f"no sound in {path}")
        return {"text": path.upper(), "language": "en"}

    files = table(spark, d, "customer").select(F.col("c_custkey").alias("document_id"), F.col("c_name").alias("title"), F.col("c_name").alias("path"), (F.col("c_acctbal") > 0).alias("has_audio"))
    return transcribed(files, plug).select("document_id", "text", "language", "error")


@query("SELECT count(*) AS n_skipped FROM conversations WHERE turn % 4 = 1")
def skipped_transcripts(spark, d):
    said = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 4 != 1, F.col("text")).alias("text"))
    return records.spoken(said)[1]


@query("""SELECT conv_id, turn, role, 'v' || turn AS version FROM conversations WHERE turn % 2 = 0""")
def prompt_front_matter(spark, d):
    front = F.concat(F.lit("name: '"), "role", F.lit("'\n# no entry\nversion: v"), F.col("turn").cast("string"))
    rows = table(spark, d, "conversations").where("turn % 2 = 0").select("conv_id", "turn", front.alias("front_matter"))
    return records.front_matter(rows).select("conv_id", "turn", F.col("entries")["name"].alias("role"), F.col("entries")["version"].alias("version"))


@query("""SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS id, role AS reference, text AS content, CASE WHEN turn % 2 = 0 THEN 'talk ' || turn ELSE '' END AS subject FROM (SELECT conv_id, turn, role,
CASE WHEN turn % 2 = 0 THEN 'SUBJECT: talk ' || turn || chr(10) ELSE '' END || regexp_replace(text, '["\\\\]', '', 'g') AS text FROM conversations)""")
def cables_of_lines(spark, d):
    c = table(spark, d, "conversations")
    body = F.concat(F.when(F.col("turn") % 2 == 0, F.concat(F.lit("SUBJECT: talk "), F.col("turn").cast("string"), F.lit("\n"))).otherwise(""), F.regexp_replace("text", r'["\\]', ""))
    fields = [F.lit("2/7/1972 0:00"), F.col("role"), F.lit("Embassy"), F.lit("UNCLASSIFIED"), F.lit(""), F.lit("header"), body]
    raw = F.concat_ws(",", *(F.concat(F.lit('"'), x, F.lit('"')) for x in ((F.col("conv_id") * 100 + F.col("turn")).cast("string"), *fields)))
    lines = c.select(F.col("conv_id").cast("string").alias("file"), "turn", F.posexplode(F.split(raw, "\n")).alias("pos", "value"))
    numbered = lines.select("file", (F.col("turn") * 1_000_000 + F.col("pos")).alias("line_no"), "value")
    return records.cable_records(numbered).select("id", "reference", "content", "subject")


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(source, '') AS reference, replace(coalesce(text, ''), chr(92), '') AS content FROM documents""")
def cables_of_documents(spark, d):
    """All documents, whole, written as an archive of cables with doubled quotes and read from its lines."""
    docs = table(spark, d, "documents")
    body = F.replace(F.translate(F.coalesce("text", F.lit("")), "\\", ""), F.lit('"'), F.lit('""'))
    fields = [F.col("doc_id").cast("string"), F.lit("2/7/1972 0:00"), F.coalesce("source", F.lit("")), F.lit("Embassy"), F.lit("SECRET"), F.lit(""), F.lit(""), body]
    with scratch(spark, "cables") as path:
        docs.select(F.concat_ws(",", *(F.concat(F.lit('"'), x, F.lit('"')) for x in fields)).alias("value")).write.text(path)
        return cut(records.cable_records(records.read_lines(spark, path)).select("id", "reference", "content"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'entity' ELSE 'officer' END AS entity_type, CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE '' END AS jurisdiction, CASE WHEN s_acctbal > 0 THEN 'leak' ELSE 'unknown' END AS source_dataset FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def offshore_entities(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    even = F.col("s_suppkey") % 2 == 0
    key = F.col("s_suppkey").cast("string")
    source = F.when(F.col("s_acctbal") > 0, "leak").otherwise("")
    entities = F.create_map(F.lit("node_id"), key, F.lit("name"), F.col("s_name"), F.lit("jurisdiction"), F.col("n_name"), F.lit("sourceID"), source)
    officers = F.create_map(F.lit("id"), key, F.lit("name"), F.col("s_name"), F.lit("sourceID"), source)
    read = rows.select(F.lit("a.zip").alias("archive"), F.when(even, "nodes-entities.csv").otherwise("nodes-officers.csv").alias("member"), F.col("s_suppkey").alias("ordinal"), F.when(even, entities).otherwise(officers).alias("fields"))
    return records.offshore_entities(read).select("id", "name", "entity_type", "jurisdiction", "source_dataset")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'entity' ELSE 'officer' END AS entity_type, n_name AS jurisdiction, count(*) OVER (PARTITION BY s_suppkey % 4) AS n_archive FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def archived_entities(spark, d):
    """Suppliers packed into four ZIP archives of two CSV files, read member by member."""
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select((F.col("s_suppkey") % 4).alias("part"), F.col("s_suppkey").cast("string").alias("node_id"), F.col("s_name").alias("name"), F.col("n_name").alias("jurisdiction"))
    with scratch(spark, "archives") as path:

        def pack(frame):
            even = frame["node_id"].astype(int) % 2 == 0
            system, at = archives.file_system(path)
            system.create_dir(at, recursive=True)
            with system.open_output_stream(f"{at}/{frame['part'].iat[0]}.zip") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                for name, mine in (("nodes-entities.csv", frame[even]), ("nodes-officers.csv", frame[~even])):
                    z.writestr(f"in/{name}", mine.drop(columns="part").to_csv(index=False))
            return frame[["part"]].head(1)

        rows.groupBy("part").applyInPandas(pack, "part long").write.format("noop").mode("overwrite").save()
        read = cut(records.read_archive(spark, path))
    counts = read.groupBy("archive").agg(F.count(F.lit(1)).alias("n_archive"))
    entities = records.offshore_entities(read.join(counts, "archive").withColumn("fields", F.map_concat("fields", F.create_map(F.lit("status"), F.col("n_archive").cast("string")))))
    return entities.select("id", "name", "entity_type", "jurisdiction", F.col("status").cast("long").alias("n_archive"))


@query("""SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, CAST(l_partkey AS VARCHAR) AS start_id, CAST(l_suppkey AS VARCHAR) AS end_id, l_returnflag AS rel_type FROM lineitem""")
def offshore_relationships(spark, d):
    text = lambda c: F.col(c).cast("string")
    upper = F.create_map(F.lit("START_ID"), text("l_partkey"), F.lit("END_ID"), text("l_suppkey"), F.lit("TYPE"), F.col("l_returnflag"))
    lower = F.create_map(F.lit("node_id_start"), text("l_partkey"), F.lit("node_id_end"), text("l_suppkey"), F.lit("rel_type"), F.col("l_returnflag"))
    read = table(spark, d, "lineitem").select(F.lit("relationships.csv").alias("member"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"), F.when(F.col("l_linestatus") == "O", upper).otherwise(lower).alias("fields"))
    return records.offshore_relationships(read).select("id", "start_id", "end_id", "rel_type")


# --- sinks and what they leave -----------------------------------------------------------------------


@query("SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY 1")
def appended_lines(spark, d):
    """Documents appended as JSON lines, in buckets by their source, in two writes, and read again."""
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    with scratch(spark, "lines") as path:
        for part in ("doc_id % 2 = 0", "doc_id % 2 = 1"):
            incremental.append_lines(docs.where(part), path, "source")
        lines = records.json_lines(spark, path, "doc_id long, text string, source string")
        return cut(lines.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars")))


@query("""SELECT 'orders' AS dataset, o_orderstatus AS "partition", count(*) AS "count", 1 AS n_writes FROM orders GROUP BY 2 UNION ALL SELECT 'nations', NULL, count(*) + 1, 2 FROM nation""")
def store_manifest(spark, d):
    """A store written twice: what did not change is not written again. The last record of each dataset and partition, and how many there are."""
    orders, nation = table(spark, d, "orders"), table(spark, d, "nation")
    with scratch(spark, "store") as root:
        store = incremental.Store(spark, root)
        for grown in (nation, nation.unionByName(nation.limit(1))):
            store.write("nations", grown)
            for status in ("F", "O", "P"):
                store.write("orders", orders.where(F.col("o_orderstatus") == status), partition=status)
        last = store.manifest().groupBy("dataset", "partition").agg(F.max_by("count", "timestamp").alias("count"), F.count(F.lit(1)).cast("int").alias("n_writes"))
        return cut(last.select("dataset", "partition", "count", "n_writes"))


@query("""SELECT 'orders' AS dataset, o_orderstatus AS "partition", count(*) AS "count", '—' AS shown_partition FROM orders GROUP BY 2 UNION ALL SELECT 'nations', NULL, count(*), '—' FROM nation WHERE n_nationkey >= 5""")
def store_timeline(spark, d):
    """What a store's readers and its timeline show after a dataset was written anew with fewer rows: the rows of the last record only."""
    orders, nation = table(spark, d, "orders"), table(spark, d, "nation")
    with scratch(spark, "store") as root:
        store = incremental.Store(spark, root)
        for status in ("F", "O", "P"):
            store.write("orders", orders.where(F.col("o_orderstatus") == status), partition=status)
        store.write("nations", nation)
        store.write("nations", nation.where("n_nationkey >= 5"))
        shown = store.timeline().where("run is not null and size_mb >= 0").groupBy("dataset").agg(F.max(F.when(F.col("partition") == "—", "—")).alias("none"))
        parts = [store.read("orders", p).select(F.lit("orders").alias("dataset"), F.lit(p).alias("partition")) for p in ("F", "O", "P")]
        rows = reduce(lambda a, b: a.union(b), [*parts, store.read("nations").select(F.lit("nations").alias("dataset"), F.lit(None).cast("string").alias("partition"))])
        counts = rows.groupBy("dataset", "partition").agg(F.count(F.lit(1)).alias("count"))
        return cut(counts.join(shown, "dataset").select("dataset", "partition", "count", F.coalesce("none", F.lit("—")).alias("shown_partition")))


#: Orders come in four batches, by years.
_PART = "greatest(0, least(3, (year(o_orderdate) - 1993) {div} 2))"


@query(f"""WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, {_PART.format(div="//")} AS part FROM orders)
SELECT o_custkey AS custkey, max(o_orderdate) AS last_date, max(o_orderkey) FILTER (last) AS last_key, min(part) AS first_part FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS last FROM o) GROUP BY 1""")
def upserted_stream(spark, d):
    """The last order of each customer, merged from a stream in four micro-batches that then all come again; the part that a customer came with first stays."""
    orders = table(spark, d, "orders")
    rows = orders.select(F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("last_date"), F.col("o_orderkey").alias("last_key"), F.expr(_PART.format(div="div")).cast("int").alias("first_part"))
    with scratch(spark, "upserts") as root:
        held = KeyedTable(spark, f"{root}/table", rows.schema, ["custkey"], ["last_date", "last_key"], buckets=8)
        for part in range(4):
            rows.where(F.col("first_part") == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        for again in range(2):
            held.upsert_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"), f"{root}/checkpoint-{again}")
        return cut(held.read())


@query("SELECT s_suppkey AS suppkey, substr(sha256(CAST(s_name AS VARCHAR)), 1, 16) AS payload_hash FROM supplier")
def audited_results(spark, d):
    return incremental.audit_rows(table(spark, d, "supplier").select(F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("payload"))).select("suppkey", "payload_hash")


@query("SELECT n_nationkey, n_name, f AS form FROM nation, (SELECT unnest(['csv', 'json', 'jsonl', 'parquet', 'text']) AS f)")
def read_by_format(spark, d):
    """Nations written in every format and read by a hint or by the folder's extension."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name").coalesce(1)
    with scratch(spark, "formats") as root:
        return cut(_in_every_format(spark, n, root))


def _in_every_format(spark, n, root):
    schema, rows = "n_nationkey int, n_name string", []
    n.write.option("header", "true").csv(f"{root}/x.csv")
    n.write.json(f"{root}/x.ndjson")
    n.groupBy().agg(F.to_json(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))).alias("value")).write.text(f"{root}/one")
    n.write.parquet(f"{root}/x")
    n.select(F.concat_ws(" ", "n_nationkey", "n_name")).write.text(f"{root}/x.txt")
    for form, name, hint in (("csv", "x.csv", None), ("jsonl", "x.ndjson", None), ("json", "one", "json"), ("parquet", "x", None)):
        rows.append(catalog.read_as(spark, f"{root}/{name}", hint, schema).select(*n.columns, F.lit(form).alias("form")))
    split = F.split("value", " ")
    rows.append(catalog.read_as(spark, f"{root}/x.txt").select(split[0].cast("int").alias("n_nationkey"), split[1].alias("n_name"), F.lit("text").alias("form")))
    return explore.with_lineage(**{str(k): r for k, r in enumerate(rows)}).drop("_source")


@query("SELECT r_regionkey, r_name FROM region")
def loaded_with_fallback(spark, d):
    """A dataset that is not there is read from where it lay before."""
    with scratch(spark, "moved") as root:
        old, new = (catalog.dataset_path(root, "gold", place, "congress", "congress_mentions", "cs400") for place in ("old", "new"))
        table(spark, d, "region").select("r_regionkey", "r_name").write.parquet(old)
        return cut(catalog.load(spark, new, "r_regionkey int, r_name string", fallback=old))


@query("SELECT DISTINCT split_part(s_name, '#', 1) || p AS source FROM supplier, (SELECT unnest(['0', '1', '2']) AS p)")
def listed_sources(spark, d):
    """Source names of datasets named after suppliers."""
    s = table(spark, d, "supplier")
    kind = F.element_at(F.array(F.lit("documents"), F.lit("entity_candidates"), F.lit("graph"), F.lit("chart")), (F.col("s_suppkey") % 4 + 1).cast("int"))
    stem = F.concat(F.substring_index("s_name", "#", 1), (F.col("s_suppkey") % 3).cast("string"))
    named = s.select(F.concat_ws("_", stem, kind).alias("asset"), F.when(F.col("s_suppkey") % 9 == 8, "platinum").otherwise("gold").alias("layer"))
    return catalog.list_sources(named)


@query("SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'cs' || p_size ELSE 'default' END AS config FROM part")
def listed_configs(spark, d):
    p = table(spark, d, "part")
    config = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("config=cs"), F.col("p_size").cast("string"), F.lit("/"))).otherwise("")
    return catalog.list_configs(p.select(F.concat(F.lit("gold/x/"), config, F.lit("part-0.parquet")).alias("path")))


@query("SELECT DISTINCT p_brand AS \"partition\" FROM part WHERE p_size > 25")
def listed_partitions(spark, d):
    p = table(spark, d, "part")
    path = F.when(F.col("p_size") > 25, F.concat(F.lit("gold/x/"), "p_brand", F.lit("/part-0.parquet"))).otherwise(F.concat(F.lit("gold/y/"), "p_brand", F.lit("/part-0.parquet")))
    return catalog.partitions(p.select(path.alias("path")), "gold/x")


def _mentions_of(spark, d):
    p = table(spark, d, "part")
    kind = F.when(F.col("p_size") % 3 == 0, "PERSON").otherwise("ORG")
    return p.select(F.col("p_partkey").cast("string").alias("mention_id"), F.col("p_brand").alias("document_id"), F.col("p_name").alias("text"), kind.alias("mention_type"), kind.alias("label"), F.length("p_name").alias("span_end"), "p_size")


@query("""SELECT 'new' AS source, CAST(p_partkey AS VARCHAR) AS id, p_brand AS document_id, p_name AS text, 'ORG' AS kind, length(p_name) AS span_end FROM part WHERE p_size % 2 = 0 AND p_size % 3 <> 0
UNION ALL SELECT 'old', NULL, p_brand, p_name, CASE WHEN p_size % 3 = 0 THEN 'PERSON' ELSE 'ORG' END, length(p_name) FROM part WHERE p_size % 2 = 1""")
def mentions_or_entities(spark, d):
    """Organisations of a source with mentions, in two partitions, and the older entities of one without; a third source has neither."""
    rows = _mentions_of(spark, d)
    with scratch(spark, "typed") as root:
        sets = Datasets(spark, root)
        for part in (0, 2):
            sets.save("mentions", rows.where(f"p_size % 4 = {part}"), "new", partition=str(part))
        sets.save("entities", rows.where("p_size % 2 = 0"), "new")
        sets.save("entities", rows.where("p_size % 2 = 1"), "old", location="elsewhere")
        new, old, none = (sets.load("mentions", s, mention_type="ORG") for s in ("new", "old", "none"))
        common = "document_id", "text", "span_end"
        new, none = (m.select(F.lit("new").alias("source"), F.col("mention_id").alias("id"), F.col("mention_type").alias("kind"), *common) for m in (new, none))
        return cut(new.unionByName(old.select(F.lit("old").alias("source"), F.lit(None).cast("string").alias("id"), F.col("label").alias("kind"), *common)).unionByName(none))


@query("""WITH l AS (SELECT l_orderkey * 100 + l_linenumber AS id, l_linestatus AS predicate, CAST(l_partkey AS VARCHAR) AS object_text, l_returnflag FROM lineitem)
SELECT 'assertions' AS kind, id, predicate, object_text, true AS negated FROM l WHERE l_returnflag = 'R' UNION ALL SELECT 'propositions', id, predicate, object_text, NULL FROM l WHERE l_returnflag = 'A'""")
def assertions_or_propositions(spark, d):
    """Assertions of a source that has them (of one configuration of two), propositions of one that has none."""
    lines = table(spark, d, "lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"), F.col("l_linestatus").alias("predicate"), F.col("l_partkey").alias("object_text"), "l_returnflag")
    flagged = lambda f, key: lines.where(F.col("l_returnflag") == f).withColumnRenamed("id", key).withColumn("negated", F.lit(True))
    with scratch(spark, "typed") as root:
        sets = Datasets(spark, root)
        sets.save("assertions", flagged("R", "assertion_id"), "r", config="cs400")
        sets.save("assertions", flagged("N", "assertion_id"), "r", config="cs800")
        sets.save("propositions", flagged("A", "proposition_id"), "a")
        a, p = sets.load("assertions", "r", config="cs400"), sets.load("assertions", "a")
        shown = lambda df, kind, key, negated: df.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"), "predicate", "object_text", negated.alias("negated"))
        return cut(shown(a, "assertions", "assertion_id", F.col("negated")).unionByName(shown(p, "propositions", "proposition_id", F.lit(None).cast("boolean"))))


@query("""SELECT id, length(content) AS n_chars, lang AS document_type FROM (SELECT CAST(doc_id AS VARCHAR) AS id, text AS content, lang FROM documents) ORDER BY id LIMIT 2000""")
def shown_documents(spark, d):
    """The documents that a source's page shows: the first by id, as many as its kind says."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"), F.col("lang").alias("document_type"), "source")
    with scratch(spark, "typed") as root:
        sets = Datasets(spark, root)
        sets.save("documents", docs, "web")
        return cut(sets.shown("documents", "web").select("id", F.length("content").alias("n_chars"), "document_type"))


@query("""SELECT 'silver' AS layer, 'web_documents' AS asset, 'documents' AS kind, 'web' AS source, NULL AS config, lang AS "partition", count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang
UNION ALL SELECT 'platinum', 'canonical_entities', 'canonical_entities', NULL, 'cs' || r_regionkey, NULL, count(n_nationkey) FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey""")
def described_datasets(spark, d):
    """What the sidecars of a store say: documents in a partition for each language, canonical entities in a configuration for each region."""
    docs, nation = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang"), table(spark, d, "nation").withColumnRenamed("n_name", "canonical_name")
    with scratch(spark, "typed") as root:
        sets = Datasets(spark, root)
        for r in docs.where("lang is not null").select("lang").distinct().collect():  # a few languages
            sets.save("documents", docs.where(F.col("lang") == r["lang"]), "web", partition=r["lang"])
        for r in table(spark, d, "region").select("r_regionkey").collect():
            sets.save("canonical_entities", nation.where(F.col("n_regionkey") == r["r_regionkey"]), config=f"cs{r['r_regionkey']}")
        return cut(sets.described().select("layer", "asset", "kind", "source", "config", "partition", "count"))


# --- metrics ---------------------------------------------------------------------------------------------


def _events(spark, d):
    return metrics.timed(table(spark, d, "events"))


@query("""WITH w AS (SELECT event_type, unnest([time_bucket(INTERVAL '5 minutes', ts), time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes']) AS window_end0 FROM events)
SELECT window_end0 - INTERVAL '5 minutes' AS window_start, event_type, count(*) AS n FROM w GROUP BY 1, 2""")
def sliding_event_rate(spark, d):
    found = metrics.rate(_events(spark, d), ["event_type"], "10 minutes", "5 minutes", 600)
    return found.select(F.col("window_start").cast(_NTZ).alias("window_start"), "event_type", "n")


@query("""WITH l AS (SELECT user_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start, CASE WHEN before IS NULL THEN 0.0 WHEN value < before THEN value ELSE value - before END AS step FROM l)
SELECT user_id, window_start, round(sum(step), 4) AS increase FROM s GROUP BY 1, 2""")
def counter_increase(spark, d):
    found = metrics.counter_rate(_events(spark, d), ["user_id"], length="1 day")
    return found.select("user_id", F.col("window_start").cast(_NTZ).alias("window_start"), F.round("increase", 4).alias("increase"))


#: Bounds of the buckets of a histogram of event values.
_BOUNDS = (1, 5, 10, 50, 100)


@query(f"""WITH b AS (SELECT unnest([{', '.join(f'{x}.0::DOUBLE' for x in _BOUNDS)}, 'infinity'::DOUBLE]) AS le), e AS (SELECT event_type, time_bucket(INTERVAL '1 day', ts) AS day, value FROM events),
c AS (SELECT event_type, day, le, count(*) FILTER (value <= le) AS c FROM e, b GROUP BY ALL), g AS (SELECT event_type, day, list(le ORDER BY le) AS les, list(c ORDER BY le) AS cs FROM c GROUP BY ALL),
f AS (SELECT event_type, day, le, c, coalesce(lag(c) OVER w, 0) AS c0, coalesce(lag(le) OVER w, 0.0) AS le0, max(c) OVER (PARTITION BY event_type, day) AS n FROM c WINDOW w AS (PARTITION BY event_type, day ORDER BY le)),
q AS (SELECT unnest([0.5, 0.99]) AS s)
SELECT event_type, day AS window_start, any_value(n)::DOUBLE AS n, round(max(CASE WHEN s = 0.5 AND c0 < 0.5 * n AND c >= 0.5 * n THEN CASE WHEN le = 'infinity' THEN le0 ELSE le0 + (le - le0) * (0.5 * n - c0) / (c - c0) END END), 6) AS p50,
round(max(CASE WHEN s = 0.99 AND c0 < 0.99 * n AND c >= 0.99 * n THEN CASE WHEN le = 'infinity' THEN le0 ELSE le0 + (le - le0) * (0.99 * n - c0) / (c - c0) END END), 6) AS p99 FROM f, q GROUP BY 1, 2""")
def histogram_quantiles(spark, d):
    """Daily quantiles of event values as a scraper of cumulative counters sees them: one sample an hour of each bucket, and a restart of the counters on the tenth day."""
    e = _events(spark, d).select("event_type", "ts", "value")
    bounds = F.explode(F.array(*(F.lit(str(float(x))) for x in _BOUNDS), F.lit("+Inf"))).alias("le")
    hours = e.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(*(F.count_if(F.col("value") <= x).alias(f"c{k}") for k, x in enumerate((*_BOUNDS, float("inf")))))
    counts = hours.select("event_type", "hour", F.posexplode(F.array(*(F.col(f"c{k}") for k in range(len(_BOUNDS) + 1)))).alias("k", "c"))
    le = F.element_at(F.array(*(F.lit(str(float(x))) for x in _BOUNDS), F.lit("+Inf")), F.col("k") + 1)
    grown = Window.partitionBy("event_type", "k", F.dayofmonth("hour") >= 10).orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # counters start with a sample of 0 before the first event, and again at the restart
    samples = counts.select("event_type", F.col("hour").alias("ts"), le.alias("le"), F.sum("c").over(grown).cast("double").alias("value"))
    zero = lambda day: e.select("event_type").distinct().select("event_type", F.lit(day).cast("timestamp").alias("ts"), bounds, F.lit(0.0).alias("value"))
    found = metrics.bucket_quantiles(samples.unionByName(zero("2023-12-31 12:00:00")), ["event_type"], [0.5, 0.99], length="1 day").where("n is not null and n > 0")
    return found.select("event_type", F.col("window_start").cast(_NTZ).alias("window_start"), "n", F.round("q0", 6).alias("p50"), F.round("q1", 6).alias("p99"))


def _played(spark, d, root, build):
    """What ``build`` makes of events as a stream that comes in four parts, one after another in time, and a last event long after, which closes all that is open."""
    e = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    last = e.limit(1).select(F.lit("none").alias("event_type"), F.lit("2030-01-01").cast("timestamp").alias("ts"), "value")
    parts = [e.where((F.dayofmonth("ts") >= a) & (F.dayofmonth("ts") < b)) for a, b in ((1, 8), (8, 16), (16, 24), (24, 32))]
    for part in (*parts, last):
        # a part has as many files as tasks read the table, and is played to its end before the next one comes
        part.write.mode("append").parquet(f"{root}/in")
        metrics.run_to_end(build(metrics.timed(spark.readStream.schema(e.schema).parquet(f"{root}/in"), late="1 hour")), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("""WITH l AS (SELECT event_type, ts, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, value) AS before FROM events),
s AS (SELECT event_type, time_bucket(INTERVAL '1 day', ts) AS window_start, CASE WHEN before IS NULL THEN 0.0 WHEN value < before THEN value ELSE value - before END AS step FROM l)
SELECT event_type, window_start, round(sum(step), 4) AS increase FROM s GROUP BY 1, 2""")
def streamed_increase(spark, d):
    """Daily increases of counters with resets, on a stream whose state waits for the watermark."""
    with scratch(spark, "stream") as root, stateful.keyed_state(spark, 8):
        found = _played(spark, d, root, lambda s: stateful.counter_increase(s, ["event_type"], length="1 day"))
        return cut(found.select("event_type", F.col("window_start").cast(_NTZ).alias("window_start"), F.round("increase", 4).alias("increase")))


@query("""WITH m AS (SELECT event_type, ts, value > 5 AS h FROM events), r AS (SELECT *, sum(CASE WHEN h THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT event_type, min(ts) AS since, max(ts) AS until, count(*) AS n FROM r WHERE h GROUP BY event_type, run HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 28800000000""")
def streamed_runs(spark, d):
    """Runs of values above 5 for eight hours or longer, on a stream; the last ones end as nothing follows them."""
    with scratch(spark, "stream") as root, stateful.keyed_state(spark, 8):
        found = _played(spark, d, root, lambda s: stateful.sustained(s, ["event_type"], F.col("value") > 5, 8 * 3600, idle="30 days"))
        return cut(found.where("ended").select("event_type", *(F.col(c).cast(_NTZ).alias(c) for c in ("since", "until")), "n"))


@query("""WITH r AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, value, row_number() OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts) ORDER BY value) AS k, count(*) OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts)) AS n FROM events)
SELECT window_start, min(value) FILTER (k >= ceil(0.5 * n)) AS q0, min(value) FILTER (k >= ceil(0.99 * n)) AS q1 FROM r GROUP BY 1""")
def daily_quantiles(spark, d):
    found = metrics.quantiles(_events(spark, d), "value", [0.5, 0.99], "1 day", accuracy=1_000_000)
    return found.select(F.col("window_start").cast(_NTZ).alias("window_start"), "q0", "q1")


@query("""WITH m AS (SELECT user_id, ts, value > 5 AS h, event_id FROM events), r AS (SELECT *, sum(CASE WHEN h THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT user_id, min(ts) AS since, max(ts) AS until, count(*) AS n FROM r WHERE h GROUP BY user_id, run HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 86400000000""")
def sustained_values(spark, d):
    found = metrics.sustained(_events(spark, d), ["user_id"], F.col("value") > 5, 86_400)
    return found.select("user_id", *(F.col(c).cast(_NTZ).alias(c) for c in ("since", "until")), "n")


@query("SELECT l_orderkey, l_linenumber, round(l_quantity / (l_tax * 1000), 6) AS ratio FROM lineitem WHERE l_tax > 0 AND l_quantity / (l_tax * 1000) > 0.9")
def limits_exceeded(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("used"), (F.col("l_tax") * 1000).alias("available"))
    return metrics.over_limit(rows).select("l_orderkey", "l_linenumber", F.round("ratio", 6).alias("ratio"))
