"""Every registered query with its SQL counterpart, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeel.functions.scalars import keyword_in_context, text_hash
from lorekeel.operators import chunking, density, documents, explore, incremental, projection, resolution, textjoin, validation, vector_index, vectors
from lorekeel.operators.components import components_of
from lorekeel.plans.base import ORACLES, QUERIES, query
from lorekeel.plans.views import ASSERTIONS_SQL, CANDIDATES_SQL, SURFACES_SQL, assertions, candidates, mentions, table
from lorekeel.plans.views import documents as given_documents
from lorekeel.streaming import metrics

# --- documents and chunks -------------------------------------------------------------------------------


@query("SELECT sha256(text) AS content_hash, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text <> '' GROUP BY 1 HAVING count(*) > 1")
def doc_content_hash_dups(spark, d):
    return documents.duplicate_groups(given_documents(spark, d))


@query("""
WITH u AS (
  SELECT 'congress-committee-' || r_regionkey AS id, r_name AS title, r_name || '. Chamber: House' AS content, 'congress.gov' AS source, 'committee_profile' AS document_type FROM region
  UNION ALL
  SELECT 'congress-member-' || n_nationkey, n_name, n_name || '. N-' || r_name, 'congress.gov', 'member_profile' FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'icij-supplier-' || s_suppkey, s_name, s_name || '. Jurisdiction: ' || n_name || CASE WHEN s_acctbal > 0 THEN '. Status: active' ELSE '' END, 'icij-supplier', 'offshore_entity'
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)
SELECT id, title, content, source, document_type, sha256(content) AS content_hash FROM u""")
def doc_project_union(spark, d):
    region, nation, supplier = (table(spark, d, t) for t in ("region", "nation", "supplier"))
    none = F.lit(None).cast("string")
    committees = region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit("House").alias("chamber"), F.lit("").alias("committee_type"), none.alias("source_url"), none.alias("system_code"), none.alias("parent_committee"))
    placed = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    members = placed.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("N").alias("party"), F.col("r_name").alias("state"), none.alias("chamber"), *(none.alias(c) for c in ("source_url", "bioguide_id", "district", "terms_served")))
    firms = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    firms = firms.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("jurisdiction"), F.lit("").alias("country"), F.when(F.col("s_acctbal") > 0, "active").alias("status"),
        F.lit("supplier").alias("source_dataset"), *(none.alias(c) for c in ("source_url", "entity_type", "incorporation_date")),
    )
    union = documents.union_documents(documents.committee_documents(committees), documents.member_documents(members), documents.offshore_documents(firms))
    return union.select("id", "title", "content", "source", "document_type", "content_hash")


@query(r"""
WITH t AS (SELECT doc_id AS document_id, source, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM documents)
SELECT document_id || ':chunk-0' AS chunk_id, document_id, CAST(0 AS INTEGER) AS "index", CAST(1 AS INTEGER) AS total_chunks,
       sha256(CASE WHEN source <> '' THEN source || chr(10) || chr(10) || text ELSE text END) AS content_hash FROM t WHERE text <> ''""")
def chunk_passthrough(spark, d):
    return chunking.passthrough(given_documents(spark, d)).select("chunk_id", "document_id", "index", "total_chunks", "content_hash")


@query()
def chunk_recursive(spark, d):
    return chunking.recursive(given_documents(spark, d), 400, 100).select("chunk_id", "document_id", "index", "total_chunks", "content_hash")


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id")
def conversation_texts(spark, d):
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("index"), "text")
    return chunking.reconstructed(turns).withColumnRenamed("document_id", "conv_id")


@query(r"SELECT page_id, coalesce(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '') AS title, length(html) AS n_chars FROM pages")
def page_titles(spark, d):
    title = F.coalesce(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1), F.lit(""))
    return table(spark, d, "pages").select("page_id", title.alias("title"), F.length("html").cast("long").alias("n_chars"))


# --- filters, facets, counts ------------------------------------------------------------------------------


@query("SELECT coalesce(nullif(source, ''), 'unknown') AS value, count(*) AS n FROM documents GROUP BY 1")
def facet_sources(spark, d):
    return explore.facet_counts(table(spark, d, "documents"), "source")


@query("""
SELECT lang AS layer, count(*) AS n, CAST(CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END AS INTEGER) AS place FROM documents GROUP BY lang""")
def facet_languages_ordered(spark, d):
    return explore.layer_counts(table(spark, d, "documents"), "lang", ["en", "de", "fr"])


@query("SELECT doc_id, source FROM documents WHERE regexp_matches(text, 'th(ere|ese)s', 'i') OR regexp_matches(source, 'th(ere|ese)s', 'i')")
def fulltext_filter(spark, d):
    return table(spark, d, "documents").where(explore.matching_text("th(ere|ese)s", ["text", "source"])).select("doc_id", "source")


@query("""
WITH p AS (SELECT conv_id, turn, text, strpos(lower(text), 'that') AS p FROM conversations)
SELECT conv_id, turn, CASE WHEN p > 0 THEN substr(text, greatest(p - 20, 1), p - greatest(p - 20, 1)) ELSE substr(text, greatest(length(text) - 19, 1), 20) END AS left_part,
       CASE WHEN p > 0 THEN substr(text, p, 4) ELSE 'that' END AS hit, CASE WHEN p > 0 THEN substr(text, p + 4, 20) ELSE '' END AS right_part FROM p""")
def keyword_in_conversations(spark, d):
    left, hit, right = keyword_in_context("text", F.lit("that"), 20)
    return table(spark, d, "conversations").select("conv_id", "turn", left.alias("left_part"), hit.alias("hit"), right.alias("right_part"))


@query(f"WITH {ASSERTIONS_SQL} SELECT predicate, count(*) AS n FROM assertions GROUP BY predicate ORDER BY n DESC, predicate LIMIT 15")
def predicate_top(spark, d):
    return explore.top_counts(assertions(spark, d), "predicate", 15, "predicate")


@query(f"""WITH {ASSERTIONS_SQL} SELECT count(*) AS total, count(*) FILTER (negated) AS negated, count(*) FILTER (hedged) AS hedged,
count(*) - count(*) FILTER (negated) - count(*) FILTER (hedged) AS confident FROM assertions""")
def flag_breakdown(spark, d):
    return explore.flag_breakdown(assertions(spark, d))


@query(f"WITH {ASSERTIONS_SQL} SELECT predicate, round(avg(confidence), 6) AS avg_confidence, count(*) AS n FROM assertions WHERE confidence >= 0.95 GROUP BY predicate")
def confident_predicates(spark, d):
    rows = assertions(spark, d).where(explore.confident_at_least("confidence", 0.95) & explore.endpoints_present())
    return rows.groupBy("predicate").agg(F.round(F.avg("confidence"), 6).alias("avg_confidence"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {ASSERTIONS_SQL} SELECT q.qualifier, CAST(CASE q.qualifier WHEN 'time' THEN t WHEN 'location' THEN l WHEN 'condition' THEN c ELSE 0 END AS BIGINT) AS n
FROM (SELECT unnest(['time', 'location', 'condition', 'manner', 'purpose']) AS qualifier) q,
(SELECT count(*) FILTER (l_shipdate IS NOT NULL) AS t, count(*) FILTER (l_quantity > 25) AS l, count(*) FILTER (l_tax > 0.04) AS c FROM assertions)""")
def qualifier_coverage(spark, d):
    return explore.qualifier_coverage(assertions(spark, d))


@query(f"""WITH {ASSERTIONS_SQL} SELECT node, count(*) AS degree FROM (SELECT 's' || subject_text AS node FROM assertions UNION ALL SELECT 'o' || object_text FROM assertions) GROUP BY node""")
def node_degree(spark, d):
    tagged = assertions(spark, d).select(F.concat(F.lit("s"), "subject_text").alias("subject_text"), F.concat(F.lit("o"), "object_text").alias("object_text"))
    return explore.node_degree(tagged)


@query("""WITH g AS (SELECT CAST(o_custkey AS VARCHAR) AS node, count(*) AS degree FROM orders GROUP BY 1)
SELECT node, degree, CAST(floor(15 + CAST(degree AS DOUBLE) / max(degree) OVER () * 25) AS INTEGER) AS size FROM g""")
def node_sizes(spark, d):
    degrees = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    return explore.node_size(degrees)


@query(f"WITH {ASSERTIONS_SQL} SELECT assertion_id, subject_text, object_text FROM assertions WHERE contains(subject_text, '77') OR contains(object_text, '77')")
def ego_filter(spark, d):
    return assertions(spark, d).where(explore.focused("77", ["subject_text", "object_text"])).select("assertion_id", "subject_text", "object_text")


@query("""WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 20)) AS INTEGER) + 1, 20) AS bin, count(*) AS n FROM orders, e GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * (hi - lo) / 20, 4) AS low, round(lo + i * (hi - lo) / 20, 4) AS high, coalesce(n, 0) AS n
FROM e, range(1, 21) r(i) LEFT JOIN b ON b.bin = i""")
def price_histogram(spark, d):
    return explore.histogram(table(spark, d, "orders"), "o_totalprice", 20).select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


@query("SELECT count(*) AS total, count(DISTINCT p_brand) AS n_documents, count(DISTINCT p_type || ' ' || p_brand || ' ' || p_name || ' ' || CAST(p_size AS VARCHAR)) AS n_texts FROM part")
def mention_statistics(spark, d):
    return explore.mention_statistics(mentions(spark, d))


@query("SELECT p_name AS text, p_type AS mention_type, count(*) AS n FROM part GROUP BY 1, 2")
def occurrence_counts(spark, d):
    return explore.occurrence_counts(table(spark, d, "part").select(F.col("p_name").alias("text"), F.col("p_type").alias("mention_type")))


@query("""WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT lang, source, n, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS place FROM c) WHERE place <= 5""")
def top_sources_by_language(spark, d):
    return resolution.top_group_names(table(spark, d, "documents"), "lang", "source", 5)


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS u, l_suppkey AS e FROM lineitem) SELECT a.e AS a, b.e AS b, count(*) AS n FROM l a JOIN l b ON a.u = b.u AND a.e < b.e GROUP BY 1, 2""")
def cooccurrence(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chunk_id"), F.col("l_suppkey").alias("entity"))
    return explore.cooccurrence(rows)


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def labelled_documents(spark, d):
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return table(spark, d, "documents").join(good, "doc_id", "left_semi").select("doc_id", "lang")


@query("SELECT d.doc_id, sha256(d.text) AS content_hash FROM documents d WHERE d.text <> '' AND sha256(d.text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src0' AND text <> '')")
def unprocessed_documents(spark, d):
    hashed = table(spark, d, "documents").select("doc_id", "source", text_hash("text").alias("content_hash")).where("content_hash <> ''")
    return incremental.unprocessed(hashed, hashed.where("source = 'src0'")).select("doc_id", "content_hash")


@query("""SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations) WHERE r = 1""")
def first_turns(spark, d):
    return explore.first_by(table(spark, d, "conversations"), ["conv_id", "role"], ["turn"]).select("conv_id", "turn", "role")


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def event_properties(spark, d):
    parsed = table(spark, d, "events").select(F.from_json("props", "k long")["k"].alias("k"), "value")
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""SELECT c_custkey, CASE WHEN n.k IS NOT NULL THEN n.bal ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer LEFT JOIN (SELECT o_custkey AS k, round(max(o_totalprice), 2) AS bal FROM orders GROUP BY 1) n ON n.k = c_custkey
UNION ALL SELECT k, bal, 'NEW' FROM (SELECT o_custkey AS k, round(max(o_totalprice), 2) AS bal FROM orders GROUP BY 1) WHERE k NOT IN (SELECT c_custkey FROM customer)""")
def upsert_balances(spark, d):
    old = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    new = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.max("o_totalprice"), 2).alias("c_acctbal")).withColumn("c_mktsegment", F.lit("NEW"))
    return incremental.merged(old, new, ["c_custkey"], ["c_acctbal"])


# --- resolution ------------------------------------------------------------------------------------------------


@query(f"WITH {SURFACES_SQL} SELECT a, b, round(shared / CAST(either AS DOUBLE), 6) AS similarity FROM pairs WHERE shared >= 2 AND shared / CAST(either AS DOUBLE) > 0.6")
def surface_similar_pairs(spark, d):
    names = resolution.surfaces(mentions(spark, d))
    return textjoin.similar_pairs(names, 0.6, 2).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {SURFACES_SQL} SELECT a, b FROM pairs WHERE shared >= 2 AND (contains(a, b) OR contains(b, a))")
def surface_contained_pairs(spark, d):
    return resolution.contained_pairs(resolution.surfaces(mentions(spark, d))).select("a", "b")


@query(f"""WITH RECURSIVE {SURFACES_SQL}, edges AS (SELECT a, b FROM pairs WHERE shared >= 2 AND (shared / CAST(either AS DOUBLE) > 0.6 OR contains(a, b) OR contains(b, a))),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT a AS node, a AS component FROM both_ways UNION SELECT w.b, r.component FROM reach r JOIN both_ways w ON w.a = r.node)
SELECT node, min(component) AS component FROM reach GROUP BY node""")
def surface_components(spark, d):
    edges = resolution.surface_edges(resolution.surfaces(mentions(spark, d)))
    return components_of(edges, "a", "b")


@query(f"""WITH RECURSIVE {SURFACES_SQL}, edges AS (SELECT a, b FROM pairs WHERE shared >= 2 AND (shared / CAST(either AS DOUBLE) > 0.6 OR contains(a, b) OR contains(b, a))),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT key AS node, key AS component FROM surfaces UNION SELECT w.b, r.component FROM reach r JOIN both_ways w ON w.a = r.node),
comp AS (SELECT node, min(component) AS component FROM reach GROUP BY node),
m AS (SELECT p_partkey, p_brand, p_type || ' ' || p_brand || ' ' || p_name || ' ' || CAST(p_size AS VARCHAR) AS text FROM part), r AS (SELECT m.*, component FROM m JOIN comp ON lower(m.text) = node),
t AS (SELECT component, text, count(*) AS n, min(p_partkey) AS first FROM r GROUP BY 1, 2), best AS (SELECT component, arg_min(text, ROW(-n, first)) AS canonical_name, count(*) - 1 AS n_aliases FROM t GROUP BY 1)
SELECT canonical_name, CAST(n_aliases AS BIGINT) AS n_aliases, CAST(count(*) AS BIGINT) AS mention_count, min(p_partkey) AS ordinal, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS source_documents
FROM r JOIN best USING (component) GROUP BY component, canonical_name, n_aliases""")
def entity_candidates(spark, d):
    found = resolution.resolve_mentions(mentions(spark, d), "parts")
    return found.select("canonical_name", F.size("aliases").cast("long").alias("n_aliases"), F.col("mention_count").cast("long").alias("mention_count"), "ordinal", F.array_join("source_documents", ",").alias("source_documents"))


@query(f"""WITH RECURSIVE {SURFACES_SQL}, edges AS (SELECT a, b FROM pairs WHERE shared >= 2 AND (shared / CAST(either AS DOUBLE) > 0.6 OR contains(a, b) OR contains(b, a))),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT key AS node, key AS component FROM surfaces UNION SELECT w.b, r.component FROM reach r JOIN both_ways w ON w.a = r.node),
comp AS (SELECT node, min(component) AS component FROM reach GROUP BY node),
m AS (SELECT p_partkey, p_brand, p_type || ' ' || p_brand || ' ' || p_name || ' ' || CAST(p_size AS VARCHAR) AS text FROM part), r AS (SELECT m.*, component FROM m JOIN comp ON lower(m.text) = node),
t AS (SELECT component, text, count(*) AS n, min(p_partkey) AS first FROM r GROUP BY 1, 2), best AS (SELECT component, arg_min(text, ROW(-n, first)) AS canonical_name, count(*) - 1 AS n_aliases FROM t GROUP BY 1)
SELECT canonical_name, CAST(n_aliases AS BIGINT) AS alias_count, count(*) AS mention_count, count(DISTINCT p_brand) AS document_count, min(p_partkey) AS ordinal FROM r JOIN best USING (component) GROUP BY component, canonical_name, n_aliases""")
def entity_rows(spark, d):
    """Entities with counts, beside which their members are rows of their own."""
    return resolution.entity_members(mentions(spark, d), "parts")[0].select("canonical_name", "alias_count", "mention_count", "document_count", "ordinal")


@query(f"""WITH RECURSIVE {SURFACES_SQL}, edges AS (SELECT a, b FROM pairs WHERE shared >= 2 AND (shared / CAST(either AS DOUBLE) > 0.6 OR contains(a, b) OR contains(b, a))),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT key AS node, key AS component FROM surfaces UNION SELECT w.b, r.component FROM reach r JOIN both_ways w ON w.a = r.node),
comp AS (SELECT node, min(component) AS component FROM reach GROUP BY node),
m AS (SELECT p_partkey, p_brand, p_type || ' ' || p_brand || ' ' || p_name || ' ' || CAST(p_size AS VARCHAR) AS text FROM part), r AS (SELECT m.*, component FROM m JOIN comp ON lower(m.text) = node),
t AS (SELECT component, text, count(*) AS n, min(p_partkey) AS first FROM r GROUP BY 1, 2), best AS (SELECT component, arg_min(text, ROW(-n, first)) AS canonical_name, count(*) - 1 AS n_aliases FROM t GROUP BY 1)
SELECT canonical_name, CAST(p_partkey AS VARCHAR) AS mention_id, p_brand AS document_id, text FROM r JOIN best USING (component)""")
def entity_mentions(spark, d):
    """A row for each mention with the name of its entity."""
    entities, members = resolution.entity_members(mentions(spark, d), "parts")
    return members.join(entities.select("candidate_id", "canonical_name"), "candidate_id").select("canonical_name", "mention_id", "document_id", "text")


@query(f"""WITH {CANDIDATES_SQL} SELECT source_entity_id, target_entity_id, CAST(score AS DOUBLE) AS score, evidence, CASE WHEN score >= 0.9 THEN 'sameAs' ELSE 'possibleSameAs' END AS alignment_type FROM edges""")
def cross_source_alignment(spark, d):
    edges = resolution.align(candidates(spark, d), ["low", "high"])
    return edges.select("source_entity_id", "target_entity_id", "score", F.array_join("evidence", ",").alias("evidence"), "alignment_type")


@query(f"""WITH RECURSIVE {CANDIDATES_SQL}, same AS (SELECT source_entity_id AS a, target_entity_id AS b FROM edges WHERE score >= 0.9), both_ways AS (SELECT a, b FROM same UNION SELECT b, a FROM same),
reach AS (SELECT candidate_id AS node, candidate_id AS component FROM named UNION SELECT w.b, r.component FROM reach r JOIN both_ways w ON w.a = r.node), comp AS (SELECT node, min(component) AS component FROM reach GROUP BY node),
r AS (SELECT named.*, component FROM named JOIN comp ON node = candidate_id)
SELECT substr(sha256(array_to_string(list_sort(list(candidate_id)), '|')), 1, 16) AS canonical_id, arg_min(canonical_name, ROW(-mention_count, ordinal)) AS canonical_name,
CAST(sum(mention_count) AS BIGINT) AS mention_count, array_to_string(list_sort(list_distinct(list(code_location))), ',') AS source_code_locations FROM r GROUP BY component""")
def canonical_entities(spark, d):
    rows = candidates(spark, d)
    merged = resolution.canonical_entities(rows, resolution.align(rows, ["low", "high"]))
    return merged.select("canonical_id", "canonical_name", "mention_count", F.array_join("source_code_locations", ",").alias("source_code_locations"))


_LINKED_SQL = """
names AS (SELECT lower(p_name) AS key, min(p_partkey) AS ordinal FROM part GROUP BY 1),
entities AS (SELECT key, ordinal, 'E' || ordinal AS id FROM names),
asked AS (SELECT p_partkey AS assertion_id, string_split(lower(p_name), ' ')[1] AS s, lower(p_name) || ' ' || lower(p_type) AS o FROM part),
keys AS (SELECT DISTINCT s AS key FROM asked UNION SELECT DISTINCT o FROM asked),
found AS (SELECT k.key, coalesce(max(CASE WHEN e.key = k.key THEN e.id END), arg_min(e.id, e.ordinal)) AS id FROM keys k JOIN entities e ON contains(e.key, k.key) OR contains(k.key, e.key) GROUP BY k.key),
linked AS (SELECT assertion_id, a.id AS subject_canonical_id, b.id AS object_canonical_id FROM asked LEFT JOIN found a ON a.key = s LEFT JOIN found b ON b.key = o)"""


def _part_entities(spark, d):
    named = table(spark, d, "part").groupBy(F.col("p_name").alias("canonical_name")).agg(F.min("p_partkey").alias("ordinal"))
    return named.select("ordinal", "canonical_name", F.concat(F.lit("E"), F.col("ordinal").cast("string")).alias("canonical_id"), F.array().cast("array<string>").alias("aliases"))


def _linked(spark, d):
    p, entities = table(spark, d, "part"), _part_entities(spark, d)
    asked = p.select(F.col("p_partkey").alias("assertion_id"), F.split("p_name", " ")[0].alias("subject_text"), F.concat_ws(" ", "p_name", "p_type").alias("object_text"))
    return resolution.link_assertions(asked, entities)


@query(f"WITH {_LINKED_SQL} SELECT assertion_id, subject_canonical_id, object_canonical_id FROM linked")
def linked_assertions(spark, d):
    return _linked(spark, d).select("assertion_id", "subject_canonical_id", "object_canonical_id")


@query(f"""WITH {_LINKED_SQL}, n AS (SELECT 'E' || min(p_partkey) AS id, p_name AS name FROM part GROUP BY p_name)
SELECT assertion_id, coalesce(s.name, string_split(p_name, ' ')[1]) AS subject_name, coalesce(o.name, p_name || ' ' || p_type) AS object_name FROM linked JOIN part ON p_partkey = assertion_id LEFT JOIN n s ON s.id = subject_canonical_id LEFT JOIN n o ON o.id = object_canonical_id""")
def named_assertions(spark, d):
    return resolution.with_entity_names(_linked(spark, d), _part_entities(spark, d)).select("assertion_id", "subject_name", "object_name")


@query(f"""WITH {_LINKED_SQL} SELECT count(*) FILTER (subject_canonical_id IS NOT NULL AND object_canonical_id IS NOT NULL) AS n_full,
count(*) FILTER ((subject_canonical_id IS NULL) <> (object_canonical_id IS NULL)) AS n_partial, count(*) FILTER (subject_canonical_id IS NULL AND object_canonical_id IS NULL) AS n_none FROM linked""")
def link_status(spark, d):
    return resolution.link_counts(_linked(spark, d))


# --- vectors ---------------------------------------------------------------------------------------------------------

_VECTOR_SQL = """
q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 50 = 0),
scored AS (SELECT query_id, vec_id, label, list_cosine_similarity(embedding::DOUBLE[], v) AS score FROM embeddings, q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)"""


def _searched(spark, d, k, rows="true", threshold=None):
    """The ``k`` vectors closest to every one whose id 50 divides."""
    e = table(spark, d, "embeddings")
    return vectors.search(e.where(rows), e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), k, threshold)


@query(f"WITH {_VECTOR_SQL} SELECT query_id, vec_id, round(score, 5) AS score, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= 10 AND score >= 0.2")
def vector_topk(spark, d):
    return _searched(spark, d, 10, threshold=0.2).select("query_id", "vec_id", F.round("score", 5).alias("score"), "place")


@query(f"WITH {_VECTOR_SQL} SELECT query_id, vec_id, round(score, 5) AS score, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= 10")
def indexed_topk(spark, d):
    """The same by an index: few lists first, then those that can still hold a closer vector."""
    e = table(spark, d, "embeddings")
    index = vector_index.VectorIndex.build(e)
    asked = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return index.search(asked, 10, probes=5, exact=True).select("query_id", "vec_id", F.round("score", 5).alias("score"), "place")


@query()
def index_search(spark, d):
    """By as many lists as nine in ten of the closest rows take on a sample of the queries; tests hold the recall."""
    e = table(spark, d, "embeddings")
    index = vector_index.VectorIndex.build(e)
    asked = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return index.search(asked, 10, probes=index.probes_for(asked, 10)).select("query_id", "vec_id", F.round("score", 5).alias("score"), "place")


@query(f"""WITH {_VECTOR_SQL}, a AS (SELECT query_id, vec_id FROM ranked WHERE place <= 50), c AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS p FROM scored WHERE label < 5), b AS (SELECT query_id, vec_id FROM c WHERE p <= 50)
SELECT query_id, (SELECT count(*) FROM a WHERE a.query_id = q.query_id) AS n_a, (SELECT count(*) FROM b WHERE b.query_id = q.query_id) AS n_b, (SELECT count(*) FROM a JOIN b USING (query_id, vec_id) WHERE a.query_id = q.query_id) AS n_both FROM q""")
def result_overlap(spark, d):
    return vectors.overlaps(_searched(spark, d, 50), _searched(spark, d, 50, "label < 5")).select("query_id", "n_a", "n_b", "n_both")


@query("""SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS score
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.3""")
def vector_pairs(spark, d):
    found = vectors.similar_vectors(table(spark, d, "embeddings"), 0.3, group_col="label")
    return found.select("a", "b", F.round("score", 5).alias("score"))


@query()
def projected_vectors(spark, d):
    """Vectors along their two directions of most variance; tests hold them against a decomposition."""
    found = projection.principal_components(table(spark, d, "embeddings"))
    return found.select("vec_id", *(F.round(F.col("coordinates")[k], 4).alias(n) for k, n in enumerate("xy")))


@query("""WITH RECURSIVE p AS (SELECT p_partkey AS id, p_retailprice / 100 AS x, p_size * 1.0::DOUBLE AS y FROM part),
near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.y = b.y AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.3::DOUBLE * 0.3::DOUBLE),
cores AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 4), links AS (SELECT a, b FROM near WHERE a IN (FROM cores) AND b IN (FROM cores)),
reach AS (SELECT id AS node, id AS c FROM cores UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.node), named AS (SELECT node, min(c) AS cluster FROM reach GROUP BY node),
beside AS (SELECT a, min(cluster) AS cluster FROM near JOIN named ON node = b GROUP BY a)
SELECT id AS partkey, coalesce(n.cluster, b.cluster) AS cluster, n.node IS NOT NULL AS core FROM p LEFT JOIN named n ON n.node = id LEFT JOIN beside b ON b.a = id""")
def part_clusters(spark, d):
    """Clusters of parts by price among those of one size: points whose second coordinates are a whole number apart."""
    points = table(spark, d, "part").select(F.col("p_partkey").alias("partkey"), (F.col("p_retailprice") / 100).alias("x"), F.col("p_size").cast("double").alias("y"))
    return density.density_clusters(points, 0.3, 4, "partkey")


@query(f"""WITH {_VECTOR_SQL}, t AS (SELECT query_id, score, doc_id, text, sum(length(text)) OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS used FROM ranked JOIN documents ON doc_id = vec_id WHERE place <= 30)
SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY score DESC, doc_id) AS context, count(*) AS n_chunks FROM t WHERE used <= 8000 GROUP BY query_id""")
def retrieval_context(spark, d):
    hits = _searched(spark, d, 30).select("query_id", F.col("vec_id").alias("chunk_id"), "score")
    chunks = table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("doc_id").alias("document_id"), "text")
    return vectors.retrieval_context(hits, chunks, keys=["query_id"])


# --- validation --------------------------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT o_orderkey, o_custkey, lower(replace(o_orderpriority, '-', ' ')) AS predicate, o_totalprice / 300000 AS confidence FROM orders),
e AS (SELECT 'INVALID_REFERENCE' AS code, false AS w FROM p WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL
SELECT 'PREDICATE_FORMAT', true FROM p WHERE NOT regexp_matches(predicate, '^[a-z][a-z0-9]*(_[a-z0-9]+)*$') UNION ALL SELECT 'CONFIDENCE_OUT_OF_RANGE', false FROM p WHERE confidence > 1)
SELECT code, w AS is_warning, count(*) AS n FROM e GROUP BY 1, 2""")
def proposition_error_codes(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    none = F.lit(None).cast("string")
    rows = o.select(
        F.lit(0).alias("batch_id"), F.col("o_orderkey").alias("pos"), F.col("o_custkey").cast("string").alias("subject_id"), none.alias("object_id"), none.alias("subject_mention_id"), none.alias("object_mention_id"),
        F.lower(F.replace("o_orderpriority", F.lit("-"), F.lit(" "))).alias("predicate"), (F.col("o_totalprice") / 300000).alias("confidence"),
    )
    known = c.where("c_acctbal > 0").select(F.lit(0).alias("batch_id"), F.col("c_custkey").cast("string").alias("id"))
    return validation.proposition_errors(rows, known).groupBy("code", "is_warning").agg(F.count(F.lit(1)).alias("n"))


# --- metrics over events -----------------------------------------------------------------------------------------------------


def _events(spark, d):
    return metrics.timed(table(spark, d, "events"))


@query("""SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type, count(*) AS n, count(*) / 300.0::DOUBLE AS per_second FROM events GROUP BY 1, 2""")
def event_rate(spark, d):
    return metrics.rate(_events(spark, d), ["event_type"]).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "per_second")


@query("""WITH g AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS n, count(*) FILTER (value > 100) AS n_errors FROM events GROUP BY 1)
SELECT window_start, n, n_errors FROM g WHERE n_errors / CAST(n AS DOUBLE) > 0.1""")
def error_ratio(spark, d):
    return metrics.error_ratio(_events(spark, d), F.col("value") > 100, 0.1, "1 hour").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", "n_errors")


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type")
def event_quantiles(spark, d):
    found = metrics.exact_quantiles(table(spark, d, "events"), ["event_type"], "value", [0.5, 0.99])
    return found.select("event_type", F.round("q0", 6).alias("p50"), F.round("q1", 6).alias("p99"))


@query("""SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, event_type AS level, count(*) AS n FROM events GROUP BY 1, 2""")
def log_counts(spark, d):
    e = _events(spark, d)
    logs = e.select("ts", F.to_json(F.struct(F.col("event_type").alias("level"), F.lit("m").alias("message"))).alias("line"))
    return metrics.log_counts(logs).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "level", "n")


@query("""WITH l AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS s FROM events),
g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '30 minutes' AS window_end, count(*) AS n FROM g GROUP BY user_id, k""")
def user_sessions(spark, d):
    found = metrics.sessions(_events(spark, d), ["user_id"])
    return found.select("user_id", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")), "n")


# the queries of these modules are registered as they are read
from lorekeel.plans import extraction_queries, lookup_queries, record_queries  # noqa: E402

MODULES = (extraction_queries, lookup_queries, record_queries)
__all__ = ["MODULES", "ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical entities over two sources: candidates, alignment, components and merge."""
    return canonical_entities(spark, sf_dir)


