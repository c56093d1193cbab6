"""Registered queries of look-ups, counts, orders and unions over entities, mentions and assertions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorekeel.operators import explore, incremental, lookup, resolution, trigram_index, vectors
from lorekeel.plans.base import query
from lorekeel.plans.views import ASSERTIONS_SQL, CANDIDATES_SQL, assertions, candidates, mentions, table
from lorekeel.session import cut, scratch

# part names as entities: their types are aliases, their brands locations
_ENTITIES_SQL = """
entities AS (
  SELECT min(p_partkey) AS ordinal, 'E' || min(p_partkey) AS canonical_id, p_name AS canonical_name, max(p_type) AS entity_type, list_sort(list_distinct(list(p_type))) AS aliases,
         list_sort(list_distinct(list(p_brand))) AS source_code_locations, count(*) AS mention_count
  FROM part GROUP BY p_name
)"""
_MENTIONS_SQL = "m AS (SELECT p_partkey AS ordinal, p_brand AS document_id, p_type || ' ' || p_brand || ' ' || p_name || ' ' || CAST(p_size AS VARCHAR) AS text FROM part)"


def _entities(spark, d):
    p = table(spark, d, "part")
    sets = [F.array_sort(F.collect_set(c)).alias(a) for c, a in (("p_type", "aliases"), ("p_brand", "source_code_locations"))]
    named = p.groupBy(F.col("p_name").alias("canonical_name")).agg(F.min("p_partkey").alias("ordinal"), F.max("p_type").alias("entity_type"), *sets, F.count(F.lit(1)).alias("mention_count"))
    return named.withColumn("canonical_id", F.concat(F.lit("E"), F.col("ordinal").cast("string"))).withColumn("candidate_type", F.col("entity_type"))


# --- filters ---------------------------------------------------------------------------------------


@query(f"WITH {_ENTITIES_SQL} SELECT canonical_id, len(source_code_locations) AS n_locations FROM entities WHERE len(source_code_locations) > 1")
def multi_source_entities(spark, d):
    return _entities(spark, d).where(lookup.multi_source()).select("canonical_id", F.size("source_code_locations").cast("long").alias("n_locations"))


@query(f"""WITH {_ENTITIES_SQL} SELECT canonical_id, canonical_name FROM entities
WHERE entity_type = 'STANDARD' AND list_contains(source_code_locations, 'Brand#7') AND (contains(lower(canonical_name), 'an') OR len(list_filter(aliases, lambda a: contains(lower(a), 'an'))) > 0)""")
def filtered_entities(spark, d):
    return _entities(spark, d).where(explore.entity_filter("STANDARD", "Brand#7", "AN")).select("canonical_id", "canonical_name")


@query(f"""WITH {_ENTITIES_SQL} SELECT canonical_id, mention_count FROM entities
WHERE upper(entity_type) = 'STANDARD' AND (contains(lower(canonical_name), 'ring') OR len(list_filter(aliases, lambda a: contains(lower(a), 'ring'))) > 0) AND mention_count >= 2""")
def filtered_candidates(spark, d):
    return _entities(spark, d).where(lookup.candidate_filter("standard", "ring", 2)).select("canonical_id", "mention_count")


@query("SELECT p_partkey, p_name FROM part WHERE p_type IN ('ECONOMY', 'SMALL') AND contains(lower(p_name), 'hot')")
def filtered_mentions(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.col("p_name"), F.col("p_name").alias("text"), F.col("p_type").alias("mention_type"))
    return rows.where(lookup.mention_filter(["ECONOMY", "SMALL"], "HOT")).select("p_partkey", "p_name")


@query("SELECT doc_id FROM documents WHERE lang = 'de' AND source = 'src0'")
def faceted_documents(spark, d):
    return table(spark, d, "documents").where(lookup.faceted(lang="de", source="src0", n_chars=None)).select("doc_id")


@query("SELECT p_partkey FROM part WHERE p_type = 'SMALL' AND contains(lower(p_name), 'bolt')")
def layered_assets(spark, d):
    assets = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("layer"), F.col("p_name").alias("name"))
    return assets.where(lookup.assets_of("SMALL", "Bolt")).select("p_partkey")


@query(f"WITH {ASSERTIONS_SQL} SELECT assertion_id FROM assertions WHERE confidence < 0.92")
def doubtful_assertions(spark, d):
    return assertions(spark, d).where(lookup.low_confidence(0.92)).select("assertion_id")


@query(f"WITH {ASSERTIONS_SQL} SELECT assertion_id, predicate FROM assertions WHERE predicate IN ('1-URGENT', 'UNKNOWN') OR l_linestatus IN ('1-URGENT', 'UNKNOWN')")
def labelled_assertions(spark, d):
    rows = assertions(spark, d).withColumn("other", F.when(F.col("hedged"), "O").otherwise("F"))
    return rows.where(explore.labelled("predicate", "other", ["1-URGENT"])).select("assertion_id", "predicate")


@query("SELECT c_custkey, seat FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal > 9000 THEN NULL ELSE c_mktsegment END AS seat FROM customer) WHERE seat IS NULL OR seat = '' OR seat IN ('BUILDING', 'MACHINERY')")
def located_customers(spark, d):
    seat = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_acctbal") > 9000, F.lit(None)).otherwise(F.col("c_mktsegment"))
    rows = table(spark, d, "customer").select("c_custkey", seat.alias("seat"))
    return rows.where(explore.located("seat", ["BUILDING", "MACHINERY"]))


# --- look-ups ----------------------------------------------------------------------------------------


@query("""WITH m AS (SELECT p_partkey, p_brand, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS span_start FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_partkey % 50 = 0))
SELECT p_partkey AS ordinal, p_brand AS document_id, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY coalesce(span_start, 0), p_partkey) AS INTEGER) AS place FROM m""")
def mentions_of_documents(spark, d):
    p = table(spark, d, "part")
    rows = p.select(F.col("p_partkey").alias("ordinal"), F.col("p_brand").alias("document_id"), F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("span_start"))
    asked = p.where("p_partkey % 50 = 0").select(F.col("p_brand").alias("document_id"))
    return lookup.document_mentions(rows, asked).select("ordinal", "document_id", "place")


@query(f"WITH {ASSERTIONS_SQL}, n AS (SELECT CAST(c_custkey AS VARCHAR) AS name FROM customer WHERE c_custkey % 50 = 0) SELECT assertion_id, name FROM assertions JOIN n ON subject_text = name OR object_text = name")
def assertions_about(spark, d):
    names = table(spark, d, "customer").where("c_custkey % 50 = 0").select(F.col("c_custkey").cast("string").alias("name"))
    return lookup.assertions_about(assertions(spark, d), names).select("assertion_id", "name")


@query(f"WITH {_ENTITIES_SQL}, n AS (SELECT DISTINCT upper(p_name) AS name FROM part WHERE p_partkey % 50 = 0) SELECT name, arg_min(canonical_id, ordinal) AS canonical_id FROM n JOIN entities ON lower(canonical_name) = lower(name) GROUP BY name")
def entities_by_name(spark, d):
    names = table(spark, d, "part").where("p_partkey % 50 = 0").select(F.upper("p_name").alias("name"))
    return lookup.entities_named(_entities(spark, d), names)


@query(f"""WITH {_ENTITIES_SQL}, n AS (SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN p_name ELSE lower(p_type) END AS name FROM part WHERE p_partkey % 50 = 0),
k AS (SELECT ordinal, canonical_id, unnest(list_append(aliases, canonical_name)) AS key FROM entities)
SELECT name, arg_min(canonical_id, ordinal) AS canonical_id FROM n JOIN k ON lower(key) = lower(name) GROUP BY name""")
def entities_by_alias(spark, d):
    p = table(spark, d, "part").where("p_partkey % 50 = 0")
    return lookup.entities_named(_entities(spark, d), p.select(F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.lower("p_type")).alias("name")), aliases=True)


@query("""WITH r AS (SELECT p_partkey, p_brand AS a, CASE WHEN p_size % 2 = 0 THEN 'Brand#' || p_size END AS b FROM part), n AS (SELECT DISTINCT p_brand AS asked FROM part WHERE p_partkey % 50 = 0)
SELECT p_partkey, asked FROM r JOIN n ON asked = a OR asked = b""")
def entities_of_documents(spark, d):
    p = table(spark, d, "part")
    rows = p.select("p_partkey", F.col("p_brand").alias("document_id"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Brand#"), F.col("p_size").cast("string"))).alias("source_doc_id"))
    return lookup.document_entities(rows, p.where("p_partkey % 50 = 0").select(F.col("p_brand").alias("document_id"))).select("p_partkey", "asked")


@query("""WITH n AS (SELECT DISTINCT upper(p_name) AS name FROM part WHERE p_partkey % 50 = 0), f AS (SELECT DISTINCT name, p_size AS size FROM part JOIN n ON lower(p_name) = lower(name))
SELECT s_suppkey, name FROM supplier JOIN f ON s_suppkey % 50 = size""")
def contexts_of_entities(spark, d):
    p = table(spark, d, "part")
    chunks = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 50).cast("int").alias("chunk_id"))
    found = p.select(F.col("p_size").alias("chunk_id"), F.col("p_name").alias("text"))
    return lookup.entity_context(chunks, found, p.where("p_partkey % 50 = 0").select(F.upper("p_name").alias("name"))).select("s_suppkey", "name")


@query(f"""WITH {_ENTITIES_SQL}, m AS (SELECT p_partkey AS mention_id, CASE WHEN p_size > 45 THEN 'E' || p_partkey ELSE '' END AS candidate_id, CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_type END AS text FROM part),
named AS (SELECT candidate_id, mention_id FROM m WHERE candidate_id IN (SELECT canonical_id FROM entities)),
k AS (SELECT DISTINCT canonical_id, lower(unnest(list_append(aliases, canonical_name))) AS key FROM entities WHERE canonical_id NOT IN (SELECT candidate_id FROM named))
SELECT * FROM named UNION ALL SELECT canonical_id, mention_id FROM k JOIN m ON lower(text) = key""")
def mentions_of_candidates(spark, d):
    p = table(spark, d, "part")
    own = F.when(F.col("p_size") > 45, F.concat(F.lit("E"), F.col("p_partkey").cast("string"))).otherwise("")
    rows = p.select(F.col("p_partkey").alias("mention_id"), own.alias("candidate_id"), F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_type")).alias("text"))
    return lookup.candidate_mentions(_entities(spark, d).withColumnRenamed("canonical_id", "candidate_id"), rows)


@query("""WITH f AS (SELECT DISTINCT 'media/' || p_brand || '/' || replace(p_name, ' ', '_') || '.MP4' AS path, replace(p_name, ' ', '_') AS stem FROM part),
t AS (SELECT p_partkey AS document_id, 'take ' || p_size || ' of ' || upper(replace(p_name, ' ', '_')) || '.txt' AS filename FROM part)
SELECT path, document_id FROM f JOIN t ON contains(lower(filename), lower(stem))""")
def transcripts_of_files(spark, d):
    p = table(spark, d, "part").withColumn("stem", F.replace("p_name", F.lit(" "), F.lit("_")))
    files = p.select(F.concat(F.lit("media/"), "p_brand", F.lit("/"), "stem", F.lit(".MP4")).alias("path")).distinct()
    said = p.select(F.col("p_partkey").alias("document_id"), F.concat(F.lit("take "), F.col("p_size").cast("string"), F.lit(" of "), F.upper("stem"), F.lit(".txt")).alias("filename"))
    return lookup.transcripts_of(files, said)


@query("SELECT 'x/' || l.doc_id || '.mp4' AS path, d.n_chars FROM labels l JOIN documents d USING (doc_id)")
def metadata_of_files(spark, d):
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".mp4"))
    files = table(spark, d, "labels").select(F.concat(F.lit("x/"), name).alias("path"))
    return lookup.metadata_of(files, table(spark, d, "documents").select(name.alias("filename"), "n_chars")).select("path", "n_chars")


@query("""WITH o AS (SELECT l_orderkey, l_partkey, l_suppkey, min(l_linenumber) AS o FROM lineitem GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY o, l_partkey, l_suppkey) AS p FROM o),
g AS (SELECT l_orderkey, string_agg(l_partkey || ':' || l_suppkey, ',' ORDER BY o, l_partkey, l_suppkey) AS mentions FROM r WHERE p <= 3 GROUP BY 1)
SELECT o_orderkey, mentions FROM orders LEFT JOIN g ON l_orderkey = o_orderkey""")
def chunks_with_mentions(spark, d):
    said = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("chunk_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ordinal"), F.col("l_partkey").cast("string").alias("text"), F.col("l_suppkey").cast("string").alias("mention_type")
    )
    chunks = table(spark, d, "orders").select(F.col("o_orderkey").alias("chunk_id"))
    listed = F.array_join(F.transform("mentions", lambda m: F.concat_ws(":", m["text"], m["mention_type"])), ",")
    return explore.with_mentions(chunks, said, 3).select(F.col("chunk_id").alias("o_orderkey"), listed.alias("mentions"))


@query(f"""WITH {CANDIDATES_SQL}, x AS (SELECT min(source_entity_id) AS id FROM edges)
SELECT target_entity_id AS other_id, coalesce(canonical_name, target_entity_id) AS other_name FROM edges JOIN x ON source_entity_id = id LEFT JOIN named ON candidate_id = target_entity_id AND mention_count > 1""")
def alignments_of_entity(spark, d):
    rows = candidates(spark, d)
    edges = resolution.align(rows, ["low", "high"])
    first = edges.agg(F.min("source_entity_id").alias("id")).first()["id"]
    return explore.alignments_of(edges, first, rows.where("mention_count > 1").select(F.col("candidate_id").alias("canonical_id"), "canonical_name")).select("other_id", "other_name")


@query("""WITH l AS (SELECT p_type AS label, arg_max(p_brand, p_partkey) AS brand FROM part WHERE p_type <> 'SMALL' GROUP BY 1) SELECT p_partkey, coalesce(brand, 'UNKNOWN') AS label FROM part LEFT JOIN l ON p_type = l.label""")
def labels_of_parts(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("text"), "p_brand")
    last = p.where("text <> 'SMALL'").select("text", F.col("p_brand").alias("label"), F.col("p_partkey").alias("ordinal"))
    return explore.joined_label(p.select("p_partkey", "text"), last).select("p_partkey", "label")


# --- counts ----------------------------------------------------------------------------------------------


@query(f"WITH {CANDIDATES_SQL} SELECT count(*) FILTER (score >= 0.9) AS same_as, count(*) FILTER (score < 0.9) AS possible_same_as FROM edges")
def alignment_counts(spark, d):
    return explore.alignment_counts(resolution.align(candidates(spark, d), ["low", "high"]))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def chunks_by_type(spark, d):
    return explore.counts_by(table(spark, d, "documents"), "lang", "source")


@query("""WITH s AS (SELECT count(DISTINCT lower(p_type || ' ' || p_brand || ' ' || p_name || ' ' || CAST(p_size AS VARCHAR))) AS n_surfaces FROM part), c AS (SELECT count(DISTINCT p_name) AS n_candidates FROM part)
SELECT n_surfaces, n_candidates, round(n_candidates / CAST(n_surfaces AS DOUBLE), 3) AS ratio FROM s, c""")
def reduction_ratio(spark, d):
    return explore.reduction_ratio(mentions(spark, d), _entities(spark, d))


@query(f"WITH {ASSERTIONS_SQL} SELECT round(avg(confidence), 9) AS avg_confidence FROM assertions")
def average_confidence(spark, d):
    return explore.average_confidence(assertions(spark, d)).select(F.round("avg_confidence", 9).alias("avg_confidence"))


@query(f"""WITH {ASSERTIONS_SQL}, g AS (SELECT node, count(*) AS degree FROM (SELECT subject_text AS node FROM assertions UNION ALL SELECT object_text FROM assertions) GROUP BY node),
l AS (SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS label FROM customer), n AS (SELECT coalesce(label, 'UNKNOWN') AS label, node, degree FROM g LEFT JOIN l ON key = node)
SELECT label, node, degree, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY degree DESC, node) AS place FROM n) WHERE place <= 20""")
def label_degrees(spark, d):
    labels = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("label"), F.col("c_custkey").alias("ordinal"))
    return explore.label_degrees(explore.node_degree(assertions(spark, d)), labels)


@query(f"WITH {_ENTITIES_SQL} SELECT count(*) AS n, sum(mention_count) / CAST(count(*) AS DOUBLE) AS mentions_each, sum(len(aliases)) / CAST(count(*) AS DOUBLE) AS aliases_each FROM entities")
def entity_averages(spark, d):
    return explore.entity_averages(_entities(spark, d))


@query("SELECT DISTINCT CASE WHEN lang = 'fr' THEN 'unknown' ELSE lang END AS language FROM documents WHERE lang <> 'fr'")
def known_languages(spark, d):
    rows = table(spark, d, "documents").select(F.when(F.col("lang") == "fr", "unknown").otherwise(F.col("lang")).alias("language"))
    return explore.known_languages(rows)


# --- orders and pages --------------------------------------------------------------------------------------


@query(f"WITH {_ENTITIES_SQL} SELECT canonical_id, mention_count FROM entities ORDER BY mention_count DESC, ordinal LIMIT 12")
def entities_by_count(spark, d):
    return explore.ordered(_entities(spark, d), "count").limit(12).select("canonical_id", "mention_count")


@query(f"WITH {_ENTITIES_SQL} SELECT canonical_id, CAST(len(aliases) AS INTEGER) AS n FROM entities ORDER BY len(aliases) DESC, ordinal LIMIT 12")
def entities_by_aliases(spark, d):
    return explore.ordered(_entities(spark, d), "aliases").limit(12).select("canonical_id", F.size("aliases").alias("n"))


@query(f"WITH {_ENTITIES_SQL} SELECT canonical_id, canonical_name FROM entities ORDER BY lower(canonical_name), ordinal LIMIT 12")
def entities_alphabetical(spark, d):
    return explore.ordered(_entities(spark, d), "name").limit(12).select("canonical_id", "canonical_name")


@query(f"WITH {_ENTITIES_SQL} SELECT canonical_id, canonical_name FROM entities ORDER BY length(canonical_name) DESC, ordinal LIMIT 12")
def entities_longest_first(spark, d):
    return explore.ordered(_entities(spark, d), "length").limit(12).select("canonical_id", "canonical_name")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200")
def order_page(spark, d):
    return explore.page(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 2)


# --- unions, graph and groups ----------------------------------------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS kind, 'customers' AS "_source" FROM customer UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), NULL, CASE WHEN s_acctbal > 5000 THEN 'rich' ELSE 'suppliers' END FROM supplier""")
def union_with_lineage(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("kind"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.when(F.col("s_acctbal") > 5000, "rich").alias("_source"))
    return explore.with_lineage(customers=customers, suppliers=suppliers)


@query(f"WITH {_ENTITIES_SQL} SELECT canonical_id AS id, canonical_name, entity_type, mention_count FROM entities")
def graph_vertices(spark, d):
    twice = _entities(spark, d)
    return incremental.vertices(twice.unionByName(twice))


@query(f"""WITH RECURSIVE {CANDIDATES_SQL}, same AS (SELECT source_entity_id AS a, target_entity_id AS b FROM edges WHERE score >= 0.9), both_ways AS (SELECT a, b FROM same UNION SELECT b, a FROM same),
reach AS (SELECT candidate_id AS node, candidate_id AS component FROM named UNION SELECT w.b, r.component FROM reach r JOIN both_ways w ON w.a = r.node), comp AS (SELECT node, min(component) AS component FROM reach GROUP BY node),
ids AS (SELECT component, substr(sha256(array_to_string(list_sort(list(node)), '|')), 1, 16) AS id FROM comp GROUP BY 1), owner AS (SELECT node, id FROM comp JOIN ids USING (component))
SELECT s.id AS src, t.id AS dst, CASE WHEN score >= 0.9 THEN 'SAMEAS' ELSE 'POSSIBLESAMEAS' END AS relation, CAST(max(score) AS DOUBLE) AS score
FROM edges JOIN owner s ON s.node = source_entity_id JOIN owner t ON t.node = target_entity_id WHERE s.id <> t.id GROUP BY 1, 2, 3""")
def alignment_relations(spark, d):
    rows = candidates(spark, d)
    edges = resolution.align(rows, ["low", "high"])
    return incremental.alignment_relations(edges, resolution.canonical_entities(rows, edges))


@query("""SELECT o_orderkey AS assertion_id, 'c' || o_custkey AS src, o_orderstatus AS dst, o_orderpriority AS predicate FROM orders WHERE o_custkey % 7 <> 0 AND o_orderstatus <> 'P'""")
def assertion_relations(spark, d):
    o = table(spark, d, "orders")
    subject = F.when(F.col("o_custkey") % 7 != 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    linked = o.select(F.col("o_orderkey").alias("assertion_id"), subject.alias("subject_canonical_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("object_canonical_id"), F.col("o_orderpriority").alias("predicate"))
    return incremental.assertion_relations(linked.unionByName(linked))


_GROUPS_SQL = """
m AS (SELECT p_partkey AS ordinal, CASE WHEN p_size % 4 = 0 THEN ' ' || upper(p_name) ELSE p_name || ' ' || CASE WHEN p_size % 3 = 0 THEN lower(p_type) ELSE p_brand END END AS raw, p_type AS label FROM part),
t AS (SELECT ordinal, trim(raw) AS text, label FROM m), names AS (SELECT DISTINCT label, lower(text) AS key FROM t), worded AS (SELECT label, key, list_distinct(string_split(key, ' ')) AS words FROM names),
pairs AS (SELECT a.key AS a, b.key AS b, len(list_intersect(a.words, b.words)) AS shared, len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)) AS either FROM worded a JOIN worded b ON a.label = b.label AND a.key < b.key),
edges AS (SELECT DISTINCT a, b FROM pairs WHERE shared >= 2 AND (shared / CAST(either AS DOUBLE) > 0.6 OR contains(a, b) OR contains(b, a))), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT DISTINCT key AS node, key AS component FROM names UNION SELECT w.b, r.component FROM reach r JOIN both_ways w ON w.a = r.node), comp AS (SELECT node, min(component) AS component FROM reach GROUP BY node),
e AS (SELECT text, count(*) AS n, min(ordinal) AS first, arg_max(label, ordinal) AS label FROM t GROUP BY text), r AS (SELECT e.*, component FROM e JOIN comp ON node = lower(text))"""


@query(f"""WITH RECURSIVE {_GROUPS_SQL}, b AS (SELECT component, arg_min(text, ROW(-n, first)) AS canonical, arg_min(label, ROW(-n, first)) AS label, CAST(sum(n) AS BIGINT) AS count FROM r GROUP BY component)
SELECT canonical, b.label, (SELECT string_agg(text, ',' ORDER BY first) FROM r WHERE r.component = b.component AND text <> canonical) AS aliases, count FROM b""")
def name_groups(spark, d):
    p = table(spark, d, "part")
    tail = F.when(F.col("p_size") % 3 == 0, F.lower("p_type")).otherwise(F.col("p_brand"))
    text = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit(" "), F.upper("p_name"))).otherwise(F.concat_ws(" ", "p_name", tail))
    groups = resolution.name_groups(p.select(F.col("p_partkey").alias("ordinal"), text.alias("text"), F.col("p_type").alias("mention_type")))
    return groups.withColumn("aliases", F.when(F.size("aliases") > 0, F.array_join("aliases", ",")))


@query("""WITH e AS (SELECT vec_id, label, embedding[1:3]::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON a.label = b.label AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1 WHERE list_cosine_similarity(a.v, b.v) > 0.8)
SELECT 'v' || a AS source_entity_id, 'v' || b AS target_entity_id, 0.75 ::DOUBLE AS score, 'embedding' AS evidence, 'possibleSameAs' AS alignment_type FROM p""")
def alignment_by_vectors(spark, d):
    e = table(spark, d, "embeddings")
    name = F.concat(F.lit("v"), F.col("vec_id").cast("string"))
    rows = e.select(
        F.col("vec_id").alias("ordinal"), name.alias("candidate_id"), F.concat(name, F.lit("!"), name).alias("canonical_name"), F.col("label").cast("string").alias("candidate_type"), F.array().cast("array<string>").alias("aliases"),
        F.when(F.col("vec_id") % 2 == 0, "even").otherwise("odd").alias("code_location"), F.slice("embedding", 1, 3).alias("embedding"),
    )
    edges = resolution.align(rows, ["even", "odd"]).where(F.array_contains("evidence", "embedding"))
    return edges.select("source_entity_id", "target_entity_id", "score", F.array_join("evidence", ",").alias("evidence"), "alignment_type")


@query("""SELECT doc_id, length(text) AS n, length(text) - length(replace(text, 'e', '')) AS n_e, 'counts' AS model, CAST(2 AS INTEGER) AS dimensions FROM documents""")
def embedded_documents(spark, d):
    found = vectors.embedded(table(spark, d, "documents").select("doc_id", "text"), lambda texts: [(len(t), t.count("e")) for t in texts], 2, model="counts")
    return found.select("doc_id", F.col("embedding")[0].cast("long").alias("n"), F.col("embedding")[1].cast("long").alias("n_e"), "model", "dimensions")


@query("""WITH t AS (SELECT conv_id * 1000 + turn AS id, conv_id, turn, text FROM conversations), q AS (SELECT conv_id AS pattern_id, min(substr(text, 4, 9)) AS pattern FROM t WHERE conv_id % 50 = 0 AND turn = 0 GROUP BY 1)
SELECT DISTINCT pattern_id, id FROM q JOIN t ON contains(lower(text), lower(pattern)) WHERE pattern <> ''""")
def trigram_matches(spark, d):
    """Turns that hold what a first turn of every conversation whose id 50 divides says, by an index of two batches."""
    t = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "conv_id", "turn", "text")
    asked = t.where("conv_id % 50 = 0 and turn = 0").groupBy(F.col("conv_id").alias("pattern_id")).agg(F.min(F.substring("text", 4, 9)).alias("pattern"))
    with scratch(spark, "trigrams") as root:
        index = trigram_index.TrigramIndex(spark, root)
        index.add(t.where("turn < 2"), "first")
        index.add(t.where("turn >= 2"), "rest")
        return cut(index.search(asked))
