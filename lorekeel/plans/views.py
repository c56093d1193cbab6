"""The given tables seen as documents, assertions, mentions and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title (the source), content, document_type (the language), domain."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("content"), F.col("lang").alias("document_type"), F.lit("web").alias("domain"))


def assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as assertions: a customer (subject) has a part (object) at a priority (predicate)."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    text = lambda c: F.col(c).cast("string")
    qualifiers = F.create_map(
        F.lit("time"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("location"), F.when(F.col("l_quantity") > 25, F.col("l_linestatus")).otherwise(""),
        F.lit("condition"), F.when(F.col("l_tax") > 0.04, text("l_tax")),
    )
    return rows.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("assertion_id"), text("o_custkey").alias("subject_text"), F.col("o_orderpriority").alias("predicate"), text("l_partkey").alias("object_text"),
        (F.col("l_returnflag") == "R").alias("negated"), (F.col("l_linestatus") == "O").alias("hedged"), (1 - F.col("l_discount")).alias("confidence"), qualifiers.alias("qualifiers"),
    )


ASSERTIONS_SQL = """
assertions AS (
  SELECT l_orderkey * 100 + l_linenumber AS assertion_id, CAST(o_custkey AS VARCHAR) AS subject_text, o_orderpriority AS predicate, CAST(l_partkey AS VARCHAR) AS object_text,
         l_returnflag = 'R' AS negated, l_linestatus = 'O' AS hedged, 1 - l_discount AS confidence,
         l_shipdate, l_quantity, l_linestatus, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as mentions: a five-word text, one type for each size class."""
    p = table(spark, sf_dir, "part")
    text = F.concat_ws(" ", "p_type", "p_brand", "p_name", F.col("p_size").cast("string"))
    return p.select(
        F.col("p_partkey").alias("ordinal"), F.col("p_partkey").cast("string").alias("mention_id"), F.col("p_brand").alias("document_id"), F.col("p_brand").alias("chunk_id"),
        text.alias("text"), F.lit("ORG").alias("mention_type"),
    )


SURFACES_SQL = """
surfaces AS (
  SELECT DISTINCT lower(p_type || ' ' || p_brand || ' ' || p_name || ' ' || CAST(p_size AS VARCHAR)) AS key FROM part
), worded AS (
  SELECT key, list_distinct(string_split(key, ' ')) AS words FROM surfaces
), pairs AS (
  SELECT a.key AS a, b.key AS b, len(list_intersect(a.words, b.words)) AS shared, len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)) AS either
  FROM worded a JOIN worded b ON a.key < b.key
)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity candidates of two locations: part names of the lower and of the upper brands, with the first part as ordinal."""
    p = table(spark, sf_dir, "part")
    location = F.when(F.col("p_brand") < "Brand#3", "low").otherwise("high")
    named = p.groupBy(location.alias("code_location"), F.when(F.col("p_size") > 25, F.concat_ws(" ", "p_name", "p_type")).otherwise(F.col("p_name")).alias("canonical_name"))
    rows = named.agg(F.min("p_partkey").alias("ordinal"), F.count(F.lit(1)).alias("mention_count"))
    return rows.select(
        "ordinal", F.concat_ws(":", "code_location", "canonical_name").alias("candidate_id"), "canonical_name", F.lit("ORG").alias("candidate_type"),
        F.array().cast("array<string>").alias("aliases"), "mention_count", "code_location", F.lit(None).cast("array<float>").alias("embedding"),
    )


CANDIDATES_SQL = """
candidates AS (
  SELECT CASE WHEN p_brand < 'Brand#3' THEN 'low' ELSE 'high' END AS code_location, CASE WHEN p_size > 25 THEN p_name || ' ' || p_type ELSE p_name END AS canonical_name,
         min(p_partkey) AS ordinal, count(*) AS mention_count
  FROM part GROUP BY 1, 2
), named AS (
  SELECT *, code_location || ':' || canonical_name AS candidate_id, lower(canonical_name) AS name, list_distinct(string_split(lower(canonical_name), ' ')) AS words FROM candidates
), signals AS (
  SELECT a.candidate_id AS a, b.candidate_id AS b, a.name = b.name AS exact, a.name <> b.name AND (contains(a.name, b.name) OR contains(b.name, a.name)) AS inside,
         len(list_intersect(a.words, b.words)) / CAST(len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)) AS DOUBLE) > 0.5 AS alike
  FROM named a JOIN named b ON a.code_location = 'low' AND b.code_location = 'high'
), edges AS (
  SELECT a AS source_entity_id, b AS target_entity_id,
         round(least(1.0, CASE WHEN exact THEN 0.95 WHEN inside THEN 0.80 ELSE 0.70 END + CASE WHEN (exact OR inside) AND alike THEN 0.05 ELSE 0 END), 3) AS score,
         CASE WHEN exact THEN CASE WHEN alike THEN 'exact_name,jaccard' ELSE 'exact_name' END
              WHEN inside THEN CASE WHEN alike THEN 'substring,jaccard' ELSE 'substring' END ELSE 'jaccard' END AS evidence
  FROM signals WHERE exact OR inside OR alike
)"""
