"""Registered queries of the operators and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeel.llm import byte_bpe, decontaminate, language_id, private_data, spelling, toxicity
from lorekeel.llm.exact_dedup import exact_dedup
from lorekeel.llm.near_dedup import near_dedup
from lorekeel.llm.packing import pack, token_pieces
from lorekeel.llm.prefix_trie import prefix_trie
from lorekeel.llm.quality import quality_rules
from lorekeel.llm.token_rollup import Rollup, count_tokens
from lorekeel.llm.url_filter import canonical_of, filter_urls, host_of
from lorekeel.session import cut, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *ranks)
    listed = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    coded = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), "ids")
    back = byte_bpe.decode(coded, *ranks)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


#: Rules of the URL query: host, path, verdict.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
#: Words that, as a part of a host between dots and hyphens, put its pages on the list.
URL_WORDS = ("casino", "bets", "pills", "adult")

#: A title that puts its page's URL on the list.
URL_JUNK = "<title>[^<]*###"


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the canonical URLs of pages on hosts with a listed word and of pages with a junk title, so that pages with another spelling of such a URL are found by it alone."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    bad = host_of(F.col("url")).rlike(rf"(^|[.-])({'|'.join(URL_WORDS)})([.-]|$)") | F.col("html").rlike(URL_JUNK)
    listed = pages.where(bad).select(canonical_of(F.col("url")).alias("url"))
    return filter_urls(pages.drop("html"), URL_RULES, listed).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = rf"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
         coalesce(regexp_extract(url, '^.*?://[^?#]*\?([^#]*)', 1, 's'), '') AS query,
         coalesce(regexp_matches(html, '{URL_JUNK}'), false) AS junk
  FROM pages
), q AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&') AS kept
  FROM p
), c AS (
  SELECT page_id, host, path,
         regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/$', '') || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS canonical,
         regexp_matches(host, '(^|[.-])({'|'.join(URL_WORDS)})([.-]|$)') OR junk AS bad
  FROM q
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
  FROM c
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/7', 'net/de/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canonical IN (SELECT canonical FROM c WHERE bad AND canonical <> '') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS l, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS z
  FROM documents
), g AS (
  SELECT doc_id, z, count(*) OVER (PARTITION BY z) AS group_size,
         first_value(doc_id) OVER (PARTITION BY z ORDER BY l DESC, doc_id) AS keep_id
  FROM n
)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(z) AS text_sha256 FROM g
"""

def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), width=4, percent=80)


def _joined(spans: str):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private_data.find_private(docs, private_data.learn(docs))
    kinds = F.col("base_spans.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base_spans"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    found = language_id.identify(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.toxicity(docs, lexicon)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
  FROM d
), n AS (
  SELECT d.doc_id, count(g) AS n FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS node, doc_id AS origin FROM n UNION SELECT e.b, r.origin FROM r JOIN e ON e.a = r.node
), c AS (
  SELECT node, min(origin) AS component_id FROM r GROUP BY node
)
SELECT doc_id, n AS n_shingles, component_id, component_id = doc_id AS kept FROM n JOIN c ON node = doc_id
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens")
    return pack(digests)


#: Tokenizer version of the counts below; its vocabulary is a parameter of the operator.
VERSION = "word_bpe_49k@1"


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted, then recounted with their end token, then those labelled toxic or of low quality are deleted; the recount is replayed."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counts = cut(count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), VERSION))
    rollup = Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    recount = counts.withColumn("n_tokens", F.col("n_tokens") + 1).withColumn("op", F.lit("revise"))
    rollup.commit(1, counts.withColumn("op", F.lit("insert")))
    rollup.commit(2, recount)
    gone = labels.where("toxic = 1 or quality = 0").select("doc_id").distinct()
    rollup.commit(3, counts.join(gone, "doc_id", "left_semi").withColumn("op", F.lit("delete")))
    rollup.commit(2, recount)
    return rollup.take()


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), shared=True)


#: A list of 256 numbers, by which a byte changes a crc32; ``{bytes}`` is a list of bytes.
CRC_TABLE_SQL = "SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tbl"
CRC_SQL = "xor(list_reduce({bytes}, lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"

OP11_SQL = f"""
WITH crc AS ({CRC_TABLE_SQL}
), t AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, chars, digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM t
), c AS (
  SELECT conv_id, {CRC_SQL.format(bytes="list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o), crc
), r AS (
  SELECT c.conv_id, 0 AS part, pos, chars, digest FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, chars, digest FROM c JOIN o ON o.conv_id = c.conv_id AND pos > h
), p AS (
  SELECT conv_id, chars, row_number() OVER w AS depth, sha256(array_to_string(list(digest) OVER w, ',')) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), q AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p
), n AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         CASE WHEN bool_and(last) THEN 1 ELSE 0 END AS leaf, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM q GROUP BY node
), s AS (
  SELECT p.node, sum(n.leaf) AS n_leaves, sum(n.saved) AS saved_tokens FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node
), k AS (
  SELECT parent AS node, count(*) AS n_children FROM n GROUP BY parent
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n AS up ON up.node = n.parent
"""


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.word_counts(table(spark, sf_dir, "documents"), slip_every=31))


OP12_SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents
), o AS (
  SELECT w, count(*) AS n, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda x: CAST(ord(x) AS BIGINT)) AS points FROM runs WHERE length(w) >= 7 GROUP BY doc_id, w
), h AS (
  SELECT w, n, {CRC_SQL.format(bytes="flatten(list_transform(points, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 | (c >> 6), 128 | (c & 63)] END))")} AS h FROM o, crc
), s AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), v AS (
  SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT x.word AS a, y.word AS b FROM v x JOIN v y ON x.v = y.v AND x.k = y.k AND x.word <> y.word
  UNION SELECT v.word, w.word FROM v JOIN words w ON v.v = w.word UNION SELECT w.word, v.word FROM v JOIN words w ON v.v = w.word
), best AS (
  SELECT a, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS b, max(w.n) AS m FROM near JOIN words w ON w.word = b GROUP BY a
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN b END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n FROM words LEFT JOIN best ON a = word
), roots AS (
  SELECT word, word AS root, form AS further FROM judged UNION ALL SELECT r.word, j.word, j.form FROM roots r JOIN judged j ON j.word = r.further
)
SELECT j.word, j.form, r.root, j.n, j.n_near, j.form_n FROM judged j JOIN roots r ON r.word = j.word AND r.further IS NULL
"""


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.with_benchmark_hits(docs, table(spark, sf_dir, "benchmark")).drop("text")
    found = F.col("found")
    items = found["items"]
    out = marked.select("doc_id", found["n_words"].alias("n_words"), decontaminate.n_hit(found).alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS l, array_to_string(w[i:i + 9], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT row, i, l, array_to_string(w[i:i + l - 1], ' ') AS g FROM (SELECT row, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw))
), o AS (
  SELECT row, i, dw.l, item FROM dw JOIN bw ON bw.g = dw.g AND bw.l = dw.l
), h AS (
  SELECT row, count(*) AS n_hit FROM (SELECT DISTINCT row, unnest(range(i, i + l)) AS k FROM o) GROUP BY row
), s AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM o GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (row) LEFT JOIN s USING (row)
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_private_data": op5_private_data,
    "op6_near_dedup": op6_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_decontamination": op13_decontamination,
}
ORACLES = {"op3_url_filter": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op6_near_dedup": OP6_SQL, "op11_prefix_trie": OP11_SQL, "op12_spelling_groups": OP12_SQL, "op13_decontamination": OP13_SQL}
