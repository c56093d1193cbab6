"""Operator 3, URL filters: rules on hosts and paths, then a list of canonical URLs.

The list is put into a blocked Bloom filter: a URL's first hash names a block of eight 32-bit
words, its second sets one bit of each word. The filter is built by one aggregate and is itself a
table of blocks. Where it is small it is broadcast, after its size has been checked; a
larger one is joined by block. What passes is a possible hit and goes on to an exact
hash join with the list, which removes the filter's false positives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.session import cut

#: Bits of filter for each listed URL; a block holds 256.
BITS_PER_URL = 16
#: The filter's size up to which it is broadcast; a block takes about 48 bytes as a row.
BROADCAST_BYTES, BLOCK_BYTES = 64 << 20, 48
#: Rules that are turned into one expression.
MAX_RULES = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or without ``://``: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url):
    """What follows the host up to ``?``, ``#`` or the end; null or without ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical_of(url):
    """Host without ``www.`` or ``m.``, path without its last slash, other parameters than tracking ones in order; no scheme or fragment."""
    params = F.split(F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit("")), "&")
    kept = F.array_sort(F.filter(params, lambda p: (p != "") & ~p.rlike(r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)")))
    query = F.array_join(kept, "&")
    bare = F.concat(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), F.regexp_replace(path_of(url), "/$", ""))
    return F.when(query == "", bare).otherwise(F.concat(bare, F.lit("?"), query))


def rule_of(host, path, rules: list[tuple[str, str, str]]):
    """(rule, verdict) of the longest of ``rules`` (host, path, verdict) that fits; null if none does.

    A rule fits its host and every subdomain, if the path starts with the rule's.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _block(url, blocks: int):
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url) -> list:
    bits = F.xxhash64(F.lit("bits"), url)
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * k).bitwiseAND(F.lit(31)).cast("int")) for k in range(8)]


def bloom_filter(listed: DataFrame, url_col: str = "url") -> tuple[DataFrame, int]:
    """(block, w0 to w7) of the distinct URLs listed, and the number of blocks."""
    blocks = max(1, -(-listed.count() * BITS_PER_URL // 256))
    words = [F.bit_or(m).alias(f"w{k}") for k, m in enumerate(_masks(F.col(url_col)))]
    return listed.groupBy(_block(F.col(url_col), blocks).alias("block")).agg(*words), blocks


def possible_hits(rows: DataFrame, filter_: DataFrame, blocks: int, url_col: str) -> DataFrame:
    """``rows`` with ``_possible``: false only if the URL is certainly not listed."""
    if blocks * BLOCK_BYTES <= BROADCAST_BYTES:
        filter_ = F.broadcast(filter_)
    inside = reduce(lambda a, b: a & b, (F.col(f"w{k}").bitwiseAND(m) != 0 for k, m in enumerate(_masks(F.col(url_col)))))
    joined = rows.withColumn("block", _block(F.col(url_col), blocks)).join(filter_, "block", "left")
    return joined.withColumn("_possible", F.coalesce(inside, F.lit(False))).drop("block", *(f"w{k}" for k in range(8)))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, canonical, rule, verdict (allow or block).

    ``listed`` has one column ``url`` of canonical URLs to block; its nulls and repeats do not matter, and an
    empty list blocks nothing. A rule's verdict goes before the list's. A null URL, or one without
    ``://``, has an empty host, path and canonical URL, which is never listed. Pages may repeat, also
    a third of them with one URL: only possible hits are shuffled, by a join that can be split. URLs of any length are judged whole, of rules that fit
    the longest counts (one host and path has one rule), other columns are not read, whatever their names, and an empty table gives no rows.
    """
    listed = cut(listed.select(F.col("url").alias("canonical")).where("canonical <> ''").distinct())
    filter_, blocks = bloom_filter(listed, "canonical")
    url = F.col("url")
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = given.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical_of(url).alias("canonical"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = possible_hits(rows, filter_, blocks, "canonical")
    exact = rows.where("_possible and _rule is null").join(listed.withColumn("_listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
    clear = rows.where("not _possible or _rule is not null").withColumn("_listed", F.lit(None).cast("boolean"))
    method = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return exact.unionByName(clear).select("page_id", "host", "path", "canonical", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", method).alias("verdict"))
