"""Operator 4, exact dedup by deterministic block naming.

A text without its ASCII white space is cut into blocks of ``block`` code points. The
distinct blocks are sorted over the whole cluster (dealt by ranges, sorted within them; by their first code points, then by a
128-bit key), and a block's place in that order is its integer name, so that names do not depend on how the cluster deals rows out; then the
distinct pairs of neighbouring names are sorted and named alike, level after level,
until each document has one name. Names stand for contents, not for hashes, so
two documents share (level, name) only if their normalised texts are equal.

Only distinct blocks cross the cluster with their content, combined before the
shuffle, so a text that a third of all rows repeat is sent once a task. Rows find
their block's name by a 128-bit key; the naming pass holds every distinct block
with its key and proves that no key stands for two contents. If one did, the keys
are drawn anew with another seed.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.session import cut, parts_for

#: Code points in a block, and how many of them it is sorted by before its key decides.
BLOCK, HEAD = 512, 32


def normalised(text):
    """``text`` (null: empty) without the characters ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _blocks(norm, block: int):
    cut_up = F.regexp_extract_all(norm, F.lit("(?s).{1,%d}" % block), F.lit(0))
    return F.when(F.length(norm) <= block, F.array(norm)).otherwise(cut_up)


def _keys(part, seed: int):
    return F.xxhash64(F.lit(2 * seed), part), F.xxhash64(F.lit(2 * seed + 1), part)


def _named(distinct: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """``keep`` of distinct rows, and as ``name`` the place of each, from 0, in the order of ``by``."""
    placed = cut(distinct.repartitionByRange(*by).sortWithinPartitions(*by).select(*keep, F.monotonically_increasing_id().alias("id")))
    # an id holds the partition above bit 33 and the place in it below; partitions are in the order of their ranges
    part, within = F.shiftright("id", 33).cast("int"), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    # a row for each partition
    return placed.withColumn("part", part).join(F.broadcast(first), "part").select(*keep, (F.col("first") + within).alias("name"))


def block_names(docs: DataFrame, text_col: str = "text", block: int = BLOCK) -> tuple[DataFrame, int]:
    """(k1, k2, name) of every distinct block, and the seed whose keys have no collision."""
    parts = docs.select(F.explode(_blocks(normalised(F.col(text_col)), block)).alias("part"))
    for seed in count():
        k1, k2 = _keys(F.col("part"), seed)
        distinct = parts.select(k1.alias("k1"), k2.alias("k2"), "part").distinct()
        # the order of first code points, then of keys: total, and light to deal out
        names = _named(distinct.select("k1", "k2", F.substring("part", 1, HEAD).alias("head")), ["head", "k1", "k2"], ["k1", "k2"])
        if names.groupBy("k1", "k2").count().where("count > 1").isEmpty():
            return names, seed


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Every row with ``level`` and ``name``, equal for two rows exactly if their normalised texts are equal.

    Columns: row_id (unique), doc_id, n_chars, text_sha256, level, name.
    """
    names, seed = block_names(docs, text_col, block)
    norm = normalised(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
        norm.alias("norm"),
    ).select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "n_chars",
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.transform(_blocks(F.col("norm"), block), lambda p: F.struct(*[k.alias(n) for k, n in zip(_keys(p, seed), ("k1", "k2"))])).alias("keys"),
    )
    rows = cut(rows)
    each = rows.select("row_id", F.size("keys").alias("nodes"), F.posexplode("keys").alias("pos", "key"))
    now = each.select("row_id", "nodes", "pos", "key.k1", "key.k2").join(names, ["k1", "k2"]).select("row_id", "nodes", "pos", "name")
    now = cut(now)
    done, level = now.where("nodes = 1").select("row_id", F.lit(0).alias("level"), "name"), 0
    now = now.where("nodes > 1")
    longest, rows_left = now.agg(F.coalesce(F.max("nodes"), F.lit(1)), F.count(F.lit(1))).first()
    while longest > 1:
        level += 1
        longest = (longest + 1) // 2
        pairs = now.groupBy("row_id", "nodes", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        rows_left = (rows_left + 1) // 2
        pairs = cut(pairs.coalesce(parts_for(rows_left)))
        named = _named(pairs.select("left", "right").distinct(), ["left", "right"], ["left", "right"])
        now = pairs.join(named, ["left", "right"]).select("row_id", F.expr("cast((nodes + 1) div 2 as int)").alias("nodes"), "pos", "name")
        now = cut(now.coalesce(parts_for(rows_left)))
        done = done.unionByName(now.where("nodes = 1").select("row_id", F.lit(level).alias("level"), "name"))
        now = now.where("nodes > 1")
    return rows.drop("keys").join(done, "row_id")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space. Of equal texts the row
    with the most code points stays, then the smallest doc_id (a null id last), then
    the first read. A null text counts as empty, and all empty or blank texts
    form one group. Repeated rows, also with one id, are rows of their own, of which
    one stays. Columns besides the two named are not read, whatever their names. An
    empty table gives no rows. Texts of any length are cut whole, into as many blocks as they have. A group of any size is counted by combining before
    the shuffle, and no group is held in one place.
    """
    named = cut(document_names(docs, id_col, text_col, block))
    best = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("id"), F.col("row_id").alias("row")))
    # written first: a join beside an aggregate on the same key could not be split where a group is hot
    groups = cut(named.groupBy("level", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")))
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row_id") == F.col("best.row")).alias("kept"), "text_sha256"
    )
