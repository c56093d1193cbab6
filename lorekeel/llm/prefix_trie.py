"""Operator 11, a prefix trie of conversations, rolled up by bands of depth.

One pass deals the turns out by hundreds of conversations, in order, and chains digests: a node is the digest of its whole
sequence, so its members meet by that key and combine before the shuffle. The pass also gives every node the nodes above it inside its band of
``height`` levels; and a node whose depth is a multiple of the height those above it among such nodes, again in bands, and so on.

Totals of subtrees then take one aggregate a level of bands: nodes explode only to those above them inside their band, which completes the
band's roots as far as the band goes; the roots make up a trie of their own, ``height`` times less deep, whose totals are found alike; and completed totals of
the roots go back to the band above each. A depth of d takes about log(d) / log(height) rounds, and no row explodes to more than ``height`` rows a round.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.llm.batches import map_batches
from lorekeel.session import cut, parts_for

#: Levels of a band; conversations that share a head of turns, and turns of a head at most.
HEIGHT, SHARING, HEAD = 8, 100, 5
#: A chunk of a node's list holds ids of one run of 2 ** CHUNK_BITS integers.
CHUNK_BITS = 12
#: The root's digest.
ROOT = hashlib.sha256(b"root").digest()[:16]

_ROWS = "conv_id long, depth long, node binary, parent binary, chars long, ends int, above array<array<binary>>"
_ROWS_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("chars", pa.int64()), ("ends", pa.int32()), ("above", pa.list_(pa.list_(pa.binary())))])


def _chain(rows: Iterator[tuple[bytes, int]], height: int) -> Iterator[tuple[int, bytes, bytes | None, int, list[list[bytes]]]]:
    """Of one sequence of turns: depth, node, parent, code points, and the nodes above it, of each level of bands that it is a node of.

    Only the last ``height`` nodes of each level are kept, so a sequence of any length takes little memory.
    """
    node, bands, depth = ROOT, [[ROOT]], 0
    yield 0, ROOT, None, 0, []
    for digest, chars in rows:
        depth += 1
        parent, node = node, hashlib.sha256(node + digest).digest()[:16]
        above, at, level = [], depth, 0
        while True:
            if level == len(bands):
                bands.append([ROOT])
            above.append(list(bands[level]))
            # the first of a band forgets the band above, after having named it
            if at % height == 0:
                bands[level] = []
            bands[level].append(node)
            if at % height:
                break
            at, level = at // height, level + 1
        yield depth, node, parent, chars, above


def _tracing(height: int, shared: bool):
    """Batches of turns in order, hundred by hundred, become rows of rebuilt conversations; nothing is kept but one head and one chain."""

    def turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("hundred", "conv_id", "digest", "chars")))

    def sequences(turns: Iterator[tuple]) -> Iterator[tuple[int, Iterator[tuple[bytes, int]]]]:
        hundred, head, row = None, [], next(turns, None)

        while row is not None:
            conv = row[1]
            if row[0] != hundred:
                hundred, head = row[0], []
            taken = zlib.crc32(b"%d" % conv) % (HEAD + 1) if shared else 0
            first, mine = (conv == hundred), head

            def rebuilt() -> Iterator[tuple[bytes, int]]:
                nonlocal row
                given, at = list(mine[:taken]) if not first else [], 0
                yield from given
                while row is not None and row[1] == conv:
                    turn = row[2:]
                    if first and at < HEAD:
                        mine.append(turn)
                    at += 1
                    row = next(turns, None)
                    if first or at > taken:
                        yield turn

            yield conv, rebuilt()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, turns in sequences(turns_of(batches)):
            last = None
            for step in _chain(turns, height):
                if last is not None:
                    out.append((conv, *last[:4], 0, last[4]))
                last = step
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ROWS_ARROW)], schema=_ROWS_ARROW)
                    out = []
            out.append((conv, *last[:4], 1, last[4]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ROWS_ARROW)], schema=_ROWS_ARROW)

    return run


def traced(conversations: DataFrame, height: int = HEIGHT, shared: bool = False) -> DataFrame:
    """A row for every conversation and depth, the root included: conv_id, depth, node, parent, chars, ends (1 at its last turn), above.

    Turns are ordered by turn (null first), then by a digest of role and text. With ``shared``, conversation c begins with the first turns of c - c % 100, as many as
    crc32(c) % 6 says (all if that has fewer, none if it is absent), in place of as many of its own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    hundred = F.col("conv_id") - F.col("conv_id") % SHARING
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), (hundred if shared else F.col("conv_id")).cast("long").alias("hundred"), "turn",
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"), F.length(text).cast("long").alias("chars"),
    )
    order = ["hundred", F.expr("conv_id <> hundred"), "conv_id", F.asc_nulls_first("turn"), "digest"]
    dealt = turns.repartition("hundred").sortWithinPartitions(*order)
    return map_batches(dealt.select("hundred", "conv_id", "digest", "chars"), _tracing(height, shared), _ROWS)


def _listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of one node after another, in order, become one digest a node."""
    node, digest, nodes, digests = None, None, [], []
    for batch in batches:
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key != node:
                if node is not None:
                    nodes.append(node)
                    digests.append(digest.hexdigest())
                node, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], ["node", "ends_sha256"])
        nodes, digests = [], []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the SHA-256 of a node's ids, ascending, joined by commas.

    Ids combine into chunks of integers that lie together, each of bounded size; a node's chunks then run through one digest, which keeps nothing of them.
    """
    chunk = F.shiftright("conv_id", CHUNK_BITS)
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = ends.groupBy("node", chunk.alias("chunk")).agg(ids.alias("ids"))
    return map_batches(chunks.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids"), _listing, "node binary, ends_sha256 string")


def _totals(nodes: DataFrame, height: int) -> DataFrame:
    """(node, n_children, n_leaves, saved_tokens) of ``nodes`` (node, depth, above, leaf, saved), each over its whole subtree."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    step, level, levels = height, 0, []
    here = nodes.select("node", "depth", "above", "leaf", "saved")
    while True:
        # of each node above, in the band: the first of a band is above the others, and only counts as a child of the band above it
        up = here.where("depth > 0").select(
            F.explode(F.expr(f"transform(above[{level}], (x, i) -> struct(x as node, int(i = size(above[{level}]) - 1) as child))")).alias("to"),
            F.when(F.col("depth") % step == 0, 0).otherwise(F.col("leaf")).alias("leaf"), F.when(F.col("depth") % step == 0, 0).otherwise(F.col("saved")).alias("saved"),
        )
        parts = up.select("to.node", "to.child", "leaf", "saved").unionByName(here.select("node", F.lit(0).alias("child"), "leaf", "saved"))
        sums = parts.groupBy("node").agg(F.sum("child").alias("n_children"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        levels.append((here, cut(sums)))
        if deepest < step:
            break
        roots = nodes.where(F.col("depth") % step == 0).select("node", "depth", "above")
        here = cut(roots.join(levels[-1][1].select("node", "leaf", "saved"), "node"))
        step, level = step * height, level + 1
    done = levels[-1][1].select("node", "leaf", "saved")
    for k in range(len(levels) - 2, -1, -1):
        # a band's completed root adds its total to what is between it and the root of the band above, which has it already
        given = levels[k + 1][0].where("depth > 0").select("node", F.explode(F.expr(f"slice(above[{k}], 2, {height})")).alias("to"))
        given = given.join(done, "node").select(F.col("to").alias("node"), "leaf", "saved")
        inner = levels[k][1].select("node", "leaf", "saved").join(levels[k + 1][0].select("node"), "node", "left_anti")
        done = cut(given.unionByName(inner).groupBy("node").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")).unionByName(done))
    counts = levels[0][1].select("node", "n_children")
    return counts.join(done, "node").select("node", "n_children", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame, height: int = HEIGHT, shared: bool = False) -> DataFrame:
    """One row per node of the trie of the conversations' turns (role, text): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conv_id`` is the smallest member, parent_conv_id that of the parent (root: null), n_convs the number of members. n_leaves counts the childless nodes of a
    node's subtree, itself included, and saved_tokens sums over it (n_convs - 1) times the code points of each node's text. ends_sha256 is of the ids of the
    conversations that end there, ascending, comma-joined. Rows are read as conv_id, turn, role, text, whatever other columns there are. A null role or text is
    empty; rows without conv_id belong to no conversation; repeated rows are turns of their own, and turns that tie are ordered by a digest of role and text. An empty
    table gives no rows. Texts of any length are met as digests only. A conversation passes through one task, turn by turn.
    """
    rows = cut(traced(conversations, height, shared))
    nodes = cut(rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("chars").alias("chars"),
        F.count(F.lit(1)).alias("n_convs"), F.sum("ends").alias("n_ends"), F.first("above").alias("above"),
    ))
    # childless: all members end here
    valued = nodes.withColumn("leaf", (F.col("n_ends") == F.col("n_convs")).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    totals = _totals(valued, height)
    ends = cut(end_digests(rows.where("ends = 1").select("node", "conv_id")))
    # coalesced: the join then shuffles both sides anew, so that a node of very many children can be split
    parts = parts_for(rows.count())
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")).coalesce(parts)
    out = nodes.select("node", "parent", "conv_id", "depth", "n_convs").coalesce(parts).join(parents, "parent", "left").join(cut(totals), "node").join(ends, "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
