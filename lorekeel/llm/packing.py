"""Operator 9, packing by minimum bin slack.

Documents become token pieces of at most one window. All that packing depends on is
how many pieces there are of each length, at most ``capacity`` numbers. A window
takes the longest piece left; a subset-sum over the lengths left, a bit for each reachable
fill, finds the fill closest to capacity, and backtracking gives how many pieces of each
length make it. That pattern is repeated while its lengths last, so the
number of patterns is bounded by the lengths, not by the documents. Pieces are numbered within their
length, task by task, and a piece's number says its window and place by arithmetic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lorekeel.llm.batches import map_batches, text_slices
from lorekeel.llm.word_bpe import encoder
from lorekeel.session import cut

#: Tokens in a window, and the id that ends a document.
CAPACITY, END_ID = 4096, 2


def padding(fill: int, capacity: int) -> int:
    """Tokens added to a window of ``fill`` tokens; a power of two stays as it is."""
    return 0 if fill & (fill - 1) == 0 else capacity - fill


def fill_window(lengths: list[tuple[int, int]], room: int, used: int, capacity: int) -> dict[int, int]:
    """Counts by length, out of (length, available), whose sum leaves a window of ``used`` plus that sum with least padding.

    One bit for each reachable sum; a length with ``k`` copies is added by doubling. The
    bits before each length are kept, so that backtracking gives the copies used.
    """
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length, copies in lengths:
        copies = min(copies, room // length)
        if not copies:
            continue
        steps.append((length, copies, reach))
        chunk = 1
        while copies:
            take = min(chunk, copies)
            reach |= (reach << (take * length)) & mask
            copies -= take
            chunk *= 2
        if reach >> room & 1:
            break
    at = min((s for s in range(room + 1) if reach >> s & 1), key=lambda s: (padding(used + s, capacity), -s)) if not reach >> room & 1 else room
    picked = {}
    for length, copies, before in reversed(steps):
        k = next(k for k in range(copies + 1) if at >= k * length and before >> (at - k * length) & 1)
        if k:
            picked[length] = k
            at -= k * length
    return picked


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repeats, {length: copies}) until ``counts`` is used up."""
    left, plan = dict(sorted(counts.items(), reverse=True)), []
    while left:
        longest = next(iter(left))
        rest = [(n, c - (n == longest)) for n, c in left.items()]
        pattern = Counter({longest: 1}) + Counter(fill_window(rest, capacity - longest, longest, capacity))
        repeats = min(left[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            left[n] -= repeats * k
            if not left[n]:
                del left[n]
        plan.append((repeats, dict(pattern)))
    return plan


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of each document's ids: doc_id, start, length, doc_tokens and tokens (little-endian unsigned 32-bit).

    A null or empty text has one piece, with the end id alone; a text of any length is encoded whole. Rows repeated
    with one id have pieces of their own. Other columns are not read, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                ends, ids = encoder(vocabulary).encode(batch.column("text"), end_id)
                sizes = np.diff(ends)
                of = np.repeat(np.arange(len(sizes)), -(-sizes // capacity))
                first = np.searchsorted(of, np.arange(len(sizes)))
                start = (np.arange(len(of)) - first[of]) * capacity
                at = ends[of] + start
                length = np.minimum(capacity, sizes[of] - start)
                data = pa.py_buffer(ids)
                offsets = pa.py_buffer(np.append(at, ends[-1]).astype(np.int64) * 4)
                tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(of), [None, offsets, data]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(of)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sizes[of], pa.int64()), tokens],
                    ["doc_id", "start", "length", "doc_tokens", "tokens"],
                )

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return map_batches(given, run, f"doc_id {kind}, start long, length long, doc_tokens long, tokens binary")


def _numbering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    part = TaskContext.get().partitionId()
    for batch in batches:
        local = []
        for n in batch.column("length").to_pylist():
            local.append(seen[n])
            seen[n] += 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int64()), pa.array(local, pa.int64())], ["piece", "length", "part", "local"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with ``length`` of 1 to ``capacity``) with sequence_id and offset.

    Places in a sequence are gapless from 0. Pieces that are equal in every column are pieces of
    their own. Columns of ``pieces`` named sequence_id or offset are replaced; all others stay, whatever their names.
    No pieces give no rows. The driver holds one count for each length, ``capacity``
    at most, and the plan made of them; both are bounded whatever the input.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    # a piece travels as one struct, so that no name of its columns can clash with a name used here
    whole = pieces.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("piece"), F.col("length").cast("long").alias("length"))
    numbered = cut(map_batches(whole, _numbering, T.StructType([*whole.schema.fields, T.StructField("part", T.LongType()), T.StructField("local", T.LongType())])))
    tally = cut(numbered.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    rows, sequence, used = [], 0, Counter()
    for repeats, pattern in plan_windows(counts, capacity):
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            # the next ``repeats * k`` pieces of this length go here, ``k`` to a window
            rows.append((n, used[n], used[n] + repeats * k, sequence, k, offset))
            used[n] += repeats * k
            offset += n * k
        sequence += repeats
    # as long as the plan, whose patterns are bounded by the lengths
    plan = pieces.sparkSession.createDataFrame(rows, "length long, since long, until long, base long, copies long, at long")
    ranked = numbered.join(offsets, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    found = ranked.join(F.broadcast(plan), "length").where("since <= rank and rank < until").withColumn("turn", F.col("rank") - F.col("since"))
    sequence_id, place = F.col("base") + F.expr("turn div copies"), F.col("at") + F.expr("turn % copies") * F.col("length")
    return found.select(*(F.col("piece")[c].alias(c) for c in kept), sequence_id.alias("sequence_id"), place.alias("offset"))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, tokens): the pieces of ``pack`` that still have their tokens, joined in order; a group is a window at most."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "tokens")))
    return placed.groupBy("sequence_id").agg(in_order.alias("p")).select("sequence_id", F.aggregate("p.tokens", F.lit(b""), lambda a, x: F.concat(a, x)).alias("tokens"))
