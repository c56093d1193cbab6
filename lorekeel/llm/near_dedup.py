"""Operator 6, near-duplicates by fast similarity sketching, banding and exact verification.

A document is its set of distinct word shingles. The sketch throws every shingle into
one of ``COORDINATES`` bins a round, keeping the least value of a bin; values of later
rounds are larger, so a set stops as soon as no bin is empty, and from round
``COORDINATES`` on bins are visited in turn, so that none stays empty. A coordinate of
two sets agrees with a probability equal to their similarity, with the concentration
of independent draws.

Documents with one set are one class from the start. Classes that share a band form a
bucket. Buckets are worked off in two passes, neither of which lists all pairs of a
bucket: first each member meets the bucket's hub, the member that shares most bands with
most others, so mostly the text that the rest were made from; what passes verification is
joined into components. Then only members of one bucket that
are still in different components can matter; small buckets compare those
directly, members of large ones by the prefix and position rules on the rarest of their shingles,
counted exactly, which lose no pair at the threshold. Of two sets the smaller one is looked up by the
shorter prefix that its size allows, which in a family of edited copies mostly holds shingles of that text
alone. Every link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lorekeel.llm.batches import map_batches, text_slices, words_of
from lorekeel.operators.components import connected_components
from lorekeel.session import cut

#: Coordinates of a sketch, and how many of them make a band: 32 bands of 4 miss a pair at 0.8 once in 20 million.
COORDINATES, BAND = 128, 4
#: Buckets of so many classes at most compare what is left directly, others by prefixes; both find the same links.
SMALL_BUCKET = 8
#: Numeric ids up to this count go to all tasks (8 bytes each, 16 for decimals) to pick the texts that are read again; beyond it they are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with good avalanche (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _seed(i: int) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (i + 1)) & 0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text; A-Z lower-cased, a text of fewer words is one shingle."""
    starts, codes, distinct = words_of(texts, lower=True)
    named = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    words = named[codes] if len(codes) else np.empty(0, np.uint64)
    n = max(len(words) - width + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = _mix(rolled ^ (words[k : k + n] + _seed(k)))
    sets = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for k in range(a, b):
                h = _mix(h ^ (words[k : k + 1] + _seed(k - a)))
            sets.append(_mix(h ^ _seed(1000 + b - a)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """A row of ``coordinates`` values for each non-empty set; rows of empty sets are all ones."""
    t = coordinates
    assert t <= 128, "rounds are kept in eight bits of a value"
    values = np.full(len(sets) * t, np.iinfo(np.uint64).max, np.uint64)
    if not sets:
        return values.reshape(0, t)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    items = np.concatenate(sets)
    for r in range(2 * t):
        if not len(items):
            break
        h = _mix(items ^ _seed(r))
        bins = (h % np.uint64(t)).astype(np.int64) if r < t else r - t
        np.minimum.at(values, owner * t + bins, (np.uint64(r) << np.uint64(56)) | (_mix(h) >> np.uint64(8)))
        full = (values.reshape(-1, t) != np.iinfo(np.uint64).max).all(axis=1)
        open_ = ~full[owner]
        owner, items = owner[open_], items[open_]
    return values.reshape(-1, t)


def band_keys(values: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key for each band of each row."""
    out = []
    for b in range(values.shape[1] // band):
        h = np.full(len(values), _seed(5000 + b), np.uint64)
        for k in range(band):
            h = _mix(h ^ values[:, b * band + k]) + _seed(k)
        out.append(h)
    return np.stack(out, axis=1).view(np.int64)


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketching(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                sets = shingle_sets(batch.column("text"), width)
                keys = band_keys(sketches(sets))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(list(map(_set_key, sets)), pa.binary()), bands],
                    ["doc_id", "n_shingles", "set_key", "bands"],
                )

    return run


def _listing(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                sets = shingle_sets(batch.column("text"), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(map(_set_key, sets)), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["set_key", "members"]
                )

    return run


def _verifying(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("members_a"), batch.column("members_b")
            ok = []
            for x, y in zip(a, b):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _exploding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole, "members"):
            shingles = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("members")]
            node = np.repeat(batch.column("node").to_numpy(), [len(x) for x in shingles])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(shingles))], ["node", "shingle"])


def _close(percent: int):
    """Sizes that two sets at the threshold can have."""
    return (100 * F.least("n_a", "n_b")) >= (percent * F.greatest("n_a", "n_b"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the least doc_id reachable over links of at least ``percent``
    similarity, its own included; ``kept`` says that the row is that document. A text of
    fewer than ``width`` words is one shingle; without words, or null, it has an empty set
    and links with nothing; a text of any length is one set. Rows repeated with one id are one document: they and all that any of
    their texts links to are of one component, and each is
    kept if that id is. A null id names a component only if no member has another: then
    component_id is null, and its rows, which nothing tells apart, are all kept. To tell rows apart give
    each an id of its own. Other columns are not read, whatever their names. An empty table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id %s, n_shingles long, set_key binary, bands array<long>" % given.schema["doc_id"].dataType.simpleString()
    rows = map_batches(given, _sketching(width), schema)
    rows = cut(rows.withColumn("row_id", F.monotonically_increasing_id()))
    some = rows.where("n_shingles > 0")
    classes = cut(some.groupBy("set_key", "n_shingles").agg(F.min("row_id").alias("node"), F.min("doc_id").alias("least_id")))

    firsts = some.join(classes.select(F.col("node").alias("row_id")), "row_id", "left_semi")
    banded = firsts.select(F.col("row_id").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    # written first, here and below: a join beside an aggregate on the same key could not be split where a bucket is hot
    sizes = cut(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    members = cut(banded.join(sizes, "key").select("key", "size", "node", "n"))
    central = members.groupBy("node").agg(F.sum("size").alias("central"))
    members = cut(members.join(central, "node").select("key", "size", "node", "n", "central"))
    best = F.max_by(F.struct(F.col("node").alias("hub"), F.col("n").alias("n_hub")), F.struct(F.col("central"), (-F.col("node")).alias("first")))
    hubs = cut(members.groupBy("key").agg(best.alias("best")).select("key", "best.*"))
    to_hub = members.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"), F.col("n").alias("n_a"), F.col("n_hub").alias("n_b"))
    tried = cut(to_hub.where(_close(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    needed = cut(members.select("node").distinct().join(classes, "node").select("node", "set_key"))
    ids = cut(needed.join(rows.select(F.col("row_id").alias("node"), "doc_id"), "node").select("doc_id").distinct())
    light = isinstance(given.schema["doc_id"].dataType, NumericType) and ids.count() <= BROADCAST_IDS
    texts = given.join(F.broadcast(ids) if light else ids, given["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    sets = map_batches(texts, _listing(width), "set_key binary, members binary")
    sets = cut(sets.join(needed, "set_key").select("node", "members").dropDuplicates(["node"]))

    def verified(pairs: DataFrame) -> DataFrame:
        full = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("members_a")), "a")
        full = full.join(sets.select(F.col("node").alias("b"), F.col("members").alias("members_b")), "b")
        return cut(map_batches(full.select("a", "b", "members_a", "members_b"), _verifying(percent), "a long, b long"))

    # rows of one id and different texts are one document: a star of their classes
    several = cut(rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")).where("x <> y").select("doc_id"))
    repeated = not several.isEmpty()
    links = verified(tried)
    if repeated:
        arms = cut(some.join(several, "doc_id", "left_semi").select("doc_id", "set_key").distinct().join(classes.select("set_key", "node"), "set_key").select("doc_id", "node"))
        centres = cut(arms.groupBy("doc_id").agg(F.min("node").alias("a")))
        links = links.unionByName(arms.join(centres, "doc_id").where("node <> a").select("a", F.col("node").alias("b")))
    found = cut(connected_components(links, "a", "b"))

    def component_of(pairs: DataFrame, end: str) -> DataFrame:
        return pairs.join(found.withColumnRenamed("node", end), end, "left").select(pairs["*"], F.coalesce("component", end).alias(f"c_{end}"))

    rest = verified(_untried(members, found, sets, tried, percent))
    if not rest.isEmpty():
        # components that a later link joins: a graph of components, not of nodes
        joined = cut(connected_components(component_of(component_of(rest, "a"), "b"), "c_a", "c_b"))
        alone = joined.join(found.select(F.col("node").alias("seen")), joined["node"] == F.col("seen"), "left_anti")
        later = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))
        found = found.join(later, "component", "left").select("node", F.coalesce("joined", "component").alias("component")).unionByName(alone)

    labels = classes.join(found, "node", "left").select("set_key", "least_id", F.coalesce("component", "node").alias("component"))
    labels = cut(labels)
    least = cut(labels.groupBy("component").agg(F.min("least_id").alias("component_id")))
    named = labels.join(least, "component").select("set_key", "component_id")
    out = some.join(named, "set_key").select("doc_id", "n_shingles", "component_id")
    out = out.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    if repeated:  # a row without words goes with the other rows of its id
        out = cut(out)
        one = cut(out.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("least")))
        out = out.join(one, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _untried(members: DataFrame, found: DataFrame, sets: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """(a, b) of one bucket, in different components and not yet compared, that can reach the threshold."""
    labelled = members.join(found, "node", "left").select("key", "size", "node", "n", F.coalesce("component", "node").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    mixed = cut(mixed)
    left = cut(labelled.join(mixed, "key", "left_semi"))

    def end(rows: DataFrame, which: str, *more: str) -> DataFrame:
        return rows.select(*(F.col(c).alias(f"{c}_{which}") for c in (*more, "n")), F.col("node").alias(which), F.col("component").alias(f"c_{which}"))

    few = left.where(F.col("size") <= SMALL_BUCKET)
    small = end(few, "a", "key").join(end(few, "b", "key"), F.expr("key_a = key_b and a < b and c_a <> c_b")).where(_close(percent)).select("a", "b")

    large = cut(left.where(F.col("size") > SMALL_BUCKET).select("node", "n", "component").distinct())
    listed = cut(map_batches(large.select("node").join(sets, "node"), _exploding, "node long, shingle long"))
    shared = cut(listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1"))
    # one row a set; shingles of no other set come first in its order, and are only counted
    order = listed.join(shared, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("order"))
    ranked = large.join(order, "node").withColumn("own", F.col("n") - F.size("order")).withColumn("length", F.expr(f"n - int(ceil(n * {percent} / 100)) + 1 - own"))
    ranked = ranked.where("length > 0").select("node", "n", "component", "own", F.posexplode(F.expr("slice(order, 1, int(length))")).alias("pos", "item"))
    prefix = cut(ranked.select("node", "n", "component", (F.col("own") + F.col("pos") + 1).alias("place"), F.col("item.shingle").alias("shingle")))
    # the smaller set of a pair must share enough for a larger one, so that its prefix is shorter
    short = prefix.where(f"place <= n - int(ceil(n * {2 * percent} / {100 + percent})) + 1")
    pairs = end(short, "a", "shingle", "place").join(end(prefix, "b", "shingle", "place"), F.expr("shingle_a = shingle_b and c_a <> c_b and (n_a < n_b or n_a = n_b and a < b)"))
    # nothing before the first shingle that two sets share is shared, which bounds what they can share in all
    reach = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    pairs = pairs.where(_close(percent)).where((100 + percent) * reach >= percent * (F.col("n_a") + F.col("n_b")))
    pairs = small.unionByName(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    return pairs.join(tried, ["a", "b"], "left_anti")
