"""Connected components by alternating large-star and small-star rounds.

Each round is one grouped minimum (combined before the shuffle) and one join on
the same key, so a hub with very many neighbours costs a partial aggregate and a
join that adaptive execution splits; no neighbour list is ever collected. Rounds run
in as many tasks as their edges are worth, since most graphs shrink to little work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.session import ROWS_A_TASK, cut, parts_for


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # coalesced: the join then shuffles both sides anew, so that a hot node's rows can be split
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).coalesce(parts)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
    across = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
    return across.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that an edge touches; component is the least node reachable.

    Edges with a null end are ignored; loops give a node its own component unless
    another edge joins it; repeated edges and both directions count once. Nodes may
    be of any orderable type. No edges give no rows. ``max_rounds`` is a guard: the
    rounds needed grow with the logarithm of the node count, and passing it raises.
    """
    given = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    given = cut(given.distinct())
    loops = given.where("u = v").select("u")
    now = given.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    mark = None
    # a round makes no edges, so the number of edges tells how many tasks its parts are worth
    rows = given.count()
    for _ in range(max_rounds):
        parts = parts_for(rows)
        now = cut(_small_star(_large_star(now, parts), parts).coalesce(parts))
        new = _mark(now)
        if new == mark or not new[0]:
            break
        mark, rows = new, new[0]
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = found.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
    alone = loops.join(found, loops["u"] == found["node"], "left_anti").select(F.col("u").alias("node"), F.col("u").alias("component"))
    return found.unionByName(alone)


def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, component) of all edges (u, v) of a task by hooking to least neighbours; nodes are numbers."""
    edges = [b.to_numpy() for b in batches]
    if not edges:
        return
    nodes, ends = np.unique(np.concatenate(edges), return_inverse=True)
    ends, label = ends.reshape(-1, 2), np.arange(len(nodes))
    while True:
        tops = label[ends]
        new = label.copy()
        np.minimum.at(new, tops.max(axis=1), tops.min(axis=1))
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    yield pd.DataFrame({"node": nodes, "component": nodes[label]})


def components_of(edges: DataFrame, u: str = "u", v: str = "v", task_edges: int = ROWS_A_TASK) -> DataFrame:
    """``connected_components``, where a graph of at most ``task_edges`` different edges, counted first, is labelled as numbers by one task.

    Rounds over so small a graph would cost their jobs, not their work. Larger graphs take the rounds, with the same rows for a result.
    """
    given = cut(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null").distinct())
    if given.count() > task_edges:
        return connected_components(given)
    ends = given.select("u").unionByName(given.select(F.col("v").alias("u"))).distinct()
    # numbered in order, so that the least number is the least node
    numbers = cut(ends.sort("u").select(F.col("u").alias("node"), F.monotonically_increasing_id().alias("id")))
    of = lambda side: numbers.select(F.col("node").alias(side), F.col("id").alias(f"id_{side}"))
    numbered = given.join(of("u"), "u").join(of("v"), "v").select("id_u", "id_v").repartition(1)
    labels = cut(numbered.mapInPandas(_labelled, "node long, component long"))
    named = lambda c, name: numbers.select(F.col("id").alias(c), F.col("node").alias(name))
    return labels.join(named("node", "n"), "node").join(named("component", "c"), "component").select(F.col("n").alias("node"), F.col("c").alias("component"))
