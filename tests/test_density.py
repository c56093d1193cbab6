import math
import random

import pytest

from lorekeel.operators.density import density_clusters

SCHEMA = "id long, x double, y double"


def plain(points, eps, least):
    """Clusters by looking at every pair."""
    usable = [p for p in points if all(v is not None and math.isfinite(v) for v in p[1:])]
    near = {i: [j for j, u, v in usable if (x - u) * (x - u) + (y - v) * (y - v) <= eps * eps] for i, x, y in usable}
    cores = {i for i in near if len(near[i]) >= least}
    name = {}
    for i in sorted(cores):
        if i in name:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in name:
                name[j] = i
                todo += [k for k in near[j] if k in cores and k not in name]
    out = {i: (None, False) for i, _, _ in points}
    for i in near:
        beside = [name[j] for j in near[i] if j in cores]
        out[i] = (name[i], True) if i in cores else (min(beside, default=None), False)
    return out


def found(spark, points, eps, least):
    got = density_clusters(spark.createDataFrame(points, SCHEMA), eps, least).collect()
    assert len(got) == len(points)
    return {r["id"]: (r["cluster"], r["core"]) for r in got}


@pytest.mark.parametrize("seed, eps, least", [(1, 0.5, 5), (2, 0.3, 3)])
def test_clusters_against_all_pairs(spark, seed, eps, least):
    rng = random.Random(seed)
    points = []
    for _ in range(9):
        cx, cy, r = rng.uniform(-4, 4), rng.uniform(-4, 4), rng.choice([0.1, 0.4, 1.0])
        points += [(cx + rng.gauss(0, r), cy + rng.gauss(0, r)) for _ in range(rng.choice([8, 30, 60]))]
    points += [(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(60)]
    rng.shuffle(points)
    rows = [(k, a, b) for k, (a, b) in enumerate(points)]
    got = found(spark, rows, eps, least)
    assert got == plain(rows, eps, least) and len({c for c, _ in got.values()}) > 3


def test_a_hot_place_nulls_and_ties(spark):
    rows = [(k, 1.0, 1.0) for k in range(400)] + [(400, 1.5, 1.0), (401, 2.0, 1.0), (402, None, 1.0), (403, 1.0, float("nan")), (404, float("inf"), 1.0), (405, 9.0, 9.0)]
    assert found(spark, rows, 0.5, 5) == plain(rows, 0.5, 5)
    assert found(spark, rows, 0.5, 1) == plain(rows, 0.5, 1)
    assert density_clusters(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dense_cells_just_in_or_out_of_reach(spark):
    for gap in (0.499, 0.501):
        rows = [(k, -0.001 * k, 0.01 * k) for k in range(12)] + [(20 + k, gap + 0.001 * k, 0.01 * k) for k in range(12)]
        got = found(spark, rows, 0.5, 5)
        assert got == plain(rows, 0.5, 5) and len({c for c, _ in got.values()}) == (1 if gap < 0.5 else 2)
