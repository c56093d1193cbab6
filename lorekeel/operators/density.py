"""Clusters of points in the plane by density, over grid cells; no cell's points are ever paired with each other.

The side of a cell is such that all its points are close. A cell of ``least`` points or more is dense: all its points are cores of one cluster. Points of
other cells, fewer than ``least`` each, look at the cells around them, so what a hot cell meets is bounded by its neighbourhood, not by
itself. Whether two dense cells have a close pair is told by boxes of their points, halved level by level where
that is open. What is then connected goes through connected components.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeel.operators.components import connected_components
from lorekeel.session import cut

#: Levels of halving at most: beyond it doubles cannot tell places of a cell apart.
MOST_LEVELS = 64


def _square(dx: Column, dy: Column) -> Column:
    return dx * dx + dy * dy


def _box_distances(a: str, b: str) -> tuple[Column, Column]:
    """Squares of the least and the most that points of two boxes (x0, x1, y0, y1) can be apart."""
    gap = lambda d: F.greatest(F.lit(0.0), F.col(f"{d}0_{a}") - F.col(f"{d}1_{b}"), F.col(f"{d}0_{b}") - F.col(f"{d}1_{a}"))
    far = lambda d: F.greatest(F.col(f"{d}1_{a}") - F.col(f"{d}0_{b}"), F.col(f"{d}1_{b}") - F.col(f"{d}0_{a}"))
    return _square(gap("x"), gap("y")), _square(far("x"), far("y"))


def _touching(points: DataFrame, pairs: DataFrame, side: float, eps: float) -> DataFrame:
    """Of ``pairs`` of dense cells (a, b) those with a point each that are at most ``eps`` apart; ``points`` (node, x, y) are those of dense cells."""
    done = None
    open_ = cut(pairs.select("a", "b", F.lit(0).cast("long").alias("kx_a"), F.lit(0).cast("long").alias("ky_a"), F.lit(0).cast("long").alias("kx_b"), F.lit(0).cast("long").alias("ky_b")))
    points = points.withColumn("fx", F.col("x") / side - F.floor(F.col("x") / side)).withColumn("fy", F.col("y") / side - F.floor(F.col("y") / side))
    for level in range(MOST_LEVELS):
        if open_.isEmpty():
            break
        cells = open_.select(F.col("a").alias("node")).unionByName(open_.select(F.col("b").alias("node"))).distinct()
        step = float(2**level)
        part = lambda f: F.least(F.floor(F.col(f) * step).cast("long"), F.lit(int(step) - 1))  # noqa: E731, B023
        boxes = points.join(cells, "node").groupBy("node", part("fx").alias("kx"), part("fy").alias("ky")).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
        boxes = cut(boxes)

        def side_of(which: str) -> DataFrame:
            up = 2 if level else 1  # noqa: B023
            own = boxes.select(F.col("node").alias(which), F.floor(F.col("kx") / up).cast("long").alias(f"kx_{which}"), F.floor(F.col("ky") / up).cast("long").alias(f"ky_{which}"), F.col("kx").alias(f"nx_{which}"), F.col("ky").alias(f"ny_{which}"), *(F.col(c).alias(f"{c}_{which}") for c in ("x0", "x1", "y0", "y1")))  # noqa: B023
            return own

        met = open_.join(side_of("a"), ["a", "kx_a", "ky_a"]).join(side_of("b"), ["b", "kx_b", "ky_b"])
        least, most = _box_distances("a", "b")
        met = cut(met.withColumn("least", least).withColumn("most", most).where(F.col("least") <= eps * eps))
        close = met.where(F.col("most") <= eps * eps).select("a", "b").distinct()
        done = close if done is None else done.unionByName(close)
        left = met.join(close, ["a", "b"], "left_anti")
        open_ = cut(left.select("a", "b", *(F.col(f"n{d}_{w}").alias(f"k{d}_{w}") for w in "ab" for d in "xy")))
    return pairs.select("a", "b").where("false") if done is None else cut(done)


def density_clusters(points: DataFrame, eps: float = 0.5, least: int = 5, id_col: str = "id", x: str = "x", y: str = "y") -> DataFrame:
    """(id, cluster, core) of every row: its cluster, named by the least id of its cores, null for noise; and whether it is a core.

    A core has ``least`` points or more within ``eps``, itself included; cores within ``eps`` of each other are of one cluster, and other points within ``eps`` of a core of that
    of those with the least name. Rows without a coordinate, or with one that is no number, are noise. Ids are distinct; points that lie on one place count each. An empty table gives no rows.
    """
    given = cut(points.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))
    side = eps * 0.7071
    usable = given.where("x is not null and y is not null and not isnan(x) and not isnan(y) and abs(x) < double('infinity') and abs(y) < double('infinity')")
    placed = usable.withColumn("cx", F.floor(F.col("x") / side).cast("long")).withColumn("cy", F.floor(F.col("y") / side).cast("long"))
    cells = cut(placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")))
    # a point of a dense cell stands for it: all are one
    dense = F.col("n") >= least
    known = cut(placed.join(cells, ["cx", "cy"]).select("id", "x", "y", "cx", "cy", dense.alias("dense"), F.when(dense, F.col("first")).otherwise(F.col("id")).alias("node")))

    around = lambda c: F.explode(F.sequence(F.col(c) - 2, F.col(c) + 2)).alias(c)
    spread = known.where("not dense").select("id", F.col("x").alias("px"), F.col("y").alias("py"), "cx", "cy")
    spread = spread.select("id", "px", "py", around("cx"), "cy").select("id", "px", "py", "cx", around("cy"))
    others = known.select("cx", "cy", F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("node").alias("other"), F.col("dense").alias("by_dense"))
    near = spread.join(others, ["cx", "cy"]).where(_square(F.col("px") - F.col("qx"), F.col("py") - F.col("qy")) <= eps * eps)
    near = cut(near.groupBy("id", "other", "by_dense").agg(F.count(F.lit(1)).alias("n")))
    lonely = near.groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("id")
    cores = cut(known.where("dense").select(F.col("node").alias("id")).distinct().unionByName(lonely))

    ends = near.join(cores, "id", "left_semi").join(cores.select(F.col("id").alias("other")), "other", "left_semi").select(F.col("id").alias("u"), F.col("other").alias("v"))
    heads = cells.where(dense).select("cx", "cy", F.col("first").alias("a"))
    reach = heads.select("a", around("cx"), "cy").select("a", "cx", around("cy"))
    pairs = reach.join(heads.withColumnRenamed("a", "b"), ["cx", "cy"]).where("a < b").select("a", "b")
    touching = _touching(known.where("dense").select("node", "x", "y"), cut(pairs), side, eps)
    linked = connected_components(ends.unionByName(touching.select(F.col("a").alias("u"), F.col("b").alias("v"))), "u", "v")
    named = cut(cores.join(linked.withColumnRenamed("node", "id"), "id", "left").select(F.col("id").alias("node"), F.coalesce("component", "id").alias("cluster")))

    border = near.join(named.withColumnRenamed("node", "other"), "other").groupBy("id").agg(F.min("cluster").alias("beside"))
    out = known.join(named, "node", "left").select("id", "cluster", F.col("cluster").isNotNull().alias("core")).join(border, "id", "left")
    out = out.select("id", F.coalesce("cluster", "beside").alias("cluster"), "core")
    rest = given.join(known.select("id"), "id", "left_anti").select("id", F.lit(None).cast(given.schema["id"].dataType).alias("cluster"), F.lit(False).alias("core"))
    return out.unionByName(rest).withColumnRenamed("id", id_col)
