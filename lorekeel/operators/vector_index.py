"""An inverted-file index of vectors: a coarse quantiser, every row in the list of its nearest centre, searches that probe few lists.

The quantiser is fitted on a bounded sample; every row is indexed. Rows and queries meet by list, in blocks, so a
list that a third of all rows fall into is many tasks, and lists that no query probes are left out before the shuffle. ``exact`` searches
go on with every list that can still hold a closer row, by the angle between its centre and its farthest row, and lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.operators.vectors import BLOCK_ROWS, best_of_block, search, units
from lorekeel.session import cut

#: Lists of an index, at most as many as it has rows; rows that the quantiser is fitted on for each list.
LISTS, ROWS_A_LIST = 100, 256
#: Lists at most: their centres and sizes go to every task.
MOST_LISTS = 65_536
#: Queries that the number of probes is chosen by.
JUDGED_QUERIES = 200
_DRAWS = 1 << 62


def _sample(rows: DataFrame, most: int, n: int) -> DataFrame:
    """About ``most`` of ``n`` rows (id), by a hash of the id."""
    return rows if n <= most else rows.where(F.pmod(F.xxhash64("id"), F.lit(_DRAWS)) < int(most / n * _DRAWS))


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.where(F.size(vector_col) > 0).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>").alias("v"))


def fit_centres(vectors: DataFrame, lists: int = LISTS, id_col: str = "vec_id", vector_col: str = "embedding", rows_a_list: int = ROWS_A_LIST, seed: int = 7) -> np.ndarray:
    """Unit vectors, ``lists`` at most, by spherical k-means over a sample of about ``rows_a_list`` rows a list; none without a row that has a length."""
    if not 0 < lists <= MOST_LISTS:
        raise ValueError(f"1 to {MOST_LISTS} lists")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = _usable(vectors, id_col, vector_col).where(length > 0)
    n = rows.count()
    sample = _sample(rows, lists * rows_a_list, n).select(array_to_vector(F.col("v").cast("array<double>")).alias("features"))
    sample = cut(sample)
    found = sample.count()
    if not found:
        return np.zeros((0, 0))
    if min(lists, found) == 1:
        return units(np.stack([sample.first()["features"].toArray()]))
    model = KMeans(k=min(lists, found), seed=seed, distanceMeasure="cosine", initSteps=2, maxIter=10).fit(sample)
    return units(np.stack(model.clusterCenters()))


def _placing(centres: np.ndarray, probes: int, with_vectors: bool = True):
    """Rows (id, v) with their nearest lists in order: list, place and angle. What has no length is in list -1."""
    names = ["id", *["v"] * with_vectors, "list", "place", "angle"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                v = units(np.stack(batch.column("v").to_numpy(zero_copy_only=False)))
                score = v @ centres.T
                near = np.argsort(-score, axis=1, kind="stable")[:, :probes]
                angle = np.arccos(np.clip(np.take_along_axis(score, near, 1), -1, 1))
                nothing = ~v.any(axis=1)
                near[nothing], angle[nothing] = -1, 0.0
                row = np.repeat(np.arange(len(v)), near.shape[1])
                place = np.tile(np.arange(near.shape[1], dtype=np.int32), len(v))
                keep = ~nothing[row] | (place == 0)
                taken = pa.array(row[keep])
                given = [batch.column(c).take(taken) for c in names[: 1 + with_vectors]]
                yield pa.RecordBatch.from_arrays([*given, pa.array(near.ravel()[keep].astype(np.int32)), pa.array(place[keep]), pa.array(angle.ravel()[keep])], names)

    return run


def _opening(centres: np.ndarray, reach: np.ndarray, blind_rows: bool, probes: int):
    """Rows (id, v, last) with every list that can hold a row of cosine ``last`` or more, but for the ``probes`` nearest, as (id, v, list).

    ``reach`` has the angle of each list's farthest row from its centre (negative: no rows). Rows without length, in list -1, score 0; so does a query without length everywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                v, last = units(np.stack(batch.column("v").to_numpy(zero_copy_only=False))), batch.column("last").to_numpy(zero_copy_only=False)
                nothing = ~v.any(axis=1)
                score = v @ centres.T if len(centres) else np.zeros((len(v), 0))
                best = np.cos(np.maximum(np.arccos(np.clip(score, -1, 1)) - reach, 0))
                open_ = (best >= last[:, None] - 1e-9) | nothing[:, None]
                if probes and score.shape[1]:
                    near = np.argsort(-score, axis=1, kind="stable")[:, :probes]
                    np.put_along_axis(open_, near, np.take_along_axis(open_, near, 1) & nothing[:, None], 1)
                open_ &= reach >= 0
                row, where = np.nonzero(open_)
                if blind_rows:
                    more = np.flatnonzero(~nothing & (last <= 0))
                    row, where = np.concatenate((row, more)), np.concatenate((where, np.full(len(more), -1)))
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(taken), batch.column("v").take(taken), pa.array(where.astype(np.int32))], ["id", "v", "list"])

    return run


@dataclass
class VectorIndex:
    """``centres`` (a row for each list) and ``rows`` (id, v, list, angle), written to the shared folder."""

    centres: np.ndarray
    rows: DataFrame
    id_col: str = "vec_id"

    @staticmethod
    def build(vectors: DataFrame, lists: int = LISTS, id_col: str = "vec_id", vector_col: str = "embedding", rows_a_list: int = ROWS_A_LIST) -> VectorIndex:
        """Index every row of ``vectors`` that has a vector; null and empty vectors are left out, repeated ids stay. All vectors are of one length."""
        centres = fit_centres(vectors, lists, id_col, vector_col, rows_a_list)
        return VectorIndex(centres, cut(_placed(_usable(vectors, id_col, vector_col), centres, 1).select("id", "v", "list", "angle")), id_col)

    def save(self, path: str) -> None:
        """Rows in the order of their lists, so that a reader passes over files and row groups without its lists; centres beside them."""
        spark = self.rows.sparkSession
        self.rows.repartitionByRange("list").sortWithinPartitions("list").write.mode("overwrite").parquet(f"{path}/rows")
        spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(self.centres)], "list int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")

    @staticmethod
    def load(spark: SparkSession, path: str, id_col: str = "vec_id") -> VectorIndex:
        centres = spark.read.parquet(f"{path}/centres").orderBy("list").collect()
        return VectorIndex(np.array([r["centre"] for r in centres]) if centres else np.zeros((0, 0)), spark.read.parquet(f"{path}/rows"), id_col)

    def added(self, vectors: DataFrame, vector_col: str = "embedding") -> VectorIndex:
        """With the rows of ``vectors`` beside its own, by the centres that it has."""
        more = _placed(_usable(vectors, self.id_col, vector_col), self.centres, 1).select("id", "v", "list", "angle")
        return VectorIndex(self.centres, cut(self.rows.unionByName(more)), self.id_col)

    def _asked(self, queries: DataFrame, probes: int, query_id: str, vector_col: str) -> DataFrame:
        return _placed(_usable(queries, query_id, vector_col), self.centres, probes)

    def search(self, queries: DataFrame, k: int, probes: int = 10, exact: bool = False, threshold: float | None = None, query_id: str = "query_id", vector_col: str = "embedding") -> DataFrame:
        """(query_id, id, score, place): of the rows in the ``probes`` lists nearest to each query the ``k`` closest by cosine, then those of at least ``threshold``.

        With ``exact`` the closest of all rows: lists follow for as long as one can hold a row as close as the last found. Ties go to the smaller id. Queries
        without length score 0 everywhere; without ``exact`` they find only rows of that kind. Rows without length are met only by ``exact``.
        """
        probes = max(1, min(probes, len(self.centres)))
        asked = cut(self._asked(queries, probes, query_id, vector_col))
        found = _met(self.rows, asked, k)
        if exact:
            found = cut(found)
            given = _usable(queries, query_id, vector_col)
            last = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
            worst = given.select(F.col("id").alias("query_id")).distinct().join(last, "query_id", "left").select(F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.col("last")).otherwise(-2.0).alias("last"))
            # a row for each list
            reached = {r["list"]: r["reach"] for r in self.rows.groupBy("list").agg(F.max("angle").alias("reach")).collect()}
            reach = np.array([reached.get(k, -1.0) for k in range(len(self.centres))])
            kind = given.schema["id"].dataType.simpleString()
            # without centres all rows are in list -1, which was met
            blind_rows = -1 in reached and len(self.centres) > 0
            open_ = given.join(worst, "id").mapInArrow(_opening(self.centres, reach, blind_rows, probes), f"id {kind}, v array<float>, list int")
            more = _met(self.rows, cut(open_), k)
            found = found.unionByName(more)
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
        out = found.withColumn("place", place).where(F.col("place") <= k).withColumnRenamed("id", self.id_col).withColumnRenamed("query_id", query_id)
        return out if threshold is None else out.where(F.col("score") >= threshold)

    def recall_by_probes(self, queries: DataFrame, k: int, query_id: str = "query_id", vector_col: str = "embedding", most: int = JUDGED_QUERIES) -> list[tuple[float, float]]:
        """For 1, 2, ... probes: the share of the ``k`` truly closest rows that lie in these lists, and the share of all rows that are met; over a sample of about ``most`` queries."""
        asked = queries.select(F.col(query_id).alias("id"), F.col(vector_col).alias("v"))
        asked = cut(_sample(asked, most, asked.count()))
        truth = search(self.rows, asked.withColumnRenamed("id", "query_id"), k, id_col="id", vector_col="v", query_id="query_id").select("query_id", "id")
        order = cut(_placed(_usable(asked, "id", "v"), self.centres, max(1, len(self.centres)), False).select(F.col("id").alias("query_id"), "list", "place"))
        lists = cut(self.rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")))
        hits = truth.join(self.rows.select("id", "list").distinct(), "id").join(order, ["query_id", "list"]).groupBy("place").agg(F.count(F.lit(1)).alias("hits"))
        met = order.join(F.broadcast(lists), "list").groupBy("place").agg(F.sum("n").alias("met"))
        rows = {r["place"]: (r["hits"] or 0, r["met"] or 0) for r in met.join(hits, "place", "full_outer").collect()}
        all_hits, pairs = truth.count(), self.rows.count() * order.select("query_id").distinct().count()
        out, so_far = [], np.zeros(2)
        for place in range(max(1, len(self.centres))):
            so_far += rows.get(place, (0, 0))
            out.append((float(so_far[0] / max(all_hits, 1)), float(so_far[1] / max(pairs, 1))))
        return out

    def probes_for(self, queries: DataFrame, k: int, recall: float = 0.9, **names: str) -> int:
        """The fewest probes that reach ``recall`` on a sample of ``queries``; all lists if none does."""
        measured = self.recall_by_probes(queries, k, **names)
        return next((n for n, (share, _) in enumerate(measured, 1) if share >= recall), len(measured))


def _placed(rows: DataFrame, centres: np.ndarray, probes: int, with_vectors: bool = True) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    if not len(centres):  # no row has a length
        return rows.select("id", *["v"] * with_vectors, F.lit(-1).alias("list"), F.lit(0).alias("place"), F.lit(0.0).alias("angle"))
    return rows.mapInArrow(_placing(centres, probes, with_vectors), f"id {kind}, {'v array<float>, ' * with_vectors}list int, place int, angle double")


def _met(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score): the ``k`` closest rows of each query (id, v, list) in each block of a list that it asks."""
    # a row for each list: bounded by their number
    n_rows = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / (4 * BLOCK_ROWS)).cast("int").alias("parts"))
    n_asked = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("sets"))
    grid = F.broadcast(cut(n_rows.join(n_asked, "list")))
    kinds = [df.schema["id"].dataType.simpleString() for df in (asked, rows)]
    kind = kinds[0] if kinds[0] == kinds[1] else "string"
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = asked.join(grid, "list").select("list", every("parts").alias("r"), block("sets").alias("q"), F.col("id").cast(kind).alias("id"), "v", F.lit(True).alias("asks"))
    b = rows.join(grid, "list").select("list", block("parts").alias("r"), every("sets").alias("q"), F.col("id").cast(kind).alias("id"), "v", F.lit(False).alias("asks"))
    found = a.unionByName(b).groupBy("list", "r", "q").applyInPandas(best_of_block(k), f"query_id {kind}, id {kind}, score double")
    return found.select(F.col("query_id").cast(kinds[0]), F.col("id").cast(kinds[1]).alias("id"), "score")
