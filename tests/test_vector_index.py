import numpy as np
import pytest
from pyspark.sql import functions as F

from lorekeel.operators.vector_index import VectorIndex, fit_centres
from lorekeel.operators.vectors import search
from lorekeel.plans import registry

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, v, first=0, ids="vec_id"):
    return spark.createDataFrame([(first + k, x.tolist()) for k, x in enumerate(v)], SCHEMA.replace("vec_id", ids))


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16))
    return centres[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 16)) * 0.25


@pytest.fixture(scope="module")
def index(spark, clustered):
    return VectorIndex.build(frame(spark, clustered), 60)


def rows_of(df):
    return sorted((r["query_id"], r["place"], r["vec_id"], round(r["score"], 5)) for r in df.collect())


def test_every_row_is_in_the_list_of_its_nearest_centre(index, clustered):
    rows = index.rows.toPandas()
    assert sorted(rows["id"]) == list(range(3000))
    unit = clustered / np.linalg.norm(clustered, axis=1)[:, None]
    score = unit @ index.centres.T
    assert np.allclose(score[rows["id"], rows["list"]], score[rows["id"]].max(axis=1), atol=1e-6)


def test_recall_and_work_on_clustered_vectors(spark, index, clustered):
    asked = frame(spark, clustered[::50] + 0.01, ids="query_id")
    measured = index.recall_by_probes(asked, 10)
    assert [m[0] for m in measured] == sorted(m[0] for m in measured) and measured[-1][0] == 1.0 and abs(measured[-1][1] - 1) < 1e-9
    probes = index.probes_for(asked, 10)
    assert measured[probes - 1][0] >= 0.9 and measured[probes - 1][1] < 0.1
    found, truth = rows_of(index.search(asked, 10, probes)), rows_of(search(frame(spark, clustered), asked, 10))
    hit = {(q, i) for q, _, i, _ in found} & {(q, i) for q, _, i, _ in truth}
    assert len(hit) >= 0.9 * len(truth) and abs(len(hit) / len(truth) - measured[probes - 1][0]) < 1e-9


def test_exact_search_with_few_probes_loses_nothing(spark, index, clustered):
    rng = np.random.default_rng(4)
    asked = frame(spark, np.concatenate([clustered[::100], rng.normal(size=(20, 16))]), ids="query_id")
    assert rows_of(index.search(asked, 7, probes=1, exact=True)) == rows_of(search(frame(spark, clustered), asked, 7))
    over = index.search(asked, 7, probes=1, exact=True, threshold=0.9)
    assert rows_of(over) == rows_of(search(frame(spark, clustered), asked, 7, 0.9))


def test_no_length_nulls_ties_and_few_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [0.0, -1.0]), (2, [2.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    index = VectorIndex.build(df, 2)
    asked = spark.createDataFrame([(1, [3.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.0, 1.0])], SCHEMA.replace("vec_id", "query_id"))
    for k in (1, 2, 3, 9):
        assert rows_of(index.search(asked, k, probes=1, exact=True)) == rows_of(search(df, asked, k))
    assert VectorIndex.build(df.where("vec_id = 1"), 5).search(asked, 3, exact=True).count() == 3
    assert VectorIndex.build(df.where("false")).search(asked, 3, exact=True).count() == 0
    none = VectorIndex.build(df.where("vec_id = 3")).search(asked, 3, exact=True)
    assert rows_of(none) == [(1, 1, 3, 0.0), (2, 1, 3, 0.0), (4, 1, 3, 0.0)]
    with pytest.raises(ValueError):
        fit_centres(df, 0)


def test_a_hot_list_is_many_tasks_and_added_rows_are_found(spark, monkeypatch):
    from lorekeel.operators import vector_index

    monkeypatch.setattr(vector_index, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(5)
    hot = np.concatenate([np.tile([1.0, 2.0, 3.0], (400, 1)) + rng.normal(size=(400, 3)) * 1e-3, rng.normal(size=(200, 3))])
    index = VectorIndex.build(frame(spark, hot[:500]), 8).added(frame(spark, hot[500:], 500))
    asked = frame(spark, hot[::40], ids="query_id")
    assert rows_of(index.search(asked, 5, probes=1, exact=True)) == rows_of(search(frame(spark, hot), asked, 5))


def test_saved_and_loaded(spark, index, clustered, tmp_path):
    index.save(str(tmp_path / "i"))
    again = VectorIndex.load(spark, str(tmp_path / "i"))
    asked = frame(spark, clustered[::300], ids="query_id")
    assert np.allclose(again.centres, index.centres) and rows_of(again.search(asked, 5, 3)) == rows_of(index.search(asked, 5, 3))


def test_recall_of_the_registered_search(spark, small):
    found = registry.QUERIES["index_search"](spark, small)
    truth = registry._searched(spark, small, 10)
    n = truth.count()
    assert n == 10 * spark.read.parquet(f"{small}/embeddings.parquet").where("vec_id % 50 = 0").count()
    assert truth.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"]).count() >= 0.9 * n
    assert found.where(F.col("place") > 10).count() == 0
