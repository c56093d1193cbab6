import numpy as np

from lorekeel.operators.projection import principal_components

SCHEMA = "vec_id long, embedding array<float>"


def plain(v, n):
    v = v - v.mean(axis=0)
    _, _, axes = np.linalg.svd(v, full_matrices=False)
    axes = axes[:n] * np.sign(axes[:n][np.arange(len(axes[:n])), np.abs(axes[:n]).argmax(axis=1)])[:, None]
    return v @ axes.T


def test_coordinates_against_a_decomposition(spark, small):
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(300, 6)) * [5, 3, 2, 1, 0.5, 0.1] + 10).astype(np.float32)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)] + [(900, None), (901, [])], SCHEMA)
    got = {r["vec_id"]: r["coordinates"] for r in principal_components(df, 3).collect()}
    assert sorted(got) == list(range(300)) and np.allclose([got[k] for k in range(300)], plain(v.astype(float), 3), atol=1e-4)
    given = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = given.orderBy("vec_id").collect()
    both = {r["vec_id"]: r["coordinates"] for r in principal_components(given).collect()}
    assert np.allclose([both[r["vec_id"]] for r in rows], plain(np.array([r["embedding"] for r in rows], float), 2), atol=1e-4)


def test_few_rows_and_columns(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)
    assert [r["coordinates"] for r in principal_components(one).collect()] == [[0.0, 0.0]]
    assert principal_components(one.where("false")).count() == 0
    two = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], SCHEMA)
    got = {r["vec_id"]: r["coordinates"] for r in principal_components(two).collect()}
    assert np.allclose([got[1], got[2]], [[-2.5, 0], [2.5, 0]], atol=1e-6)
    narrow = spark.createDataFrame([(k, [float(k)]) for k in range(3)], SCHEMA)
    assert sorted(r["coordinates"] for r in principal_components(narrow).collect()) == [[-1.0, 0.0], [0.0, 0.0], [1.0, 0.0]]
