import random

import pytest
from pyspark.sql import functions as F

from lorekeel.operators.keyed_table import KEPT_SNAPSHOTS, KeyedTable

SCHEMA = "k string, g int, x long, first long"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def table(spark, folder, **how):
    return KeyedTable(spark, str(folder), schema(spark), ["k", "g"], ["x"], **how)


def plain(batches):
    """Rows of a dict that takes one batch after another."""
    held = {}
    for rows in batches:
        last = {}
        for k, g, x, first in rows:
            last[k, g] = max(last.get((k, g), (x, first)), (x, first))
        for key, (x, first) in last.items():
            held[key] = (x, held.get(key, (x, first))[1])
    return sorted((str(k), g, x, f) for (k, g), (x, f) in held.items())


def rows_of(df):
    return sorted((str(r["k"]), r["g"], r["x"], r["first"]) for r in df.collect())


def random_batches(seed, n):
    rng = random.Random(seed)
    return [[(rng.choice(["a", "b", "c", None]), rng.randint(0, 30), rng.randint(0, 99), rng.randint(0, 99)) for _ in range(rng.randint(1, 60))] for _ in range(n)]


def test_batches_replays_and_versions(spark, tmp_path):
    t, batches = table(spark, tmp_path / "t", buckets=7), random_batches(1, 4)
    for k, rows in enumerate(batches):
        assert t.upsert(spark.createDataFrame(rows, SCHEMA), "w", k)
    assert rows_of(t.read()) == plain(batches)
    for k, rows in enumerate(batches):
        assert not t.upsert(spark.createDataFrame(rows, SCHEMA), "w", k)
    assert rows_of(t.read()) == plain(batches) and rows_of(t.read(2)) == plain(batches[:2])
    assert t.upsert(spark.createDataFrame(batches[0], SCHEMA), "other", 0)  # another writer's numbers are its own
    with pytest.raises(ValueError):
        t.read(99)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=16)
    t.upsert(spark.createDataFrame([("a", g, 0, 0) for g in range(200)], SCHEMA))
    before = t._snapshot()[1]
    one = spark.createDataFrame([("a", 5, 9, 9)], SCHEMA)
    t.upsert(one)
    after, touched = t._snapshot()[1], one.select(t.bucket()).first()[0]
    assert len(before) == 16 and {b for b in before if before[b] != after[b]} == {touched}
    assert t.read(only={touched}).where("x = 9").count() == 1 and t.read().count() == 200


def test_a_broken_off_write_is_not_seen_and_goes(spark, tmp_path, monkeypatch):
    t, batches = table(spark, tmp_path / "t", buckets=3), random_batches(2, 7)
    t.upsert(spark.createDataFrame(batches[0], SCHEMA), "w", 0)
    broken = spark.createDataFrame(batches[1], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.upsert(broken, "w", 1)
    assert rows_of(t.read()) == plain(batches[:1])
    for k, rows in enumerate(batches[1:], 1):
        t.upsert(spark.createDataFrame(rows, SCHEMA), "w", k)
    gone = t.vacuum()
    assert gone and rows_of(t.read()) == plain(batches) and len(t._snapshots()) == KEPT_SNAPSHOTS and t.vacuum() == []
    assert rows_of(t.read(6)) == plain(batches[:6])


def test_streams_that_run_again(spark, tmp_path):
    batches, source = random_batches(3, 4), str(tmp_path / "in")
    t = table(spark, tmp_path / "t", buckets=5)
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if k % 2:
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
            t.upsert_stream(stream, str(tmp_path / "ck"))
            assert rows_of(t.read()) == plain(batches[: k + 1])
    version = t._snapshot()[0]
    # the checkpoint is lost: all micro-batches come again, with the numbers that they had
    t.upsert_stream(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), str(tmp_path / "other"))
    assert rows_of(t.read()) == plain(batches) and t._snapshot()[0] == version


def test_empty_batches_and_wrong_columns(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.read().count() == 0 and t.vacuum() == []
    assert not t.upsert(spark.createDataFrame([], SCHEMA), "w", 0) and t._snapshot()[2] == {"w": 0}
    assert t.upsert(spark.createDataFrame([("a", 1, None, None), ("a", 1, 3, None)], SCHEMA).withColumn("more", F.lit(1)), "w", 1)
    assert rows_of(t.read()) == [("a", 1, 3, None)]
    for keys, update in ((["k"], ["k"]), ([], ["x"]), (["nothing"], [])):
        with pytest.raises(ValueError):
            KeyedTable(spark, str(tmp_path), schema(spark), keys, update)
