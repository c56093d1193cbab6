import datetime
import random
import types

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lorekeel.streaming import metrics, stateful

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
SCHEMA = "k string, ts timestamp, value double"


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def batches():
    """Samples in arrival order: a little out of order inside and between batches, resets, a last batch that moves the watermark on."""
    rng = random.Random(11)
    samples = []
    for k in "abc":
        value = 0.0
        for t in range(0, 3000, 25):
            value = rng.random() if rng.random() < 0.1 else value + rng.random() * 5
            samples.append((k, at(t + rng.random()), value))
    samples.sort(key=lambda s: s[1] + datetime.timedelta(seconds=rng.random() * 90))
    cut = [0, 80, 150, 151, 290, len(samples)]
    return [samples[a:b] for a, b in zip(cut, cut[1:])] + [[("end", at(10**6), 0.0)]]


def played(spark, batches, build, folder, late="2 minutes", restart=True, schema=SCHEMA):
    """Rows that a stream gives out for batches that come one after another; with a query stopped and started anew between any two."""
    source, sink, kept = str(folder / "in"), str(folder / "out"), str(folder / "state")
    spark.createDataFrame([], schema).write.parquet(source)
    with stateful.keyed_state(spark):
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
            if restart or k + 1 == len(batches):
                stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
                metrics.run_to_end(build(metrics.timed(stream, late=late)), sink, kept)
    return spark.read.parquet(sink)


@pytest.mark.parametrize("restart", [True, False])
def test_increases_agree_with_the_batch_version(spark, batches, tmp_path, restart):
    got = played(spark, batches, lambda s: stateful.counter_increase(s, ["k"], length="5 minutes"), tmp_path, restart=restart)
    whole = spark.createDataFrame([r for b in batches for r in b], SCHEMA).where("k <> 'end'")
    expected = metrics.counter_rate(whole, ["k"])
    plain = lambda df: sorted((r["k"], r["window_start"], r["window_end"], round(r["increase"], 6)) for r in df.collect())
    assert plain(got) == plain(expected) and got.count() == 30


def test_runs_agree_with_the_batch_version(spark, batches, tmp_path):
    holds = F.col("value") > 3
    got = played(spark, batches, lambda s: stateful.sustained(s, ["k"], F.col("value") > 3, 60, idle="1 hour"), tmp_path)
    whole = spark.createDataFrame([r for b in batches for r in b], SCHEMA).where("k <> 'end'")
    expected = metrics.sustained(whole, ["k"], holds, 60)
    plain = lambda df: sorted((r["k"], r["since"], r["until"], r["n"]) for r in df.collect())
    assert plain(got.where("ended")) == plain(expected) and got.where("ended").count() > 3
    fired = {(r["k"], r["since"]): r["until"] for r in got.where("not ended").collect()}
    assert set(fired) == {(r["k"], r["since"]) for r in expected.collect()}
    assert all(60 <= (u - s).total_seconds() <= 90 for (_, s), u in fired.items())


def test_late_samples_nulls_and_idle_keys(spark, tmp_path):
    rows = [[("a", at(0), 5.0), ("a", None, 9.0), ("a", at(10), None), (None, at(0), 1.0)], [("b", at(2000), 1.0)], [("b", at(2300), 2.0)], [("a", at(1), 100.0)], [("a", at(9000), 50.0), ("a", at(9001), 60.0), (None, at(9002), 4.0)], [("end", at(10**6), 0.0)], [("end", at(10**6 + 1), 0.0)]]
    got = played(spark, rows, lambda s: stateful.counter_increase(s, ["k"], length="5 minutes", idle="1 hour"), tmp_path)
    found = sorted((str(r["k"]), r["window_start"], r["increase"]) for r in got.where("k <> 'end' or k is null").collect())
    starts = {s: s.replace(tzinfo=datetime.timezone.utc) for _, s, _ in found}
    assert [(k, int((starts[s] - START).total_seconds()), x) for k, s, x in found] == [("None", 0, 0.0), ("None", 9000, 0.0), ("a", 0, 0.0), ("a", 9000, 10.0), ("b", 1800, 0.0), ("b", 2100, 1.0)]


def test_keys_seen_within_the_lateness(spark, tmp_path):
    rows = [[("a", at(0), 1.0), ("b", at(1), 1.0), ("a", at(2), 1.0)], [("a", at(60), 1.0)], [("c", at(5000), 1.0)], [("c", at(5001), 1.0), ("a", at(5002), 1.0)], [("d", at(9000), 1.0)]]
    got = played(spark, rows, lambda s: stateful.first_seen(s, "k"), tmp_path)
    assert sorted(r["k"] for r in got.collect()) == ["a", "a", "b", "c", "d"]


def test_the_sessions_own_setting_comes_back(spark):
    before = spark.conf.get(stateful._PROVIDER, None)
    with stateful.keyed_state(spark):
        assert spark.conf.get(stateful._PROVIDER) == stateful._ROCKS
    assert spark.conf.get(stateful._PROVIDER, None) == before
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    with stateful.keyed_state(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions


class Held:
    """State of one key in memory, with the calls of Spark's map, list and value states that are used."""

    def __init__(self, entries):
        self.entries, self.getMapState, self.getListState, self.getValueState = entries, self.named, self.named, self.named

    def named(self, name, *_):
        return Held(self.entries.setdefault(name, {}))

    def exists(self):
        return bool(self.entries)

    def keys(self):
        return iter(list(self.entries))

    def getValue(self, key):
        return self.entries[key]

    def updateValue(self, key, value):
        self.entries[key] = value

    def removeKey(self, key):
        del self.entries[key]

    def get(self):
        return self.entries.get(0) or iter(self.entries.values())

    def update(self, value):
        self.entries[0] = value

    def appendList(self, values):
        self.entries |= {k: v for k, v in enumerate(values, len(self.entries) + 1)}

    def put(self, values):
        self.entries.clear()
        self.appendList(values)

    def clear(self):
        self.entries.clear()

    def registerTimer(self, at):
        pass

    deleteTimer = registerTimer


def fed(processor, batches):
    """Rows given out for (seconds and values, watermark in seconds), and the most entries that waited."""
    entries, out, most = {}, [], 0
    processor.init(Held(entries))
    for samples, mark in batches:
        frame = pd.DataFrame({"us": [int(t * 1_000_000) for t, _ in samples], "x": [float(x) for _, x in samples]})
        marks = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: mark * 1000)
        for found in processor.handleInputRows(("k",), iter([frame]), marks):
            out += found.itertuples(index=False, name=None)
        most = max(most, len(entries["waiting"]))
    return out, most


@pytest.mark.parametrize("processor", [stateful._Increases(["k"], None, 3_600_000_000), stateful._Runs(["k"], 7_200_000, 600)])
def test_samples_wait_by_the_hour(processor):
    samples = [(t, 1 + t % 7) for t in range(10_000)]
    out, most = fed(processor, [(samples[::2], 0), (samples[1::2], 0), ([], 5000), ([], 20_000)])
    assert most <= 6
    plain, _ = fed(type(processor)(["k"], processor.idle_ms, getattr(processor, "length_us", 600)), [(samples, 20_000)])
    assert sorted(out) == sorted(plain) and len(out) >= 2


def test_a_window_that_a_key_was_idle_in_is_one_row():
    out, _ = fed(stateful._Increases(["k"], 60_000, 300_000_000), [([(0, 1), (10, 3), (200, 10), (210, 14)], 0), ([], 250), ([], 400)])
    assert out == [("k", 0, 6.0)]
