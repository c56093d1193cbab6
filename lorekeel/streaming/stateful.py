"""Stream operators with state and timers: counters with resets, conditions that last, keys seen before.

Samples wait in the state of their key until the watermark has passed them, then are taken in the order of their
times, so late and unordered ones count where they belong. A key holds its waiting samples, an hour of them together, one last sample and its open window or run; a key idle
for ``idle`` is forgotten, if that is given. Samples go into state and out of it as arrays, and a task has those of one key and hour at once. Results agree with the batch functions of ``metrics`` as far as the watermark has come.
"""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: A sample as it waits, the span of times that waits as one entry of the state, and the samples that a task collects before it writes them there.
_SAMPLE = np.dtype([("us", "<i8"), ("x", "<f8")])
_SPAN_US = 3_600_000_000
_COLLECTED = 1 << 18
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def keyed_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which state with timers needs, and deal it to ``partitions``, which a query keeps from its first start on.

    The session's own settings come back after.
    """
    wanted = {_PROVIDER: _ROCKS} | ({} if partitions is None else {"spark.sql.shuffle.partitions": str(partitions)})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class _Ordered(StatefulProcessor):
    """Hands the samples (ts in microseconds, x) of a key on in order of their times, once the watermark has passed them."""

    state = "ts long"  # what a subclass remembers between samples

    def __init__(self, keys: list[str], idle_ms: int | None) -> None:
        self.keys, self.idle_ms = keys, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        # by hour, first time and a number of its own
        self.waiting = handle.getMapState("waiting", "hour long, first long, place long", "samples binary")
        self.memory = handle.getValueState("memory", self.state)
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names, fresh = self._names(), []
        for frame in rows:
            samples = np.empty(len(frame), _SAMPLE)
            # whole microseconds since 1970, as the sender cast them
            samples["us"], samples["x"] = frame["us"].astype("int64"), frame["x"].astype(float)
            fresh.append(samples)
            if sum(map(len, fresh)) >= _COLLECTED:
                self._keep(np.concatenate(fresh), names)
                fresh = []
        if fresh:
            self._keep(np.concatenate(fresh), names)
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs(), names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        yield from self._advance(key, mark, self._names())

    def _names(self) -> list[tuple[int, int, int]]:
        return [tuple(name) for name in self.waiting.keys()] if self.waiting.exists() else []

    def _keep(self, samples: np.ndarray, names: list) -> None:
        """Let samples wait, and add what they wait under to ``names``."""
        place = 1 + max((name[2] for name in names), default=-1)
        samples = samples[np.argsort(samples["us"], kind="stable")]
        hours = samples["us"] // _SPAN_US
        for part in np.split(samples, np.flatnonzero(np.diff(hours)) + 1):
            if len(part):
                name = (int(part["us"][0] // _SPAN_US), int(part["us"][0]), place)
                self.waiting.updateValue(name, (part.tobytes(),))
                names.append(name)

    def _advance(self, key, mark_ms: int, names: list) -> Iterator[pd.DataFrame]:
        mark = mark_ms * 1000
        memory = self.memory.get() if self.memory.exists() else None
        out, left = [], []
        for _, group in itertools.groupby(sorted(names), key=lambda name: name[0]):
            mine = list(group)
            if mine[0][1] > mark:
                left += mine
                continue
            samples = np.concatenate([np.frombuffer(self.waiting.getValue(name)[0], _SAMPLE) for name in mine])
            samples = samples[np.lexsort((samples["x"], samples["us"]))]
            due = int(np.searchsorted(samples["us"], mark, "right"))
            found, memory = self.take(samples["us"][:due], samples["x"][:due], memory)
            out += found
            for name in mine:
                self.waiting.removeKey(name)
            self._keep(samples[due:], left)
        found, memory = self.settle(memory, mark)
        out += found
        forget = memory is not None and not left and self.forgotten(memory, mark)
        if memory is not None and not forget:
            self.memory.update(memory)
        elif self.memory.exists():
            self.memory.clear()
        self._wake(left, None if forget else memory, mark_ms)
        if out:
            yield pd.DataFrame([(*key, *row) for row in out], columns=[*self.keys, *self.columns])

    def _wake(self, names: list, memory: tuple | None, mark_ms: int) -> None:
        """One timer a key: for its first waiting sample, or what it remembers."""
        if names:
            at = -(-min(name[1] for name in names) // 1000)
        elif memory is not None and (due := self.due(memory)) is not None:
            at = -(-due // 1000)
        else:
            at = None
        old = self.timer.get()[0] if self.timer.exists() else None
        if at == old:
            return
        if old is not None:
            self.handle.deleteTimer(old)
            self.timer.clear()
        if at is not None:
            at = max(at, mark_ms + 1)
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def apart(self, memory: tuple, us: int) -> bool:
        """Whether the key was idle from what it remembers up to a time."""
        return self.idle_ms is not None and memory[0] + self.idle_ms * 1000 <= us

    def gaps(self, us: np.ndarray, memory: tuple | None) -> np.ndarray:
        """Whether the key was idle before each sample; not before its first."""
        before = np.append(us[0] if memory is None else memory[0], us[:-1])
        return np.zeros(len(us), bool) if self.idle_ms is None else (us - before >= self.idle_ms * 1000) & ((memory is not None) | (np.arange(len(us)) > 0))

    def forgotten(self, memory: tuple, us: int) -> bool:
        return self.apart(memory, us)

    def due(self, memory: tuple) -> int | None:
        """When something is to be given out, or forgotten, though no sample comes."""
        return None if self.idle_ms is None else memory[0] + self.idle_ms * 1000

    def close(self) -> None:
        pass


class _Increases(_Ordered):
    """The increase of a counter in each window, given out when the watermark has passed its end."""

    state, columns = "ts long, value double, window long, increase double, open boolean", ["window_us", "increase"]

    def __init__(self, keys: list[str], idle_ms: int | None, length_us: int) -> None:
        super().__init__(keys, idle_ms)
        self.length_us = length_us

    def take(self, us: np.ndarray, x: np.ndarray, memory: tuple | None) -> tuple[list, tuple | None]:
        if not len(us):
            return [], memory
        before = np.append(x[0] if memory is None else memory[1], x[:-1])
        with np.errstate(invalid="ignore"):
            step = np.where(x < before, x, x - before)
        step[self.gaps(us, memory)] = 0.0
        if memory is None:
            step[0] = 0.0
        window = us // self.length_us * self.length_us
        first = np.flatnonzero(np.append(True, np.diff(window) != 0))
        sums = list(zip(window[first].tolist(), np.add.reduceat(step, first).tolist()))
        if memory is not None and memory[4]:
            if memory[2] == sums[0][0]:
                sums[0] = (memory[2], memory[3] + sums[0][1])
            else:
                sums.insert(0, (memory[2], memory[3]))
        return sums[:-1], (int(us[-1]), float(x[-1]), *sums[-1], True)

    def settle(self, memory: tuple | None, mark_us: int) -> tuple[list, tuple | None]:
        if memory is None or not memory[4] or memory[2] + self.length_us > mark_us:
            return [], memory
        return [(memory[2], memory[3])], (*memory[:4], False)

    def forgotten(self, memory: tuple, us: int) -> bool:
        return not memory[4] and self.apart(memory, us)

    def due(self, memory: tuple) -> int | None:
        return memory[2] + self.length_us if memory[4] else super().due(memory)


class _Runs(_Ordered):
    """Runs of samples for which a condition holds and that last long enough: once when they do, once when they end."""

    state, columns = "ts long, since long, n long, told boolean", ["since_us", "until_us", "n", "ended"]

    def __init__(self, keys: list[str], idle_ms: int | None, seconds: int) -> None:
        super().__init__(keys, idle_ms)
        self.least_us = seconds * 1_000_000

    def take(self, us: np.ndarray, x: np.ndarray, memory: tuple | None) -> tuple[list, tuple | None]:
        if not len(us):
            return [], memory
        holds, gap = x != 0, self.gaps(us, memory)
        broken = ~holds | gap
        out = []
        # a run that goes on has its start, its length so far and whether it was told from before
        goes_on = memory is not None and not broken[0]
        if memory is not None and not goes_on and memory[3]:
            out.append((memory[1], memory[0], memory[2], True))
        first = np.flatnonzero(holds & (gap | ~np.append(goes_on, holds[:-1])))
        last = np.flatnonzero(holds & np.append(broken[1:], True))
        since, n_before, told = us[first], np.zeros(len(first), np.int64), np.zeros(len(first), bool)
        if goes_on:
            first, since, n_before, told = np.append(0, first), np.append(memory[1], since), np.append(memory[2], n_before), np.append(memory[3], told)
        enough = np.maximum(np.searchsorted(us, since + self.least_us), first)
        lasting, open_run = told | (enough <= last), holds[-1]
        for k in np.flatnonzero(lasting).tolist():
            if not told[k]:
                out.append((int(since[k]), int(us[enough[k]]), int(n_before[k] + enough[k] - first[k] + 1), False))
            if k + 1 < len(first) or not open_run:
                out.append((int(since[k]), int(us[last[k]]), int(n_before[k] + last[k] - first[k] + 1), True))
        return out, (int(us[-1]), int(since[-1]), int(n_before[-1] + last[-1] - first[-1] + 1), bool(lasting[-1])) if open_run else None

    def settle(self, memory: tuple | None, mark_us: int) -> tuple[list, tuple | None]:
        # a run that no sample follows any more has ended
        if memory is not None and memory[3] and self.apart(memory, mark_us):
            return [(memory[1], memory[0], memory[2], True)], None
        return [], memory

def _milliseconds(duration: str | None) -> int | None:
    return None if duration is None else int(pd.Timedelta(duration).value // 1_000_000)


def _transformed(samples: DataFrame, keys: list[str], x, ts: str, processor: _Ordered, columns: str) -> DataFrame:
    given = samples.where(F.col(ts).isNotNull() & x.isNotNull()).select(*keys, F.col(ts), F.unix_micros(ts).alias("us"), x.cast("double").alias("x"))
    schema = StructType([*(given.schema[k] for k in keys), *StructType.fromDDL(columns).fields])
    return given.groupBy(*keys).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def counter_increase(samples: DataFrame, keys: list[str], value: str = "value", ts: str = "ts", length: str = "5 minutes", idle: str | None = None) -> DataFrame:
    """(keys, window_start, window_end, increase) of counters on a stream with a watermark on ``ts``: a row for each window that has a sample, once the watermark has passed its end.

    A fall is a reset, after which the count starts at 0; the first sample of a key, or the first after it was idle for ``idle``, increases nothing. Samples that tie in time are taken by their
    values. Samples later than the watermark are dropped, those without a time or value are left out.
    """
    length_us = _milliseconds(length) * 1000
    found = _transformed(samples, keys, F.col(value), ts, _Increases(keys, _milliseconds(idle), length_us), "window_us long, increase double")
    return found.select(*keys, F.timestamp_micros("window_us").alias("window_start"), F.timestamp_micros(F.col("window_us") + length_us).alias("window_end"), "increase")


def sustained(samples: DataFrame, keys: list[str], holds, seconds: int = 300, ts: str = "ts", idle: str | None = None) -> DataFrame:
    """(keys, since, until, n, ended) of runs of samples, on a stream with a watermark on ``ts``, for which a condition holds for ``seconds`` or longer.

    A run is told once when it has lasted so long (not ended, as an alert that fires), and once when a sample follows for which the condition does not hold, or with ``idle`` when none has
    followed for that long (ended: the run as a whole). A null condition does not hold; samples that tie in time count as not holding first.
    """
    found = _transformed(samples, keys, F.coalesce(holds, F.lit(False)).cast("int"), ts, _Runs(keys, _milliseconds(idle), seconds), "since_us long, until_us long, n long, ended boolean")
    return found.select(*keys, F.timestamp_micros("since_us").alias("since"), F.timestamp_micros("until_us").alias("until"), "n", "ended")


def first_seen(rows: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows of a stream whose key was not seen within the lateness of its watermark: what is older is forgotten, so the state is bounded. Null keys are one key."""
    return rows.dropDuplicatesWithinWatermark([key])
