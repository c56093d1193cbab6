"""Windowed metrics over event streams; every function works on a batch or a stream alike.

On a stream, ``late`` sets how long a window waits for late events before its row is final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from lorekeel.session import cut


def timed(events: DataFrame, ts: str = "ts", late: str | None = None) -> DataFrame:
    """``events`` with ``ts`` as a timestamp, and a watermark on a stream."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return rows.withWatermark(ts, late) if rows.isStreaming and late else rows


def _edges(rows: DataFrame) -> DataFrame:
    return rows.withColumn("window_start", F.col("window.start")).withColumn("window_end", F.col("window.end")).drop("window")


def rate(events: DataFrame, keys: list[str], length: str = "5 minutes", slide: str | None = None, seconds: int = 300, ts: str = "ts") -> DataFrame:
    """(window_start, window_end, keys, n, per_second) of each window."""
    frame = F.window(ts, length, slide) if slide else F.window(ts, length)
    out = events.groupBy(frame, *keys).agg(F.count(F.lit(1)).alias("n"))
    return _edges(out.withColumn("per_second", F.col("n") / seconds))


def error_ratio(events: DataFrame, is_error, over: float, length: str = "5 minutes", ts: str = "ts") -> DataFrame:
    """Windows whose share of errors is above ``over``."""
    out = events.groupBy(F.window(ts, length)).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_error).alias("n_errors"))
    return _edges(out.withColumn("ratio", F.col("n_errors") / F.col("n")).where(F.col("ratio") > over))


def quantiles(events: DataFrame, value: str, shares: list[float], length: str, ts: str = "ts", accuracy: int = 10_000) -> DataFrame:
    """(window_start, window_end, q0, q1, ...) by a mergeable sketch."""
    found = F.percentile_approx(value, shares, accuracy).alias("q")
    out = events.groupBy(F.window(ts, length)).agg(found)
    return _edges(out.select("window", *(F.col("q")[k].alias(f"q{k}") for k in range(len(shares)))))


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """(keys, q0, q1, ...): quantiles of each key by linear interpolation between the two nearest values, null values aside. For batches.

    Rows are sorted over the cluster, by key and value, and numbered by the sizes of the parts before them, so that no key is held by one task.
    """
    placed = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")).repartitionByRange(*keys, "_v").sortWithinPartitions(*keys, "_v")
    placed = cut(placed.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    # a row for each part and key that it holds; a key's rows lie together, so a part's first id of a key tells the place in it
    parts = placed.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), (F.lit(s) * (F.col("_all") - 1)).alias("at")) for k, s in enumerate(shares)))).alias("_s")
    asked = parts.select(*keys, "_part", "_n", "_first", "_before", each)
    near = F.explode(F.array_distinct(F.array(F.floor("_s.at"), F.ceil("_s.at")))).alias("_rank")
    ids = asked.select(*keys, "_n", "_before", "_first", "_s", near).where("_rank >= _before and _rank < _before + _n").select(*keys, "_s", "_rank", (F.col("_first") + F.col("_rank") - F.col("_before")).alias("_id"))
    held = placed.join(ids.drop(*keys), "_id").withColumn("_w", 1 - F.abs(F.col("_rank") - F.col("_s.at")))
    out = held.groupBy(*keys, "_s.k").agg(F.sum(F.col("_w") * F.col("_v")).alias("_q"))
    return out.groupBy(*keys).agg(*(F.max(F.when(F.col("k") == k, F.col("_q"))).alias(f"q{k}") for k in range(len(shares))))


def bucket_quantiles(samples: DataFrame, keys: list[str], shares: list[float], series: list[str] | None = None, le: str = "le", value: str = "value", ts: str = "ts", length: str = "5 minutes") -> DataFrame:
    """(window_start, window_end, keys, n, q0, q1, ...) from cumulative histogram buckets: samples of counters, one series for each of ``series`` (the keys, if none are named) and upper bound ``le``.

    Each bucket's counter has its increase in a window, resets included; increases of series with one key add up. Inside the bucket in which a share falls the quantile is
    interpolated between its bounds; the lowest bucket begins at 0 if its bound is positive, else it is the bound itself. A share in the last bucket (``+Inf``) is the bound below it; a window
    without increase, or without an infinite bucket, or with that one alone, has null quantiles. A share below 0 or above 1 is minus or plus infinity. For batches.
    """
    bound = F.when(F.lower(F.col(le).cast("string")).isin("+inf", "inf", "infinity", "+infinity"), F.lit(float("inf"))).otherwise(F.expr(f"try_cast(`{le}` as double)"))
    rows = samples.withColumn("_le", bound).where("_le is not null and not isnan(_le)")
    steps = counter_rate(rows, [*dict.fromkeys([*keys, *(series or [])]), "_le"], value, ts, length)
    each = steps.groupBy("window_start", "window_end", *keys, "_le").agg(F.sum("increase").alias("c"))
    listed = each.groupBy("window_start", "window_end", *keys).agg(F.array_sort(F.collect_list(F.struct(F.col("_le").alias("le"), "c"))).alias("b"))
    # counts that fall from a bucket to the next come from samples that were not taken at once; the running most mends them
    listed = listed.withColumn("b", F.transform("b", lambda x, i: F.struct(x["le"].alias("le"), F.array_max(F.slice("b", F.lit(1), i + 1)["c"]).alias("c"))))
    last = F.try_element_at("b", F.lit(-1))
    listed = listed.withColumn("n", F.when(last["le"] == float("inf"), last["c"]))
    usable = (F.col("n") > 0) & (F.size("b") > 1)

    def quantile(share: float):
        if share < 0 or share > 1:
            return F.when(usable, F.lit(float("-inf") if share < 0 else float("inf")))
        rank = F.lit(share) * F.col("n")
        at = F.array_position(F.transform("b", lambda x: x["c"] >= rank), True).cast("int")
        here, below = F.try_element_at("b", at), F.when(at > 1, F.try_element_at("b", at - 1))
        low = F.when(at > 1, below["le"]).otherwise(0.0)
        part = (rank - F.coalesce(below["c"], F.lit(0.0))) / F.nullif(here["c"] - F.coalesce(below["c"], F.lit(0.0)), F.lit(0.0))
        inside = F.when((at == 1) & (here["le"] <= 0), here["le"]).otherwise(low + (here["le"] - low) * F.coalesce(part, F.lit(1.0)))
        return F.when(usable, F.when(at == F.size("b"), F.try_element_at("b", F.lit(-2))["le"]).otherwise(inside))

    return listed.select("window_start", "window_end", *keys, "n", *(quantile(s).alias(f"q{k}") for k, s in enumerate(shares)))


def log_counts(logs: DataFrame, schema: str = "level string, message string", pattern: str = ".*", length: str = "1 minute", ts: str = "ts", raw: str = "line") -> DataFrame:
    """(window_start, window_end, level, n) of JSON log lines whose level fits a pattern; lines that are no JSON have no level."""
    rows = logs.withColumn("level", F.from_json(raw, schema)["level"]).where(F.col("level").rlike(f"^(?:{pattern})$"))
    return _edges(rows.groupBy(F.window(ts, length), "level").agg(F.count(F.lit(1)).alias("n")))


def sessions(events: DataFrame, keys: list[str], gap: str = "30 minutes", ts: str = "ts") -> DataFrame:
    """(window_start, window_end, keys, n) of runs of events with less than ``gap`` between them; a session ends ``gap`` after its last event."""
    out = events.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return _edges(out)


def counter_rate(samples: DataFrame, keys: list[str], value: str = "value", ts: str = "ts", length: str = "5 minutes") -> DataFrame:
    """(window_start, window_end, keys, increase) of counters; a fall is a reset, after which the count starts at 0. For batches."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(ts))
    step = F.when(before.isNull(), 0.0).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    out = samples.withColumn("_step", step).groupBy(F.window(ts, length), *keys).agg(F.sum("_step").alias("increase"))
    return _edges(out)


def over_limit(samples: DataFrame, used: str = "used", limit: str = "available", over: float = 0.9) -> DataFrame:
    """``samples`` with ``ratio`` of used to available, above ``over``; without a positive limit there is no ratio."""
    ratio = F.col(used) / F.nullif(F.greatest(F.col(limit), F.lit(0)), F.lit(0))
    return samples.withColumn("ratio", ratio).where(F.col("ratio") > over)


def sustained(samples: DataFrame, keys: list[str], holds, seconds: int = 300, ts: str = "ts") -> DataFrame:
    """(keys, since, until, n) of runs of successive samples for which a condition holds, that last ``seconds`` or longer. For batches."""
    order = Window.partitionBy(*keys).orderBy(ts)
    marked = samples.select(*keys, ts, F.coalesce(holds, F.lit(False)).alias("_holds"))
    runs = marked.withColumn("_run", F.sum((~F.col("_holds")).cast("int")).over(order)).where("_holds")
    spans = runs.groupBy(*keys, "_run").agg(F.min(ts).alias("since"), F.max(ts).alias("until"), F.count(F.lit(1)).alias("n")).drop("_run")
    return spans.where(F.unix_micros("until") - F.unix_micros("since") >= seconds * 1_000_000)


def first_seen(rows: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows whose key was not seen before; on a stream the seen keys are kept as state."""
    return rows.dropDuplicates([key])


def run_to_end(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write all that is there to Parquet, once, and stop; a rerun goes on where this one ended."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
