"""Operator 10, token counts as delta-maintained rollups.

A rollup lives in a folder that the cluster shares. A batch of changes (insert, revise, delete) is
resolved against what earlier batches left of each (document, tokenizer version), and
becomes signed sums by source, language and version: what a document counted before is taken
away, what it counts now is added. Totals are the plain sum of the deltas of committed batches.

A commit costs the batch and what it touches, not the history. Changes lie in ``BUCKETS`` folders by document and version, and a
batch looks up only the buckets that it has rows in. Runs of ``FAN`` batches are merged into one, runs of
``FAN`` such runs again, so that a look-up reads a number of runs that grows with the logarithm of the number of batches, and a
record is written again as often. Totals are kept as running sums beside the deltas.

A batch is written in steps: its changes, its deltas, the totals after it, the merges that it completes, then its commit, one
small file that appears by a rename at the next free place, with the last few batches in it, so that nothing lists all commits. Only committed batches are read. A batch that is committed again is not
applied again, and one that broke off is written anew over its remains, so replays and lost
drivers or executors change nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeel.llm.batches import map_batches
from lorekeel.llm.word_bpe import counting
from lorekeel.session import cut

#: Folders that a run's records are dealt into, and runs that are merged into one.
BUCKETS, FAN = 64, 4

_KEYS = ["doc_id", "version"]
_GROUP = ["source", "lang", "version"]
_COMMIT = "batch int, recent array<int>"


def count_tokens(docs: DataFrame, vocabulary: str, version: str) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens) of every row; a null or empty text counts 0, a text of any length is counted whole, an empty table gives no rows; repeated rows count each, other columns are not read."""
    given = docs.select("doc_id", "source", "lang", "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name != "text")
    return map_batches(given, counting(vocabulary), f"{kinds}, n_tokens long").withColumn("version", F.lit(version))


class Rollup:
    """Totals by source, language and tokenizer version under ``root``; document ids are of ``id_type``."""

    def __init__(self, spark: SparkSession, root: str, id_type: str = "long") -> None:
        self.spark, self.root = spark, root.rstrip("/")
        # named, as an empty run has no file to tell it
        self.records = f"doc_id {id_type}, version string, source string, lang string, n_tokens long, at int, bucket int"

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/batch={batch}"

    def _there(self, place: int) -> bool:
        """Whether a batch is committed at a place; a broken-off one has no file there."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/place={place}/part-*")
        return bool(list(at.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(at) or []))

    def _commits(self, places: str) -> DataFrame:
        return self.spark.read.schema(_COMMIT).parquet(f"{self.root}/commits/{places}")

    def _head(self) -> tuple[int, list[int]]:
        """How many batches are committed, and the last ``FAN`` of them.

        Places are taken one after another, so the last is found by doubling and halving: looks that grow with the logarithm of the number of batches, and one file read.
        """
        over = 1
        while self._there(over):
            over *= 2
        under = over // 2
        while over - under > 1:
            middle = (under + over) // 2
            under, over = (middle, over) if self._there(middle) else (under, middle)
        return (under, list(self._commits(f"place={under}").first()["recent"])) if under else (0, [])

    def _is_committed(self, batch: int, n: int) -> bool:
        """Whether ``batch`` is one of the first ``n``, which are in order: a search by halves."""
        low, high = 1, n
        while low <= high:
            middle = (low + high) // 2
            found = self._commits(f"place={middle}").first()["batch"]
            if found == batch:
                return True
            low, high = (middle + 1, high) if found < batch else (low, middle - 1)
        return False

    def committed(self) -> list[int]:
        """All batches that count, in order: a list of every commit, which neither ``commit`` nor ``totals`` needs."""
        try:
            return [r["batch"] for r in self._commits("").select("batch").sort("batch").collect()]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _runs(self, done: list[int], before: int = 0) -> list[str]:
        """Folders of the runs that together hold the changes of ``before`` batches and then ``done``: the fewest aligned ones. ``done`` may be the last ``FAN`` only."""
        out, at, n = [], 0, before + len(done)
        while at < n:
            level = 0
            while at % FAN ** (level + 1) == 0 and at + FAN ** (level + 1) <= n:
                level += 1
            at += FAN**level
            out.append(f"{self.root}/merged/level={level}/to={at}" if level else self._path("changes", done[at - before - 1]))
        return out

    def _latest(self, runs: list[str], touched: DataFrame | None = None) -> DataFrame | None:
        """The latest record of each document and version in ``runs``, deleted ones (null counts) included; only of the buckets ``touched``, if given."""
        if not runs:
            return None
        rows = reduce(DataFrame.unionByName, (self._read(r) for r in runs))
        if touched is not None:
            # at most BUCKETS numbers; a list of literals prunes folders before they are read
            rows = rows.where(F.col("bucket").isin([r["bucket"] for r in touched.select("bucket").distinct().collect()]))
        fields = F.struct("at", "source", "lang", "n_tokens")
        last = rows.groupBy("bucket", *_KEYS).agg(F.max_by(fields, "at").alias("r"))
        return last.select("bucket", *_KEYS, "r.at", "r.source", "r.lang", "r.n_tokens")

    def current(self, batches: list[int]) -> DataFrame | None:
        """The latest record of each document and version over the first ``batches``, deleted ones (null counts) included."""
        last = self._latest(self._runs(batches))
        return None if last is None else last.drop("bucket", "at")

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.records).parquet(path)

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply ``changes`` (op, doc_id, source, lang, version, n_tokens, and seq if a document may change twice) as ``batch``.

        Of several changes to one document and version the one with the largest seq counts; then, as
        ties must not matter, the largest (op, n_tokens, source, lang). ``insert`` and ``revise`` both set the count, whether or not
        there was one, and may move a document to another source or language. ``delete``, and a null
        count, take it away, if there was one. Rows that repeat one document and version in a batch are one change. Null ids, sources, languages and versions are values as any other. An
        empty batch commits nothing but itself. Returns whether the batch was new; batches must come in order.
        """
        n, recent = self._head()
        if recent and batch <= recent[-1]:
            if batch in recent or self._is_committed(batch, n):
                return False
            raise ValueError(f"batch {batch} comes after {recent[-1]}")
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        order = F.struct(seq.cast("long").alias("seq"), "op", F.coalesce("n_tokens", F.lit(-1)).alias("n"), F.col("source").alias("s"), F.col("lang").alias("l"))
        kept = F.when(F.col("op") == "delete", F.lit(None)).otherwise(F.col("n_tokens")).cast("long")
        last = changes.groupBy(*_KEYS).agg(F.max_by(F.struct("source", "lang", kept.alias("n_tokens")), order).alias("r"))
        bucket = F.pmod(F.xxhash64(*_KEYS), F.lit(BUCKETS)).cast("int").alias("bucket")
        self._write(last.select(*_KEYS, "r.source", "r.lang", "r.n_tokens", F.lit(n).cast("int").alias("at"), bucket), self._path("changes", batch))

        new = self._read(self._path("changes", batch))
        signed = new.where("n_tokens is not null").select(*_GROUP, F.lit(1).alias("sign"), "n_tokens")
        old = self._latest(self._runs(recent, n - len(recent)), new)
        if old is not None:
            same = old["doc_id"].eqNullSafe(new["doc_id"]) & old["version"].eqNullSafe(new["version"])
            gone = old.join(new.select(*_KEYS), same, "left_semi").where("n_tokens is not null")
            signed = signed.unionByName(gone.select(*_GROUP, F.lit(-1).alias("sign"), "n_tokens"))
        deltas = signed.groupBy(*_GROUP).agg(F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
        deltas.write.mode("overwrite").parquet(self._path("deltas", batch))
        sums = self.spark.read.parquet(self._path("deltas", batch))
        if recent:
            sums = sums.unionByName(self.spark.read.parquet(self._path("totals", recent[-1])))
        sums = sums.groupBy(*_GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.write.mode("overwrite").parquet(self._path("totals", batch))

        n, level, recent = n + 1, 1, [*recent, batch][-FAN:]
        while n % FAN**level == 0:
            step = FAN ** (level - 1)
            parts = [self._path("changes", recent[k - n - 1]) if level == 1 else f"{self.root}/merged/level={level - 1}/to={k}" for k in range(n - FAN**level + step, n + 1, step)]
            self._write(self._latest(parts), f"{self.root}/merged/level={level}/to={n}")
            level += 1
        self.spark.createDataFrame([(batch, recent)], _COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/place={n}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) over all committed batches, without groups that have no document left."""
        _, recent = self._head()
        if not recent:
            return self.spark.createDataFrame([], "source string, lang string, version string, n_docs long, n_tokens long")
        return self.spark.read.parquet(self._path("totals", recent[-1])).select(*_GROUP, "n_docs", "n_tokens").where("n_docs <> 0")

    def take(self) -> DataFrame:
        """The totals, written apart from the rollup, whose files then go: for a rollup that was made for one result."""
        out = cut(self.totals())
        self.spark.range(0).write.mode("overwrite").parquet(self.root)
        return out
