"""Tables merged by key, in buckets: an upsert rewrites only the buckets that it touches, and a replayed one changes nothing.

Rows lie in folders of a bucket and a version. A snapshot names the folder of every bucket and, for each writer, the last batch that it has
merged; it is one small file that Spark's committer puts in place whole, so readers see a batch wholly or not at all. What a broken-off write left
behind is in no snapshot, and goes with the next ``vacuum``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lorekeel.operators.incremental import merged
from lorekeel.session import cut, removed

#: Buckets of a table; its snapshot holds as many names.
BUCKETS = 64
#: Snapshots that stay readable.
KEPT_SNAPSHOTS = 3
_SNAPSHOT = "version long, folders map<int,string>, batches map<string,long>"


class KeyedTable:
    """A table of ``schema`` under ``root`` with one row for each of ``keys``; a new row of a known key replaces the ``update`` columns. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], update: list[str], buckets: int = BUCKETS) -> None:
        unknown = {*keys, *update} - set(schema.names)
        if unknown or not keys or set(keys) & set(update):
            raise ValueError(f"keys and update columns are columns of the table, and different ones: {sorted(unknown) or keys}")
        self.spark, self.root, self.schema, self.keys, self.update, self.buckets = spark, root.rstrip("/"), schema, keys, update, buckets

    def _snapshots(self) -> list[int]:
        try:
            found = self.spark.read.schema(_SNAPSHOT).parquet(f"{self.root}/snapshots")
            return sorted(r["version"] for r in found.select("version").collect())
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _snapshot(self, version: int | None = None) -> tuple[int, dict[int, str], dict[str, int]]:
        """Version, folder of each bucket that has rows, last batch of each writer; of the newest snapshot, if no other is asked for."""
        known = self._snapshots()
        if not known:
            return 0, {}, {}
        version = known[-1] if version is None else version
        if version not in known:
            raise ValueError(f"no snapshot {version}")
        row = self.spark.read.schema(_SNAPSHOT).parquet(f"{self.root}/snapshots").where(F.col("version") == version).first()
        return row["version"], dict(row["folders"]), dict(row["batches"])

    def read(self, version: int | None = None, only: set[int] | None = None) -> DataFrame:
        """All rows as of a version (the newest); ``only`` of some buckets."""
        folders = self._snapshot(version)[1]
        return self._rows([f for b, f in folders.items() if only is None or b in only])

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/{f}" for f in sorted(folders)))

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def upsert(self, rows: DataFrame, writer: str = "batch", batch: int | None = None) -> bool:
        """Merge ``rows``; whether anything was merged.

        A ``batch`` at or below the last one of its ``writer`` was merged before and is passed over, so an engine may hand it in again. Of several rows of one key the last by all
        other columns, in their order, counts. Null keys are keys as any other. An empty batch only leaves its number.
        """
        version, folders, batches = self._snapshot()
        if batch is not None and batch <= batches.get(writer, -1):
            return False
        others = [c for c in self.schema.names if c not in self.keys]
        rows = cut(rows.select(*self.schema.names).groupBy(*self.keys).agg(F.max(F.struct(*others)).alias("_n")).select(*self.keys, "_n.*").select(*self.schema.names))
        # at most ``buckets`` numbers
        touched = {r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect()}
        version += 1
        if touched:
            whole = merged(self._rows([folders[b] for b in touched if b in folders]), rows, self.keys, self.update)
            at = f"rows/{version}-{uuid.uuid4().hex}"
            whole.withColumn("_bucket", self.bucket()).repartition(len(touched), "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{at}")
            folders |= {b: f"{at}/_bucket={b}" for b in touched}
        if batch is not None:
            batches[writer] = batch
        self.spark.createDataFrame([(version, folders, batches)], _SNAPSHOT).coalesce(1).write.mode("append").parquet(f"{self.root}/snapshots")
        return bool(touched)

    def upsert_stream(self, stream: DataFrame, checkpoint: str, writer: str = "stream") -> StreamingQuery:
        """Merge all that a stream has, micro-batch by micro-batch, each once whatever is run again, and stop."""
        write = stream.writeStream.foreachBatch(lambda rows, batch: self.upsert(rows, writer, batch) and None)
        query = write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def vacuum(self) -> list[str]:
        """Delete row folders that none of the last snapshots names, and older snapshots; what was deleted. Not beside a writer."""
        known = self._snapshots()
        if not known:
            return []
        kept = self.spark.read.schema(_SNAPSHOT).parquet(f"{self.root}/snapshots").where(F.col("version").isin(known[-KEPT_SNAPSHOTS:])).orderBy("version").collect()
        named = {f for r in kept for f in r["folders"].values()}
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/rows")
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for version in fs.listStatus(fs_path) if fs.exists(fs_path) else []:
            for folder in fs.listStatus(version.getPath()):
                name = f"rows/{version.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and name not in named:
                    removed(self.spark, f"{self.root}/{name}")
                    gone.append(name)
        # the newest snapshots anew, in one file, before the old files go
        old = [f.getPath().toString() for f in fs.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshots")) if f.getPath().getName().startswith("part-")]
        if len(known) > KEPT_SNAPSHOTS:
            again = [(r["version"], r["folders"], r["batches"]) for r in kept]
            self.spark.createDataFrame(again, _SNAPSHOT).coalesce(1).write.mode("append").parquet(f"{self.root}/snapshots")
            for path in old:
                removed(self.spark, path)
        return sorted(gone)
