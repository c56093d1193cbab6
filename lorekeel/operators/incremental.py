"""Sinks that do not repeat work: unchanged content is not written again, keys are merged, processed texts are left out."""

from __future__ import annotations

import datetime
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.session import cut, removed
from lorekeel.sources.catalog import exists

#: Records that a manifest keeps.
KEPT_RECORDS = 100
MANIFEST = "run_id string, timestamp timestamp, dataset string, partition string, format string, count long, size_bytes long, content_hash string, path string"


def content_mark(rows: DataFrame) -> tuple[int, str]:
    """(rows, mark): a mark of the content that does not depend on the order of rows; repeated rows count."""
    each = F.xxhash64(*sorted(rows.columns))
    out = rows.agg(F.count(F.lit(1)), F.sum(each.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(each))).first()
    return out[0], f"{out[0]}:{out[1]}:{out[2]}"


class Store:
    """Datasets under ``root`` with a manifest of what was written when."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def _log(self) -> str:
        return f"{self.root}/_manifest"

    def manifest(self) -> DataFrame:
        """The last ``KEPT_RECORDS`` records of each dataset."""
        if not exists(self.spark, self._log):
            return self.spark.createDataFrame([], MANIFEST)
        rows = self.spark.read.schema(MANIFEST).parquet(self._log)
        place = F.row_number().over(Window.partitionBy("dataset").orderBy(F.desc("timestamp"), F.desc("run_id")))
        return rows.withColumn("_p", place).where(F.col("_p") <= KEPT_RECORDS).drop("_p")

    def write(self, dataset: str, rows: DataFrame | None, partition: str | None = None, run_id: str | None = None, form: str = "parquet") -> bool:
        """Write ``rows`` (as ``parquet``, ``json`` lines or ``csv``) unless the last record of this dataset and partition has the same content; whether it was written.

        Each write has a folder of its own, which counts once a record names it: a write that breaks off changes nothing for readers. The folder before the last goes then.
        """
        if rows is None:
            return False
        rows = cut(rows)
        n, mark = content_mark(rows)
        mine = self._records(dataset, partition)
        last = mine[0] if mine else None
        if last is not None and last["content_hash"] == mark:
            return False
        run_id = run_id or uuid.uuid4().hex
        at = f"{self.root}/{dataset}" + (f"/partition={partition}" if partition else "") + f"/run={run_id}-{uuid.uuid4().hex[:8]}"
        rows.write.format(form).option("header", "true").save(at)
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(at)
        size = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        record = (run_id, datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None), dataset, partition, form, n, size, mark, at)
        self.spark.createDataFrame([record], MANIFEST).coalesce(1).write.mode("append").parquet(self._log)
        if len(mine) > 1:  # those who read the last one may still be at it
            removed(self.spark, mine[1]["path"])
        return True

    def _records(self, dataset: str, partition: str | None) -> list:
        """The last two records of a dataset and partition, the newest first."""
        mine = self.manifest().where((F.col("dataset") == dataset) & F.col("partition").eqNullSafe(F.lit(partition)))
        return mine.orderBy(F.desc("timestamp"), F.desc("run_id")).limit(2).collect()

    def read(self, dataset: str, partition: str | None = None, schema: str | None = None) -> DataFrame:
        """Rows of the last write; without one, or of a partition that has none, an error. CSV and JSON need a schema for other types than text."""
        mine = self._records(dataset, partition)
        if not mine:
            raise ValueError(f"nothing written for {dataset}, {partition}")
        reader = self.spark.read.option("header", "true")
        return (reader.schema(schema) if schema else reader).format(mine[0]["format"]).load(mine[0]["path"])

    def timeline(self) -> DataFrame:
        """Records for display: size in MiB (0 without one), a short run id, a dash where there is no partition."""
        mib = F.round(F.coalesce("size_bytes", F.lit(0)) / 2**20, 2)
        return self.manifest().select("dataset", "timestamp", mib.alias("size_mb"), F.substring("run_id", 1, 8).alias("run"), F.coalesce("partition", F.lit("—")).alias("partition"), "count")


def merged(old: DataFrame, new: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """``old`` with the ``update`` columns of rows that ``new`` has too, and the rows only ``new`` has; of rows of ``new`` with one key the last by all columns. Null keys are keys as any other."""
    once = new.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(F.max(F.struct(*[c for c in old.columns if c not in keys])).alias("_n"))
    mark = old.withColumn("_there", F.lit(True))
    same = reduce(lambda a, b: a & b, (mark[k].eqNullSafe(once[f"_k_{k}"]) for k in keys))
    joined = mark.join(once, same, "full_outer")
    there = F.coalesce("_there", F.lit(False))
    columns = []
    for c in old.columns:
        if c in keys:
            columns.append(F.coalesce(c, f"_k_{c}").alias(c))
        elif c in update:
            columns.append(F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.when(there, F.col(c)).otherwise(F.col(f"_n.{c}")).alias(c))
    return joined.select(*columns)


def unprocessed(rows: DataFrame, processed: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows whose key was not processed yet; a null key never was."""
    return rows.join(processed.select(key).distinct(), key, "left_anti")


#: Folders that appended lines are dealt to.
LINE_BUCKETS = 256


def append_lines(rows: DataFrame, path: str, id_col: str = "document_id", buckets: int = LINE_BUCKETS) -> None:
    """Append rows as JSON lines, the rows of a document in one of ``buckets`` folders; an id that is no safe name (letters, digits, ``_``, ``.`` and ``-``, no sign first) stops the write."""
    safe = F.col(id_col).cast("string").rlike(r"^[a-zA-Z0-9][a-zA-Z0-9_.\-]*$")
    sure = F.when(F.coalesce(safe, F.lit(False)), F.col(id_col)).otherwise(F.raise_error(F.concat(F.lit("no safe name: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).cast(rows.schema[id_col].dataType))
    bucket = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(buckets)).cast("int")
    rows.withColumn(id_col, sure).withColumn("_bucket", bucket).write.mode("append").partitionBy("_bucket").json(path)


def lines_of(spark: SparkSession, path: str, ids: list[str], schema: str, id_col: str = "document_id", buckets: int = LINE_BUCKETS) -> DataFrame:
    """Appended rows of some documents; only their buckets are read."""
    asked = spark.createDataFrame([(str(i),) for i in ids], "id string").select(F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("b")).distinct()
    lines = spark.read.schema(f"{schema}, _bucket int").json(path).where(F.col("_bucket").isin([r["b"] for r in asked.collect()]))
    return lines.where(F.col(id_col).cast("string").isin([str(i) for i in ids])).drop("_bucket")


def audit_rows(results: DataFrame, payload: str = "payload") -> DataFrame:
    """``results`` with payload_hash, the first 16 hexadecimal digits of the payload's SHA-256."""
    return results.withColumn("payload_hash", F.substring(F.sha2(F.col(payload).cast("string"), 256), 1, 16))


def append_audit(results: DataFrame, path: str, payload: str = "payload") -> None:
    """Append ``audit_rows`` as JSON lines."""
    audit_rows(results, payload).write.mode("append").json(path)


def vertices(entities: DataFrame) -> DataFrame:
    return entities.select(F.col("canonical_id").alias("id"), "canonical_name", "entity_type", "mention_count").dropDuplicates(["id"])


def alignment_relations(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """(src, dst, relation, score): alignments between canonical entities; candidates are mapped to theirs, and edges inside one are left out."""
    owner = entities.select(F.explode("source_candidate_ids").alias("candidate_id"), "canonical_id")
    a, b = owner.toDF("source_entity_id", "src"), owner.toDF("target_entity_id", "dst")
    both = edges.join(a, "source_entity_id").join(b, "target_entity_id").where("src <> dst")
    return both.groupBy("src", "dst", F.upper("alignment_type").alias("relation")).agg(F.max("score").alias("score"))


def assertion_relations(linked: DataFrame) -> DataFrame:
    """(assertion_id, src, dst, predicate): assertions with both ends linked, once each."""
    both = linked.where("subject_canonical_id is not null and object_canonical_id is not null")
    named = both.select("assertion_id", F.col("subject_canonical_id").alias("src"), F.col("object_canonical_id").alias("dst"), "predicate")
    return named.dropDuplicates(["assertion_id"])
