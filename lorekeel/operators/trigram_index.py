"""A trigram index of texts kept on disk: postings in buckets, extended by batches, looked up by the buckets of what is asked.

A text that holds a pattern holds all its trigrams. A search reads the counts and then the postings of the pattern's rarest trigram
only, from the folder of its bucket, and looks at the texts of rows that have it, so what it reads grows with what is asked and not
with the table. Case is left aside.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lorekeel.session import cut, dealt, parts_for

#: Code points of a piece, folders that pieces and texts are dealt to, and candidates for a folder up to which only those that are needed are read.
GRAM, BUCKETS, FEW = 3, 64, 8


def grams(text: Column) -> Column:
    """Distinct pieces of ``GRAM`` code points of a lower-cased text; none of a shorter one."""
    pieces = F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.call_function("substring", text, i, F.lit(GRAM)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


class TrigramIndex:
    """An index under ``root`` of texts by ids of one type. Batches are added, each once by its name; ids are distinct over all of them."""

    def __init__(self, spark: SparkSession, root: str, id_type: str | DataType = "long", buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.id_type = id_type if isinstance(id_type, str) else id_type.simpleString()

    def _bucket(self, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def batches(self) -> list[str]:
        """Batches that were added whole."""
        try:
            return sorted(r["batch"] for r in self.spark.read.schema("batch string, folder string").parquet(f"{self.root}/batches").select("batch").collect())
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def add(self, rows: DataFrame, batch: str, id_col: str = "id", text_col: str = "text") -> bool:
        """Index ``rows``; whether it was done, which it is not if the batch is there already. Null texts and ids are left out. A batch counts once all of it is written."""
        if batch in self.batches():
            return False
        folder = f"{batch}-{uuid.uuid4().hex}"
        given = rows.select(F.col(id_col).cast(self.id_type).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
        given = cut(given.withColumn("bucket", self._bucket("id")))
        given.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/texts/{folder}")
        postings = given.select("id", F.explode(grams(F.lower("text"))).alias("gram")).withColumn("bucket", self._bucket("gram"))
        # dealt by bucket and part of the ids, so that a piece that a third of all texts hold is several files
        parts = F.pmod(F.xxhash64("id"), F.lit(4))
        dealt = postings.repartition("bucket", parts).sortWithinPartitions("bucket", "gram", "id")
        dealt.write.partitionBy("bucket").parquet(f"{self.root}/postings/{folder}")
        counts = self._read("postings", [folder], f"id {self.id_type}, gram string, bucket int").groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
        counts.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/counts/{folder}")
        self.spark.createDataFrame([(batch, folder)], "batch string, folder string").coalesce(1).write.mode("append").parquet(f"{self.root}/batches")
        return True

    def _folders(self) -> list[str]:
        return [r["folder"] for r in self.spark.read.schema("batch string, folder string").parquet(f"{self.root}/batches").orderBy("batch").collect()] if self.batches() else []

    def _read(self, kind: str, folders: list[str], schema: str, only: list[int] | None = None) -> DataFrame:
        """Rows of a kind; ``only`` of some buckets, whose folders alone are read."""
        rows = None
        for folder in folders:
            part = self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/{folder}")
            part = part if only is None else part.where(F.col("bucket").isin(only))
            rows = part if rows is None else rows.unionByName(part)
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def search(self, patterns: DataFrame, pattern_id: str = "pattern_id", pattern: str = "pattern") -> DataFrame:
        """Distinct (pattern_id, id) of the texts that hold a pattern, case aside. Patterns of one or two code points are looked for in all texts; null and empty ones are in none."""
        folders = self._folders()
        asked = cut(patterns.select(F.col(pattern_id).alias("pattern_id"), F.lower(F.col(pattern)).alias("low")).where("low is not null and low <> ''").distinct())
        texts = f"id {self.id_type}, text string, bucket int"
        each = cut(asked.select("pattern_id", "low", F.explode(grams(F.col("low"))).alias("gram")).withColumn("bucket", self._bucket("gram")))
        # at most ``buckets`` numbers
        buckets = [r["bucket"] for r in each.select("bucket").distinct().collect()]
        counts = self._read("counts", folders, "gram string, n long, bucket int", buckets).groupBy("gram").agg(F.sum("n").alias("n"))
        counted = each.join(counts, "gram", "left").select("pattern_id", "low", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("g"))
        # a piece that no text has rules the pattern out
        rarest = counted.groupBy("pattern_id", "low").agg(F.min("g").alias("g")).where("g.n > 0").select("pattern_id", "low", "g.gram", "g.n")
        rarest = cut(rarest.withColumn("bucket", self._bucket("gram")))
        buckets = [r["bucket"] for r in rarest.select("bucket").distinct().collect()]
        candidates = rarest.agg(F.sum("n")).first()[0] or 0
        postings = self._read("postings", folders, f"id {self.id_type}, gram string, bucket int", buckets)
        met = rarest.drop("bucket", "n").join(postings.select("gram", "id"), "gram").select("pattern_id", "low", "id")
        buckets = None
        if candidates <= self.buckets * FEW:
            met = cut(met.withColumn("bucket", self._bucket("id")))
            buckets = [r["bucket"] for r in met.select("bucket").distinct().collect()]
            met = met.drop("bucket")
        # dealt by id to as many tasks as the candidates, of known number, are worth; a text is looked at where it lies
        parts = parts_for(candidates)
        held = self._read("texts", folders, texts, buckets).drop("bucket").repartition(parts, "id")
        found = met.repartition(parts, "id").join(dealt(held), "id").where(F.contains(F.lower("text"), F.col("low"))).select("pattern_id", "id")
        short = asked.where(F.length("low") < GRAM)
        if not short.isEmpty():
            found = found.unionByName(self._read("texts", folders, texts).join(short, F.contains(F.lower("text"), F.col("low"))).select("pattern_id", "id"))
        return found.distinct()
