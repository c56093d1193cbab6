"""Typed datasets of the layered store: saved with a sidecar, found by kind and source, read with the schema of their kind."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeel.sources import catalog

METADATA = "_metadata.json"


class Kind(NamedTuple):
    """``layer`` it lies in, ``schema`` of its rows, ``key`` that orders them, rows ``shown`` by default, the kind read in its ``stead`` where it is missing; ``shared``: of no single source."""

    layer: str
    schema: str
    key: str
    shown: int = 5000
    stead: str | None = None
    shared: bool = False


_SPAN = "document_id string, chunk_id string, text string"
_TRIPLE = "document_id string, chunk_id string, subject_text string, predicate string, object_text string, confidence double"
_ENTITY = "canonical_name string, candidate_type string, aliases array<string>, mention_count long"
KINDS = {
    "documents": Kind("silver", "id string, title string, content string, source string, document_type string, domain string, content_hash string", "id", shown=2000),
    "chunks": Kind("silver", f"{_SPAN}, chunk_index int, content_hash string", "chunk_id"),
    "entities": Kind("silver", f"{_SPAN}, label string, span_start int, span_end int", "document_id"),
    "mentions": Kind("gold", f"mention_id string, {_SPAN}, mention_type string, span_start int, span_end int, context string, content_hash string", "mention_id", stead="entities"),
    "propositions": Kind("gold", f"proposition_id string, {_TRIPLE}", "proposition_id"),
    "assertions": Kind("gold", f"assertion_id string, {_TRIPLE}, negated boolean, hedged boolean, qualifiers map<string,string>", "assertion_id", stead="propositions"),
    "entity_candidates": Kind("gold", f"candidate_id string, {_ENTITY}, code_location string, embedding array<float>, content_hash string", "candidate_id"),
    "canonical_entities": Kind("platinum", "canonical_id string, canonical_name string, entity_type string, source_candidate_ids array<string>, mention_count long", "canonical_id", shared=True),
    "entity_alignments": Kind("platinum", "source_entity_id string, target_entity_id string, alignment_type string, score double, evidence array<string>", "source_entity_id", shared=True),
    "assertion_graph": Kind("platinum", "assertion_id string, subject_canonical_id string, predicate string, object_canonical_id string", "assertion_id", shared=True),
}


def sidecar(spark: SparkSession, folder: str, name: str = METADATA) -> dict | None:
    """What the file ``name`` of a dataset's folder says; None where there is none, or where it is no JSON object. Spark's readers pass over names with a leading underscore."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:
        return None
    finally:
        stream.close()
    return said if isinstance(said, dict) else None


class Datasets:
    """Datasets below ``root``; one that another code location wrote is found like any."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _name(self, kind: str, source: str | None) -> str:
        if KINDS[kind].shared != (source is None):
            raise ValueError(f"{kind} are of {'no single' if KINDS[kind].shared else 'a'} source")
        return f"{source}_{kind}" if source else kind

    def save(self, kind: str, rows: DataFrame, source: str | None = None, location: str = "default", config: str | None = None, partition: str | None = None) -> str:
        """Write ``rows`` anew as a dataset of ``kind``; its folder.

        Columns are cast to those of the kind: what it does not know is left out, what ``rows`` lack is null. The sidecar goes before the rows and comes back after them, so
        a write that breaks off leaves a dataset that is not found rather than half of one.
        """
        name = self._name(kind, source)
        at = catalog.dataset_path(self.root, KINDS[kind].layer, location, source or "default", name, config) + (f"/partition={partition}" if partition else "")
        typed = self.spark.createDataFrame([], KINDS[kind].schema).schema
        whole = rows.select(*((F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in typed))
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{METADATA}")
        files = marker.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.delete(marker, False)
        whole.write.mode("overwrite").parquet(f"{at}/data")
        said = {"kind": kind, "source": source, "config": config, "partition": partition, "format": "parquet", "count": self.spark.read.schema(typed).parquet(f"{at}/data").count()}
        out = files.create(marker, True)
        try:
            out.write(json.dumps(said, sort_keys=True).encode())
        finally:
            out.close()
        return at

    def listed(self) -> DataFrame:
        """(layer, code_location, group, asset, root) of every dataset, and of each of its configurations and partitions that has a sidecar of its own."""
        return catalog.list_datasets(self.spark, self.root)

    def roots(self, kind: str, source: str | None = None, config: str | None = None, partition: str | None = None) -> list[str]:
        """Folders with the rows of a dataset, in order: all its configurations and partitions, or those asked for. Of several code locations the first counts."""
        mine = self.listed().where((F.col("layer") == KINDS[kind].layer) & (F.col("asset") == self._name(kind, source)))
        # a dataset's folders: as many as it has configurations and partitions
        found = [(r["code_location"], r["group"], r["root"]) for r in mine.orderBy("code_location", "group", "root").collect()]
        asked = {f"{k}={v}" for k, v in (("config", config), ("partition", partition)) if v is not None}
        return [root for *place, root in found if place == list(found[0][:2]) and asked <= set(root.split("/"))]

    def load(self, kind: str, source: str | None = None, config: str | None = None, partition: str | None = None, mention_type: str | None = None) -> DataFrame:
        """Rows of a dataset with the schema of its kind; where it is missing, those of the kind in its stead with that one's schema; without either no rows.

        ``mention_type`` keeps the mentions of one type; rows read in their stead have no such type and all stay.
        """
        at = self.roots(kind, source, config, partition)
        if not at:
            stead = KINDS[kind].stead
            instead = stead and self.roots(stead, source, config, partition)
            return self.load(stead, source, config, partition) if instead else self.spark.createDataFrame([], KINDS[kind].schema)
        rows = self.spark.read.schema(KINDS[kind].schema).parquet(*(f"{root}/data" for root in at))
        return rows.where(F.col("mention_type") == mention_type) if mention_type and kind == "mentions" else rows

    def shown(self, kind: str, source: str | None = None, limit: int | None = None, **asked: str | None) -> DataFrame:
        """The first rows of ``load`` by the key, and all other columns among equals: as many as the kind shows, or ``limit``."""
        rows = self.load(kind, source, **asked)
        order = [c for c, t in rows.dtypes if not t.startswith("map")]
        key = KINDS[kind].key if KINDS[kind].key in order else order[0]
        return rows.orderBy(key, *(c for c in order if c != key)).limit(KINDS[kind].shown if limit is None else limit)

    def described(self) -> DataFrame:
        """``listed`` with what each sidecar says: kind, source, config, partition, format, count; nulls where it says nothing."""
        rows = [(*r, json.dumps(sidecar(self.spark, r["root"]) or {})) for r in self.listed().collect()]
        fields = "kind string, source string, config string, partition string, format string, count long"
        said = self.spark.createDataFrame(rows, "layer string, code_location string, group string, asset string, root string, said string")
        return said.withColumn("said", F.from_json("said", fields)).select("layer", "code_location", "group", "asset", "root", "said.*")
