"""The layered store: where datasets lie, what is there, and typed reads with fallbacks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# What follows a source's name in the names of its datasets.
SUFFIXES = ["documents", "chunks", "entities", "propositions", "mentions", "assertions", "embeddings", "entity_candidates", "graph"]


def dataset_path(root: str, layer: str, location: str, group: str, name: str, config: str | None = None) -> str:
    path = f"{root.rstrip('/')}/{layer}/{location}/{group}/{name}"
    return f"{path}/config={config}" if config else path


def group_of(name):
    """The part of a dataset's name before its first underscore."""
    return F.split(name, "_")[0]


#: Folders between a dataset's own and a sidecar below it: a configuration, a partition or the parts of a day.
BELOW = 4


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    """(layer, code_location, group, asset, root) of every folder with a metadata file, the first four being its first parts below ``root``.

    Spark's readers pass over names with a leading underscore, so the files are named by patterns that the file system looks up, and only their names, one for
    each dataset, configuration and partition, come to the driver, never those of data files.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(root)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    base = files.makeQualified(top).toString().rstrip("/") + "/"
    found = []
    for depth in range(4, 5 + BELOW):
        for status in files.globStatus(hadoop.Path(top, "/".join(["*"] * depth) + "/_metadata.json")) or []:
            folder = status.getPath().getParent().toString()
            found.append((*folder.removeprefix(base).split("/")[:4], folder))
    return spark.createDataFrame(found, "layer string, code_location string, group string, asset string, root string")


def list_sources(datasets: DataFrame) -> DataFrame:
    """Distinct source names: dataset names without a known suffix. Datasets of the platinum layer are of no single source."""
    pattern = "^(.+?)_(" + "|".join(sorted(SUFFIXES, key=len, reverse=True)) + ")$"
    named = datasets.where("layer <> 'platinum'").select(F.regexp_extract("asset", pattern, 1).alias("source")).where("source <> ''")
    return named.distinct().orderBy("source")


def list_configs(paths: DataFrame) -> DataFrame:
    """Distinct ``config=`` parts of ``paths`` (path); ``default`` for data without one, and where there is no data."""
    found = paths.select(F.coalesce(F.nullif(F.regexp_extract("path", r"/config=([^/]+)/", 1), F.lit("")), F.lit("default")).alias("config")).distinct()
    spark = paths.sparkSession
    fallback = spark.createDataFrame([("default",)], "config string").join(found.limit(1), F.lit(True), "left_anti")
    return found.unionByName(fallback).orderBy("config")


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def load(spark: SparkSession, path: str, schema: StructType | str | None = None, fallback: str | None = None, limit: int = 0) -> DataFrame:
    """Parquet of a dataset and all its partitions; that of ``fallback`` where it is missing. ``limit`` 0: all rows."""
    at = path if exists(spark, path) or fallback is None else fallback
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(at)
    return rows.limit(limit) if limit else rows


def format_of(path: str, hint: str | None = None) -> str:
    """The format that a hint or an extension names: jsonl, json (one value a file), csv, text or parquet, which is also that of a name without one."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    kind = (hint or (name.rsplit(".", 1)[-1] if "." in name else "parquet")).lower()
    named = {"ndjson": "jsonl", "txt": "text", "md": "text", "pq": "parquet"}.get(kind, kind)
    if named not in ("jsonl", "json", "csv", "text", "parquet"):
        raise ValueError(f"no reader for {kind}")
    return named


def read_as(spark: SparkSession, path: str, hint: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """Rows of a file or folder by ``format_of``; CSV files have a header."""
    kind = format_of(path, hint)
    reader = spark.read.schema(schema) if schema is not None and kind != "text" else spark.read
    if kind == "csv":
        return reader.option("header", "true").csv(path)
    if kind in ("json", "jsonl"):
        return reader.option("multiLine", str(kind == "json").lower()).json(path)
    return reader.text(path) if kind == "text" else reader.parquet(path)


def partitions(paths: DataFrame, below: str) -> DataFrame:
    """Distinct first path parts below a folder."""
    return paths.select(F.regexp_extract("path", rf"\Q{below}\E/?([^/]+)/", 1).alias("partition")).where("partition <> ''").distinct().orderBy("partition")
