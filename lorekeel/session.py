"""Session settings and lineage cutting shared by every operator."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "lorekeel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # files of a checkpoint go when nothing refers to it any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(name).config(map=settings)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from ``spark.checkpoint.dir``; a local one only where that is unset and one machine does all."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR")))
    return sc.getCheckpointDir().rstrip("/")


#: Rows of a few numbers that one task takes at least, where a table's size is known.
ROWS_A_TASK = 250_000


def parts_for(rows: int) -> int:
    """Tasks for a table of ``rows`` narrow rows: in proportion to it, never one alone."""
    return max(4, -(-rows // ROWS_A_TASK))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so that lost executors recompute nothing before it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that deals both sides by key, whatever their sizes are held to be.

    Spark guesses a table's size from its compressed files, and keeps that guess through a checkpoint and for rows that were exploded; a join that
    trusts it may send hundreds of megabytes through the driver.
    """
    return df.hint("merge")


def removed(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder with all that is in it; whether it was there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder where the cluster's shared files are, for as long as the block lasts; what is read from it must be cut inside."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        removed(spark, path)
