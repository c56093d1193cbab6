"""Small Arrow helpers for the operators that read whole texts inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one slice of a batch holds at most, unless a single text is longer.
SLICE_BYTES = 1 << 20


#: Rows of an Arrow batch at most where rows hold whole texts or sets; it bounds the memory of tasks and changes no result.
BATCH_ROWS = 500
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` in batches of ``BATCH_ROWS`` rows at most; the session keeps that bound."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS)) <= BATCH_ROWS:
        conf.set(_ROWS, str(BATCH_ROWS))

    def freeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(freeing, schema)


def text_slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of whole rows of about ``limit`` text bytes, to bound a task's memory."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, so_far = 0, 0
    for i, n in enumerate(sizes):
        if i > at and so_far + n > limit:
            yield batch.slice(at, i - at)
            at, so_far = i, 0
        so_far += int(n)
    yield batch.slice(at)


#: Steps of a draw: a share of one row in 10^18 still has some.
_DRAWS = 1 << 62


def drawn(id_col: str, share: float | Column) -> Column:
    """Whether an id belongs to a sample of about ``share`` (0 to 1) of all ids, by its hash: the same ids in every run, at any size of table."""
    place = F.pmod(F.xxhash64(id_col), F.lit(_DRAWS))
    return place < (F.lit(int(share * _DRAWS)) if isinstance(share, float) else F.floor(F.least(share, F.lit(1.0)) * F.lit(float(_DRAWS))).cast("long"))


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with as many underscores as it takes to be none of ``columns`` (case aside)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def words_of(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none): starts (one more than texts), word codes, the distinct words.

    Code points past ASCII are never separators here; only the six ASCII white-space characters are.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    flat = pc.dictionary_encode(parts.flatten())
    codes, distinct = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
    starts = parts.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    blank = pc.index(distinct, "").as_py() if len(distinct) else -1
    if blank >= 0:
        keep = codes != blank
        starts = np.concatenate(([0], np.cumsum(keep)))[starts]
        codes = codes[keep]
    return starts, codes, distinct
