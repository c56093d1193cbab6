"""Cutting documents into chunks with deterministic identifiers.

``passthrough`` is plain SQL. ``recursive`` reads whole texts in Arrow batches: a text is
cut at the coarsest separator it holds, pieces that are still too long at the next
finer one, and neighbouring pieces are put together again up to the size, each chunk
starting with as many of the last pieces of the one before as the overlap allows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.functions.scalars import falsy, stripped

#: Separators from coarse to fine; the last one cuts between any two characters.
SEPARATORS = ("\n\n", "\n", ". ", " ", "")
#: Size and overlap in code points by document type; None: a single chunk. Other types take DEFAULT.
PROFILES = {
    "bill": (400, 100), "cable": (1500, 250), "court_document": (2000, 400), "media": (800, 150),
    "member_profile": None, "committee_profile": None, "offshore_entity": None,
}
DEFAULT = (1000, 200)
#: Text bytes that are cut up at once, unless one text is longer.
SLICE_BYTES = 1 << 20


def split_text(text: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of ``text`` in order, stripped, none longer than ``size`` (code points); none for a blank text."""
    out: list[str] = []
    _split(text, size, overlap, separators, out)
    return out


def _split(text: str, size: int, overlap: int, separators: tuple[str, ...], out: list[str]) -> None:
    mark, finer = next((s, separators[k + 1 :]) for k, s in enumerate(separators) if not s or s in text)
    if mark:
        head, *tail = text.split(mark)
        pieces = [head, *(mark + t for t in tail)]
    else:
        pieces = list(text)
    window: deque[str] = deque()
    held = 0
    for piece in pieces:
        if len(piece) > size and finer:
            _emit(window, out)
            window, held = deque(), 0
            _split(piece, size, overlap, finer, out)
            continue
        if window and held + len(piece) > size:
            _emit(window, out)
            while window and (held > overlap or held + len(piece) > size):
                held -= len(window.popleft())
        window.append(piece)
        held += len(piece)
    _emit(window, out)


def _emit(window: deque[str], out: list[str]) -> None:
    chunk = "".join(window).strip()
    if chunk:
        out.append(chunk)


def _titled(prepend: bool):
    return F.when(F.lit(prepend) & falsy("title").isNotNull(), F.concat("title", F.lit("\n\n"), "text")).otherwise(F.col("text"))


def _finished(chunks: DataFrame, prepend: bool) -> DataFrame:
    """``chunks`` (document_id, title, text, index, total_chunks, metadata) with chunk_id and content_hash."""
    named = chunks.withColumn("text", _titled(prepend))
    chunk_id = F.concat(F.col("document_id").cast("string"), F.lit(":chunk-"), F.col("index").cast("string"))
    return named.select(chunk_id.alias("chunk_id"), "document_id", "text", "index", "total_chunks", "metadata", F.sha2("text", 256).alias("content_hash"))


def passthrough(docs: DataFrame, prepend_title: bool = True) -> DataFrame:
    """One chunk per document (id, title, content) whose content is not blank."""
    whole = docs.select(F.col("id").alias("document_id"), "title", stripped("content").alias("text")).where("text <> ''")
    whole = whole.select("*", F.lit(0).alias("index"), F.lit(1).alias("total_chunks"), F.create_map(F.lit("strategy"), F.lit("passthrough")).alias("metadata"))
    return _finished(whole, prepend_title)


def _cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of rows (id, title, content, size, overlap); a row without a size is one chunk. Slices of rows are bounded by their text."""
    for whole in batches:
        lengths = pc.fill_null(pc.binary_length(whole.column("content")), 0).to_pylist()
        at = 0
        while at < whole.num_rows:
            end, held = at + 1, lengths[at]
            while end < whole.num_rows and held + lengths[end] <= SLICE_BYTES:
                held += lengths[end]
                end += 1
            batch, at = whole.slice(at, end - at), end
            of, texts, index, total = [], [], [], []
            for k, (content, size, overlap) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("content", "size", "overlap")))):
                bare = content.strip() if content else ""
                chunks = [] if not bare else [bare] if size is None else split_text(content, size, overlap)
                of += [k] * len(chunks)
                texts += chunks
                index += range(len(chunks))
                total += [len(chunks)] * len(chunks)
            rows = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(rows) for c in ("id", "title", "size", "overlap")), pa.array(texts, pa.string()), pa.array(index, pa.int32()), pa.array(total, pa.int32())],
                ["document_id", "title", "size", "overlap", "text", "index", "total_chunks"],
            )


def _chunked(docs: DataFrame, size, overlap, prepend_title: bool) -> DataFrame:
    """Chunks of documents (id, title, content) by columns of size and overlap; a null size makes one chunk of a document."""
    given = docs.select("id", F.col("title").cast("string").alias("title"), F.col("content").cast("string").alias("content"), size.cast("int").alias("size"), overlap.cast("int").alias("overlap"))
    kind = given.schema["id"].dataType.simpleString()
    cut_up = given.mapInArrow(_cutting, f"document_id {kind}, title string, size int, overlap int, text string, index int, total_chunks int")
    text = lambda c: F.col(c).cast("string")
    notes = F.create_map(F.lit("chunk_size"), text("size"), F.lit("chunk_overlap"), text("overlap"), F.lit("strategy"), F.lit("recursive"))
    whole = F.create_map(F.lit("strategy"), F.lit("passthrough"))
    return _finished(cut_up.withColumn("metadata", F.when(F.col("size").isNull(), whole).otherwise(notes)), prepend_title)


def recursive(docs: DataFrame, size: int | None = None, overlap: int | None = None, prepend_title: bool = True) -> DataFrame:
    """Overlapping chunks of every document (id, title, content); a size or overlap of 0 means the default.

    The title goes before the text of each chunk after it was cut, so a chunk may be longer than ``size`` by that.
    """
    return _chunked(docs, F.lit(size or DEFAULT[0]), F.lit(overlap or DEFAULT[1]), prepend_title)


def by_type(docs: DataFrame, profiles: dict = PROFILES) -> DataFrame:
    """Chunks of documents of any type, each by its type's profile, in one pass over them."""
    known = F.create_map(*(x for kind, p in profiles.items() for x in (F.lit(kind), F.array(*(F.lit(n).cast("int") for n in (p or (None, None)))))))
    kind = F.coalesce("document_type", F.lit(""))
    profile = F.coalesce(F.try_element_at(known, kind), F.array(*map(F.lit, DEFAULT)))
    return _chunked(docs, profile[0], profile[1], True)


def reconstructed(chunks: DataFrame) -> DataFrame:
    """document_id and the texts of its chunks in order, joined by an empty line."""
    parts = F.array_sort(F.collect_list(F.struct("index", "text")))
    return chunks.groupBy("document_id").agg(F.array_join(parts["text"], "\n\n").alias("text"))
