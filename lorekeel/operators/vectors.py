"""Vector search and similarity joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions.scalars import cosine
from lorekeel.session import cut

#: Vectors in a block of a similarity join.
BLOCK_ROWS = 2048
#: Tasks at most that pairs of blocks are dealt to; with more pairs a task has several, one after another.
MOST_TASKS = 20_000


def top_k(vectors: DataFrame, query: list[float], k: int, threshold: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows closest to ``query`` by cosine, with ``score``; then those of at least ``threshold``.

    Ties go to the smaller id. A vector without length, or of another length, has score 0. Null and empty ones are left out.
    Each task keeps ``k`` rows, so the order is never made over all of them.
    """
    asked = F.array(*(F.lit(float(x)) for x in query))
    scored = vectors.where(F.size(vector_col) > 0).withColumn("score", cosine(vector_col, asked)).drop(vector_col)
    best = scored.orderBy(F.desc("score"), id_col).limit(k)
    return best if threshold is None else best.where(F.col("score") >= threshold)


def units(v: np.ndarray) -> np.ndarray:
    """Rows in double precision, each of length 1 or, without one, as it is."""
    v = v.astype(np.float64)
    norm = np.linalg.norm(v, axis=1)
    return v / np.where(norm > 0, norm, 1)[:, None]


def best_of_block(k: int, query_block: int = 512) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For a frame of queries and rows (id, v, asks): query_id, id and score of the ``k`` rows closest to each query, a slice of queries at a time."""

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        mine, held = frame[frame["asks"]], frame[~frame["asks"]].sort_values("id")
        out = []
        if len(mine) and len(held):
            u, v = (units(np.stack(x["v"].to_numpy())) for x in (mine, held))
            q, ids = mine["id"].to_numpy(), held["id"].to_numpy()
            for at in range(0, len(u), query_block):
                far = u[at : at + query_block] @ v.T
                np.negative(far, out=far)
                n = min(k, len(ids))
                # all that are no farther than the last of the closest, ties and all; only those are put in order
                least = np.partition(far, n - 1, axis=1)[:, n - 1 : n]
                i, j = np.nonzero(~(far > least))
                near = far[i, j]
                # rows are in the order of their ids, which decides among equals
                order = np.lexsort((j, near, i))
                order = order[np.arange(len(order)) - np.searchsorted(i, i) < n]
                out.append(pd.DataFrame({"query_id": q[at : at + query_block][i[order]], "id": ids[j[order]], "score": -near[order]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []})

    return best


def search(vectors: DataFrame, queries: DataFrame, k: int, threshold: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding", query_id: str = "query_id", query_block: int = 512) -> DataFrame:
    """(query_id, id, score, place): the ``k`` rows closest by cosine to each of ``queries`` (query_id, embedding), then those of at least ``threshold``; exact.

    Ties go to the smaller id; vectors without length have score 0, null and empty ones are left out. Rows and queries meet in blocks: a pair
    of blocks is one task's matrix product, made a slice of queries at a time, and keeps ``k`` rows for each query, which are merged by query.
    """
    rows = vectors.where(F.size(vector_col) > 0).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    asked = queries.where(F.size(vector_col) > 0).select(F.col(query_id).alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    n_rows, n_asked = (max(1, -(-df.count() // n)) for df, n in ((rows, BLOCK_ROWS * 4), (asked, BLOCK_ROWS)))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = asked.select(every(n_rows).alias("r"), block(n_asked).alias("q"), "id", "v", F.lit(True).alias("asks"))
    b = rows.select(block(n_rows).alias("r"), every(n_asked).alias("q"), "id", "v", F.lit(False).alias("asks"))
    kinds = [df.schema["id"].dataType.simpleString() for df in (asked, rows)]

    # one type for both ids inside a task; they get their own back after
    kind = kinds[0] if kinds[0] == kinds[1] else "string"
    both = a.withColumn("id", F.col("id").cast(kind)).unionByName(b.withColumn("id", F.col("id").cast(kind)))
    found = both.groupBy("r", "q").applyInPandas(best_of_block(k, query_block), f"query_id {kind}, id {kind}, score double")
    found = found.select(F.col("query_id").cast(kinds[0]), F.col("id").cast(kinds[1]).alias(id_col), "score")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), id_col))
    out = found.withColumn("place", place).where(F.col("place") <= k)
    return out if threshold is None else out.where(F.col("score") >= threshold)


def similar_vectors(vectors: DataFrame, over: float, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, score) of all pairs of a group with a cosine above ``over``, a before b; exact.

    Vectors are dealt into blocks of about ``block_rows``, and each pair of blocks is one matrix product in
    one task; only hits are given out. Memory is bounded by two blocks, whatever the size of a group.
    """
    group = F.lit(0) if group_col is None else F.col(group_col)
    rows = vectors.where(F.size(vector_col) > 0).select(group.alias("group"), F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    # written first: a join beside an aggregate on the same key could not be split where a group is hot
    sizes = cut(rows.groupBy("group").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).cast("int").alias("blocks")))
    dealt = rows.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    # one row; a task has about one pair of blocks, which small blocks would otherwise be put together in
    pairs = sizes.agg(F.sum(F.col("blocks").cast("long") * (F.col("blocks") + 1) / 2)).first()[0] or 1
    spread = dealt.select("group", "id", "v", "own", other).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    spread = spread.repartition(int(min(pairs, MOST_TASKS)), "group", "low", "high")
    kind = rows.schema["id"].dataType.simpleString()

    def products(frame: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(frame["v"].to_numpy())
        norm = np.linalg.norm(v, axis=1)
        v = v / np.where(norm > 0, norm, 1)[:, None]
        own, low, high, ids = frame["own"].to_numpy(), frame["low"].iat[0], frame["high"].iat[0], frame["id"].to_numpy()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        score = v[left] @ v[right].T
        i, j = np.nonzero(score > over)
        a, b, s = ids[left[i]], ids[right[j]], score[i, j]
        if low == high:
            keep = a < b
            a, b, s = a[keep], b[keep], s[keep]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "score": s})

    return spread.groupBy("group", "low", "high").applyInPandas(products, f"a {kind}, b {kind}, score double")


def overlap(left: DataFrame, right: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row: rows of either result, rows of both, the shared part of the smaller, and both mean scores."""
    a, b = left.select(id_col, "score"), right.select(F.col(id_col), F.col("score").alias("score_b"))
    both = a.join(b, id_col, "full_outer")
    counts = both.agg(
        F.count("score").alias("n_a"), F.count("score_b").alias("n_b"), F.sum((F.col("score").isNotNull() & F.col("score_b").isNotNull()).cast("long")).alias("n_both"),
        F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean_a"), F.coalesce(F.avg("score_b"), F.lit(0.0)).alias("mean_b"),
    )
    return counts.withColumn("share", F.coalesce(F.col("n_both") / F.nullif(F.least("n_a", "n_b"), F.lit(0)), F.lit(0.0)))


def overlaps(left: DataFrame, right: DataFrame, id_col: str = "vec_id", query_id: str = "query_id") -> DataFrame:
    """(query_id, n_a, n_b, n_both, share) for each query: rows of either result, of both, and the shared part of the smaller one."""
    a, b = left.select(query_id, id_col, F.lit(1).alias("in_a")), right.select(query_id, id_col, F.lit(1).alias("in_b"))
    counts = a.join(b, [query_id, id_col], "full_outer").groupBy(query_id).agg(F.count("in_a").alias("n_a"), F.count("in_b").alias("n_b"), F.count(F.expr("in_a + in_b")).alias("n_both"))
    return counts.withColumn("share", F.coalesce(F.col("n_both") / F.nullif(F.least("n_a", "n_b"), F.lit(0)), F.lit(0.0)))


def budgeted(rows: DataFrame, budget: int, order: list, text_col: str = "text", keys: list[str] | None = None) -> DataFrame:
    """The leading rows of an order (of a bounded result such as a top-k, one for each of ``keys``) whose texts together stay within ``budget`` code points."""
    window = Window.partitionBy(*(keys or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("used", F.sum(F.coalesce(F.length(text_col), F.lit(0))).over(window)).where(F.col("used") <= budget)


def retrieval_context(hits: DataFrame, chunks: DataFrame, budget: int = 8000, keys: list[str] | None = None) -> DataFrame:
    """One row (for each of ``keys``) with ``context``: the texts of the hits (chunk_id, score), best first, as far as the budget reaches, an empty line between them."""
    texts = hits.join(chunks.select("chunk_id", "document_id", "text"), "chunk_id")
    kept = budgeted(texts, budget, [F.desc("score"), "chunk_id"], keys=keys)
    parts = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "chunk_id", "text")))
    return kept.groupBy(*(keys or [])).agg(F.array_join(parts["text"], "\n\n").alias("context"), F.count(F.lit(1)).alias("n_chunks"))


def embedded(rows: DataFrame, embed, dimensions: int, text_col: str = "text", model: str = "", batch_size: int = 100) -> DataFrame:
    """``rows`` with ``embedding`` (by ``embed``: a list of texts to a list of vectors, called ``batch_size`` at a time), ``model`` and ``dimensions``."""

    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.fillna("").tolist()
            out = [v for k in range(0, len(texts), batch_size) for v in embed(texts[k : k + batch_size])]
            yield pd.Series([np.asarray(v, np.float32) for v in out], dtype=object)

    # the hints say that batches come as an iterator; they are resolved here, as annotations are kept as text
    vectors.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return rows.withColumn("embedding", F.pandas_udf(vectors, "array<float>")(text_col)).withColumn("model", F.lit(model)).withColumn("dimensions", F.lit(dimensions))
