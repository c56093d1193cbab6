"""Vectors in few dimensions: principal components of all rows, found from moments that tasks add up."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeel.functions.scalars import dot
from lorekeel.session import cut

#: Rows below which there is nothing to project, and columns of a vector at most: a square of them comes to the driver.
LEAST_ROWS, MOST_COLUMNS = 2, 4096


def principal_components(vectors: DataFrame, n: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, coordinates): each vector, less the mean of all, along the ``n`` directions of most variance; the largest entry of a direction is positive.

    Fewer than two rows, or directions without variance, have coordinates 0. Null and empty vectors are left out; all others are of one length. Means and second moments are one aggregate each,
    and only a matrix of the vectors' own width reaches the driver. Repeated rows count each.
    """
    rows = vectors.where(F.size(vector_col) > 0).select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("v"))
    rows = cut(rows)
    if rows.isEmpty():
        return rows.select(id_col, F.array().cast("array<double>").alias("coordinates"))
    stats = rows.select(array_to_vector("v").alias("f")).select(Summarizer.metrics("mean", "count").summary(F.col("f")).alias("s")).first()["s"]
    width = len(stats["mean"])
    if width > MOST_COLUMNS:
        raise ValueError(f"over {MOST_COLUMNS} columns")
    if stats["count"] < LEAST_ROWS:
        return rows.select(id_col, F.array(*(F.lit(0.0) for _ in range(n))).alias("coordinates"))
    k = min(n, width)
    model = PCA(k=k, inputCol="f", outputCol="p").fit(rows.select(array_to_vector("v").alias("f")))
    directions = model.pc.toArray()
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(k)])
    directions, mean = directions * np.where(signs == 0, 1, signs), np.array(stats["mean"])
    along = [dot("v", F.array(*(F.lit(float(x)) for x in directions[:, j]))) - float(mean @ directions[:, j]) for j in range(k)]
    return rows.select(id_col, F.array(*along, *(F.lit(0.0) for _ in range(n - k))).alias("coordinates"))
