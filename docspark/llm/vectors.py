"""What both vector searches share: valid vectors, even blocks, and Arrow columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid(vector: Column, allow_zero: bool = False) -> Column:
    """Neither null nor holding null or non-finite components, nor empty, nor (unless allowed) zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    sound = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False)))
    return sound if allow_zero else sound & F.exists(vector, lambda x: x != 0)


def common_length(vectors: DataFrame, vector: str) -> int:
    """The length that most vectors have (of equal ones the larger); 0 without vectors."""
    sizes = vectors.groupBy(F.size(vector).alias("n")).agg(F.count("*").alias("rows"))
    top = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    return top["n"] if top else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, the smaller vec_id first among ties."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[rank < k]


def merged_ranks(found: DataFrame, k: int) -> DataFrame:
    """Ranks over all blocks; a query has at most k rows of each block that it met."""
    order = Window.partitionBy("query_no", "query_id").orderBy(F.desc("score"), "vec_id", "vec_no")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
