"""Helpers of the vector searches: usable vectors, cells, and the best pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(df: DataFrame, vec_id: str, vector: str, allow_zero: bool) -> DataFrame:
    """``id`` (long) and ``v`` (array of double) of the vectors that take part.

    Null vectors, empty ones, and those with null or non-finite components don't;
    zero ones only if allowed. Of differing lengths the most frequent one counts
    (ties: the longer). Null ids take no part.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.col("v")
    good = F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite)
    if not allow_zero:
        good = good & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.coalesce(good, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("v") == (sizes["d"] if sizes else 0))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow list column, a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def best_pairs(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best pairs of each query: largest score, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.concatenate([first, [len(q)]])))
    return order[rank < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best found of each query."""
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def part_of(key: str, parts: Column | int) -> Column:
    """A part from 0 to ``parts`` - 1 by the hash of ``key``."""
    return F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts) if isinstance(parts, int) else parts).cast("int")
