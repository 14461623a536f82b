"""Exact top-k search by multi-resolution segment statistics.

Vectors become integers, floor(1024 * x). Each is cut into segments, coarse to
fine, with the mean and the deviation (root of the summed squares around the
mean) of each segment. By Cauchy-Schwarz they bound a product from above,
``sum(n * mean_q * mean_x + dev_q * dev_x)``, and so the distance
``|q|^2 + |x|^2 - 2 q.x`` from below. At each level, candidates whose bound
can't reach the query's k-th best score so far go; survivors get their exact
integer product. Nothing is approximate: bounds have slack for rounding, and
equal scores stay until ids are compared.

All queries meet all rows, in blocks: the table is dealt into cells by hash and
the queries into blocks, and every pair of the two is a group of bounded size.

Vectors that are null or hold null or non-finite components take no part, zero
ones do (see ``usable`` for differing lengths). A row is no candidate of
queries with its own id. Repeated rows count once. Fewer than k candidates give
fewer rows, an empty table none. Scores outside the range of a long are set to
its ends. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetrend.llm.common import cut_lineage
from pricetrend.llm.vectors import best_pairs, matrix, part_of, ranked, usable


LEAST, MOST = -(1 << 63), (1 << 63) - 1  # of a long


@dataclass(frozen=True)
class TopkParams:
    k: int = 10
    scale: int = 1024
    segments: tuple[int, ...] = (1, 4, 16)
    per_cell: int = 16384
    queries_per_block: int = 4096
    at_once: int = 1024


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles while all products are exact in them, else Python integers."""
    v = np.floor(x * float(scale))
    if v.size and (not np.isfinite(v).all() or float(np.abs(v).max()) >= math.sqrt(2.0 ** 52 / x.shape[1])):
        whole = lambda t: math.floor(t * scale) if abs(t) < 2.0 ** 52 else int(t) * scale
        return np.array([[whole(t) for t in row] for row in x.tolist()], dtype=object)
    return v


def statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """For each row root(n) * mean and deviation of its segments, side by side, so that
    the product of two rows bounds the product of their vectors."""
    v = v.astype(np.float64)
    out = []
    for piece in np.array_split(v, min(segments, v.shape[1]), axis=1):
        mean = piece.mean(1)
        out += [math.sqrt(piece.shape[1]) * mean, np.sqrt(((piece - mean[:, None]) ** 2).sum(1))]
    return np.stack(out, axis=1)


def scan(queries: np.ndarray, qids: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
         params: TopkParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best pairs of each query: query positions, positions of vectors, scores."""
    k = params.k
    if queries.dtype == object or vectors.dtype == object:
        return scan_huge(queries, qids, vectors, ids, k)
    order = np.argsort(-(vectors ** 2).sum(1), kind="stable")
    levels = [(statistics(queries, n), statistics(vectors, n)) for n in params.segments]
    size = np.sqrt((queries ** 2).sum(1))
    bound = np.full(len(queries), -np.inf)
    q, v, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for at in range(0, len(order), params.at_once):
        here = order[at:at + params.at_once]
        slack = 1e-9 * (size * math.sqrt(float((vectors[here] ** 2).sum(1).max(initial=0.0))) + 1.0)
        i = j = None
        for of_q, of_v in levels:
            if i is None or len(i) > 0.2 * len(queries) * len(here):
                top = of_q @ of_v[here].T
                alive = (top >= (bound - slack)[:, None]) & (qids[:, None] != ids[here])
                if i is not None:
                    last = np.zeros_like(alive)
                    last[i, j] = True
                    alive &= last
                i, j = np.nonzero(alive)
            else:
                top = np.einsum("ij,ij->i", of_q[i], of_v[here[j]])
                stay = top >= (bound - slack)[i]
                i, j = i[stay], j[stay]
        if len(i) > 0.2 * len(queries) * len(here):
            score = (queries @ vectors[here].T)[i, j]
        else:
            score = np.einsum("ij,ij->i", queries[i], vectors[here[j]])
        reach = score >= bound[i]
        q, v, s = np.concatenate([q, i[reach]]), np.concatenate([v, here[j[reach]]]), np.concatenate([s, score[reach]])
        keep = best_pairs(q, s, ids[v], k)
        q, v, s = q[keep], v[keep], s[keep]
        worst = np.full(len(queries), np.inf)
        np.minimum.at(worst, q, s)
        bound = np.where(np.bincount(q, minlength=len(queries)) >= k, worst, -np.inf)
    return q, v, s


def scan_huge(queries: np.ndarray, qids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for components beyond the exact range of doubles: all products in Python integers."""
    out: list[tuple[int, int, int]] = []
    for i, row in enumerate(queries.tolist()):
        found = ((min(max(sum(int(a) * int(b) for a, b in zip(row, x)), LEAST), MOST), j) for j, x in enumerate(vectors.tolist()) if ids[j] != qids[i])
        out += [(i, j, s) for s, j in heapq.nsmallest(k, found, key=lambda t: (-t[0], ids[t[1]]))]
    q, v, s = (list(c) for c in zip(*out)) if out else ([], [], [])
    return np.array(q, np.int64), np.array(v, np.int64), np.array(s, object)


def search(df: DataFrame, is_query, params: TopkParams = TopkParams(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (long) of the k highest integer products of
    every row for which the condition ``is_query`` on ``id`` holds."""
    rows = cut_lineage(usable(df, vec_id, vector, allow_zero=True).distinct(), "topk-vectors")
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.sum(F.when(is_query, 1).otherwise(0)).alias("q")).first()
    if not about["n"] or not about["q"]:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, cells = about["d"], math.ceil(about["n"] / params.per_cell)
    blocks = math.ceil(about["q"] / params.queries_per_block)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("cell", part_of("id", cells)).withColumn("block", every(blocks))
    right = (rows.where(is_query).select(F.col("id").alias("qid"), F.col("v").alias("q"))
             .withColumn("block", part_of("qid", blocks)).withColumn("cell", every(cells)))

    def meet(vs: pa.Table, qs: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if vs.num_rows and qs.num_rows:
            ids, x = vs.column("id").to_numpy(), integers(matrix(vs.column("v"), width), params.scale)
            for at in range(0, qs.num_rows, params.at_once):
                part = qs.slice(at, params.at_once)
                qid = part.column("qid").to_numpy()
                i, j, s = scan(integers(matrix(part.column("q"), width), params.scale), qid, x, ids, params)
                out[0].append(qid[i])
                out[1].append(ids[j])
                out[2] += [int(t) for t in s.tolist()]
        return pa.table({"query_id": np.concatenate([np.zeros(0, np.int64), *out[0]]), "vec_id": np.concatenate([np.zeros(0, np.int64), *out[1]]),
                         "score": pa.array(out[2], pa.int64())})

    found = left.groupBy("cell", "block").cogroup(right.groupBy("cell", "block")).applyInArrow(meet, "query_id long, vec_id long, score long")
    return ranked(found, params.k)
