"""Approximate nearest neighbours by an adaptive dimension scan.

Index: vectors are dealt into lists by their nearest centre (k-means on a
bounded sample; every vector is indexed). For inner products each vector gets
one more coordinate that gives all the same length, so the largest product is
the least distance. Search: a query probes its nearest lists; a random rotation
makes partial distances over the first coordinates estimates of the whole, and
in blocks of columns a candidate is abandoned once a hypothesis test says that
its distance exceeds the query's k-th best so far. Survivors get their exact
inner product on the original vectors.

A query first searches its nearest lists, and takes the k-th best of them as
the bound for the others. The number of lists to probe is calibrated on the
sample so that ``recall`` of true neighbours lie in them. Large lists are split
by hash, and so are their queries, so that no task holds more than
``per_part`` of the one and ``queries_per_part`` of the other on average.

Vectors that are null, zero, or hold null or non-finite components take no
part (see ``usable`` for differing lengths). Repeated rows count once; a row is
no candidate of queries with its own id. A query that its lists leave short of k
goes on to further ones, in the end to all; fewer than k candidates give fewer
rows, an empty table none. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetrend.llm.common import cut_lineage
from pricetrend.llm.vectors import best_pairs, matrix, part_of, ranked, usable


@dataclass(frozen=True)
class AnnParams:
    k: int = 20
    sample: int = 8192
    per_list: int = 1024        # vectors to a list, on average, while the sample can feed the centres
    recall: float = 0.97
    first_lists: int = 2
    columns: int = 16
    doubt: float = 1.5          # of the hypothesis tests, in deviations of a partial distance
    per_part: int = 8192
    queries_per_part: int = 16384
    at_once: int = 1024
    seed: int = 20


@dataclass
class AnnIndex:
    """What every task needs to deal out vectors: bounded by the sample size."""

    params: AnnParams
    width: int
    longest: float              # largest squared length
    scale: float
    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Scaled vectors with the additional coordinate, rotated."""
        x = x / self.scale
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.longest - (x * x).sum(1)))
        return np.concatenate([x, more[:, None]], axis=1) @ self.rotation

    def nearness(self, lifted: np.ndarray) -> np.ndarray:
        """Squared distances to the centres."""
        return (lifted * lifted).sum(1)[:, None] + (self.centres * self.centres).sum(1) - 2.0 * lifted @ self.centres.T


def fit(vectors: DataFrame, params: AnnParams = AnnParams()) -> AnnIndex | None:
    """Centres, rotation and number of probes from a bounded sample (smallest id hashes);
    ``vectors`` is a table of ``usable`` ones. None if it is empty."""
    top = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    about = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.max(top).alias("top")).first()
    if not about["n"]:
        return None
    scale = float(about["top"])
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))
    longest = float(vectors.agg(F.max(square)).first()[0])
    # At most ``sample`` vectors, and fewer of very long ones: two million numbers in all.
    most = max(256, min(params.sample, 2_000_000 // about["d"]))
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(most).select("v").collect()
    x = np.array([r["v"] for r in rows], np.float64)
    rng = np.random.default_rng(params.seed)
    rotation = np.linalg.qr(rng.normal(size=(about["d"] + 1,) * 2))[0]
    index = AnnIndex(params, about["d"], longest, scale, rotation, np.zeros((1, about["d"] + 1)), 1)
    lifted = index.lift(x)
    lists = max(1, min(math.ceil(about["n"] / params.per_list), len(x) // 8))
    centres = lifted[np.sort(rng.choice(len(lifted), lists, replace=False))]
    for _ in range(12):
        index.centres = centres
        own = index.nearness(lifted).argmin(1)
        size = np.bincount(own, minlength=lists)
        total = np.zeros_like(centres)
        np.add.at(total, own, lifted)
        centres = np.where(size[:, None] > 0, total / np.maximum(1, size)[:, None], centres)
    index.centres = centres
    # Where the true neighbours of sample queries lie, among the lists in order of nearness.
    own = index.nearness(lifted).argmin(1)
    asked = np.arange(0, len(x), max(1, len(x) // 512))
    products = (x[asked] / scale) @ (x / scale).T
    products[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-products, axis=1, kind="stable")[:, :params.k]
    place = np.argsort(np.argsort(index.nearness(index.lift(x[asked], True)), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, own[near], 1).ravel() + 1
    index.probes = int(min(lists, max(1, math.ceil(np.quantile(needed, params.recall)))))
    return index


def scan(index: AnnIndex, queries: np.ndarray, qids: np.ndarray, bound: np.ndarray, vectors: np.ndarray,
         ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best pairs of ``queries`` in one part of a list: query positions, positions of vectors, products.

    ``bound`` is a product per query that pairs must reach to matter (-inf: none).
    """
    p = index.params
    width, dims = p.columns, index.width + 1
    edges = [*range(0, dims, width), dims]
    lq, lx = index.lift(queries, True), index.lift(vectors)
    length = (lq * lq).sum(1) + index.longest
    bound = bound.copy()
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for at in range(0, len(vectors), p.at_once):
        stop = min(len(vectors), at + p.at_once)
        with np.errstate(over="ignore", invalid="ignore"):
            least = length - 2.0 * bound / index.scale ** 2
        least = np.where(np.isfinite(least), np.maximum(least, 0.0), np.inf)
        a, b = edges[0], edges[1]
        part = ((lq[:, a:b] ** 2).sum(1)[:, None] + (lx[at:stop, a:b] ** 2).sum(1)) - 2.0 * lq[:, a:b] @ lx[at:stop, a:b].T
        alive = (part * (dims / b) <= (least * (1.0 + p.doubt / math.sqrt(b)) ** 2 + 1e-12)[:, None]) & (qids[:, None] != ids[at:stop])
        i, j = np.nonzero(alive)
        far = part[i, j]
        for a, b in zip(edges[1:-1], edges[2:]):
            if not len(i):
                break
            # One product for all pairs is cheaper while many are alive.
            if len(i) > 0.2 * alive.size:
                cross = (lq[:, a:b] @ lx[at:stop, a:b].T)[i, j]
                far = far + (lq[:, a:b] ** 2).sum(1)[i] + (lx[at:stop, a:b] ** 2).sum(1)[j] - 2.0 * cross
            else:
                far = far + ((lq[i, a:b] - lx[at + j, a:b]) ** 2).sum(1)
            slack = 1.0 + p.doubt / math.sqrt(b) if b < dims else 1.0 + 1e-9
            stay = far * (dims / b) <= least[i] * slack ** 2 + 1e-9
            i, j, far = i[stay], j[stay], far[stay]
        score = np.einsum("ij,ij->i", queries[i], vectors[at + j])
        q = np.concatenate([held[-1][0], i])
        v = np.concatenate([held[-1][1], at + j])
        s = np.concatenate([held[-1][2], score])
        keep = best_pairs(q, s, ids[v], p.k)
        q, v, s = q[keep], v[keep], s[keep]
        held = [(q, v, s)]
        full = np.bincount(q, minlength=len(queries)) >= p.k
        worst = np.full(len(queries), np.inf)
        np.minimum.at(worst, q, s)
        bound = np.where(full, np.maximum(bound, worst), bound)
    return held[0]


def _dealt(vectors: DataFrame, index: AnnIndex) -> DataFrame:
    """id, v and list of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def assign(batches):
        m = shared.value
        for b in batches:
            x = matrix(b.column("v"), m.width)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(m.nearness(m.lift(x)).argmin(1).astype(np.int32))], ["id", "v", "list"])

    return vectors.mapInArrow(assign, "id long, v array<double>, list int")


def _routes(queries: DataFrame, index: AnnIndex, start: int, stop: int) -> DataFrame:
    """A row of each query (qid, q, bound) for the lists from place ``start`` to ``stop`` in nearness."""
    shared = queries.sparkSession.sparkContext.broadcast(index)

    def route(batches):
        m = shared.value
        for b in batches:
            order = np.argsort(m.nearness(m.lift(matrix(b.column("q"), m.width), True)), axis=1, kind="stable")[:, start:stop]
            yield pa.RecordBatch.from_arrays([b.column("qid"), b.column("q"), b.column("bound"),
                                              pa.array(order.astype(np.int32).tolist(), pa.list_(pa.int32()))], ["qid", "q", "bound", "lists"])

    return queries.mapInArrow(route, "qid long, q array<double>, bound double, lists array<int>").select(
        "qid", "q", "bound", F.explode("lists").alias("list"))


def _probe(dealt: DataFrame, routed: DataFrame, index: AnnIndex) -> DataFrame:
    """query_id, vec_id, score of the best pairs in each part of the routed lists."""
    p = index.params
    n_vectors = {r["list"]: r["n"] for r in dealt.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_queries = {r["list"]: r["n"] for r in routed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces = lambda n, most: F.element_at(F.array(*[F.lit(max(1, math.ceil(n.get(i, 0) / most))) for i in range(len(index.centres))]), F.col("list") + 1)
    parts, blocks = pieces(n_vectors, p.per_part), pieces(n_queries, p.queries_per_part)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = dealt.withColumn("part", part_of("id", parts)).withColumn("block", every(blocks))
    right = routed.withColumn("block", part_of("qid", blocks)).withColumn("part", every(parts))
    shared = dealt.sparkSession.sparkContext.broadcast(index)

    def search(vs: pa.Table, qs: pa.Table) -> pa.Table:
        m = shared.value
        out = [[], [], []]
        if vs.num_rows and qs.num_rows:
            ids, x = vs.column("id").to_numpy(), matrix(vs.column("v"), m.width)
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            for at in range(0, qs.num_rows, m.params.at_once):
                part = qs.slice(at, m.params.at_once)
                qid = part.column("qid").to_numpy()
                i, j, s = scan(m, matrix(part.column("q"), m.width), qid, part.column("bound").to_numpy(), x, ids)
                for held, got in zip(out, (qid[i], ids[j], s)):
                    held.append(got)
        kinds = (np.int64, np.int64, np.float64)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (np.concatenate([np.zeros(0, t), *o]).astype(t) for o, t in zip(out, kinds)))))

    keys = ["list", "part", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")


def search(df: DataFrame, is_query, params: AnnParams = AnnParams(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest found (largest inner
    product) of every row for which the condition ``is_query`` on ``id`` holds."""
    vectors = cut_lineage(usable(df, vec_id, vector, allow_zero=False).distinct(), "ann-vectors")
    index = fit(vectors, params)
    if index is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dealt = cut_lineage(_dealt(vectors, index), "ann-lists")
    queries = vectors.where(is_query).select(F.col("id").alias("qid"), F.col("v").alias("q"), F.lit(float("-inf")).alias("bound"))
    first = min(params.first_lists, index.probes)
    found = cut_lineage(_probe(dealt, _routes(queries, index, 0, first), index), "ann-first")
    if index.probes > first:
        last = ranked(found, params.k).where(F.col("rank") == params.k).select(F.col("query_id").alias("its_id"), F.col("score").alias("told"))
        bounded = queries.join(last, F.col("qid") == F.col("its_id"), "left").select("qid", "q", F.coalesce("told", "bound").alias("bound"))
        bounded = cut_lineage(bounded, "ann-bounded")
        found = found.unionByName(_probe(dealt, _routes(bounded, index, first, index.probes), index))
    # Tiny or empty lists may leave a query short of k: it goes on to further lists, in the end to all.
    probed = index.probes
    while probed < len(index.centres):
        found = cut_lineage(ranked(found, params.k).drop("rank"), "ann-found")
        enough = (found.groupBy(F.col("query_id").alias("its_id")).agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") >= params.k))
        short = cut_lineage(queries.join(enough, F.col("qid") == F.col("its_id"), "left_anti"), "ann-short")
        if not short.limit(1).count():
            break
        more = min(len(index.centres), 4 * probed)
        found = found.unionByName(_probe(dealt, _routes(short, index, probed, more), index))
        probed = more
    return ranked(found, params.k)
