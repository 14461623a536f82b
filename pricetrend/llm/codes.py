"""Vector code compression: a product quantiser trained with ball k-means.

Vectors become integers, floor(scale * x), and are cut into ``parts`` equal
consecutive parts. Every part position has a codebook, at first that part of the
rows with the smallest ids. A round assigns each part to the nearest entry
(squared Euclidean distance, ties to the lower index) and then replaces each
entry by the componentwise floor of its parts' mean; unused entries stay.

The parts assigned to an entry are a ball around it. Its radius names the
neighbours, the entries near enough to take a member. Sorted by distance from
the entry they cut the ball into a stable core, whose members can't leave, and
rings: a member of ring r is compared with the r nearest neighbours only. A
ball whose entry and neighbours haven't moved keeps its members without any
distance. Distances are exact integers and a neighbour is left out only if it is
strictly farther, so the result is that of the full search.

A round is two jobs over a written table: one assigns (rows keep their code and
distances beside them), one adds up the parts of each entry. Only codebooks and
sums, of a size that the parameters fix, pass through the driver.

Vectors that are null, empty or hold null or non-finite components are dropped.
Of differing lengths the most frequent one counts (ties: the longer). A length
that ``parts`` doesn't divide is filled with zeros. Components beyond what exact
64-bit distances allow (2**26 for 64 dimensions, after scaling) count as that
limit. Null ids sort last and stay. Repeated rows count and are returned each;
among equal ids the smaller vector comes first. Fewer rows than entries give
shorter codebooks, an empty table none and no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetrend.llm.common import cut_lineage
from pricetrend.llm.vectors import matrix
from pricetrend.operators.keyed import join_series
from pricetrend.session import last_written, release_table


@dataclass(frozen=True)
class CodeParams:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    at_once: int = 65536    # rows whose balls a task forms at once


@dataclass(frozen=True)
class Codes:
    rows: DataFrame         # id, label, code (entry of each part), dist (squared distance of each part)
    books: np.ndarray       # parts x entries x width

    def digest(self) -> str:
        """SHA-256 of all entries' decimal components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """All squared distances, exact: by doubles where they hold every product, else by integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * most ** 2 < 2 ** 52 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)


class Balls:
    """The balls of one codebook: neighbours by distance, ring bounds, and which are settled."""

    def __init__(self, book: np.ndarray, before: np.ndarray, radius2: np.ndarray):
        gap = distances(book, book)
        np.fill_diagonal(gap, -1)
        self.order = np.argsort(gap, axis=1, kind="stable")[:, 1:]
        self.gap = np.take_along_axis(gap, self.order, axis=1)
        moved = (book != before).any(axis=1)
        shift = np.sqrt(((book - before).astype(np.float64) ** 2).sum(1))
        # No member is farther from the moved entry than radius + shift; half a unit covers rounding.
        reach = 2.0 * (np.sqrt(radius2.astype(np.float64)) + shift) * (1 + 1e-9) + 0.5
        self.near = (self.gap.astype(np.float64) <= (reach * reach)[:, None]).sum(1)
        of_neighbours = np.array([moved[o[:n]].any() for o, n in zip(self.order, self.near)], bool)
        self.settled = ~(moved | of_neighbours)


def assign(x: np.ndarray, code: np.ndarray, dist: np.ndarray, book: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part and its squared distance, from the last round's."""
    code, dist = code.copy(), dist.copy()
    by = np.argsort(code, kind="stable")
    cuts = np.flatnonzero(np.diff(code[by])) + 1
    for members in np.split(by, cuts):
        if not len(members):
            continue
        i = int(code[members[0]])
        if balls.settled[i]:
            continue
        own = ((x[members] - book[i]) ** 2).sum(1)
        dist[members] = own
        ring = np.searchsorted(balls.gap[i, :balls.near[i]], 4 * own, side="right")
        # The stable core has ring 0; the outer rings are searched in groups of like size.
        for low, high in ((0, 4), (4, 16), (16, 64), (64, len(book))):
            pick = (ring > low) & (ring <= high)
            if not pick.any():
                continue
            mine, until = members[pick], ring[pick]
            entries = np.concatenate([[i], balls.order[i, :until.max()]])
            rank = np.arange(len(entries))
            asc = np.argsort(entries)
            d = distances(x[mine], book[entries[asc]])
            d[rank[asc][None, :] > until[:, None]] = np.iinfo(np.int64).max
            best = d.argmin(1)
            code[mine], dist[mine] = entries[asc][best], d[np.arange(len(mine)), best]
    return code, dist


def _pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held, n = [*held, b], n + b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _lists(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    at = pa.array(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(at, pa.array(a.ravel(), kind))


def whole_vectors(df: DataFrame, vec_id: str, vector: str, label: str | None, params: CodeParams) -> DataFrame:
    """id, label and v (integers, filled up to a multiple of ``parts``) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), (F.col(f"`{label}`") if label else F.lit(None)).cast("string").alias("label"),
                     F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where(F.coalesce((F.size("v") > 0) & F.forall("v", finite), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = sizes["d"] if sizes else params.parts
    limit = float(2 ** ((62 - d.bit_length()) // 2 - 1))
    whole = F.transform("v", lambda x: F.floor(F.least(F.greatest(x * params.scale, F.lit(-limit)), F.lit(limit))).cast("int"))
    fill = F.array_repeat(F.lit(0), -d % params.parts)
    return rows.where(F.size("v") == d).select("id", "label", F.concat(whole, fill).alias("v"))


def _next_table(rows: DataFrame, run, schema: str, old: str | None) -> DataFrame:
    """The assigned rows as a written table; the one they were read from goes."""
    out = cut_lineage(rows.mapInArrow(run, schema), "vector-codes")
    if old:
        release_table(rows.sparkSession, old)
    return out


def compress(df: DataFrame, params: CodeParams = CodeParams(), vec_id: str = "vec_id", vector: str = "embedding",
             label: str | None = "label") -> Codes:
    """Codes and distances of all rows that take part, and the final codebooks."""
    spark, p = df.sparkSession, params
    rows = cut_lineage(whole_vectors(df, vec_id, vector, label, p), "vector-codes")
    path = last_written()
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(p.entries).select("v").collect()  # at most one codebook
    schema = "id long, label string, v array<int>, code array<int>, dist array<long>"
    if not first:
        return Codes(spark.createDataFrame([], schema).drop("v"), np.zeros((p.parts, 0, 0), np.int64))
    books = np.array([r["v"] for r in first], np.int64)
    books = np.ascontiguousarray(books.reshape(len(first), p.parts, -1).transpose(1, 0, 2))
    width = books.shape[2]
    balls: list[Balls] | None = None
    for step in range(p.rounds + 1):
        shared = spark.sparkContext.broadcast((books, balls))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books, balls = shared.value
            for t in _pieces(batches, p.at_once):
                x = matrix(t.column("v"), p.parts * width).astype(np.int64)
                code, dist = np.empty((2, len(x), p.parts), np.int64)
                for k in range(p.parts):
                    part = x[:, k * width:(k + 1) * width]
                    if balls is None:
                        for at in range(0, len(x), 4096):
                            d = distances(part[at:at + 4096], books[k])
                            code[at:at + 4096, k] = best = d.argmin(1)
                            dist[at:at + 4096, k] = d[np.arange(len(d)), best]
                    else:
                        code[:, k], dist[:, k] = assign(part, matrix(t.column("code"), p.parts)[:, k].astype(np.int64),
                                                        matrix(t.column("dist"), p.parts)[:, k], books[k], balls[k])
                out = pa.table({"id": t.column("id"), "label": t.column("label"), "v": t.column("v"),
                                "code": _lists(code, pa.int32()), "dist": _lists(dist, pa.int64())})
                yield from out.combine_chunks().to_batches()

        rows = _next_table(rows, run, schema, path)
        path = last_written()
        if step < p.rounds:
            before, (books, radius2) = books, _replaced(rows, books, p)
            balls = [Balls(*t) for t in zip(books, before, radius2)]
    return Codes(rows.drop("v"), books)


def _replaced(rows: DataFrame, books: np.ndarray, p: CodeParams) -> tuple[np.ndarray, np.ndarray]:
    """The entries replaced by the floors of their parts' means, and the squared radii of the balls."""
    parts, k, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, far = np.zeros((parts, k), np.int64), np.zeros((parts, k), np.int64)
        total = np.zeros((parts, k, width), np.int64)
        for t in _pieces(batches, p.at_once):
            x, code, dist = matrix(t.column("v"), parts * width).astype(np.int64), matrix(t.column("code"), parts), matrix(t.column("dist"), parts)
            for i in range(parts):
                n[i] += np.bincount(code[:, i], minlength=k)
                np.maximum.at(far[i], code[:, i], dist[:, i])
                np.add.at(total[i], code[:, i], x[:, i * width:(i + 1) * width])
        i, j = np.nonzero(n)
        names = ["part", "entry", "n", "far", *(f"s{c}" for c in range(width))]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(n[i, j]), pa.array(far[i, j]),
                                          *(pa.array(total[i, j, c]) for c in range(width))], names)

    schema = "part int, entry int, n long, far long, " + ", ".join(f"s{c} long" for c in range(width))
    sums = (rows.select("v", "code", "dist").mapInArrow(add, schema).groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), F.max("far").alias("far"), *[F.sum(F.col(f"s{c}").cast("decimal(38,0)")).alias(f"s{c}") for c in range(width)]))
    books, radius2 = books.copy(), np.zeros((parts, k), np.int64)
    for r in sums.collect():  # a row per entry
        books[r["part"], r["entry"]] = [int(r[f"s{c}"]) // r["n"] for c in range(width)]
        radius2[r["part"], r["entry"]] = r["far"]
    return books, radius2


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``error`` (distances summed over parts) and ``label_error`` (errors summed
    over equal labels, nulls together). Sums are taken before the join, which moves no data rows
    while the labels are few (see ``join_series``)."""
    rows = coded.withColumn("error", F.aggregate("dist", F.lit(0).cast("long"), lambda a, x: a + x))
    per = rows.groupBy(F.col("label").alias("symbol")).agg(F.sum("error").alias("label_error"))
    return join_series(rows.withColumnRenamed("label", "symbol"), per, spread_by="id").withColumnRenamed("symbol", "label")


def code_text(code, entries: int = 256):
    """The entries of a code as hex digits, as many for each as the largest index needs."""
    digits = max(2, math.ceil(math.log(max(2, entries), 16)))
    return F.array_join(F.transform(code, lambda c: F.lower(F.lpad(F.hex(c), digits, "0"))), "")
