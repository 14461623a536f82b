"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Every source gets a target number of words. The document rates closest to 1 (in
relative entropy) that meet all targets are exponentially tilted:
``rate = min(most, exp(lambda_source * size / mean_size))``. The lambdas solve
the convex dual, found by Newton steps kept inside a bracket; each step is one
aggregate over the table of distinct (source, size), not over the documents.
All sums are exact decimals, so reruns agree bit by bit.

Rates become whole copies by systematic rounding: the rows of a source are
dealt into buckets by hash, ordered by size in each, and a row gets one more
copy where the running sum of the fractions passes a whole number. As
neighbours in that order have almost the same size, a bucket misses its share
by no more than its largest document; single copies of smaller documents then
make up what is missing, to within about the smallest that fits.

Null or empty texts have size 0 and rate 1. Null sources are a source of
their own, the last in order. Repeated rows share their copies. A source
without words has target 0. Very long texts only count their words. An empty table gives an
empty result. ``mix`` keeps all columns, whatever their names; its own go by names that the table
doesn't have. The table of sources (a row each) is numbered in one task, which holds no documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from pricetrend.llm.common import cut_lineage, fresh_name, words_in

UNIT = 1 << 20          # rates are rounded to this part before they are summed
EXACT = "decimal(38,9)"


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (5, 2, 1)   # of the sources by code point, repeating
    most: int = 3                          # copies of a document, and target over size
    tolerance: float = 1e-6
    max_steps: int = 80
    rows_per_bucket: int = 512


def source_targets(sized: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """source, sid (1, 2, ... by code point, null last), source_size, rows, target.

    Targets share the total by weight and stop at ``most`` times the source's
    size; the excess is shared again. In order of size per weight, that means a
    common level per unit of weight, the largest of those the prefixes give.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, params.weights)), (F.pmod(F.col("sid") - 1, F.lit(len(params.weights))) + 1).cast("int"))
    per = (per.withColumn("sid", F.row_number().over(ordered).cast("long"))
           .withColumn("weight", weight.cast("long"))
           .withColumn("cap", F.col("source_size") * F.lit(params.most)))
    tight = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    onward = tight.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("sid")
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("weight").over(onward))
    return (per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
            .select("source", "sid", "source_size", "rows",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")))


def _rate(most: int):
    tilt = F.try_divide(F.col("lam") * F.col("size"), F.col("mean"))
    return F.when(F.col("full"), F.when(F.col("size") > 0, F.lit(float(most))).otherwise(F.lit(1.0))).when(
        F.col("mean") > 0, F.least(F.lit(float(most)), F.exp(F.least(tilt, F.lit(math.log(most) + 1.0))))).otherwise(F.lit(1.0))


def solve(histogram: DataFrame, sources: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``sources`` with the lambda of each (columns lam, mean, full) that meets its target.

    ``histogram`` has sid, size and n (rows of that size). Sources whose target is
    their most possible are full: every document with words at the highest rate.
    """
    most = float(params.most)
    state = sources.withColumn("mean", F.try_divide(F.col("source_size").cast("double"), F.col("rows"))).withColumn(
        "full", F.col("target") >= F.col("source_size") * F.lit(most)).withColumn(
        "lam", F.when(F.col("full") | (F.col("source_size") <= 0), 0.0).otherwise(F.log(F.try_divide(F.col("target"), F.col("source_size"))))).withColumn(
        "lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double"))
    state = cut_lineage(state, "mix-state")
    for _ in range(params.max_steps):
        words = F.col("n") * F.col("size") * _rate(params.most)
        slope = F.when(_rate(params.most) < most, F.try_divide(words * F.col("size"), F.col("mean"))).otherwise(F.lit(0.0))
        got = (histogram.join(state.select("sid", "lam", "mean", "full"), "sid").groupBy("sid")
               .agg(F.sum(words.cast(EXACT)).cast("double").alias("g"), F.sum(slope.cast(EXACT)).cast("double").alias("h")))
        miss = F.col("g") - F.col("target")
        free = ~F.col("full") & (F.col("source_size") > 0)
        done = ~free | (F.abs(miss) <= F.col("target") * params.tolerance)
        lo = F.when(miss < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(miss >= 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.try_divide(miss, F.col("h"))
        inside = (newton > F.coalesce("lo", F.lit(-math.inf))) & (newton < F.coalesce("hi", F.lit(math.inf))) & (
            F.abs(newton - F.col("lam")) < 4.0 + 2.0 * F.abs("lam"))
        fallback = (F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2)
                    .when(F.col("hi").isNull(), 2.0 * F.abs("lam") + 1.0).otherwise(-2.0 * F.abs("lam") - 1.0))
        step = state.join(got, "sid").withColumn("lo", lo).withColumn("hi", hi).withColumn("done", done)
        step = step.withColumn("lam", F.when(F.col("done"), F.col("lam")).when(inside, newton).otherwise(fallback))
        state = cut_lineage(step.drop("g", "h"), "mix-state")
        if state.where(~F.col("done")).isEmpty():
            return state.drop("lo", "hi", "done")
        state = state.drop("done")
    raise RuntimeError(f"targets not met after {params.max_steps} steps")


def plan(sized: DataFrame, key: str, params: MixParams = MixParams()) -> DataFrame:
    """The mix of a table with columns ``key``, source and size: for each distinct row
    its number of ``rows``, their ``copies`` together, source_size, target and rate.

    ``sized`` is read several times; write it first if it is dear.
    """
    sources = cut_lineage(source_targets(sized, params), "mix-sources")
    ids = sources.select(F.col("source").alias("its_source"), "sid")
    groups = cut_lineage(sized.join(ids, F.col("source").eqNullSafe(F.col("its_source")))
                         .groupBy(key, "sid", "size").agg(F.count(F.lit(1)).alias("n")), "mix-groups")
    histogram = cut_lineage(groups.groupBy("sid", "size").agg(F.sum("n").alias("n")), "mix-histogram")
    solved = solve(histogram, sources, params)
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(params.rows_per_bucket)))
    parts = F.floor(_rate(params.most) * UNIT + F.lit(0.5)).cast("long")
    w = Window.partitionBy("sid", "bucket").orderBy("size", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sofar = F.sum(F.col("n") * F.pmod("parts", F.lit(UNIT))).over(w) + F.pmod(F.xxhash64("sid", "bucket"), F.lit(UNIT))
    own = F.col("n") * F.pmod("parts", F.lit(UNIT))
    whole = lambda x: F.floor(x / F.lit(UNIT)).cast("long")
    rounded = (groups.join(solved, "sid")
               .withColumn("bucket", F.pmod(F.xxhash64(key), buckets))
               .withColumn("parts", parts)
               .withColumn("sofar", sofar)
               .withColumn("copies", F.col("n") * whole(F.col("parts")) + whole(F.col("sofar")) - whole(F.col("sofar") - own)))
    # What a bucket still misses (or has too much) is made up by single copies of documents
    # that fit: first in hash order, then the rest by the smallest.
    everything = Window.partitionBy("sid", "bucket")
    for order in ([F.xxhash64(F.lit("settle"), key), F.col(key)], [F.col("size"), F.col(key)]):
        miss = whole(F.sum(F.col("n") * F.col("parts") * F.col("size") - F.col("copies") * F.col("size") * F.lit(UNIT)).over(everything))
        rounded = rounded.withColumn("miss", miss)
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("miss")) & F.when(
            F.col("miss") > 0, F.col("copies") < F.col("n") * params.most).otherwise(F.col("copies") > 0)
        upto = everything.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        used = F.sum(F.when(fits, F.col("size")).otherwise(F.lit(0))).over(upto)
        rounded = rounded.withColumn("used", used).withColumn(
            "copies", F.col("copies") + F.when(fits & (F.col("used") <= F.abs("miss")), F.signum("miss").cast("long")).otherwise(F.lit(0)))
    return rounded.select(key, "source", "size", "source_size", "target", _rate(params.most).alias("rate"), F.col("n").alias("rows"), "copies")


def per_row(planned: DataFrame, name: str = "row_copies", at_once: int = 10_000) -> DataFrame:
    """A row for each original row: of r equal rows sharing c copies, the first
    c mod r take one more than the others."""
    r = F.col("rows")
    chunks = planned.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((r - 1) / at_once).cast("long"))))
    spread = chunks.withColumn("_row", F.explode(F.sequence(F.col("_chunk") * at_once, F.least(r, (F.col("_chunk") + 1) * at_once) - 1)))
    return (spread.withColumn(name, F.floor(F.col("copies") / r).cast("long") + (F.col("_row") < F.col("copies") % r).cast("long"))
            .drop("_chunk", "_row"))


def mix(df: DataFrame, params: MixParams = MixParams(), text: str = "text", source: str = "source") -> DataFrame:
    """``df`` with each row repeated as often as the mix takes it (0 to ``most`` times)."""
    mark, size = fresh_name(df, "mark"), fresh_name(df, "words")
    # Equal rows have equal marks; they share their copies.
    marked = df.withColumn(mark, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).withColumn(size, words_in(F.col(text)))
    sized = cut_lineage(marked.select(F.col(mark).alias("key"), F.col(source).alias("source"), F.col(size).alias("size")), "mix-sized")
    planned = cut_lineage(plan(sized, "key", params).select("key", "rows", "copies").where("copies > 0"), "mix-plan")
    key, copies, again = (fresh_name(df, x) for x in ("key", "copies", "again"))
    taken = planned.select(F.col("key").alias(key), F.col("copies").alias(copies), "rows")
    bodies, here = marked.drop(size), F.col(mark) == F.col(key)
    # Merged at every size: the plan grows with the documents, so it is never broadcast.
    out = bodies.join(taken.where("rows = 1").drop("rows").hint("merge"), here)
    several = taken.where("rows > 1").drop("rows")
    if not several.isEmpty():
        out = out.unionByName(bodies.join(several, here).dropDuplicates([mark]))
    return out.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in df.columns])
