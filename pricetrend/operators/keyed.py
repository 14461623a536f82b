"""Joining one row per series to the rows of the series.

A symbol may hold a third of all rows, so data rows are never shuffled on the
symbol alone. The per-series table is written and counted: up to
``broadcast_rows`` rows it is broadcast (the data rows don't move), beyond that
its rows are repeated for every salt and the data rows are dealt by
(symbol, salt), which splits a hot symbol evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricetrend.session import cut_lineage


def join_series(df: DataFrame, per_series: DataFrame, spread_by: str = "bar_no",
                broadcast_rows: int = 100_000, salts: int = 64) -> DataFrame:
    """``df`` with the other columns of ``per_series`` (one row per symbol, NULL included)."""
    keyed = cut_lineage(per_series.withColumnRenamed("symbol", "_its_symbol"), "per-series")
    same = F.col("symbol").eqNullSafe(F.col("_its_symbol"))
    if keyed.count() <= broadcast_rows:
        return df.join(F.broadcast(keyed), same, "left").drop("_its_symbol")
    keyed = keyed.withColumn("_its_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    return (dealt.join(keyed, same & (F.col("_salt") == F.col("_its_salt")), "left")
            .drop("_its_symbol", "_salt", "_its_salt"))
