"""Chronological bar numbering and bounded row blocks.

Neither step puts a whole series into one task:

* ``number_bars`` counts bars per (symbol, time chunk), turns the counts into
  per-chunk offsets by a scan in two levels (``scan``), and numbers rows
  inside each chunk. A chunk holds at most ``chunk_bars`` bars because bars
  are unique per (symbol, bar_ts) and at least one grain apart.
* ``block_rows`` cuts each numbered series into blocks of ``block`` bars and
  copies the last ``halo`` bars of every block into the next one, so bounded
  look-back windows are exact inside a (symbol, block) partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pricetrend.operators.scan import GROUP, sums_before
from pricetrend.sources.bars import GRAIN_SECONDS, wall_seconds


def time_chunk(ts_col: str, grain: str, chunk_bars: int):
    span = GRAIN_SECONDS[grain] * chunk_bars
    return F.floor(wall_seconds(F.col(ts_col)) / F.lit(span))


def number_bars(bars: DataFrame, grain: str = "day", chunk_bars: int = 4096,
                symbol_col: str = "symbol", order_col: str = "bar_ts",
                tie_break: list[str] | None = None) -> DataFrame:
    """Add ``bar_no`` (1-based, per symbol, by ``order_col``, then ``tie_break``).

    A NULL time has no position: the query fails instead of losing the row. A NULL
    symbol is a series of its own. Without ``tie_break`` times must be unique in a
    series (bars are; ``read_ohlc_csv`` rejects duplicates).
    """
    place = F.when(F.col(order_col).isNull(), F.raise_error(F.lit(f"NULL {order_col}: the row has no position")).cast("long"))
    chunked = bars.withColumn("_chunk", place.otherwise(time_chunk(order_col, grain, chunk_bars)))
    counts = chunked.groupBy(symbol_col, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    # Chunks of times before 1970 have negative numbers.
    numbered = counts.withColumn("_at", F.col("_chunk") + F.lit(GROUP * GROUP // 2))
    offsets = sums_before(numbered, symbol_col, "_at", {"_n": "_offset"}).select(
        F.col(symbol_col).alias("_symbol"), F.col("_chunk").alias("_at"), "_offset")
    w_local = Window.partitionBy(symbol_col, "_chunk").orderBy(order_col, *(tie_break or []))
    return (chunked
            .withColumn("_local", F.row_number().over(w_local))
            .join(offsets, F.col(symbol_col).eqNullSafe(F.col("_symbol")) & (F.col("_chunk") == F.col("_at")))
            .withColumn("bar_no", (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_chunk", "_local", "_offset", "_symbol", "_at"))


def block_rows(numbered: DataFrame, block: int, halo: int) -> DataFrame:
    """Assign ``blk``/``pos`` and replicate the last ``halo`` rows into ``blk + 1``.

    ``pos`` is the position inside the row's *own* block; copies carry
    ``is_halo = true`` and keep their original ``pos``.
    """
    if halo >= block:
        raise ValueError("halo must be smaller than the block")
    k = F.col("bar_no") - 1
    shift = F.explode(F.when(F.pmod(k, F.lit(block)) >= block - halo, F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0))))
    return (numbered
            .withColumn("_shift", shift)
            .withColumn("blk", (F.floor(k / F.lit(block)) + F.col("_shift")).cast("long"))
            .withColumn("pos", F.pmod(k, F.lit(block)).cast("int"))
            .withColumn("is_halo", F.col("_shift") == 1)
            .drop("_shift"))
