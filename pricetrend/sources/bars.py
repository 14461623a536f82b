"""Bar sources: ticks -> OHLC bars (E1) and the fixture bar tables.

A bar is one row per (symbol, bar_ts). Open and close are the prices of the
first and last tick by a *unique* ordering key, so results do not depend on
input order or partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BAR_COLUMNS = ["symbol", "bar_ts", "open", "high", "low", "close"]

# Seconds per bar for the supported grains; used to bound rows per time chunk.
GRAIN_SECONDS = {
    "minute": 60,
    "hour": 3600,
    "6 hours": 6 * 3600,
    "day": 86400,
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Wall-clock epoch; all bar arithmetic is on TIMESTAMP_NTZ, so the session
# time zone never moves a bar boundary.
def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def wall_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 00:00 of the wall-clock time (TZ-free)."""
    return F.timestamp_diff("SECOND", epoch_ntz(), ts.cast("timestamp_ntz"))


def bar_start(ts: Column, grain: str) -> Column:
    """Start of the bar holding ``ts``, as TIMESTAMP_NTZ."""
    span = F.lit(GRAIN_SECONDS[grain])
    sec = wall_seconds(ts)
    return F.timestamp_add("SECOND", sec - F.pmod(sec, span), epoch_ntz())


def ohlc_bars(ticks: DataFrame, symbol: str | Column, ts: str, price: str | Column,
              grain: str, order: list[str | Column] | None = None) -> DataFrame:
    """Aggregate ticks into OHLC bars.

    ``order`` is the unique tick ordering inside a bar (defaults to ``ts``);
    open = price of the first tick, close = price of the last. Ticks with a
    NULL or NaN price are not part of any bar. The aggregate is partial (map-side
    combine), so a hot symbol is reduced before the shuffle.
    """
    sym = F.col(symbol) if isinstance(symbol, str) else symbol
    px = F.col(price) if isinstance(price, str) else price
    key = F.struct(*(order or [F.col(ts)]))
    return (ticks
            .select(sym.alias("symbol"), bar_start(F.col(ts), grain).alias("bar_ts"),
                    px.cast("double").alias("price"), key.alias("_ord"))
            .where(F.col("price").isNotNull() & ~F.isnan("price") & F.col("symbol").isNotNull())
            .groupBy("symbol", "bar_ts")
            .agg(F.min_by("price", "_ord").alias("open"),
                 F.max("price").alias("high"),
                 F.min("price").alias("low"),
                 F.max_by("price", "_ord").alias("close")))


def gridded_bars(bars: DataFrame, grain: str) -> DataFrame:
    """``bars`` on the full time grid of each symbol, from its first to its last bar;
    times without a bar have NULL prices. The grid of a symbol is as long as its time span."""
    step = F.make_dt_interval(secs=F.lit(float(GRAIN_SECONDS[grain])))
    grid = (bars.groupBy("symbol").agg(F.min("bar_ts").alias("a"), F.max("bar_ts").alias("b"))
            .select("symbol", F.explode(F.sequence("a", "b", step)).alias("bar_ts")))
    return grid.join(bars, ["symbol", "bar_ts"], "left").select(*bars.columns)


def events_bars(spark: SparkSession, sf_dir: str, grain: str = "hour") -> DataFrame:
    """Fixture: symbol = event_type, price = value, tick order (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events")
    return ohlc_bars(ev, "event_type", "ts", "value", grain,
                     order=[F.col("ts"), F.col("event_id")])


LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                  "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus"]


def lineitem_bars(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Fixture: symbol = l_returnflag, price = unit price, ties by all columns.

    (l_orderkey, l_linenumber) is not unique in the fixture, full rows are;
    the ordering struct therefore spans every column.
    """
    li = read_table(spark, sf_dir, "lineitem")
    unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return ohlc_bars(li, "l_returnflag", "l_shipdate", unit, grain,
                     order=[F.col(c) for c in LINEITEM_ORDER])


def multi_source_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several sources as one bar table, symbols prefixed by source."""
    ev = events_bars(spark, sf_dir, "day").withColumn(
        "symbol", F.concat(F.lit("events:"), "symbol"))
    li = lineitem_bars(spark, sf_dir, "day").withColumn(
        "symbol", F.concat(F.lit("lineitem:"), "symbol"))
    return ev.unionByName(li, allowMissingColumns=True)
