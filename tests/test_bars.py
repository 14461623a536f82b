from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_MAIN
from pricetrend.operators.sequence import number_bars
from pricetrend.sources.bars import events_bars, lineitem_bars, ohlc_bars, read_table


def test_daily_event_bars_shape(spark):
    bars = events_bars(spark, SF_SMALL, "day")
    assert bars.count() == 150
    per = {r.symbol: r.n for r in bars.groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 5 and set(per.values()) == {30}


def test_open_close_follow_tick_order(spark):
    ev = read_table(spark, SF_SMALL, "events")
    bars = ohlc_bars(ev, "event_type", "ts", "value", "day", order=[F.col("ts"), F.col("event_id")])
    pdf = ev.toPandas()
    pdf["bar_ts"] = pdf.ts.dt.floor("D")
    pdf = pdf.sort_values(["ts", "event_id"])
    g = pdf.groupby(["event_type", "bar_ts"]).value
    exp = {(k[0], k[1].to_pydatetime()): (a, b, c, d)
           for k, a, b, c, d in zip(g.first().index, g.first(), g.max(), g.min(), g.last())}
    got = {(r.symbol, r.bar_ts): (r.open, r.high, r.low, r.close) for r in bars.collect()}
    assert got == exp


def test_bars_independent_of_partitioning(spark):
    ev = read_table(spark, SF_SMALL, "events")
    a = ohlc_bars(ev, "event_type", "ts", "value", "hour", order=[F.col("ts"), F.col("event_id")])
    b = ohlc_bars(ev.repartition(7).orderBy(F.rand(3)), "event_type", "ts", "value", "hour",
                  order=[F.col("ts"), F.col("event_id")])
    assert sorted(a.collect()) == sorted(b.collect())


def test_bar_numbering_matches_row_number(spark):
    bars = lineitem_bars(spark, SF_MAIN, "day")
    # tiny chunks force many chunk offsets per symbol
    got = number_bars(bars, grain="day", chunk_bars=16).select("symbol", "bar_ts", "bar_no")
    pdf = bars.select("symbol", "bar_ts").toPandas().sort_values(["symbol", "bar_ts"])
    pdf["bar_no"] = pdf.groupby("symbol").cumcount() + 1
    exp = {(r.symbol, r.bar_ts.to_pydatetime()): r.bar_no for r in pdf.itertuples()}
    assert {(r.symbol, r.bar_ts): r.bar_no for r in got.collect()} == exp
