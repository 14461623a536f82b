import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricetrend.operators.indicators import INDICATORS
from pricetrend.plans.panels import indicators_from_bars
from pricetrend.sources import read_ohlc_csv, write_panel
from pricetrend.operators.sequence import number_bars
from pricetrend.session import checkpoint_dir, cut_lineage, scratch_tables
from pricetrend.sources.bars import events_bars, ohlc_bars


def test_csv_files_round_trip(spark):
    """Daily bars written as one newest-first CSV per series read back into the same panel."""
    bars = events_bars(spark, SF_SMALL, "day")
    pdf = bars.toPandas()
    d = tempfile.mkdtemp(prefix="pt-csv-")
    paths = []
    for sym, g in pdf.groupby("symbol"):
        g = g.sort_values("bar_ts", ascending=False)
        out = pd.DataFrame({"Date": g.bar_ts.dt.strftime("%d-%b-%Y"), "Open Price": g.open,
                            "High Price": g.high, "Low Price": g.low, "Close Price": g.close,
                            "No. of Trades": range(len(g))})
        p = os.path.join(d, f"{sym}.csv")
        out.to_csv(p, index=False)
        paths.append(p)
    csv = read_ohlc_csv(spark, paths)
    assert set(csv.columns) >= {"symbol", "bar_ts", "open", "high", "low", "close", "no_of_trades"}
    a = indicators_from_bars(csv, "day").select("symbol", "bar_no", *INDICATORS).toPandas()
    b = indicators_from_bars(bars, "day").select("symbol", "bar_no", *INDICATORS).toPandas()
    key = ["symbol", "bar_no"]
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True),
                                  b.sort_values(key).reset_index(drop=True))


def test_panel_sink_partitions_by_symbol(spark):
    panel = indicators_from_bars(events_bars(spark, SF_SMALL, "day"), "day")
    path = os.path.join(tempfile.mkdtemp(prefix="pt-sink-"), "panel")
    write_panel(panel, path)
    parts = sorted(e for e in os.listdir(path) if e.startswith("symbol="))
    assert parts == [f"symbol={s}" for s in ["click", "error", "purchase", "signup", "view"]]
    back = spark.read.parquet(path).where(F.col("symbol") == "view")
    assert back.count() == 30


def test_csv_files_with_different_columns(spark):
    d = tempfile.mkdtemp(prefix="pt-csv2-")
    a = pd.DataFrame({"Date": ["2020-01-02", "2020-01-01"], "High Price": [2.0, 1.5],
                      "Low Price": [1.0, 0.5], "Close Price": [1.5, 1.0], "Total Volume": [10, 20]})
    b = pd.DataFrame({"Date": ["2020-01-01"], "High Price": [5.0], "Low Price": [4.0],
                      "Close Price": [4.5], "Turnover": [99.5]})
    a.to_csv(os.path.join(d, "AAA.csv"), index=False)
    b.to_csv(os.path.join(d, "BBB.csv"), index=False)
    df = read_ohlc_csv(spark, [os.path.join(d, "AAA.csv"), os.path.join(d, "BBB.csv")])
    rows = {(r.symbol, str(r.bar_ts.date())): (r.close, r.total_volume, r.turnover) for r in df.collect()}
    assert rows == {("AAA", "2020-01-02"): (1.5, 10.0, None), ("AAA", "2020-01-01"): (1.0, 20.0, None),
                    ("BBB", "2020-01-01"): (4.5, None, 99.5)}


def _write(name, text):
    path = os.path.join(tempfile.mkdtemp(prefix="pt-csv3-"), name)
    with open(path, "w") as f:
        f.write(text)
    return path


HEAD = "Date,High Price,Low Price,Close Price\n"


def _dates(df):
    return sorted(str(r.bar_ts.date()) for r in df.collect())


def test_one_date_layout_per_file(spark):
    days = ["14/02/2020", "13/02/2020", "12/02/2020", "11/02/2020"]
    path = _write("X.csv", HEAD + "".join(f"{d},3,1,2\n" for d in days))
    assert _dates(read_ohlc_csv(spark, path)) == ["2020-02-11", "2020-02-12", "2020-02-13", "2020-02-14"]
    other = _write("Y.csv", HEAD + "02/14/2020,3,1,2\n02/11/2020,3,1,2\n")
    assert len(read_ohlc_csv(spark, [path, other]).collect()) == 6
    named = _write("Z.csv", HEAD + "5-January-2020,3,1,2\n")
    assert _dates(read_ohlc_csv(spark, named)) == ["2020-01-05"]


@pytest.mark.parametrize("rows, said", [
    ("12/02/2020,3,1,2\n11/02/2020,3,1,2\n", "give date_format"),
    ("week 3,3,1,2\n2020-01-01,3,1,2\n", "no date layout fits"),
    ("2020-01-01,3,1,2\n,3,1,2\n", "1 rows without a date"),
    ("2020-01-01,3,1,2\n2020-01-01,4,1,2\n2020-01-02,4,1,2\n", "2 rows on 2020-01-01; 1 such dates"),
])
def test_dates_that_cannot_be_used_raise(spark, rows, said):
    with pytest.raises(ValueError, match=said):
        read_ohlc_csv(spark, _write("X.csv", HEAD + rows))


def test_ambiguous_dates_with_a_format_and_kept_duplicates(spark):
    path = _write("X.csv", HEAD + "12/02/2020,3,1,2\n12/02/2020,5,1,2\n")
    got = read_ohlc_csv(spark, path, date_format="dd/MM/yyyy", duplicates="keep")
    assert _dates(got) == ["2020-02-12", "2020-02-12"]
    numbered = number_bars(got, tie_break=["high"]).collect()
    assert sorted((r.bar_no, r.high) for r in numbered) == [(1, 3.0), (2, 5.0)]


def test_headers_in_another_order(spark):
    a = _write("A.csv", HEAD + "2020-01-01,9,1,5\n")
    b = _write("B.csv", "Date,Close Price,High Price,Low Price\n2020-01-01,5,9,1\n")
    assert {(r.high, r.low, r.close) for r in read_ohlc_csv(spark, [a, b]).collect()} == {(9.0, 1.0, 5.0)}
    with pytest.raises(ValueError, match="no column Low Price"):
        read_ohlc_csv(spark, _write("C.csv", "Date,Close Price,High Price\n2020-01-01,5,9\n"))


def test_rows_are_never_lost_in_numbering(spark):
    rows = [("a", "2020-01-01"), ("a", "2020-01-02"), (None, "2020-01-01")]
    df = spark.createDataFrame(rows, "symbol string, d string").selectExpr("symbol", "CAST(d AS timestamp_ntz) AS bar_ts")
    assert sorted((r.symbol or "", r.bar_no) for r in number_bars(df).collect()) == [("", 1), ("a", 1), ("a", 2)]
    with pytest.raises(Exception, match="NULL bar_ts"):
        number_bars(df.union(spark.sql("SELECT 'a', CAST(NULL AS timestamp_ntz)"))).collect()


def test_nan_ticks_are_no_prices(spark):
    df = spark.createDataFrame([("a", 1, float("nan")), ("a", 2, 5.0)], "s string, i int, p double")
    df = df.withColumn("ts", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    r = ohlc_bars(df, "s", "ts", "p", "day", order=[F.col("i")]).first()
    assert (r.open, r.high, r.low, r.close) == (5.0, 5.0, 5.0, 5.0)


def test_written_tables_can_be_released(spark):
    with scratch_tables(spark):
        df = cut_lineage(spark.range(9).withColumn("k", F.col("id") % 3), "x", partition_by="k")
        assert df.schema.names == ["id", "k"] and df.where("k = 1").count() == 3
        assert [f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith("x-")]
    assert not [f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith("x-")]


def test_the_shared_folder_is_empty_after_release(spark):
    from pricetrend.plans import catalog
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch_tables(spark):
        for name in ("sma_10", "gnb_overall", "stratified_folds", "csv_daily_bars"):
            assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before


def test_headers_of_many_files_take_one_job(spark):
    """2,000 files of three layouts: as many jobs as for 20."""
    from pricetrend.sources.csv import _by_header
    heads = ["Date,High Price,Low Price,Close Price", 'Close Price,"Low Price",High Price,Date,Turnover', "\nDate,Open Price,High Price,Low Price,Close Price"]
    def write(n):
        d = tempfile.mkdtemp(prefix="pt-many-")
        for i in range(n):
            with open(os.path.join(d, f"S{i:05d}.csv"), "w") as f:
                f.write(heads[i % 3] + "\n1,2,3,4,5\n")
        return d
    jobs = {}
    for n in (20, 2000):
        d = write(n)
        spark.sparkContext.setJobGroup(f"headers-{n}", "headers")
        got = _by_header(spark, [d])
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # Reading the list of files may take a job of its own when there are many.
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{n}"))
        assert sorted(len(h) for h in got) == [4, 5, 5] and sum(map(len, got.values())) == n
        assert got[("Close Price", "Low Price", "High Price", "Date", "Turnover")][0].endswith("S00001.csv")
    assert jobs[2000] <= jobs[20] + 1


def test_a_file_name_with_blanks(spark):
    d = tempfile.mkdtemp(prefix="pt-blank-")
    with open(os.path.join(d, "TWO WORDS.csv"), "w") as f:
        f.write("Date,High Price,Low Price,Close Price\n2020-01-01,3,1,2\n")
    assert [(r.symbol, r.close) for r in read_ohlc_csv(spark, [d]).collect()] == [("TWO WORDS", 2.0)]


def test_an_empty_file_is_named(spark):
    d = tempfile.mkdtemp(prefix="pt-void-")
    open(os.path.join(d, "void.csv"), "w").close()
    with pytest.raises(ValueError, match="void.csv: no column Date"):
        read_ohlc_csv(spark, [d])
