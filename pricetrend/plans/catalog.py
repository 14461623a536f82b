"""The registered query catalogue: name -> (Spark plan, DuckDB oracle SQL).

Every plan reads the fixture tables of ``sf_dir`` in full. Doubles are
rounded (6 digits) and integers cast alike on both
sides so that the comparison is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricetrend.functions.columns import rounded
from pricetrend.operators.labels import horizon_label
from pricetrend.operators.sequence import number_bars
from pricetrend.plans import oracle as O
from pricetrend.plans.panels import fixture_bars, fixture_indicators, fixture_trends, indicators_from_bars
from pricetrend.session import cut_lineage, scratch_path
from pricetrend.sources import read_ohlc_csv, write_ohlc_csv, write_panel
from pricetrend.sources.bars import gridded_bars, multi_source_bars
from pricetrend.sources.symbols import symbol_dim, with_symbol_names

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

EMA_DIGITS = 6
EMA_COLUMNS = {"macd", "rsi", "macd_lag", "rsi_lag"}

# Display names for the fixture series (S4 dimension rows).
FIXTURE_SYMBOL_NAMES = {
    "click": "Click stream",
    "error": "Error stream",
    "purchase": "Purchase stream",
    "signup": "Signup stream",
    "view": "View stream",
}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _digits(c: str) -> int:
    return EMA_DIGITS if c in EMA_COLUMNS else 6


def spark_round(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[rounded(F.col(c), _digits(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def sql_round(cols: list[str]) -> str:
    return ", ".join(O.r(c, _digits(c)) + f" AS {c}" for c in cols)


# ---------------------------------------------------------------- bars
BAR_VALUES = ["open", "high", "low", "close"]


def _bars_query(fixture: str) -> QueryFn:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars, _ = fixture_bars(spark, sf_dir, fixture)
        return spark_round(bars, BAR_VALUES)
    return q


for _name, _fx in [("ohlc_bars_hourly", "events_hour"), ("ohlc_bars_6h", "events_6h"),
                   ("ohlc_bars_daily", "events_day"), ("ohlc_bars_lineitem_daily", "lineitem_day")]:
    register(_name, f"SELECT symbol, bar_ts, {sql_round(BAR_VALUES)} FROM ({O.bars_sql(_fx)})")(
        _bars_query(_fx))


@register("multi_source_bars", f"""
SELECT 'events:' || symbol AS symbol, bar_ts, {sql_round(BAR_VALUES)} FROM ({O.bars_sql('events_day')})
UNION ALL
SELECT 'lineitem:' || symbol AS symbol, bar_ts, {sql_round(BAR_VALUES)} FROM ({O.bars_sql('lineitem_day')})""")
def multi_source(spark, sf_dir):
    return spark_round(multi_source_bars(spark, sf_dir), BAR_VALUES)


@register("csv_daily_bars", f"SELECT symbol, bar_ts, {sql_round(BAR_VALUES)} FROM ({O.bars_sql('events_day')})")
def csv_daily_bars(spark, sf_dir):
    """The daily bars written as one CSV file per series and read back by the CSV source."""
    bars, _ = fixture_bars(spark, sf_dir, "events_day")
    path = scratch_path(spark, "csv")
    write_ohlc_csv(bars, path)
    return spark_round(read_ohlc_csv(spark, path).select("symbol", "bar_ts", *BAR_VALUES), BAR_VALUES)


_names_values = ", ".join(f"('{k}', '{v}')" for k, v in sorted(FIXTURE_SYMBOL_NAMES.items()))


@register("bars_with_symbol_name", f"""
SELECT b.symbol, b.bar_ts, {O.r('b.close')} AS close, coalesce(d.symbol_name, b.symbol) AS symbol_name
FROM ({O.bars_sql('events_day')}) b
LEFT JOIN (VALUES {_names_values}) d(symbol, symbol_name) ON b.symbol = d.symbol""")
def bars_with_symbol_name(spark, sf_dir):
    bars, _ = fixture_bars(spark, sf_dir, "events_day")
    named = with_symbol_names(bars, symbol_dim(spark, FIXTURE_SYMBOL_NAMES))
    return spark_round(named.select("symbol", "bar_ts", "close", "symbol_name"), ["close"])


# ---------------------------------------------------------------- sequence, label
@register("chronological_index", f"""
SELECT symbol, bar_ts, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS bar_no
FROM ({O.bars_sql('events_hour')})""")
def chronological_index(spark, sf_dir):
    bars, grain = fixture_bars(spark, sf_dir, "events_hour")
    return number_bars(bars, grain=grain).select("symbol", "bar_ts", "bar_no")


def _panel_query(fixture: str, cols: list[str], trends: bool = False) -> QueryFn:
    # Only the indicators that the columns come from are computed.
    needed = {c.removesuffix("_trend").removesuffix("_lag") for c in cols}

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = (fixture_trends if trends else fixture_indicators)(spark, sf_dir, fixture, needed)
        doubles = [c for c in cols if dict(df.dtypes)[c] == "double"]
        return spark_round(df.select("symbol", "bar_ts", "bar_no", *cols), doubles)
    return q


def _panel_sql(fixture: str, cols: list[str], doubles: list[str]) -> str:
    sel = ", ".join([O.r(c, _digits(c)) + f" AS {c}" if c in doubles else c for c in cols])
    return O.with_panel(fixture, f"SELECT symbol, bar_ts, bar_no, {sel} FROM trends")


INDICATOR_DOUBLES = {"price_change", "sma_10", "wma_10", "stck", "stcd", "williams_r", "macd",
                     "rsi", "cci", "ad_osc", "momentum", "stck_lag", "stcd_lag",
                     "williams_r_lag", "macd_lag", "rsi_lag", "cci_lag", "ad_osc_lag"}


def _register_panel(name: str, fixture: str, cols: list[str], trends: bool = False) -> None:
    doubles = [c for c in cols if c in INDICATOR_DOUBLES]
    register(name, _panel_sql(fixture, cols, doubles))(_panel_query(fixture, cols, trends))


_register_panel("price_change", "events_hour", ["price_change"])
_register_panel("movement_label", "events_hour", ["movement"])


@register("movement_label_horizon1", O.with_panel("events_hour", """
SELECT symbol, bar_ts, bar_no, movement_h1 FROM (
  SELECT symbol, bar_ts, bar_no,
         lead(movement) OVER (PARTITION BY symbol ORDER BY bar_no) AS movement_h1 FROM ind)
WHERE movement_h1 IS NOT NULL"""))
def movement_label_horizon1(spark, sf_dir):
    ind = fixture_indicators(spark, sf_dir, "events_hour", [])
    return horizon_label(ind.select("symbol", "bar_ts", "bar_no", "price_change"), 1).select(
        "symbol", "bar_ts", "bar_no", "movement_h1")


# ---------------------------------------------------------------- indicators
for _name, _col in [("sma_10", "sma_10"), ("wma_10", "wma_10"), ("stoch_k", "stck"),
                    ("stoch_d", "stcd"), ("williams_r", "williams_r"), ("cci_20", "cci"),
                    ("ad_oscillator", "ad_osc"), ("momentum_roc", "momentum")]:
    _register_panel(_name, "events_hour", [_col])
_register_panel("macd", "lineitem_day", ["macd"])
_register_panel("rsi_14", "lineitem_day", ["rsi"])
_register_panel("macd_hourly", "events_hour", ["macd"])
_register_panel("rsi_14_hourly", "events_hour", ["rsi"])

PANEL_COLS = ["open", "high", "low", "close", "price_change", "sma_10", "wma_10", "stck", "stcd",
              "williams_r", "macd", "rsi", "cci", "ad_osc", "momentum", "movement"]
LAG_COLS = ["stck_lag", "stcd_lag", "williams_r_lag", "macd_lag", "rsi_lag", "cci_lag",
            "ad_osc_lag"]
INDICATOR_DOUBLES |= {"open", "high", "low", "close"}
_register_panel("indicator_panel", "events_hour", PANEL_COLS)
_register_panel("indicator_panel_long", "lineitem_day", PANEL_COLS)
_register_panel("indicator_lags", "events_hour", LAG_COLS)



@register("macd_with_gaps", O.gapped_macd_sql("events_hour", sql_round(["close", "sma_10", "macd"])))
def macd_with_gaps(spark, sf_dir):
    """W2, W7 on the hourly grid: hours without ticks are bars without a close."""
    bars, grain = fixture_bars(spark, sf_dir, "events_hour")
    ind = indicators_from_bars(gridded_bars(cut_lineage(bars, "bars"), grain), grain, indicators=["sma_10", "macd"])
    return spark_round(ind.select("symbol", "bar_ts", "bar_no", "close", "sma_10", "macd"), ["close", "sma_10", "macd"])


# ---------------------------------------------------------------- trends
for _name, _col in [("trend_sma", "sma_10_trend"), ("trend_wma", "wma_10_trend"),
                    ("trend_stck", "stck_trend"), ("trend_stcd", "stcd_trend"),
                    ("trend_williams_r", "williams_r_trend"), ("trend_macd", "macd_trend"),
                    ("trend_rsi", "rsi_trend"), ("trend_cci", "cci_trend"),
                    ("trend_ad", "ad_osc_trend"), ("trend_momentum", "momentum_trend")]:
    _register_panel(_name, "events_hour", [_col], trends=True)

TREND_COLS = ["sma_10_trend", "wma_10_trend", "stck_trend", "stcd_trend", "williams_r_trend",
              "macd_trend", "rsi_trend", "cci_trend", "ad_osc_trend", "momentum_trend"]
_register_panel("trend_panel", "events_hour", ["close", "movement"] + TREND_COLS, trends=True)
_register_panel("trend_panel_long", "lineitem_day", ["close", "movement"] + TREND_COLS, trends=True)
_register_panel("trend_panel_daily", "events_day", ["close", "movement"] + TREND_COLS, trends=True)


def _register_sink(name: str, cols: list[str], trends: bool = False) -> None:
    doubles = [c for c in cols if c in INDICATOR_DOUBLES]

    def q(spark, sf_dir):
        panel = (fixture_trends if trends else fixture_indicators)(spark, sf_dir, "events_day")
        path = scratch_path(spark, name)
        write_panel(panel, path)
        return spark_round(spark.read.parquet(path).select("symbol", "bar_ts", "bar_no", *cols), doubles)

    q.__doc__ = "S5, S6: the panel written by the sink, one folder per series, and read back."
    register(name, _panel_sql("events_day", cols, doubles))(q)


_register_sink("indicator_sink", PANEL_COLS + LAG_COLS)
_register_sink("trend_sink", ["close", "movement"] + TREND_COLS, trends=True)

# ---------------------------------------------------------------- features & splits
from pricetrend.models.gnb import gnb_predict, gnb_stats, with_probability  # noqa: E402
from pricetrend.operators.evaluate import accuracy_by, by_threshold  # noqa: E402
from pricetrend.operators.features import feature_set, impute_mean, minmax_scale, standard_scale  # noqa: E402
from pricetrend.operators.split import balanced_split, holdout_split  # noqa: E402
from pricetrend.plans.prepare import prepare  # noqa: E402

FX = "events_hour"


def _trends(spark, sf_dir):
    """Trend panel written once; feature and model plans branch many times over it."""
    from pricetrend.session import cut_lineage
    return cut_lineage(fixture_trends(spark, sf_dir, FX), "trends")


def _base(spark, sf_dir, rep="continuous"):
    t = _trends(spark, sf_dir)
    cols = feature_set(t, "continuous" if rep == "continuous" else "trend_only")
    assert cols == O.FEATURE_SETS[rep], cols
    return t.select("symbol", "bar_no", F.col("movement").cast("int").alias("movement"),
                    *[F.col(c).cast("double").alias(c) for c in cols]), cols


_CF = O.CONTINUOUS
_cf_sql = ", ".join(O.r(c, _digits(c)) + f" AS {c}" for c in _CF)


@register("numeric_features", O.with_panel(FX, f"""
SELECT symbol, bar_no, CAST(movement AS INTEGER) AS movement, {_cf_sql} FROM trends"""))
def numeric_features(spark, sf_dir):
    b, cols = _base(spark, sf_dir)
    return spark_round(b, cols)


@register("impute_mean", O.with_prep(FX, _CF, None, 0.2, f"SELECT symbol, bar_no, movement, {_cf_sql} FROM imp"))
def impute_mean_q(spark, sf_dir):
    b, cols = _base(spark, sf_dir)
    return spark_round(impute_mean(b, cols), cols)


@register("standard_scale_all", O.with_prep(FX, _CF, "all", 0.2, f"SELECT symbol, bar_no, movement, {_cf_sql} FROM scaled"))
def standard_scale_all(spark, sf_dir):
    b, cols = _base(spark, sf_dir)
    return spark_round(standard_scale(impute_mean(b, cols), cols), cols)


@register("standard_scale_train", O.with_prep(FX, _CF, "train", 0.2, f"SELECT symbol, bar_no, movement, is_test, {_cf_sql} FROM prep"))
def standard_scale_train(spark, sf_dir):
    x, cols = prepare(_trends(spark, sf_dir), "svm", "continuous")
    return spark_round(x.select("symbol", "bar_no", "movement", "is_test", *cols), cols)


_mm_sql = ", ".join(
    f"{O.r(f'coalesce(({c} - min({c}) OVER (PARTITION BY symbol)) / CASE WHEN max({c}) OVER (PARTITION BY symbol) - min({c}) OVER (PARTITION BY symbol) > 0 THEN max({c}) OVER (PARTITION BY symbol) - min({c}) OVER (PARTITION BY symbol) END, {O.f(0.0)}) * {O.f(2.0)} + {O.f(-1.0)}', _digits(c))} AS {c}"
    for c in _CF)


@register("minmax_scale", O.with_prep(FX, _CF, None, 0.2, f"SELECT symbol, bar_no, movement, {_mm_sql} FROM imp"))
def minmax_scale_q(spark, sf_dir):
    b, cols = _base(spark, sf_dir)
    return spark_round(minmax_scale(impute_mean(b, cols), cols), cols)


def _split_q(test_size):
    def q(spark, sf_dir):
        b, _ = _base(spark, sf_dir)
        return holdout_split(b.select("symbol", "bar_no", "movement"), test_size).select(
            "symbol", "bar_no", "split_rank", "is_test")
    return q


register("split_80_20", O.with_prep(FX, _CF, None, 0.2, "SELECT symbol, bar_no, split_rank, is_test FROM prep"))(_split_q(0.2))
register("split_70_30", O.with_prep(FX, _CF, None, 0.3, "SELECT symbol, bar_no, split_rank, is_test FROM prep"))(_split_q(0.3))


@register("balanced_split", O.with_panel(FX, f"""
SELECT symbol, bar_no, movement,
  CASE WHEN crank <= ceil(CAST(m AS DOUBLE) * {O.f(0.2)}) THEN 'tune' WHEN crank <= m THEN 'eval' ELSE 'surplus' END AS role
FROM (SELECT *, CASE WHEN count(DISTINCT movement) OVER (PARTITION BY symbol) >= 2
                     THEN min(csize) OVER (PARTITION BY symbol) ELSE 0 END AS m
      FROM (SELECT symbol, bar_no, CAST(movement AS INTEGER) AS movement,
              row_number() OVER (PARTITION BY symbol, movement ORDER BY {O.split_hash_sql()}) AS crank,
              count(*) OVER (PARTITION BY symbol, movement) AS csize FROM ind))"""))
def balanced_split_q(spark, sf_dir):
    b, _ = _base(spark, sf_dir)
    return balanced_split(b.select("symbol", "bar_no", "movement")).select(
        "symbol", "bar_no", "movement", "role")


@register("stratified_folds", O.with_prep(FX, _CF, None, 0.3, "SELECT symbol, bar_no, movement, fold FROM prep", folds=5))
def stratified_folds_q(spark, sf_dir):
    x, _ = prepare(_trends(spark, sf_dir), "rf_cv", "continuous")
    return x.select("symbol", "bar_no", "movement", "fold")


# ---------------------------------------------------------------- naive Bayes
def _gnb(spark, sf_dir, rep, trends=None):
    from pricetrend.session import cut_lineage
    x, cols = prepare(trends if trends is not None else _trends(spark, sf_dir), "nb", rep)
    x = cut_lineage(x, f"prep-nb-{rep}")   # fit and predict branches read it once each
    stats = gnb_stats(x.where("is_train"), cols)
    return x, cols, stats


def _gnb_sql(rep, select):
    feats = O.FEATURE_SETS[rep]
    return O.with_prep(FX, feats, "all", 0.2, "", 0).rstrip() + ",\n" + O.gnb_ctes(feats) + "\n" + select


_stat_cols = ["log_prior"] + [f"mean_{c}" for c in _CF] + [f"var_{c}" for c in _CF]


@register("gnb_stats", _gnb_sql("continuous", f"SELECT symbol, movement, n, {', '.join(O.r(c) + ' AS ' + c for c in _stat_cols)} FROM gstats"))
def gnb_stats_q(spark, sf_dir):
    _, _, stats = _gnb(spark, sf_dir, "continuous")
    return spark_round(stats, _stat_cols)


@register("gnb_predict", _gnb_sql("continuous", "SELECT symbol, bar_no, movement, prediction FROM pred WHERE is_test"))
def gnb_predict_q(spark, sf_dir):
    x, cols, stats = _gnb(spark, sf_dir, "continuous")
    return gnb_predict(x.where("is_test"), stats, cols).select("symbol", "bar_no", "movement", "prediction")


@register("gnb_threshold", _gnb_sql("continuous", f"""SELECT symbol, bar_no, movement, {O.r('p1')} AS p1, CAST(p1 > 0.5 AS INTEGER) AS prediction
FROM (SELECT *, 1 / (1 + exp(least(greatest(jll0 - jll1, {O.f(-700.0)}), {O.f(700.0)}))) AS p1 FROM pred WHERE is_test)"""))
def gnb_threshold_q(spark, sf_dir):
    """The probability of an up move, and the class by the threshold 0.5."""
    x, cols, stats = _gnb(spark, sf_dir, "continuous")
    scored = with_probability(gnb_predict(x.where("is_test"), stats, cols))
    return spark_round(scored.select("symbol", "bar_no", "movement", "p1", by_threshold("p1").alias("prediction")), ["p1"])


def _gnb_acc(rep):
    def q(spark, sf_dir):
        x, cols, stats = _gnb(spark, sf_dir, rep)
        acc = accuracy_by(gnb_predict(x.where("is_test"), stats, cols), ["symbol"])
        return spark_round(acc, ["accuracy"])
    return q


_acc_sel = f"SELECT symbol, {O.r('avg(CAST(prediction = movement AS DOUBLE))')} AS accuracy, count(*) AS n FROM pred WHERE is_test GROUP BY symbol"
register("gnb_accuracy", _gnb_sql("continuous", _acc_sel))(_gnb_acc("continuous"))
register("gnb_trend_accuracy", _gnb_sql("trend", _acc_sel))(_gnb_acc("trend"))


@register("gnb_overall", None)
def gnb_overall(spark, sf_dir):
    parts = []
    trends = _trends(spark, sf_dir)
    for rep in ("continuous", "trend"):
        x, cols, stats = _gnb(spark, sf_dir, rep, trends)
        acc = accuracy_by(gnb_predict(x.where("is_test"), stats, cols), ["symbol"])
        parts.append(acc.agg(F.avg("accuracy").alias("accuracy")).select(
            F.lit(rep).alias("representation"), "accuracy"))
    return spark_round(parts[0].unionByName(parts[1]), ["accuracy"])


ORACLE["gnb_overall"] = "\nUNION ALL\n".join(
    _gnb_sql(rep, f"SELECT '{rep}' AS representation, {O.r('avg(acc)')} AS accuracy FROM "
                  "(SELECT symbol, avg(CAST(prediction = movement AS DOUBLE)) AS acc FROM pred WHERE is_test GROUP BY symbol)")
    .replace("WITH RECURSIVE", "SELECT * FROM (WITH RECURSIVE", 1) + ")"
    for rep in ("continuous", "trend"))

# ---------------------------------------------------------------- the balanced protocol
@register("balanced_features", O.with_balanced(FX, _CF, f"SELECT symbol, bar_no, movement, is_train, is_test, {_cf_sql} FROM prep"))
def balanced_features(spark, sf_dir):
    """Features on [-1, 1] of the tuning and evaluation sets of equal classes."""
    x, cols = prepare(_trends(spark, sf_dir), "nb", "continuous", protocol="balanced")
    return spark_round(x.select("symbol", "bar_no", "movement", "is_train", "is_test", *cols), cols)


def _balanced_acc(rep):
    def q(spark, sf_dir):
        from pricetrend.session import cut_lineage
        x, cols = prepare(_trends(spark, sf_dir), "nb", rep, protocol="balanced")
        x = cut_lineage(x, f"prep-balanced-{rep}")
        stats = gnb_stats(x.where("is_train"), cols)
        return spark_round(accuracy_by(gnb_predict(x.where("is_test"), stats, cols), ["symbol"]), ["accuracy"])
    return q


for _rep, _name in (("continuous", "gnb_balanced_accuracy"), ("trend", "gnb_balanced_trend_accuracy")):
    register(_name, O.with_balanced(FX, O.FEATURE_SETS[_rep], "").rstrip() + ",\n" + O.gnb_ctes(O.FEATURE_SETS[_rep]) + "\n" + _acc_sel)(_balanced_acc(_rep))

# ---------------------------------------------------------------- learned models (rows-only checks)
from functools import reduce  # noqa: E402

from pricetrend.models import forest as _forest  # noqa: E402
from pricetrend.models import mlp as _mlp  # noqa: E402
from pricetrend.models import stumps as _stumps  # noqa: E402
from pricetrend.models import svm as _svm  # noqa: E402
from pricetrend.plans import experiments as X  # noqa: E402
from pricetrend.session import is_written, last_written  # noqa: E402

RESULT_COLS = ["symbol", "representation", "model", "grid_index", "metric", "value"]


def _res(df):
    """Results rows with the parameter map rendered as sorted k=v text."""
    entries = F.filter(F.map_entries("params"), lambda e: e["value"].isNotNull())
    kv = F.array_join(F.array_sort(F.transform(entries,
                                               lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return df.select("symbol", "representation", "model", kv.alias("params"), "grid_index",
                     "metric", rounded(F.col("value"), 6).alias("value"))


def _panel(spark, sf_dir):
    return _trends(spark, sf_dir)


def _kept_panel(spark, sf_dir) -> DataFrame:
    """The panel, written once for all families that a session fits (see ``_fit``)."""
    key = _fit_key(spark, sf_dir, "panel")
    if not is_written(_RESULTS.get(key, "")):
        cut_lineage(_panel(spark, sf_dir), "panel")
        _RESULTS[key] = last_written()
    return spark.read.parquet(_RESULTS[key])


def _fit(spark, sf_dir, family: str, rep: str, *more, keep: bool = False) -> None:
    """Fit the full grid of one family on one representation, unless this session has it.

    Fitting is by far the dearest step and several queries report on the same fits,
    so a session keeps the written results of each until the tables are released, and
    what is needed to build its store rows. Forests are saved only where models are asked for.
    """
    key = _fit_key(spark, sf_dir, family, rep, *more)
    if is_written(_RESULTS.get(key, "")) and (not keep or key in _STORES):
        return
    _STORES.pop(key, None)
    panel = _kept_panel(spark, sf_dir)
    if family == "rf" and not keep:
        res = X.rf_results(panel, rep)
    else:
        got = X.svm_fitted(panel, rep, feature_set=more[0]) if more else X.fitted(panel, family, rep)
        res, _STORES[key] = got.results, got.store
    cut_lineage(res, f"results-{family}-{rep}")
    _RESULTS[key] = last_written()


def _fit_key(spark, sf_dir, *what) -> tuple:
    """Session, folder and the size and time of its files: a changed table is fitted anew."""
    files = spark.read.parquet(f"{sf_dir}/events.parquet").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    version = files.agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    return (spark.sparkContext.applicationId, sf_dir, str(version), *what)


def _family(spark, sf_dir, family: str, rep: str, *more) -> DataFrame:
    """The results table of one family on one representation, with the full grid."""
    _fit(spark, sf_dir, family, rep, *more)
    return spark.read.parquet(_RESULTS[_fit_key(spark, sf_dir, family, rep, *more)])


def _store(spark, sf_dir) -> DataFrame:
    """The kept models of all families and representations."""
    parts = []
    for rep in ("continuous", "trend"):
        for family in X.families(rep):
            _fit(spark, sf_dir, family, rep, keep=True)
            parts.append(_STORES[_fit_key(spark, sf_dir, family, rep)])
    return cut_lineage(reduce(DataFrame.unionByName, parts), "model-store")


_RESULTS: dict[tuple, str] = {}
_STORES: dict[tuple, DataFrame] = {}


def _families(spark, sf_dir, wanted=None) -> DataFrame:
    parts = [_family(spark, sf_dir, f, rep) for rep in ("continuous", "trend") for f in X.families(rep) if wanted is None or f in wanted]
    return reduce(DataFrame.unionByName, parts)


@register("svm_poly_cv")
def svm_poly_cv(spark, sf_dir):
    """M1: all 20 points of the polynomial grid."""
    return _res(_family(spark, sf_dir, "svm", "continuous").where("params['kernel'] = 'poly'"))


@register("svm_rbf_cv")
def svm_rbf_cv(spark, sf_dir):
    """M2: all 44 points of the RBF grid."""
    return _res(_family(spark, sf_dir, "svm", "continuous").where("params['kernel'] = 'rbf'"))


@register("svm_trend_cv")
def svm_trend_cv(spark, sf_dir):
    """M3 on the trend signals: all 64 points."""
    return _res(_family(spark, sf_dir, "svm", "trend"))


@register("svm_trend_superset_cv")
def svm_trend_superset_cv(spark, sf_dir):
    """M3 as coded in the study (prices, indicators, lags and signals): all 64 points, degree 4 by a
    sketch whose kernel error is in the parameters."""
    return _res(_family(spark, sf_dir, "svm", "trend", "trend_superset"))


@register("svm_trend_superset_rbf_cv")
def svm_trend_superset_rbf_cv(spark, sf_dir):
    """The 44 RBF points of the same grid."""
    return _res(_family(spark, sf_dir, "svm", "trend", "trend_superset").where("params['kernel'] = 'rbf'"))


@register("svm_overall")
def svm_overall(spark, sf_dir):
    per = X.svm_summary(_families(spark, sf_dir, {"svm"}))
    return spark_round(per.groupBy("representation").agg(F.avg("accuracy").alias("accuracy")),
                       ["accuracy"])


@register("rf_sweep_top3")
def rf_sweep_top3(spark, sf_dir):
    top = X.rf_top3(_family(spark, sf_dir, "rf", "continuous"))
    return spark_round(top.select("symbol", "representation", "rank", "ntrees",
                                  F.col("value").alias("accuracy")), ["accuracy"])


def _stumps_sql(select: str) -> str:
    """DuckDB: the stumps of every tree count, as ``stump_cv`` and ``ranked``, then ``select``."""
    step = _forest.TREE_COUNTS[0]
    return (O.with_prep(FX, O.TREND_ONLY, None, 0.3, "", folds=5).rstrip() + ",\n" + _stumps.stump_ctes(O.TREND_ONLY, _forest.TREE_COUNTS)
            + f""",
ranked AS (SELECT *, ntrees // {step} - 1 AS i, row_number() OVER (PARTITION BY symbol ORDER BY cv_accuracy DESC, ntrees) AS r FROM stump_cv)
""" + select)


@register("rf_trend_stumps", _stumps_sql(f"SELECT symbol, CAST(ntrees AS INTEGER) AS ntrees, {O.r('cv_accuracy')} AS cv_accuracy FROM stump_cv"))
def rf_trend_stumps(spark, sf_dir):
    """M5, G1: mean accuracy over five folds of every tree count."""
    res = _family(spark, sf_dir, "rf_cv", "trend")
    return spark_round(res.select("symbol", F.col("params")["ntrees"].cast("int").alias("ntrees"), F.col("value").alias("cv_accuracy")), ["cv_accuracy"])


@register("rf_trend_cv", _stumps_sql(f"""SELECT symbol, 'trend' AS representation, 'rf_cv' AS model, 'max_depth=1,ntrees=' || ntrees AS params,
  CAST(i AS INTEGER) AS grid_index, 'cv_accuracy' AS metric, {O.r('cv_accuracy')} AS value, selection FROM (
  SELECT *, 'first_k' AS selection FROM ranked WHERE i < 3 UNION ALL SELECT *, 'best_k' FROM ranked WHERE r <= 3)"""))
def rf_trend_cv(spark, sf_dir):
    res = _family(spark, sf_dir, "rf_cv", "trend")
    return _res(X.rf_cv_selected(res, "first_k")).withColumn("selection", F.lit("first_k")).unionByName(
        _res(X.rf_cv_selected(res, "best_k").drop("rank")).withColumn("selection", F.lit("best_k")))


@register("rf_overall")
def rf_overall(spark, sf_dir):
    return spark_round(X.overall(_families(spark, sf_dir, {"rf", "rf_cv"})), ["accuracy"])


@register("mlp_grid_top3")
def mlp_grid_top3(spark, sf_dir):
    return _res(X.mlp_top3(_family(spark, sf_dir, "mlp", "continuous")).drop("rank"))


@register("mlp_trend_grid")
def mlp_trend_grid(spark, sf_dir):
    return _res(_family(spark, sf_dir, "mlp", "trend"))


@register("mlp_overall")
def mlp_overall(spark, sf_dir):
    return spark_round(X.overall(_families(spark, sf_dir, {"mlp"})), ["accuracy"])


@register("model_comparison")
def model_comparison(spark, sf_dir):
    return spark_round(X.comparison(_families(spark, sf_dir)), ["continuous", "trend"])


@register("model_comparison_balanced")
def model_comparison_balanced(spark, sf_dir):
    """A9 under the balanced protocol: all families on features in [-1, 1], tuned and evaluated on equal classes."""
    return spark_round(X.comparison(cut_lineage(X.run_all(_panel(spark, sf_dir), X.BALANCED_GRIDS), "results-balanced")), ["continuous", "trend"])


@register("model_report")
def model_report(spark, sf_dir):
    """Per series and model the accuracy under the study's rule, with the kept parameters."""
    return spark_round(X.per_series(_families(spark, sf_dir)), ["accuracy"])


@register("model_store")
def model_store(spark, sf_dir):
    """Every kept model with its grid point, the score it was chosen by and the size of its weights."""
    rows = _store(spark, sf_dir)
    return spark_round(rows.select("symbol", "representation", "model", "member", "grid_index", X.params_text(F.col("params")).alias("params"), "score",
                                   F.size("features").alias("n_features"), F.size("weights").alias("n_weights")), ["score"])


@register("model_predict")
def model_predict(spark, sf_dir):
    """A row per test bar and kept model, scored from the store alone."""
    rows, panel = _store(spark, sf_dir), _kept_panel(spark, sf_dir)
    parts = [X.test_predictions(panel, rows, f, rep) for rep in ("continuous", "trend") for f in X.families(rep)]
    return spark_round(reduce(DataFrame.unionByName, parts), ["score"])


def _grid_points() -> list[tuple]:
    """The values of GRID_COLUMNS at each point of all grids."""
    points = [("svm", i, p) for i, p in enumerate(_svm.poly_grid() + _svm.rbf_grid())] + [("mlp", i, p) for i, p in enumerate(_mlp.mlp_grid())]
    return [(model, i, p.get("kernel"), *(None if p.get(c) is None else float(p[c]) for c in list(GRID_COLUMNS)[3:])) for model, i, p in points]


GRID_COLUMNS = {"model": "string", "grid_index": "int", "kernel": "string", "degree": "double", "gamma": "double", "C": "double",
                "n_neurons": "double", "epochs": "double", "lr": "double", "momentum": "double", "dropout_rate": "double"}


def _sql_axis(values, name: str) -> str:
    return f"(SELECT unnest([{', '.join(map(str, values))}]) AS {name}, unnest(range({len(values)})) AS i_{name})"


@register("param_grid", f"""
WITH poly AS (SELECT 'svm' AS model, i_degree * {len(_svm.POLY_C)} + i_c AS grid_index, 'poly' AS kernel, degree, NULL AS gamma, c
  FROM {_sql_axis(_svm.POLY_DEGREES, 'degree')} CROSS JOIN {_sql_axis(_svm.POLY_C, 'c')}),
rbf AS (SELECT 'svm' AS model, {len(_svm.POLY_DEGREES) * len(_svm.POLY_C)} + i_gamma * {len(_svm.RBF_C)} + i_c AS grid_index, 'rbf' AS kernel, NULL AS degree, gamma, c
  FROM {_sql_axis(_svm.RBF_GAMMAS, 'gamma')} CROSS JOIN {_sql_axis(_svm.RBF_C, 'c')}),
mlp AS (SELECT 'mlp' AS model, (i_n * {len(_mlp.MLP_GRID['epochs'])} + i_e) * {len(_mlp.MLP_GRID['momentum'])} + i_m AS grid_index, n, e, m
  FROM {_sql_axis(_mlp.MLP_GRID['n_neurons'], 'n')} CROSS JOIN {_sql_axis(_mlp.MLP_GRID['epochs'], 'e')}
  CROSS JOIN {_sql_axis(_mlp.MLP_GRID['momentum'], 'm')}),
points AS (SELECT model, grid_index, kernel, degree, gamma, c, NULL AS n, NULL AS e, NULL AS m FROM poly UNION ALL
  SELECT model, grid_index, kernel, degree, gamma, c, NULL, NULL, NULL FROM rbf UNION ALL
  SELECT model, grid_index, NULL, NULL, NULL, NULL, n, e, m FROM mlp),
series AS (SELECT event_type AS symbol, CAST(count(*) AS BIGINT) AS bars FROM
  (SELECT DISTINCT event_type, date_trunc('hour', ts) FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL) GROUP BY ALL)
SELECT symbol, bars, model, CAST(grid_index AS INTEGER) AS grid_index, kernel, CAST(degree AS DOUBLE) AS degree, CAST(gamma AS DOUBLE) AS gamma,
  CAST(c AS DOUBLE) AS "C", CAST(n AS DOUBLE) AS n_neurons, CAST(e AS DOUBLE) AS epochs,
  CASE WHEN model = 'mlp' THEN {O.f(_mlp.MLP_GRID['lr'][0])} END AS lr, CAST(m AS DOUBLE) AS momentum,
  CASE WHEN model = 'mlp' THEN {O.f(_mlp.MLP_GRID['dropout_rate'][0])} END AS dropout_rate
FROM series CROSS JOIN points""")
def param_grid(spark, sf_dir):
    """Every grid point for every series of the table, with the bars its fits would see."""
    fields = list(GRID_COLUMNS)
    points = F.array(*[F.struct(*[F.lit(v).cast(GRID_COLUMNS[c]).alias(c) for c, v in zip(fields, p)]) for p in _grid_points()])
    bars, _ = fixture_bars(spark, sf_dir, FX)
    series = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"))
    return series.select("symbol", "bars", F.explode(points).alias("p")).select("symbol", "bars", "p.*")


@register("gnb_f1", _gnb_sql("continuous", f"""
SELECT symbol, {O.r("coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)")} AS f1 FROM (
  SELECT symbol,
    sum(CAST(movement = 1 AND prediction = 1 AS DOUBLE)) AS tp,
    sum(CAST(movement = 0 AND prediction = 1 AS DOUBLE)) AS fp,
    sum(CAST(movement = 1 AND prediction = 0 AS DOUBLE)) AS fn
  FROM pred WHERE is_test GROUP BY symbol)"""))
def gnb_f1(spark, sf_dir):
    """A10: F1 of the up class for naive Bayes on the continuous features."""
    from pricetrend.operators.evaluate import f1_by
    x, cols, stats = _gnb(spark, sf_dir, "continuous")
    return spark_round(f1_by(gnb_predict(x.where("is_test"), stats, cols), ["symbol"]), ["f1"])


# ---------------------------------------------------------------- named feature sets (section 1.4)
def _register_feature_set(name: str, set_name: str, cols: list[str]) -> None:
    doubles = [c for c in cols if c not in TREND_COLS]
    sel = ", ".join(O.r(c, _digits(c)) + f" AS {c}" if c in doubles else f"CAST({c} AS DOUBLE) AS {c}"
                    for c in cols)

    def q(spark, sf_dir):
        t = _trends(spark, sf_dir)
        got = feature_set(t, set_name)
        assert got == cols, got
        x = t.select("symbol", "bar_no", F.col("movement").cast("int").alias("movement"),
                     *[F.col(c).cast("double").alias(c) for c in cols])
        return spark_round(x, doubles)

    register(name, O.with_panel(FX, f"SELECT symbol, bar_no, CAST(movement AS INTEGER) AS movement, {sel} FROM trends"))(q)


_register_feature_set("continuous_lagged_features", "continuous_lagged", _CF + LAG_COLS)
_register_feature_set("trend_superset_features", "trend_superset", _CF + LAG_COLS + TREND_COLS)


# ---------------------------------------------------------------- selection and roll-ups
from pricetrend.plans import signals as SG  # noqa: E402


def _signals(spark, sf_dir):
    return cut_lineage(SG.signal_results(_trends(spark, sf_dir)), "results")


def _signal_sql(select: str) -> str:
    return SG.results_sql(FX, SG.report_sql() + select)


_ACC = f"{O.r('accuracy')} AS accuracy"
_VAL = f"{O.r('value')} AS value"
_ROW = "symbol, representation, model, grid_index"


def _value_rows(df, *more):
    return spark_round(df.select("symbol", "representation", "model", "grid_index", *more, "value"), ["value"])


@register("signal_cv_accuracy", _signal_sql(f"SELECT {_ROW}, {_VAL} FROM res WHERE metric = 'cv_accuracy'"))
def signal_cv_accuracy(spark, sf_dir):
    """A2: mean accuracy over five stratified folds of every candidate."""
    return _value_rows(_signals(spark, sf_dir).where("metric = 'cv_accuracy'"))


@register("signal_sweep", _signal_sql(f"SELECT {_ROW}, {_VAL} FROM res WHERE metric = 'test_accuracy'"))
def signal_sweep(spark, sf_dir):
    """Every candidate scored on the test split, without folds."""
    return _value_rows(_signals(spark, sf_dir).where("metric = 'test_accuracy'"))


@register("signal_best_params", _signal_sql(f"SELECT {_ROW}, kernel, signal, {_VAL} FROM svm1"))
def signal_best_params(spark, sf_dir):
    """The best grid point per series and kernel, ties to the lowest index."""
    best = X.best_points(_signals(spark, sf_dir))
    return _value_rows(best, "kernel", F.col("params")["signal"].alias("signal"))


@register("signal_svm_per_series", _signal_sql(f"SELECT symbol, representation, {_ACC} FROM per WHERE model = 'svm'"))
def signal_svm_per_series(spark, sf_dir):
    """A3: (best of the one kernel + best of the other) / 2."""
    per = X.svm_summary(_signals(spark, sf_dir))
    return spark_round(per.select("symbol", "representation", "accuracy"), ["accuracy"])


@register("signal_svm_overall", _signal_sql(f"SELECT representation, {_ACC} FROM total WHERE model = 'svm'"))
def signal_svm_overall(spark, sf_dir):
    """A4: the mean of A3 over the series."""
    per = X.svm_summary(_signals(spark, sf_dir))
    return spark_round(per.groupBy("representation").agg(F.avg("accuracy").alias("accuracy")), ["accuracy"])


@register("signal_top3_larger", _signal_sql(f"SELECT {_ROW}, CAST(r AS INTEGER) AS rank, ntrees, {_VAL} FROM rf3"))
def signal_top3_larger(spark, sf_dir):
    """Top three by (accuracy, ntrees), larger ntrees first on ties."""
    return _value_rows(X.rf_top3(_signals(spark, sf_dir)), "rank", "ntrees")


@register("signal_top3_earlier", _signal_sql(f"SELECT {_ROW}, CAST(r AS INTEGER) AS rank, {_VAL} FROM mlp3"))
def signal_top3_earlier(spark, sf_dir):
    """Top three above zero, earlier grid point first on ties."""
    return _value_rows(X.mlp_top3(_signals(spark, sf_dir)), "rank")


@register("signal_first3", _signal_sql(f"SELECT {_ROW}, {_VAL} FROM res WHERE model = 'rf_cv' AND grid_index < 3"))
def signal_first3(spark, sf_dir):
    """The first three grid points, whatever their score."""
    return _value_rows(X.rf_cv_selected(_signals(spark, sf_dir), "first_k"))


@register("signal_series_max", _signal_sql(f"SELECT symbol, representation, model, {O.r('max(value)')} AS value FROM res GROUP BY symbol, representation, model"))
def signal_series_max(spark, sf_dir):
    """The running maximum of each series and model."""
    best = X.series_max(_signals(spark, sf_dir))
    return spark_round(best, ["value"])


@register("signal_overall", _signal_sql(f"SELECT representation, model, {_ACC}, n_series FROM total"))
def signal_overall(spark, sf_dir):
    """Each model's roll-up over the series."""
    return spark_round(X.overall(_signals(spark, sf_dir)), ["accuracy"])


@register("signal_rf_first3_overall", _signal_sql(f"""SELECT representation, {O.r('avg(best)')} AS accuracy FROM
  (SELECT symbol, representation, max(value) AS best FROM res WHERE model = 'rf_cv' AND grid_index < 3 GROUP BY ALL) GROUP BY ALL"""))
def signal_rf_first3_overall(spark, sf_dir):
    """A6 over G7: the mean of each series' best among the first three points."""
    res = X.overall(_signals(spark, sf_dir), "first_k").where("model = 'rf_cv'")
    return spark_round(res.select("representation", "accuracy"), ["accuracy"])


@register("signal_comparison", _signal_sql(f"""SELECT model, {O.r('continuous')} AS continuous, {O.r('trend')} AS trend FROM (
  SELECT CASE WHEN model = 'rf_cv' THEN 'rf' ELSE model END AS model, max(CASE WHEN representation = 'continuous' THEN accuracy END) AS continuous,
    max(CASE WHEN representation = 'trend' THEN accuracy END) AS trend FROM total GROUP BY 1)"""))
def signal_comparison(spark, sf_dir):
    """One row per model, one column per representation."""
    return spark_round(X.comparison(_signals(spark, sf_dir)), ["continuous", "trend"])


@register("signal_report", _signal_sql(f"SELECT symbol, representation, model, {_ACC}, best_params FROM per"))
def signal_report(spark, sf_dir):
    """One row per series, representation and model, with the parameters kept."""
    return spark_round(X.per_series(_signals(spark, sf_dir)), ["accuracy"])
