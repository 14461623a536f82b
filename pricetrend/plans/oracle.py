"""Reference SQL (DuckDB dialect) for the correctness check.

Written the straightforward way on purpose: one window per symbol, a
recursive CTE for the EMAs. It shares no code path with the Spark plans
(blocks, halos, carries, chunk offsets) and so checks them independently.
"""

from __future__ import annotations

LINEITEM_ORDER = ("l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                  "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus")


def f(x: float) -> str:
    """A double literal that DuckDB reads back bit-exactly."""
    return f"CAST({x!r} AS DOUBLE)"


def r(expr: str, digits: int = 6) -> str:
    m = f(float(10 ** digits))
    return f"(round(({expr}) * {m}) / {m} + 0.0)"


def bar_start(ts: str, grain: str) -> str:
    if grain == "6 hours":
        return f"(date_trunc('day', {ts}) + to_hours(CAST(floor(hour({ts}) / 6) * 6 AS BIGINT)))"
    return f"CAST(date_trunc('{grain}', {ts}) AS TIMESTAMP)"


def bars_sql(fixture: str) -> str:
    src, grain = fixture.split("_", 1)
    grain = grain.replace("6h", "6 hours")
    if src == "events":
        return f"""SELECT event_type AS symbol, {bar_start('ts', grain)} AS bar_ts,
  arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, (ts, event_id)) AS close
FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2"""
    px = "l_extendedprice / nullif(l_quantity, 0)"
    return f"""SELECT l_returnflag AS symbol, {bar_start('l_shipdate', grain)} AS bar_ts,
  arg_min({px}, ({LINEITEM_ORDER})) AS open, max({px}) AS high, min({px}) AS low,
  arg_max({px}, ({LINEITEM_ORDER})) AS close
FROM lineitem WHERE {px} IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2"""


def W(n: int | None = None, start: int | None = None, end: int = 0) -> str:
    base = "PARTITION BY symbol ORDER BY bar_no"
    if n is not None:
        return f"({base} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    if start is not None:
        e = "CURRENT ROW" if end == 0 else f"{-end} PRECEDING"
        return f"({base} ROWS BETWEEN {start} PRECEDING AND {e})"
    return f"({base})"


def panel_ctes(fixture: str) -> str:
    """CTEs bars -> numbered -> ind (indicators, lags, label) -> trends."""
    a12, a26, arsi = 2.0 / 13.0, 2.0 / 27.0, 1.0 / 14.0
    wma_terms = " + ".join(
        [f"{f(10.0)} * close"] + [f"{f(float(10 - k))} * lag(close, {k}) OVER {W()}" for k in range(1, 10)])
    tp_lags = ",\n    ".join(f"lag(tp, {k}) OVER {W()} AS tp_l{k}" for k in range(1, 20))
    mad = " + ".join(["abs(tp - tp_mean)"] + [f"abs(tp_l{k} - tp_mean)" for k in range(1, 20)])
    return f"""bars AS ({bars_sql(fixture)}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS bar_no FROM bars),
l1 AS (
  SELECT *,
    lag(close) OVER {W()} AS c1,
    lag(close, 12) OVER {W()} AS c12,
    CASE WHEN count(close) OVER {W(10)} >= 10 THEN avg(close) OVER {W(10)} END AS sma_10,
    CASE WHEN count(close) OVER {W(10)} >= 10 THEN ({wma_terms}) / {f(55.0)} END AS wma_10,
    max(high) OVER {W(14)} AS hh, min(low) OVER {W(14)} AS ll,
    least(count(high) OVER {W(14)}, count(low) OVER {W(14)}) AS nhl,
    (high + low + close) / {f(3.0)} AS tp
  FROM numbered),
l2 AS (
  SELECT *,
    avg(tp) OVER {W(20)} AS tp_mean, count(tp) OVER {W(20)} AS ntp,
    {tp_lags},
    CASE WHEN nhl >= 14 THEN {f(100.0)} * (close - ll) / nullif(hh - ll, 0) END AS stck,
    CASE WHEN nhl >= 14 THEN {f(100.0)} * (close - hh) / nullif(hh - ll, 0) END AS williams_r,
    (high - c1) / nullif(high - low, 0) AS ad_osc,
    (close - c12) / nullif(c12, 0) * {f(100.0)} AS momentum,
    close - c1 AS price_change,
    CASE WHEN close - c1 > 0 THEN close - c1 ELSE {f(0.0)} END AS up,
    CASE WHEN close - c1 < 0 THEN c1 - close ELSE {f(0.0)} END AS dn
  FROM l1),
l3 AS MATERIALIZED (
  SELECT *,
    CASE WHEN ntp >= 20 THEN (tp - tp_mean) / nullif({f(0.015)} * (({mad}) / {f(20.0)}), 0) END AS cci,
    CASE WHEN count(stck) OVER {W(3)} >= 3 THEN avg(stck) OVER {W(3)} END AS stcd
  FROM l2),
ema AS (
  SELECT symbol, bar_no, close AS e12, close AS e26, up AS eu, dn AS ed FROM l3 WHERE bar_no = 1
  UNION ALL
  SELECT c.symbol, c.bar_no,
    {f(a12)} * c.close + {f(1 - a12)} * e.e12,
    {f(a26)} * c.close + {f(1 - a26)} * e.e26,
    {f(arsi)} * c.up + {f(1 - arsi)} * e.eu,
    {f(arsi)} * c.dn + {f(1 - arsi)} * e.ed
  FROM ema e JOIN l3 c ON c.symbol = e.symbol AND c.bar_no = e.bar_no + 1),
l4 AS (
  SELECT l3.*,
    CASE WHEN l3.bar_no >= 26 THEN ema.e12 - ema.e26 END AS macd,
    CASE WHEN l3.bar_no >= 14 THEN
      CASE WHEN ema.ed = 0 THEN {f(100.0)} ELSE {f(100.0)} - {f(100.0)} / ({f(1.0)} + ema.eu / ema.ed) END
    END AS rsi
  FROM l3 JOIN ema USING (symbol, bar_no)),
ind AS (
  SELECT symbol, bar_ts, bar_no, open, high, low, close, price_change,
    sma_10, wma_10, stck, stcd, williams_r, macd, rsi, cci, ad_osc, momentum,
    lag(stck) OVER {W()} AS stck_lag, lag(stcd) OVER {W()} AS stcd_lag,
    lag(williams_r) OVER {W()} AS williams_r_lag, lag(macd) OVER {W()} AS macd_lag,
    lag(rsi) OVER {W()} AS rsi_lag, lag(cci) OVER {W()} AS cci_lag,
    lag(ad_osc) OVER {W()} AS ad_osc_lag,
    CAST(CASE WHEN price_change > 0 THEN 1 ELSE 0 END AS INTEGER) AS movement
  FROM l4),
trends AS (
  SELECT *,
    {trend_sql()}
  FROM ind)"""


def _dir(x: str) -> str:
    return (f"CAST(CASE WHEN {x} IS NULL OR {x}_lag IS NULL THEN 0 "
            f"WHEN {x} > {x}_lag THEN 1 ELSE -1 END AS INTEGER) AS {x}_trend")


def trend_sql() -> str:
    parts = [
        "CAST(CASE WHEN close > sma_10 THEN 1 ELSE -1 END AS INTEGER) AS sma_10_trend",
        "CAST(CASE WHEN close > wma_10 THEN 1 ELSE -1 END AS INTEGER) AS wma_10_trend",
        _dir("stck"), _dir("stcd"), _dir("williams_r"), _dir("macd"),
        ("CAST(CASE WHEN rsi IS NULL THEN 0 WHEN rsi > 70 THEN -1 WHEN rsi < 30 THEN 1 "
         "WHEN rsi_lag IS NULL THEN 0 WHEN rsi > rsi_lag THEN 1 ELSE -1 END AS INTEGER) AS rsi_trend"),
        _dir("cci"), _dir("ad_osc"),
        ("CAST(CASE WHEN momentum IS NULL THEN 0 WHEN momentum > 0 THEN 1 ELSE -1 END AS INTEGER) "
         "AS momentum_trend"),
    ]
    return ",\n    ".join(parts)


def with_panel(fixture: str, select: str) -> str:
    return f"WITH RECURSIVE {panel_ctes(fixture)}\n{select}"


def gapped_macd_sql(fixture: str, columns: str) -> str:
    """Bars on their full hourly grid; the MACD averages run over observed closes."""
    a12, a26 = 2.0 / 13.0, 2.0 / 27.0
    return f"""WITH RECURSIVE bars AS ({bars_sql(fixture)}),
grid AS (SELECT symbol, unnest(generate_series(min(bar_ts), max(bar_ts), INTERVAL 1 HOUR)) AS bar_ts FROM bars GROUP BY symbol),
numbered AS (SELECT g.symbol, g.bar_ts, close, row_number() OVER (PARTITION BY g.symbol ORDER BY g.bar_ts) AS bar_no
  FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.bar_ts = b.bar_ts),
seen AS MATERIALIZED (SELECT *, count(close) OVER {W()} AS obs,
  CASE WHEN count(close) OVER {W(10)} >= 10 THEN avg(close) OVER {W(10)} END AS sma_10 FROM numbered),
observed AS MATERIALIZED (SELECT symbol, obs, close FROM seen WHERE close IS NOT NULL),
ema AS (
  SELECT symbol, obs, close AS e12, close AS e26 FROM observed WHERE obs = 1
  UNION ALL
  SELECT o.symbol, o.obs, {f(a12)} * o.close + {f(1 - a12)} * e.e12, {f(a26)} * o.close + {f(1 - a26)} * e.e26
  FROM ema e JOIN observed o ON o.symbol = e.symbol AND o.obs = e.obs + 1),
ind AS (SELECT s.symbol, s.bar_ts, s.bar_no, s.close, s.sma_10, CASE WHEN s.obs >= 26 THEN e.e12 - e.e26 END AS macd
  FROM seen s LEFT JOIN ema e ON s.symbol = e.symbol AND s.obs = e.obs)
SELECT symbol, bar_ts, bar_no, {columns} FROM ind"""


# ------------------------------------------------------------------ feature preparation
CONTINUOUS = ["open", "high", "low", "sma_10", "wma_10", "stck", "stcd", "williams_r", "macd",
              "rsi", "cci", "ad_osc", "momentum"]
TREND_ONLY = ["sma_10_trend", "wma_10_trend", "stck_trend", "stcd_trend", "williams_r_trend",
              "macd_trend", "rsi_trend", "cci_trend", "ad_osc_trend", "momentum_trend"]
FEATURE_SETS = {"continuous": CONTINUOUS, "trend": TREND_ONLY}


def split_hash_sql(seed: int = 42) -> str:
    return f"md5(symbol || '|' || CAST(bar_no AS VARCHAR) || '|' || '{seed}')"


def prep_ctes(feats: list[str], scale: str | None, test_size: float, folds: int = 0) -> str:
    """CTEs feat -> imp -> [scaled] -> split -> [scaled_train] -> prep (after ``trends``)."""
    P = "OVER (PARTITION BY symbol)"
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in feats)
    imp = ", ".join(f"coalesce({c}, avg({c}) {P}, {f(0.0)}) AS {c}" for c in feats)
    ctes = [f"feat AS (SELECT symbol, bar_no, CAST(movement AS INTEGER) AS movement, {cols} FROM trends)",
            f"imp AS (SELECT symbol, bar_no, movement, {imp} FROM feat)"]
    prev = "imp"
    if scale == "all":
        z = ", ".join(
            f"coalesce(({c} - avg({c}) {P}) / CASE WHEN stddev_pop({c}) {P} > 0 "
            f"THEN stddev_pop({c}) {P} END, {f(0.0)}) AS {c}" for c in feats)
        ctes.append(f"scaled AS (SELECT symbol, bar_no, movement, {z} FROM imp)")
        prev = "scaled"
    fl = ", ".join(feats)
    ctes.append(f"""split AS (
  SELECT symbol, bar_no, movement, {fl}, split_hash, split_rank,
    split_rank <= ceil(CAST(n AS DOUBLE) * {f(test_size)}) AS is_test,
    NOT (split_rank <= ceil(CAST(n AS DOUBLE) * {f(test_size)})) AS is_train
  FROM (SELECT *, {split_hash_sql()} AS split_hash,
          row_number() OVER (PARTITION BY symbol ORDER BY {split_hash_sql()}) AS split_rank,
          count(*) {P} AS n FROM {prev}))""")
    prev = "split"
    if scale == "train":
        st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in feats)
        z = ", ".join(f"coalesce((x.{c} - st.m_{c}) / CASE WHEN st.s_{c} > 0 THEN st.s_{c} END, "
                      f"{f(0.0)}) AS {c}" for c in feats)
        ctes.append(f"trstats AS (SELECT symbol, {st} FROM split WHERE is_train GROUP BY symbol)")
        ctes.append(f"""scaled_train AS (SELECT x.symbol, x.bar_no, x.movement, {z},
  x.split_hash, x.split_rank, x.is_test, x.is_train
  FROM split x LEFT JOIN trstats st USING (symbol))""")
        prev = "scaled_train"
    if folds:
        ctes.append(f"""prep AS (SELECT p.*, coalesce(fo.fold, -1) AS fold FROM {prev} p LEFT JOIN (
  SELECT symbol, bar_no, CAST(ntile({folds}) OVER (PARTITION BY symbol, movement ORDER BY split_hash) - 1
    AS INTEGER) AS fold
  FROM {prev} WHERE is_train) fo USING (symbol, bar_no))""")
    else:
        ctes.append(f"prep AS (SELECT * FROM {prev})")
    return ",\n".join(ctes)


def with_prep(fixture: str, feats: list[str], scale: str | None, test_size: float,
              select: str, folds: int = 0) -> str:
    return (f"WITH RECURSIVE {panel_ctes(fixture)},\n{prep_ctes(feats, scale, test_size, folds)}\n"
            f"{select}")


def with_balanced(fixture: str, feats: list[str], select: str) -> str:
    """``prep`` of the balanced protocol: features on [-1, 1], tuning and evaluation sets of equal classes."""
    lo, hi = "min({0}) OVER (PARTITION BY symbol)", "max({0}) OVER (PARTITION BY symbol)"
    mm = ", ".join(f"CASE WHEN {hi} > {lo} THEN ({{0}} - ({lo} + {hi}) / {f(2.0)}) / (({hi} - {lo}) / {f(2.0)}) ELSE {f(-1.0)} END AS {{0}}".format(c)
                   for c in feats)
    return f"""WITH RECURSIVE {panel_ctes(fixture)},
{prep_ctes(feats, None, 0.2)[:-len('prep AS (SELECT * FROM split)')]}unit AS (SELECT symbol, bar_no, movement, split_hash, {mm} FROM split),
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol, movement ORDER BY split_hash) AS crank,
    count(*) OVER (PARTITION BY symbol, movement) AS csize FROM unit),
sized AS (SELECT *, CASE WHEN count(DISTINCT movement) OVER (PARTITION BY symbol) >= 2
    THEN min(csize) OVER (PARTITION BY symbol) ELSE 0 END AS m FROM ranked),
prep AS (SELECT *, crank <= ceil(CAST(m AS DOUBLE) * {f(0.2)}) AS is_train,
    crank > ceil(CAST(m AS DOUBLE) * {f(0.2)}) AS is_test FROM sized WHERE crank <= m)
{select}"""


def gnb_ctes(feats: list[str], var_smoothing: float = 1e-9) -> str:
    means = ", ".join(f"avg({c}) AS mean_{c}" for c in feats)
    vars_ = ", ".join(f"var_pop({c}) AS var_{c}" for c in feats)
    eps = "greatest(" + ", ".join(f"var_pop({c})" for c in feats) + f", {f(0.0)}) * {f(var_smoothing)}"
    wide = []
    for k in (0, 1):
        wide.append(f"max(CASE WHEN movement = {k} THEN log_prior END) AS lp{k}")
        for c in feats:
            wide.append(f"max(CASE WHEN movement = {k} THEN mean_{c} END) AS m{k}_{c}")
            wide.append(f"max(CASE WHEN movement = {k} THEN var_{c} END) AS v{k}_{c}")

    def jll(k):
        norm = " + ".join([f(0.0)] + [f"ln({f(6.283185307179586)} * v{k}_{c})" for c in feats])
        dist = " + ".join([f(0.0)] + [f"pow({c} - m{k}_{c}, 2) / v{k}_{c}" for c in feats])
        return f"lp{k} - {f(0.5)} * ({norm}) - {f(0.5)} * ({dist})"
    return f"""cls AS (SELECT symbol, movement, count(*) AS n, {means}, {vars_}
  FROM prep WHERE is_train GROUP BY symbol, movement),
eps AS (SELECT symbol, {eps} AS eps FROM prep WHERE is_train GROUP BY symbol),
gstats AS (SELECT c.symbol, CAST(c.movement AS INTEGER) AS movement, c.n,
    ln(c.n / sum(c.n) OVER (PARTITION BY c.symbol)) AS log_prior,
    {', '.join(f'c.mean_{x}' for x in feats)},
    {', '.join(f'c.var_{x} + e.eps AS var_{x}' for x in feats)}
  FROM cls c JOIN eps e USING (symbol)),
wide AS (SELECT symbol, {', '.join(wide)} FROM gstats GROUP BY symbol),
scored AS (SELECT p.*, {jll(0)} AS jll0, {jll(1)} AS jll1 FROM prep p LEFT JOIN wide USING (symbol)),
pred AS (SELECT *, CAST(CASE WHEN jll0 IS NULL AND jll1 IS NULL THEN NULL WHEN jll0 IS NULL THEN 1
    WHEN jll1 IS NULL THEN 0 WHEN jll1 > jll0 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM scored)"""
