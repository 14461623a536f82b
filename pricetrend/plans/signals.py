"""Single-signal candidates: a results table that SQL can recompute.

Each indicator is a one-rule classifier: on the trend representation it says
"up" when its trend signal is +1, on the continuous one when its value is above
its series' mean. Scored on the same splits and folds as the learned models and
laid out like their results, the ten candidates are a grid for every
selection rule and roll-up of ``experiments``: they answer how far single
indicators go, and check those rules against an independent formulation.

  svm     cv_accuracy on the 80/20 training rows; the first five indicators stand
          in the place of the poly grid, the others of the rbf grid
  rf      test_accuracy (80/20), continuous; ntrees = 10, 20, ... by position
  rf_cv   cv_accuracy on the 70/30 training rows, trend
  mlp     test_accuracy (70/30)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricetrend.operators.indicators import INDICATORS
from pricetrend.operators.keyed import join_series
from pricetrend.operators.split import holdout_split, stratified_folds
from pricetrend.plans import oracle as O
from pricetrend.session import cut_lineage

DIGITS = 1e9        # values are rounded, so that ties are ties in any summation order
ABOVE = 1e-9        # relative margin above the mean
POLY = INDICATORS[:5]


def candidates(panel: DataFrame) -> DataFrame:
    """symbol, bar_no, movement and the 20 predictions (trend first) of each bar."""
    panel = cut_lineage(panel.select("symbol", "bar_no", F.col("movement").cast("int").alias("movement"),
                                     *INDICATORS, *[f"{x}_trend" for x in INDICATORS]), "signals")
    means = panel.groupBy("symbol").agg(*[F.avg(x).alias(f"_m_{x}") for x in INDICATORS])
    joined = join_series(panel, means)
    trend = [(F.col(f"{x}_trend") == 1).cast("int") for x in INDICATORS]
    above = [F.coalesce(F.col(x) > F.col(f"_m_{x}") + ABOVE * F.abs(f"_m_{x}"), F.lit(False)).cast("int") for x in INDICATORS]
    return joined.select("symbol", "bar_no", "movement", F.array(*trend, *above).alias("says"))


def _scores(rows: DataFrame, by: list[str]) -> DataFrame:
    """accuracy of each candidate (representation, grid_index) in each group of ``by``."""
    n = len(INDICATORS)
    said = rows.select(*by, "movement", F.posexplode("says").alias("cand", "said"))
    return (said.groupBy(*by, "cand").agg(F.avg((F.col("said") == F.col("movement")).cast("double")).alias("accuracy"))
            .withColumn("representation", F.when(F.col("cand") < n, F.lit("trend")).otherwise(F.lit("continuous")))
            .withColumn("grid_index", (F.col("cand") % n).cast("int")).drop("cand"))


def signal_results(panel: DataFrame) -> DataFrame:
    """The results table (layout of ``experiments``) of all candidates."""
    base = cut_lineage(candidates(panel), "candidates")
    parts = []
    named = F.element_at(F.array(*map(F.lit, INDICATORS)), F.col("grid_index") + 1)
    for test_size, tested, crossed in ((0.2, "rf", "svm"), (0.3, "mlp", "rf_cv")):
        split = cut_lineage(stratified_folds(cut_lineage(holdout_split(base, test_size), "split")), "folds")
        test = _scores(split.where("is_test"), ["symbol"])
        cv = (_scores(split.where("is_train"), ["symbol", "fold"]).groupBy("symbol", "representation", "grid_index")
              .agg(F.avg("accuracy").alias("accuracy")))
        for model, metric, got in ((tested, "test_accuracy", test), (crossed, "cv_accuracy", cv)):
            if model == "rf":
                got = got.where("representation = 'continuous'")
            if model == "rf_cv":
                got = got.where("representation = 'trend'")
            params = {"svm": F.create_map(F.lit("kernel"), F.when(named.isin(*POLY), F.lit("poly")).otherwise(F.lit("rbf")),
                                          F.lit("signal"), named),
                      "mlp": F.create_map(F.lit("signal"), named)}.get(
                model, F.create_map(F.lit("ntrees"), ((F.col("grid_index") + 1) * 10).cast("string"), F.lit("signal"), named))
            parts.append(got.select("symbol", "representation", F.lit(model).alias("model"), params.alias("params"), "grid_index",
                                    F.lit(metric).alias("metric"), (F.round(F.col("accuracy") * DIGITS) / DIGITS).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def results_sql(fixture: str, select: str) -> str:
    """DuckDB: CTE ``res`` (symbol, representation, model, grid_index, signal, kernel,
    ntrees, metric, value), then ``select``."""
    trend = ", ".join(f"CAST({x}_trend = 1 AS INTEGER)" for x in INDICATORS)
    above = ", ".join(f"CAST(coalesce({x} > avg({x}) OVER s + {O.f(ABOVE)} * abs(avg({x}) OVER s), FALSE) AS INTEGER)" for x in INDICATORS)
    names = ", ".join(f"'{x}'" for x in INDICATORS)

    def scores(part: str, test_size: float, models: tuple[str, str]) -> str:
        tested, crossed = models
        r = lambda x: f"round(({x}) * {O.f(DIGITS)}) / {O.f(DIGITS)}"
        return f"""{part} AS MATERIALIZED (SELECT *, split_rank <= ceil(CAST(n AS DOUBLE) * {O.f(test_size)}) AS is_test FROM base),
{part}f AS MATERIALIZED (SELECT symbol, movement, says, ntile(5) OVER (PARTITION BY symbol, movement ORDER BY split_hash) AS fold FROM {part} WHERE NOT is_test),
{part}t AS (SELECT symbol, cand, {r('avg(CAST(said = movement AS DOUBLE))')} AS value FROM
  (SELECT symbol, movement, unnest(says) AS said, unnest(range(20)) AS cand FROM {part} WHERE is_test) GROUP BY ALL),
{part}c AS (SELECT symbol, cand, {r('avg(acc)')} AS value FROM (SELECT symbol, fold, cand, avg(CAST(said = movement AS DOUBLE)) AS acc FROM
  (SELECT symbol, movement, fold, unnest(says) AS said, unnest(range(20)) AS cand FROM {part}f) GROUP BY ALL) GROUP BY ALL),
{part}r AS (SELECT symbol, cand, '{tested}' AS model, 'test_accuracy' AS metric, value FROM {part}t
  UNION ALL SELECT symbol, cand, '{crossed}', 'cv_accuracy', value FROM {part}c)"""

    return O.with_panel(fixture, "").rstrip() + f""",
base AS MATERIALIZED (SELECT symbol, bar_no, CAST(movement AS INTEGER) AS movement, [{trend}, {above}] AS says,
  {O.split_hash_sql()} AS split_hash, row_number() OVER (PARTITION BY symbol ORDER BY {O.split_hash_sql()}) AS split_rank,
  count(*) OVER s AS n FROM trends WINDOW s AS (PARTITION BY symbol)),
{scores('s20', 0.2, ('rf', 'svm'))},
{scores('s30', 0.3, ('mlp', 'rf_cv'))},
every AS (SELECT symbol, CASE WHEN cand < 10 THEN 'trend' ELSE 'continuous' END AS representation, model, CAST(cand % 10 AS INTEGER) AS grid_index,
  metric, value FROM (SELECT * FROM s20r UNION ALL SELECT * FROM s30r)),
res AS MATERIALIZED (SELECT *, ([{names}])[grid_index + 1] AS signal, CASE WHEN grid_index < 5 THEN 'poly' ELSE 'rbf' END AS kernel,
  (grid_index + 1) * 10 AS ntrees FROM every
  WHERE NOT (model = 'rf' AND representation = 'trend') AND NOT (model = 'rf_cv' AND representation = 'continuous'))
{select}"""


def report_sql() -> str:
    """CTEs after ``res``: per (symbol, representation, model) the accuracy under the model's rule."""
    k = "symbol, representation"
    row = lambda order, part=k: f"row_number() OVER (PARTITION BY {part} ORDER BY {order})"
    return f""",
svm1 AS (SELECT * FROM (SELECT *, {row('value DESC, grid_index', k + ', kernel')} AS r FROM res WHERE model = 'svm') WHERE r = 1),
rf3 AS (SELECT * FROM (SELECT *, {row('value DESC, ntrees DESC')} AS r FROM res WHERE model = 'rf') WHERE r <= 3),
cv3 AS (SELECT * FROM (SELECT *, {row('value DESC, grid_index')} AS r FROM res WHERE model = 'rf_cv') WHERE r <= 3),
mlp3 AS (SELECT * FROM (SELECT *, {row('value DESC, grid_index')} AS r FROM res WHERE model = 'mlp' AND value > 0) WHERE r <= 3),
per AS (SELECT {k}, 'svm' AS model, avg(value) AS accuracy, string_agg('kernel=' || kernel || ',signal=' || signal, '; ' ORDER BY kernel) AS best_params
    FROM svm1 GROUP BY {k}
  UNION ALL SELECT {k}, 'rf', avg(value), string_agg('ntrees=' || ntrees || ',signal=' || signal, '; ' ORDER BY r) FROM rf3 GROUP BY {k}
  UNION ALL SELECT {k}, 'rf_cv', max(value), string_agg('ntrees=' || ntrees || ',signal=' || signal, '; ' ORDER BY grid_index) FROM cv3 GROUP BY {k}
  UNION ALL SELECT {k}, 'mlp', value, 'signal=' || signal FROM (SELECT *, {row('value DESC, grid_index')} AS r FROM res WHERE model = 'mlp') WHERE r = 1),
total AS (SELECT representation, model, avg(accuracy) AS accuracy, count(*) AS n_series FROM per GROUP BY ALL)
"""
