"""Entry point C: model grids per series -> one results table -> roll-ups.

results: symbol, representation, model, params MAP<STRING,STRING>,
         grid_index INT, metric STRING, value DOUBLE

Roll-ups follow the study's arithmetic:
  svm  per series (best poly CV + best rbf CV) / 2, then mean over series (A3, A4)
  rf   mean of the top-3 test accuracies of every series (G5, A5)
  rf_cv (trend) max of the selected three per series, then mean (G7, A6)
  nb   mean test accuracy (A7)
  mlp  per-series max over the grid, then mean (G8, A8); top-3 report (G6)
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pricetrend.models import forest, mlp, store, stumps, svm
from pricetrend.models.gnb import gnb_predict, gnb_stats, gnb_wide
from pricetrend.models.shards import deal
from pricetrend.models.svm import SvmParams
from pricetrend.operators.evaluate import (accuracy_by, f1_by, first_k, top3_value_then_earlier,
                                           top3_value_then_larger, top_k)
from pricetrend.plans.prepare import PROTOCOLS, prepare, raw_features, scaling_of, split_rows
from pricetrend.session import cut_lineage, scratch_path


@dataclass(frozen=True)
class GridConfig:
    svm: list[dict] = field(default_factory=lambda: svm.poly_grid() + svm.rbf_grid())
    rf_counts: list[int] = field(default_factory=lambda: list(forest.TREE_COUNTS))
    mlp: list[dict] = field(default_factory=mlp.mlp_grid)
    svm_params: SvmParams = SvmParams()
    protocol: str = "study"     # or "balanced" (see ``prepare``)


# 64 SVM points, 20 tree counts, 48 networks.
REFERENCE_GRIDS = GridConfig()
BALANCED_GRIDS = GridConfig(protocol="balanced")


def _map(pairs: dict[str, F.Column]) -> F.Column:
    args = []
    for k, v in pairs.items():
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def _results(df: DataFrame, rep: str, model: str, params: dict[str, F.Column],
             metrics: list[str], grid_index: F.Column) -> DataFrame:
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                  for m in metrics]))
    return (df.select("symbol", F.lit(rep).alias("representation"), F.lit(model).alias("model"),
                      _map(params).alias("params"), grid_index.cast("int").alias("grid_index"),
                      stacked.alias("_m"))
            .select("symbol", "representation", "model", "params", "grid_index",
                    "_m.metric", "_m.value"))


def prepared(panel: DataFrame, family: str, rep: str, feature_set: str | None = None,
             protocol: str = "study") -> tuple[DataFrame, list[str]]:
    """Prepared features, written once and laid out by symbol, so that the fits of a
    series read its own files only."""
    x, cols = prepare(panel, family, rep, feature_set, protocol=protocol)
    return cut_lineage(x, f"prep-{family}-{rep}", partition_by="symbol"), cols


# ------------------------------------------------------------------ families
@dataclass(frozen=True)
class Fitted:
    """What a family's grid came to, and the kept models (see ``models.store``; G2)."""
    results: DataFrame
    store: DataFrame


def _text_map(pairs: dict[str, F.Column]) -> F.Column:
    """A parameter map without the NULL ones."""
    return F.map_filter(_map(pairs), lambda _, v: v.isNotNull())


def svm_fitted(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS, feature_set: str | None = None) -> Fitted:
    """M1-M3; the trend side takes ``trend_only`` by default, ``feature_set="trend_superset"``
    as the study's code does. Kept: the best point of each kernel by CV score."""
    x, cols = prepared(panel, "svm", rep, feature_set, cfg.protocol)
    m = svm.svm_fit(x, cols, cfg.svm, params=cfg.svm_params)
    res = _results(m, rep, "svm",
                   {c: F.col(c) for c in ("kernel", "degree", "gamma", "C", "n_components", "kernel_error", "converged")},
                   ["cv_accuracy", "test_accuracy"], F.col("grid_index"))
    best = top_k(m, ["symbol", "kernel"], [F.desc("cv_accuracy"), F.asc("grid_index")], 1)
    params = _text_map({c: F.col(c) for c in ("kernel", "degree", "gamma", "C", "n_components")} | {"seed": F.lit(cfg.svm_params.seed)})
    return Fitted(res, store.entries(best, scaling_of(panel, "svm", rep, feature_set, protocol=cfg.protocol), rep, "svm", cols, F.col("kernel"),
                                     F.col("grid_index"), params, F.col("cv_accuracy"), F.col("weights")))


def _count_index(cfg: GridConfig) -> F.Column:
    pairs = [v for i, c in enumerate(cfg.rf_counts) for v in (F.lit(c), F.lit(i))]
    return F.element_at(F.create_map(*pairs), F.col("ntrees"))


def rf_results(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS, keep: str | None = None) -> DataFrame:
    x, cols = prepared(panel, "rf", rep, protocol=cfg.protocol)
    r = forest.rf_sweep(x, cols, cfg.rf_counts, keep=keep)
    return _results(r.withColumnRenamed("accuracy", "test_accuracy"), rep, "rf",
                    {c: F.col(c) for c in ("ntrees", "max_depth", "max_bins")}, ["test_accuracy"], _count_index(cfg))


def rf_fitted(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> Fitted:
    """M4. Kept: the forests of the three best tree counts."""
    spark = panel.sparkSession
    keep = scratch_path(spark, f"forests-{rep}")
    res = cut_lineage(rf_results(panel, rep, cfg, keep), "rf-results")
    cols = raw_features(panel, rep)[1]
    # all trees of one series: as many as the largest count
    trees = (forest.saved_trees(spark, keep).groupBy(F.col("symbol").alias("_of"))
             .agg(F.array_sort(F.collect_list(F.struct("tree", "nodes"))).alias("trees")))
    best = rf_top3(res).select("symbol", "rank", "grid_index", "params", "value", "ntrees").join(trees, F.col("symbol").eqNullSafe(F.col("_of")))
    nodes = F.transform(F.slice("trees", F.lit(1), F.col("ntrees")), lambda t: t["nodes"])
    return Fitted(res, store.entries(best, scaling_of(panel, "rf", rep, protocol=cfg.protocol), rep, "rf", cols, F.col("rank"), F.col("grid_index"),
                                     F.col("params"), F.col("value"), store.tree_weights(nodes)))


def rf_cv_fitted(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> Fitted:
    """M5. Kept: the best tree count by CV score, grown on all training rows."""
    x, cols = prepared(panel, "rf_cv", rep, protocol=cfg.protocol)
    trees = cut_lineage(stumps.stumps_fit(x, cols, max(cfg.rf_counts)), "stumps")
    r = cut_lineage(stumps.stumps_accuracy(x, cols, cfg.rf_counts, trees), "stump-scores")
    params = {c: F.col(c) for c in ("ntrees", "max_depth")}
    best = top_k(r, ["symbol"], [F.desc("cv_accuracy"), F.asc("ntrees")], 1).join(
        stumps.per_series(trees.where(F.col("fold") == stumps.ALL)).withColumnRenamed("symbol", "_of"), F.col("symbol").eqNullSafe(F.col("_of")))
    kept = F.slice(F.element_at("trees", F.lit(stumps.ALL)), F.lit(1), F.col("ntrees"))
    return Fitted(_results(r, rep, "rf_cv", params, ["cv_accuracy"], _count_index(cfg)),
                  store.entries(best, scaling_of(panel, "rf_cv", rep, protocol=cfg.protocol), rep, "rf_cv", cols, F.lit(""), _count_index(cfg),
                                _text_map(params), F.col("cv_accuracy"), store.stump_weights(kept)))


def nb_fitted(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> Fitted:
    """M6/M7."""
    x, cols = prepared(panel, "nb", rep, protocol=cfg.protocol)
    stats = gnb_stats(x.where("is_train"), cols)
    scored = gnb_predict(x.where("is_test"), stats, cols)
    acc = accuracy_by(scored, ["symbol"]).join(f1_by(scored, ["symbol"]), "symbol").withColumnRenamed("accuracy", "test_accuracy")
    both = gnb_wide(stats, cols).join(acc.withColumnRenamed("symbol", "_of"), F.col("symbol").eqNullSafe(F.col("_of")), "left")
    numbers = ["lp0", "lp1"] + [f"{x}{k}_{c}" for k in (0, 1) for x in "mv" for c in cols]
    weights = F.array(*[F.coalesce(F.col(c), F.lit(float("nan"))) for c in numbers])
    return Fitted(_results(acc, rep, "nb", {}, ["test_accuracy", "f1"], F.lit(0)),
                  store.entries(both, scaling_of(panel, "nb", rep, protocol=cfg.protocol), rep, "nb", cols, F.lit(""), F.lit(0), F.create_map().cast("map<string,string>"),
                                F.col("test_accuracy"), weights))


def mlp_fitted(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> Fitted:
    """M8/M9. Kept: the best point by test accuracy, as the study takes it."""
    x, cols = prepared(panel, "mlp", rep, protocol=cfg.protocol)
    dealt = deal(x.select("symbol", "bar_no", "movement", "is_train", "is_test", *cols))
    models = mlp.mlp_fit(dealt, cols, cfg.mlp)
    r = cut_lineage(mlp.mlp_accuracy(dealt, cols, models), "mlp-scores")
    params = {c: F.col(c) for c in ("n_neurons", "epochs", "lr", "momentum", "dropout_rate", "epochs_used", "best_epoch")}
    best = top_k(r, ["symbol"], [F.desc("accuracy"), F.asc("grid_index")], 1).join(
        models.select(F.col("symbol").alias("_of"), F.col("grid_index").alias("_index"), "weights"),
        F.col("symbol").eqNullSafe(F.col("_of")) & (F.col("grid_index") == F.col("_index")))
    return Fitted(_results(r.withColumnRenamed("accuracy", "test_accuracy"), rep, "mlp", params, ["test_accuracy"], F.col("grid_index")),
                  store.entries(best, scaling_of(panel, "mlp", rep, protocol=cfg.protocol), rep, "mlp", cols, F.lit(""), F.col("grid_index"),
                                _text_map(params), F.col("accuracy"), F.col("weights")))


def svm_results(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS, feature_set: str | None = None) -> DataFrame:
    return svm_fitted(panel, rep, cfg, feature_set).results


def rf_cv_results(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> DataFrame:
    return rf_cv_fitted(panel, rep, cfg).results


def nb_results(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> DataFrame:
    return nb_fitted(panel, rep, cfg).results


def mlp_results(panel: DataFrame, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> DataFrame:
    return mlp_fitted(panel, rep, cfg).results


def fitted(panel: DataFrame, family: str, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> Fitted:
    return {"svm": svm_fitted, "nb": nb_fitted, "rf": rf_fitted, "rf_cv": rf_cv_fitted, "mlp": mlp_fitted}[family](panel, rep, cfg)


def test_bars(panel: DataFrame, family: str, rep: str, protocol: str = "study") -> DataFrame:
    """(symbol, bar_no, raw features...) of the bars that the family's split keeps for testing."""
    base, cols = raw_features(panel, rep)
    return split_rows(base, PROTOCOLS[protocol][family]).where("is_test").select("symbol", "bar_no", *cols)


def test_predictions(panel: DataFrame, rows: DataFrame, family: str, rep: str,
                     protocol: str = "study") -> DataFrame:
    """What every kept model of the family says on its test bars, with what happened."""
    said = store.predict(test_bars(panel, family, rep, protocol), rows.where((F.col("model") == family) & (F.col("representation") == rep)))
    truth = panel.select(F.col("symbol").alias("_its"), F.col("bar_no").alias("_bar"), F.col("movement").cast("int").alias("movement"))
    return said.join(truth, F.col("symbol").eqNullSafe(F.col("_its")) & (F.col("bar_no") == F.col("_bar"))).drop("_its", "_bar")


# ------------------------------------------------------------------ selection and roll-ups
def best_points(res: DataFrame) -> DataFrame:
    """The best grid point by CV score per (symbol, kernel), ties to the lowest index."""
    cv = res.where("model = 'svm' AND metric = 'cv_accuracy'").withColumn(
        "kernel", F.col("params")["kernel"])
    return top_k(cv, ["symbol", "representation", "kernel"],
                 [F.desc("value"), F.asc("grid_index")], 1).drop("rank")


def series_max(res: DataFrame) -> DataFrame:
    """The best value of each (symbol, representation, model)."""
    return res.groupBy("symbol", "representation", "model").agg(F.max("value").alias("value"))


def svm_summary(res: DataFrame) -> DataFrame:
    """A3: best CV score per (symbol, kernel), averaged."""
    best = best_points(res)
    return (best.groupBy("symbol", "representation")
            .agg(F.avg("value").alias("accuracy"),
                 F.max(F.when(F.col("kernel") == "poly", F.col("value"))).alias("poly_cv"),
                 F.max(F.when(F.col("kernel") == "rbf", F.col("value"))).alias("rbf_cv")))


def rf_top3(res: DataFrame) -> DataFrame:
    """Per series the top three (accuracy, ntrees) pairs, larger ntrees first on ties."""
    r = res.where("model = 'rf' AND metric = 'test_accuracy'").withColumn(
        "ntrees", F.col("params")["ntrees"].cast("int"))
    return top3_value_then_larger(r, ["symbol", "representation"], "value", "ntrees")


def rf_cv_selected(res: DataFrame, selection: str = "best_k") -> DataFrame:
    """G7 (first three grid points, as coded) or the best three by CV score."""
    r = res.where("model = 'rf_cv' AND metric = 'cv_accuracy'")
    if selection == "first_k":
        return first_k(r, 3)
    return top_k(r, ["symbol", "representation"], [F.desc("value"), F.asc("grid_index")], 3)


def mlp_top3(res: DataFrame) -> DataFrame:
    """Top three grid points per series, earlier point first on ties."""
    r = res.where("model = 'mlp' AND metric = 'test_accuracy'")
    return top3_value_then_earlier(r, ["symbol", "representation"], "value")


def params_text(c: F.Column) -> F.Column:
    """A parameter map as sorted ``k=v`` text (NULL values left out)."""
    entries = F.filter(F.map_entries(c), lambda e: e["value"].isNotNull())
    return F.array_join(F.array_sort(F.transform(
        entries, lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")


def _joined(df: DataFrame, order: str) -> F.Column:
    """The rows' parameter texts in rank order, separated by ``;``."""
    return F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order), params_text(F.col("params")).alias("p")))),
        lambda e: e["p"]), "; ")


def per_series(res: DataFrame, selection: str = "best_k") -> DataFrame:
    """One accuracy per (symbol, representation, model) under each model's rule,
    with the parameters that produced it (best points, or the three kept)."""
    keys = ["symbol", "representation"]
    best = best_points(res)
    svm_s = (best.groupBy(*keys)
             .agg(F.avg("value").alias("accuracy"), _joined(best, "kernel").alias("best_params"))
             .select(*keys, F.lit("svm").alias("model"), "accuracy", "best_params"))
    top = rf_top3(res)
    rf = (top.groupBy(*keys).agg(F.avg("value").alias("accuracy"),
                                 _joined(top, "rank").alias("best_params"))
          .select(*keys, F.lit("rf").alias("model"), "accuracy", "best_params"))
    sel = rf_cv_selected(res, selection).withColumn("_o", F.col("grid_index"))
    rfc = (sel.groupBy(*keys).agg(F.max("value").alias("accuracy"),
                                  _joined(sel, "_o").alias("best_params"))
           .select(*keys, F.lit("rf_cv").alias("model"), "accuracy", "best_params"))
    nb = (res.where("model = 'nb' AND metric = 'test_accuracy'")
          .select(*keys, F.lit("nb").alias("model"), F.col("value").alias("accuracy"),
                  F.lit("").alias("best_params")))
    m1 = top_k(res.where("model = 'mlp' AND metric = 'test_accuracy'"), keys,
               [F.desc("value"), F.asc("grid_index")], 1)
    ml = m1.select(*keys, F.lit("mlp").alias("model"), F.col("value").alias("accuracy"),
                   params_text(F.col("params")).alias("best_params"))
    return svm_s.unionByName(rf).unionByName(rfc).unionByName(nb).unionByName(ml)


def overall(res: DataFrame, selection: str = "best_k") -> DataFrame:
    """Mean over series per (representation, model)."""
    return (per_series(res, selection).drop("best_params").groupBy("representation", "model")
            .agg(F.avg("accuracy").alias("accuracy"), F.count(F.lit(1)).alias("n_series")))


def comparison(res: DataFrame, selection: str = "best_k") -> DataFrame:
    """One row per model, one column per representation (the chart's data).

    The study's random-forest bar is the test-split sweep on the continuous
    data and the cross-validated stumps on the trend data; both land in "rf".
    """
    o = overall(res, selection).withColumn(
        "model", F.when(F.col("model") == "rf_cv", F.lit("rf")).otherwise(F.col("model")))
    return (o.groupBy("model").pivot("representation", ["continuous", "trend"])
            .agg(F.first("accuracy")))


def run_all(panel: DataFrame, cfg: GridConfig = REFERENCE_GRIDS,
            representations=("continuous", "trend")) -> DataFrame:
    """Every family on every representation, as one results table."""
    panel = cut_lineage(panel, "panel")
    return reduce(DataFrame.unionByName, [family_results(panel, f, rep, cfg) for rep in representations for f in families(rep)])


def families(rep: str) -> list[str]:
    """The study sweeps forests on the test split for continuous data and
    cross-validates depth-1 forests for trend data."""
    return ["svm", "rf" if rep == "continuous" else "rf_cv", "nb", "mlp"]


def family_results(panel: DataFrame, family: str, rep: str, cfg: GridConfig = REFERENCE_GRIDS) -> DataFrame:
    return rf_results(panel, rep, cfg) if family == "rf" else fitted(panel, family, rep, cfg).results
