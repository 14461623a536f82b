"""Feature preparation pipelines, one per model family of the study.

  family  impute   scale               split   selection
  svm     all      z, fit on train     80/20   5-fold CV on train
  rf      all      none                80/20   sweep, test accuracy
  rf_cv   all      none                70/30   5-fold CV on train (stumps)
  nb      all      z, fit on all       80/20   test accuracy
  mlp     all      z, fit on all       70/30   grid, test accuracy

That is the protocol "study". The protocol "balanced" scales every family's features onto
[-1, 1] (F4) and takes tuning and evaluation sets of equal classes (F7): models are fitted
and chosen on the first 20 % of the smaller class and as many of the other one, and tested
on the rest. Rows beyond the smaller class are in neither set; they count for the scaling.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pricetrend.operators.labels import horizon_label
from pricetrend.operators.features import (feature_set, impute_and_minmax, impute_and_scale, impute_mean,
                                           minmax_scaling, scaling)
from pricetrend.operators.split import balanced_split, holdout_split, stratified_folds
from pricetrend.session import cut_lineage


@dataclass(frozen=True)
class PrepSpec:
    test_size: float
    scale: str | None        # None | "all" | "train" | "minmax"
    folds: int = 0
    tune: float | None = None  # balanced sets: the share that tunes (``test_size`` is not used)


PREP = {
    "svm": PrepSpec(0.2, "train", 5),
    "rf": PrepSpec(0.2, None, 0),
    "rf_cv": PrepSpec(0.3, None, 5),
    "nb": PrepSpec(0.2, "all", 0),
    "mlp": PrepSpec(0.3, "all", 0),
}

PROTOCOLS = {
    "study": PREP,
    "balanced": {f: PrepSpec(1 - 0.2, "minmax", spec.folds, 0.2) for f, spec in PREP.items()},
}

# Representation -> default feature set.
REPRESENTATIONS = {"continuous": "continuous", "trend": "trend_only"}


def raw_features(panel: DataFrame, representation: str, feature_set_name: str | None = None,
                 horizon: int = 0) -> tuple[DataFrame, list[str]]:
    """(symbol, bar_no, movement, features...) as they are in the panel."""
    cols = feature_set(panel, feature_set_name or REPRESENTATIONS[representation])
    if horizon:
        panel = (horizon_label(panel, horizon, "_next")
                 .withColumn("movement", F.col("_next")).drop("_next"))
    return panel.select("symbol", "bar_no", F.col("movement").cast("int").alias("movement"),
                        *[F.col(c).cast("double").alias(c) for c in cols]), cols


def split_rows(base: DataFrame, spec: PrepSpec, seed: int = 42) -> DataFrame:
    """``base`` with is_train and is_test; of balanced sets the rows that are in either."""
    if spec.tune is None:
        return holdout_split(base, spec.test_size, seed)
    roles = balanced_split(base, spec.tune, seed=seed).where("role <> 'surplus'")
    return roles.withColumns({"is_train": F.col("role") == "tune", "is_test": F.col("role") == "eval"}).drop("role")


def scaling_of(panel: DataFrame, family: str, representation: str, feature_set_name: str | None = None,
               seed: int = 42, horizon: int = 0, protocol: str = "study") -> DataFrame:
    """What ``prepare`` does to the raw features, as arrays in their order: symbol, fill, center, scale.

    A value is ``(coalesce(x, fill) - center) / scale``, 0 where the scale is 0.
    """
    spec = PROTOCOLS[protocol][family]
    base, cols = raw_features(panel, representation, feature_set_name, horizon)
    if spec.scale == "train":
        stats = scaling(holdout_split(base, spec.test_size, seed), cols, "is_train")
    elif spec.scale == "minmax":
        stats = minmax_scaling(base, cols)
    else:
        stats = scaling(base, cols)
    arrays = {n: F.array(*[F.col(f"_{k}_{c}") for c in cols]) for n, k in (("fill", "m"), ("center", "c"), ("scale", "s"))}
    if spec.scale is None:
        arrays |= {"center": F.array_repeat(F.lit(0.0), len(cols)), "scale": F.array_repeat(F.lit(1.0), len(cols))}
    return stats.select("symbol", *[v.alias(n) for n, v in arrays.items()])


def prepare(panel: DataFrame, family: str, representation: str,
            feature_set_name: str | None = None, seed: int = 42,
            horizon: int = 0, protocol: str = "study") -> tuple[DataFrame, list[str]]:
    """Panel -> (symbol, bar_no, movement, is_train, is_test, [fold], features...).

    ``horizon`` 0 keeps the study's label (bar t's own move, seen by bar t's
    features); ``horizon`` h > 0 labels bar t with the move of bar t + h, and
    the last h bars of each series, which have no such move, are left out.
    """
    spec = PROTOCOLS[protocol][family]
    base, cols = raw_features(panel, representation, feature_set_name, horizon)
    if spec.scale == "all":
        x = split_rows(impute_and_scale(base, cols), spec, seed)
    elif spec.scale == "minmax":
        x = split_rows(impute_and_minmax(base, cols), spec, seed)
    elif spec.scale == "train":
        # one pass of statistics over all rows (imputing) and the training rows (scaling)
        split = cut_lineage(split_rows(base, spec, seed), f"split-{family}-{representation}")
        x = impute_and_scale(split, cols, fit_on="is_train")
    else:
        x = split_rows(impute_mean(base, cols), spec, seed)
    if spec.folds:
        # fold ranks read the split frame twice (training rows, join back)
        x = stratified_folds(cut_lineage(x, f"split-{family}-{representation}"), spec.folds)
    return x, cols
