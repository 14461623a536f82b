"""The fitted models as a table, and predictions from it.

A row is one fitted model of one series: representation, model family, ``member``
(the kernel of an SVM, the rank of a forest), grid point, the score it was chosen
by, the raw features it reads with what fills, centres and scales them, and its
weights as one array of numbers. The table can be written, read again and
joined to new bars; nothing else is needed to apply a model.

``predict`` deals the bars into shards like training does, sends each shard the
models of its series, and scores all of them on the shard's rows in one task.

Layout of ``weights`` by family:

  svm     the mapped features' weights and the intercept; kernel, degree, gamma and width are parameters
  mlp     hidden weights, hidden biases, output weights, output bias
  nb      log prior of class 0 and 1, then means and variances of class 0, then of class 1 (NaN: none)
  rf      per tree its number of nodes, then per node feature (-1: leaf), threshold, left, right, share of class 1
  rf_cv   per stump feature, cut, vote below, vote above (shares of class 1 in units of 1e-9)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pricetrend.models.mlp import probability
from pricetrend.models.shards import PER_SHARD, deal, every_shard
from pricetrend.models.stumps import UNIT
from pricetrend.models.svm import FeatureMap, SvmParams

KEY = ["symbol", "representation", "model", "member"]
STORE = ("symbol string, representation string, model string, member string, grid_index int, params map<string,string>, score double, "
         "features array<string>, fill array<double>, center array<double>, scale array<double>, weights array<double>")


def entries(models: DataFrame, scaling: DataFrame, representation: str, model: str, features: list[str], member: Column,
            grid_index: Column, params: Column, score: Column, weights: Column) -> DataFrame:
    """Store rows of the chosen models of one family; ``scaling`` has symbol, fill, center, scale."""
    stats = scaling.withColumnRenamed("symbol", "_its")
    rows = models.join(stats, F.col("symbol").eqNullSafe(F.col("_its")))      # a row per series and chosen model on both sides
    return rows.select("symbol", F.lit(representation).alias("representation"), F.lit(model).alias("model"), member.cast("string").alias("member"),
                       grid_index.cast("int").alias("grid_index"), params.alias("params"), score.cast("double").alias("score"),
                       F.array(*map(F.lit, features)).alias("features"), "fill", "center", "scale", weights.cast("array<double>").alias("weights"))


def tree_weights(nodes: Column) -> Column:
    """Trees (arrays of nodes by id) as numbers."""
    flat = lambda t: F.flatten(F.transform(t, lambda n: F.array(
        n["feature"].cast("double"), n["threshold"], n["left"].cast("double"), n["right"].cast("double"), n["p"])))
    return F.flatten(F.transform(nodes, lambda t: F.concat(F.array(F.size(t).cast("double")), flat(t))))


def stump_weights(trees: Column) -> Column:
    return F.flatten(F.transform(trees, lambda t: F.array(t["feature"].cast("double"), t["cut"], t["low"].cast("double"), t["high"].cast("double"))))


def scaled(x: np.ndarray, fill: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Raw features as the model was given them."""
    x = np.where(np.isnan(x), fill, x) - center
    return np.where(scale > 0, x / np.where(scale > 0, scale, 1.0), 0.0)


def forest_share(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Mean share of class 1 over the trees."""
    total, n, at = np.zeros(len(x)), 0, 0
    while at < len(w):
        size = int(w[at])
        feature, threshold, left, right, p = w[at + 1:at + 1 + 5 * size].reshape(size, 5).T
        feature, left, right = feature.astype(np.int64), left.astype(np.int64), right.astype(np.int64)
        node = np.zeros(len(x), np.int64)
        while (inner := feature[node] >= 0).any():
            go = np.flatnonzero(inner)
            here = node[go]
            node[go] = np.where(x[go, feature[here]] <= threshold[here], left[here], right[here])
        total += p[node]
        n, at = n + 1, at + 1 + 5 * size
    return total / max(1, n)


def bayes_odds(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of class 1 and class; without a likelihood of either class the prior decides."""
    d = x.shape[1]
    prior, stats = w[:2], w[2:].reshape(2, 2, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        jll = [prior[k] - 0.5 * np.log(2 * np.pi * stats[k, 1]).sum() - 0.5 * ((x - stats[k, 0]) ** 2 / stats[k, 1]).sum(1) for k in (0, 1)]
    none = [~np.isfinite(j) for j in jll]
    by_prior = np.nan_to_num(prior[1], nan=-np.inf) > np.nan_to_num(prior[0], nan=-np.inf)
    says = np.where(none[0] & none[1], by_prior, np.where(none[0], True, np.where(none[1], False, jll[1] > jll[0])))
    gap = np.clip(np.nan_to_num(jll[0] - jll[1]), -700, 700)
    return np.where(none[0] | none[1], says, 1 / (1 + np.exp(gap))), says


def scores(x: np.ndarray, model: str, params: dict[str, str], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score (margin of an SVM, else the share or probability of class 1) and class of every row."""
    if model == "svm":
        kernel = params["kernel"]
        value = int(params["degree"]) if kernel == "poly" else float(params["gamma"])
        width = int(params["n_components"]) if params.get("n_components") else None
        settings = {"seed": int(params["seed"])}
        if width:
            settings |= {"sketch_width": width, "max_monomials": 0} if kernel == "poly" else {"n_components": width}
        phi = FeatureMap(x.shape[1], (kernel, value), SvmParams(**settings))
        out = np.concatenate([phi(x[i:i + 1024]) @ w for i in range(0, len(x), 1024)]) if len(x) else np.zeros(0)
        return out, out > 0
    if model == "mlp":
        out = probability(x, w, int(params["n_neurons"]))
    elif model == "rf":
        out = forest_share(x, w)
    elif model == "rf_cv":
        out = np.zeros(len(x))
        for feature, cut, low, high in w.reshape(-1, 4):
            out += np.where(x[:, int(feature)] <= cut, low, high)
        whole = max(1, len(w) // 4) * UNIT
        return out / whole, 2 * out > whole
    else:
        return bayes_odds(x, w)
    return out, out > 0.5


PREDICTIONS = "symbol string, bar_no long, representation string, model string, member string, grid_index int, score double, prediction int"


def predict(bars: DataFrame, store: DataFrame, per_shard: int = PER_SHARD) -> DataFrame:
    """A row per bar and stored model of its series. ``bars`` has symbol, bar_no and the raw features by name
    (extra columns are ignored); bars of series without a model give no row."""
    names = [c for c in bars.columns if c not in ("symbol", "bar_no")]
    dealt = deal(bars.select("symbol", F.col("bar_no").cast("long").alias("bar_no"), *[F.col(f"`{c}`").cast("double").alias(c) for c in names]), per_shard)
    of = dealt.select(F.col("symbol").alias("_its"), F.col("shards").alias("_shards")).distinct()
    joined = store.join(of, F.col("symbol").eqNullSafe(F.col("_its")))
    sent = every_shard(joined.withColumn("shards", F.col("_shards") + 0).drop("_its", "_shards"))

    def score(g: pa.Table, s: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.split()[0]: [] for f in PREDICTIONS.split(", ")}
        if g.num_rows and s.num_rows:
            for r in s.to_pylist():
                raw = np.stack([g.column(c).to_numpy().astype(np.float64) for c in r["features"]], axis=1)
                fill, center, scale = (np.array(r[c], float) for c in ("fill", "center", "scale"))
                value, says = scores(scaled(raw, fill, center, scale), r["model"], dict(r["params"] or []), np.array(r["weights"], float))
                n = g.num_rows
                for c, v in (("symbol", [r["symbol"]] * n), ("bar_no", g.column("bar_no").to_pylist()), ("score", value.tolist()), ("prediction", says.astype(int).tolist()),
                             *((c, [r[c]] * n) for c in ("representation", "model", "member", "grid_index"))):
                    out[c] += v
        types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
        return pa.table({f.split()[0]: pa.array(out[f.split()[0]], types[f.split()[1]]) for f in PREDICTIONS.split(", ")})

    return dealt.groupBy("symbol", "shard").cogroup(sent.groupBy("symbol", "shard")).applyInArrow(score, PREDICTIONS)
