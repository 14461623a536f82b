"""M5, G1: forests of depth-1 trees on trend signals as grouped sums.

Signals are -1, 0 or +1, so a stump has two cuts per feature (at -0.5 and 0.5) and
all it needs are sums of bootstrap weights. A row's weight in a tree is Poisson(1),
read off an md5 of series, bar and tree by a threshold table: rows need no order
and no resampling. One grouped aggregate over (symbol, fold, tree) gives the sums of
every series, fold and tree; the trees that leave a fold out come from the total
less the fold's own sums. A tree looks at the first ``floor(sqrt(features))`` features, in the
order of another md5, that can be cut at all, and takes the cut of the lowest Gini impurity (ties: the earlier
feature, then the lower cut). A leaf votes its share of class 1 in units of 1e-9,
so vote sums are exact whatever their order; k trees say 1 iff the first k votes sum to over k / 2.

Fitted trees are a row per series, joined as in ``operators.keyed``; votes are expressions.
The same in SQL: ``stump_ctes``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricetrend.operators.keyed import join_series
from pricetrend.session import cut_lineage

CUTS = (-0.5, 0.5)
UNIT = 10 ** 9
SHARE = 8           # trees that share an md5, four hex digits each
ALL = -1            # "fold" of the trees that leave nothing out


def poisson_thresholds() -> list[int]:
    """Least of 65,536 draws for each weight from 1 on: 65536 * P(Poisson(1) < weight), rounded up."""
    out, below, k = [], 0.0, 0
    while True:
        below += math.exp(-1) / math.factorial(k)
        k += 1
        if math.ceil(65536 * below) > 65535:
            return out
        out.append(math.ceil(65536 * below))


def subset_size(cols: list[str]) -> int:
    return max(1, math.isqrt(len(cols)))


def stump_sums(train: DataFrame, cols: list[str], n_trees: int, seed: int = 42) -> DataFrame:
    """Per (symbol, fold, tree): n and p (weights, weights of class 1) of all rows and, for each feature
    i and cut j, n_i_j and p_i_j of the rows on its low side."""
    blocks = F.explode(F.sequence(F.lit(0), F.lit(-(-n_trees // SHARE) - 1))).alias("_block")
    keyed = train.select("symbol", "bar_no", "fold", F.col("movement").cast("long").alias("_y"), *cols, blocks)
    digest = F.md5(F.concat_ws("|", F.coalesce("symbol", F.lit("")), F.col("bar_no").cast("string"), F.col("_block").cast("string"), F.lit(str(seed))))
    draws = F.transform(F.sequence(F.lit(0), F.lit(SHARE - 1)), lambda j: F.struct(
        (F.col("_block") * SHARE + j).alias("tree"), F.conv(F.substring(F.col("_digest"), 4 * j + 1, F.lit(4)), 16, 10).cast("int").alias("u")))
    each = keyed.withColumn("_digest", digest).select("symbol", "fold", "_y", *cols, F.explode(draws).alias("_d"))
    weight = sum((F.when(F.col("_d.u") >= t, 1).otherwise(0) for t in poisson_thresholds()), F.lit(0)).cast("long")
    rows = each.where(F.col("_d.tree") < n_trees).withColumn("_w", weight).where("_w > 0")
    sums = [F.sum("_w").alias("n"), F.sum(F.col("_w") * F.col("_y")).alias("p")]
    for i, c in enumerate(cols):
        for j, cut in enumerate(CUTS):
            low = F.col(f"`{c}`") <= cut
            sums += [F.sum(F.when(low, F.col("_w")).otherwise(0)).alias(f"n_{i}_{j}"),
                     F.sum(F.when(low, F.col("_w") * F.col("_y")).otherwise(0)).alias(f"p_{i}_{j}")]
    return rows.groupBy("symbol", "fold", F.col("_d.tree").alias("tree")).agg(*sums)


def _vote(p: Column, n: Column) -> Column:
    """The share of class 1 in units, 0 of nothing."""
    return F.when(n > 0, F.floor(p.cast("double") / n.cast("double") * UNIT + 0.5)).otherwise(0).cast("long")


def stumps_fit(prep: DataFrame, cols: list[str], n_trees: int = 200, seed: int = 42) -> DataFrame:
    """(symbol, fold, tree, feature, cut, low, high): the trees that were grown without a fold's rows, and
    with fold ALL those of all training rows. ``prep`` has movement, is_train, fold and the signals."""
    own = cut_lineage(stump_sums(prep.where("is_train"), cols, n_trees, seed), "stump-sums")
    names = [c for c in own.columns if c not in ("symbol", "fold", "tree")]
    total = own.groupBy("symbol", "tree").agg(*[F.sum(c).alias(c) for c in names])
    per_tree = Window.partitionBy("symbol", "tree")     # a row per fold
    without = own.select("symbol", "fold", "tree", *[(F.sum(c).over(per_tree) - F.col(c)).alias(c) for c in names])
    sums = without.unionByName(total.withColumn("fold", F.lit(ALL)))

    def side(i: int, j: int) -> list[Column]:
        n, p = F.col(f"n_{i}_{j}"), F.col(f"p_{i}_{j}")
        return [n, p, F.col("n") - n, F.col("p") - p]

    def purity(n: Column, p: Column) -> Column:
        a, b, m = p.cast("double"), (n - p).cast("double"), n.cast("double")
        return (a * a + b * b) / m

    features = []
    for i, c in enumerate(cols):
        cuts = []
        for j in range(len(CUTS)):
            nl, pl, nr, pr = side(i, j)
            cuts.append(F.when((nl > 0) & (nr > 0), F.struct(
                (purity(nl, pl) + purity(nr, pr)).alias("score"), F.lit(-i).alias("f"), F.lit(-j).alias("c"),
                _vote(pl, nl).alias("low"), _vote(pr, nr).alias("high"))))
        key = F.md5(F.concat_ws("|", F.coalesce("symbol", F.lit("")), F.col("tree").cast("string"), F.lit(c), F.lit(str(seed))))
        features.append(F.struct(key.alias("key"), F.filter(F.array(*cuts), lambda x: x.isNotNull()).alias("cuts")))
    able = F.array_sort(F.filter(F.array(*features), lambda x: F.size(x["cuts"]) > 0))
    best = F.array_max(F.flatten(F.transform(F.slice(able, 1, subset_size(cols)), lambda x: x["cuts"])))
    leaf = _vote(F.col("p"), F.col("n"))
    return (sums.withColumn("b", best).select(
        "symbol", "fold", "tree", F.coalesce(-F.col("b.f"), F.lit(0)).alias("feature"),
        F.element_at(F.array(*map(F.lit, CUTS)), F.coalesce(-F.col("b.c"), F.lit(0)) + 1).alias("cut"),
        F.coalesce("b.low", leaf).alias("low"), F.coalesce("b.high", leaf).alias("high")))


def per_series(trees: DataFrame) -> DataFrame:
    """A row per symbol: ``trees``, a map from fold to its trees in order."""
    # at most all trees of one series: folds x trees small structs
    lists = trees.groupBy("symbol", "fold").agg(F.array_sort(F.collect_list(F.struct("tree", "feature", "cut", "low", "high"))).alias("t"))
    return lists.groupBy("symbol").agg(F.map_from_entries(F.collect_list(F.struct("fold", "t"))).alias("trees"))


def with_votes(rows: DataFrame, trees: DataFrame, cols: list[str], fold: Column) -> DataFrame:
    """``rows`` with ``votes``: what each tree of the row's fold says, in units."""
    x = F.array(*[F.col(c) for c in cols])
    joined = join_series(rows, per_series(trees))
    votes = F.transform(F.try_element_at("trees", fold), lambda t: F.when(F.element_at(x, t["feature"] + 1) <= t["cut"], t["low"]).otherwise(t["high"]))
    return joined.withColumn("votes", votes).drop("trees")


def says_up(votes: str, k: int) -> Column:
    """Whether the first k trees say class 1."""
    total = F.aggregate(F.slice(votes, 1, k), F.lit(0).cast("long"), lambda a, v: a + v)
    return (2 * total > k * UNIT).cast("int")


def stumps_cv(prep: DataFrame, cols: list[str], counts: list[int], seed: int = 42) -> DataFrame:
    """Mean accuracy over the folds per (symbol, ntrees)."""
    trees = cut_lineage(stumps_fit(prep, cols, max(counts), seed), "stumps")
    return stumps_accuracy(prep, cols, counts, trees)


def stumps_accuracy(prep: DataFrame, cols: list[str], counts: list[int], trees: DataFrame) -> DataFrame:
    train = prep.where("is_train").select("symbol", "bar_no", "fold", "movement", *cols)
    scored = with_votes(train, trees, cols, F.col("fold"))
    right = [F.avg((says_up("votes", k) == F.col("movement")).cast("double")).alias(f"_{k}") for k in counts]
    folds = scored.groupBy("symbol", "fold").agg(*right)
    wide = folds.groupBy("symbol").agg(*[F.avg(f"_{k}").alias(f"_{k}") for k in counts])
    # Rounded, so that ties between tree counts are ties in any order of the sums.
    points = F.explode(F.array(*[F.struct(F.lit(k).alias("ntrees"), (F.round(F.col(f"_{k}") * 1e9) / 1e9).alias("cv_accuracy")) for k in counts])).alias("p")
    return wide.select("symbol", points).select("symbol", "p.ntrees", F.lit(1).alias("max_depth"), "p.cv_accuracy")


def stump_ctes(cols: list[str], counts: list[int], seed: int = 42) -> str:
    """DuckDB: CTE ``stump_cv`` (symbol, ntrees, cv_accuracy) after ``prep`` (with fold)."""
    n_trees, d = max(counts), lambda x: f"CAST({x} AS DOUBLE)"
    weight = " + ".join(f"CAST(u >= {t} AS BIGINT)" for t in poisson_thresholds())
    cells = [(i, j, c, cut) for i, c in enumerate(cols) for j, cut in enumerate(CUTS)]
    sums = ", ".join(f"sum(CASE WHEN {c} <= {cut} THEN w ELSE 0 END) AS n_{i}_{j}, sum(CASE WHEN {c} <= {cut} THEN w * movement ELSE 0 END) AS p_{i}_{j}"
                     for i, j, c, cut in cells)
    names = ["n", "p"] + [f"{x}_{i}_{j}" for i, j, _, _ in cells for x in "np"]
    left = ", ".join(f"CAST(sum({c}) OVER (PARTITION BY symbol, tree) - {c} AS BIGINT) AS {c}" for c in names)
    options = ", ".join(f"{{'f': {i}, 'c': {j}, 'cut': {cut}, 'name': '{c}', 'nl': n_{i}_{j}, 'pl': p_{i}_{j}}}" for i, j, c, cut in cells)
    purity = lambda n, p: f"({d(p)} * {d(p)} + {d(f'({n} - {p})')} * {d(f'({n} - {p})')}) / {d(n)}"
    vote = lambda p, n: f"CAST(floor({d(p)} / {d(n)} * {float(UNIT)}::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
    votes = ", ".join(f"sum(CASE WHEN tree < {k} THEN vote ELSE 0 END) * 2 > {k * UNIT} AS up_{k}" for k in counts)
    points = " UNION ALL ".join(f"SELECT symbol, fold, {k} AS ntrees, avg(CAST(CAST(up_{k} AS INTEGER) = movement AS DOUBLE)) AS acc FROM said GROUP BY ALL" for k in counts)
    return f"""drawn AS (SELECT p.*, tree, CAST('0x' || substr(md5(symbol || '|' || bar_no || '|' || (tree // {SHARE}) || '|{seed}'), 4 * (tree % {SHARE}) + 1, 4) AS INTEGER) AS u
  FROM prep p, range({n_trees}) AS r(tree) WHERE is_train),
weighed AS (SELECT *, {weight} AS w FROM drawn),
own AS MATERIALIZED (SELECT symbol, fold, tree, sum(w) AS n, sum(w * movement) AS p, {sums} FROM weighed WHERE w > 0 GROUP BY symbol, fold, tree),
grown AS (SELECT symbol, fold, tree, {left} FROM own),
options AS (SELECT symbol, fold, tree, n, p, unnest([{options}], recursive := true) FROM grown),
able AS (SELECT *, n - nl AS nr, p - pl AS pr, md5(symbol || '|' || tree || '|' || name || '|{seed}') AS key FROM options WHERE nl > 0 AND n - nl > 0),
looked AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY symbol, fold, tree ORDER BY key) AS place FROM able) WHERE place <= {subset_size(cols)}),
chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, fold, tree ORDER BY {purity('nl', 'pl')} + {purity('nr', 'pr')} DESC, f, c) AS r
  FROM looked) WHERE r = 1),
trees AS MATERIALIZED (SELECT g.symbol, g.fold, g.tree, f, cut, CASE WHEN f IS NULL THEN CASE WHEN g.n > 0 THEN {vote('g.p', 'g.n')} ELSE 0 END ELSE {vote('pl', 'nl')} END AS low,
  CASE WHEN f IS NULL THEN CASE WHEN g.n > 0 THEN {vote('g.p', 'g.n')} ELSE 0 END ELSE {vote('pr', 'nr')} END AS high
  FROM grown g LEFT JOIN chosen USING (symbol, fold, tree)),
said AS MATERIALIZED (SELECT symbol, fold, bar_no, movement, {votes} FROM
  (SELECT p.symbol, p.fold, p.bar_no, p.movement, t.tree, CASE WHEN ([{', '.join(cols)}])[coalesce(f, 0) + 1] <= coalesce(cut, 0) THEN low ELSE high END AS vote
   FROM prep p JOIN trees t ON p.symbol = t.symbol AND p.fold = t.fold WHERE p.is_train) GROUP BY ALL),
stump_cv AS (SELECT symbol, ntrees, round(avg(acc) * 1e9::DOUBLE) / 1e9::DOUBLE AS cv_accuracy FROM ({points}) GROUP BY ALL)"""
