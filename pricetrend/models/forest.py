"""M4: random forests and the tree-count sweep (G4). Stumps on trend signals: ``stumps``.

A forest of k trees is the first k trees of a larger forest: the trees are
independent draws, and a seeded generator that hands out per-tree seeds in
order (the study's setting) makes the k-tree forest exactly that prefix.
Each (symbol[, fold]) therefore grows the largest forest once, as
independently seeded blocks of ``block`` trees fitted side by side, and every
swept count k is scored from the first k / block blocks. A Spark forest's
``rawPrediction`` is the sum of its trees' class probabilities, so summing
block raws gives each prefix's soft vote: class 1 iff the class-1 sum exceeds
k/2 (ties go to class 0).

A level of trees is a job in which every partition sends statistics of every node, so
a fit's shuffle grows with nodes times partitions: a longer series is read from its own files
and dealt by bar into as few partitions as its rows need (``_of_series``). Each row's node is kept from
level to level; without that every level walks all trees again from their roots, which Spark
sends along with each of its jobs. The trees are the same either way.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricetrend.models.common import assemble, run_parallel
from pricetrend.session import scratch_path

# The study's tree counts, 10 to 200 in steps of 10.
TREE_COUNTS = list(range(10, 201, 10))
# Deepest tree Spark grows; stands in for unlimited depth.
MAX_DEPTH_UNLIMITED = 30
# Split points considered per feature; Spark bins continuous features.
MAX_BINS = 64
# Rows from which a series is dealt anew, and the rows of a partition then.
LONG_SERIES = 8_192
PER_PARTITION = 262_144


def block_size(counts: list[int]) -> int:
    return reduce(math.gcd, counts)


def prefix_accuracy(votes: DataFrame, block: int, counts: list[int], keys: list[str]) -> DataFrame:
    """(keys..., ntrees, correct, n) for every prefix size in ``counts`` from the class-1 votes
    of every block on every row (see ``_votes``)."""
    rows = votes.groupBy(*keys, "_row", "_y").agg(F.array_sort(F.collect_list(F.struct("block", "vote"))).alias("_b"))     # one row's blocks
    rows = rows.select(*keys, "_y", F.transform("_b", lambda b: b["vote"]).alias("_v"))
    stack = F.explode(F.array(*[
        F.struct(F.lit(k).alias("ntrees"),
                 F.aggregate(F.slice("_v", 1, k // block), F.lit(0.0), lambda a, x: a + x)
                 .alias("votes")) for k in sorted(counts)]))
    return (rows.select(*keys, "_y", stack.alias("_s"))
            .select(*keys, F.col("_s.ntrees").alias("ntrees"),
                    ((F.lit(2.0) * F.col("_s.votes") > F.col("_s.ntrees").cast("double"))
                     .cast("int") == F.col("_y")).cast("int").alias("ok"))
            .groupBy(*keys, "ntrees")
            .agg(F.sum("ok").alias("correct"), F.count(F.lit(1)).alias("n")))


def _votes(model, rows: DataFrame) -> DataFrame:
    """What a block's trees say of every row: the sum of their shares of class 1."""
    model.setRawPredictionCol("_raw").setProbabilityCol("").setPredictionCol("")
    return model.transform(rows).select("symbol", "_row", F.col("movement").cast("int").alias("_y"), vector_to_array("_raw")[1].alias("vote"))


def _forest(n_trees: int, max_depth: int, seed: int) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth,
                                  maxBins=MAX_BINS, featureSubsetStrategy="sqrt", seed=seed,
                                  cacheNodeIds=True, checkpointInterval=-1,
                                  labelCol="label", featuresCol="features")


def _labelled(df: DataFrame, cols: list[str]) -> DataFrame:
    return assemble(df, cols).withColumn("label", F.col("movement").cast("double"))


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("_row", F.monotonically_increasing_id()).persist()


def _of_series(prep: DataFrame, cols: list[str], symbol: str, rows: int) -> DataFrame:
    """The labelled rows of one series, kept in memory for its fits.

    Spark seeds the bootstrap of a partition by its number. Short series therefore stay in the partitions
    they are read in; those of a long one depend on its bars only. It never gets more than the cores,
    or its shuffles would grow with the square of its length.
    """
    mine = F.col("symbol") == symbol
    if rows < LONG_SERIES:
        return _numbered(_labelled(prep, cols).where(mine))
    n = min(math.ceil(rows / PER_PARTITION), max(1, prep.sparkSession.sparkContext.defaultParallelism))
    # before ``assemble``, which no filter is pushed below
    dealt = prep.where(mine).repartition(n, "bar_no").sortWithinPartitions("bar_no", "is_train", "movement", *cols)
    return _numbered(_labelled(dealt, cols))


def rf_sweep(prep: DataFrame, cols: list[str], counts: list[int] = TREE_COUNTS,
             max_depth: int = MAX_DEPTH_UNLIMITED, seed: int = 42,
             parallelism: int | None = None, keep: str | None = None) -> DataFrame:
    """M4 + G4: test accuracy per (symbol, ntrees), trained on the training rows.

    ``max_depth`` and ``max_bins`` are reported: Spark's trees are at most 30 deep and
    choose among that many binned split points. With ``keep``, a folder on shared storage, the
    fitted blocks are saved there (see ``saved_trees``).

    Every (series, block) is fitted, scored and saved side by side and then let go; what it says of the
    test rows goes to a table, from which all prefixes are counted in one job. Small fits are
    latency-bound (a few short jobs each), so more of them run concurrently than there are cores.
    """
    spark = prep.sparkSession
    sizes = {r["symbol"]: r["n"] for r in prep.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).collect() if r["symbol"] is not None}
    names, block = sorted(sizes), block_size(counts)
    per = [_of_series(prep, cols, s, sizes[s]) for s in names]
    voted = scratch_path(spark, "forest-votes")

    def fit(i: int, b: int) -> None:
        model = _forest(block, max_depth, seed + b).fit(per[i].where("is_train"))
        if keep:
            model.write().save(f"{keep}/series={i}/block={b}")
        _votes(model, per[i].where("is_test")).write.parquet(f"{voted}/series={i}/block={b}")

    try:
        run_parallel([lambda i=i, b=b: fit(i, b) for i in range(len(names)) for b in range(max(counts) // block)],
                     parallelism or max(16, 2 * spark.sparkContext.defaultParallelism))
    finally:
        for d in per:
            d.unpersist()
    if keep:
        spark.createDataFrame(list(enumerate(names)), "series int, symbol string").write.parquet(f"{keep}/names")
    schema = "symbol string, _row long, _y int, vote double, block int"
    votes = spark.read.schema(schema).parquet(voted) if names else spark.createDataFrame([], schema)
    out = prefix_accuracy(votes, block, counts, ["symbol"])
    return out.select("symbol", "ntrees", F.lit(max_depth).alias("max_depth"), F.lit(MAX_BINS).alias("max_bins"),
                      (F.col("correct") / F.col("n")).alias("accuracy"))


def saved_trees(spark: SparkSession, keep: str) -> DataFrame:
    """(symbol, tree, nodes) of the forests that ``rf_sweep`` saved: a node is feature, threshold, left
    and right child, and its share of class 1; a leaf has no feature. Trees are numbered over the blocks."""
    fields = ("treeID int, nodeData struct<id: int, impurityStats: array<double>, leftChild: int, rightChild: int, "
              "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>>>")
    raw = spark.read.schema(fields).parquet(f"{keep}/series=*/block=*/data")
    place = lambda name: F.regexp_extract(F.input_file_name(), f"/{name}=([0-9]+)/", 1).cast("int")
    stats = F.col("nodeData.impurityStats")
    leaf = F.col("nodeData.leftChild") < 0
    node = F.struct(F.col("nodeData.id").alias("id"), F.when(leaf, -1).otherwise(F.col("nodeData.split.featureIndex")).alias("feature"),
                    F.coalesce(F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)), F.lit(0.0)).alias("threshold"),
                    F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
                    (stats[1] / (stats[0] + stats[1])).alias("p"))
    rows = raw.select(place("series").alias("series"), place("block").alias("block"), "treeID", node.alias("node"))
    trees = rows.groupBy("series", "block", "treeID").agg(F.array_sort(F.collect_list("node")).alias("nodes"))     # one tree
    per_block = trees.groupBy("series").agg(F.max("treeID").alias("_last"))
    return (trees.join(per_block, "series").join(spark.read.parquet(f"{keep}/names"), "series")
            .select("symbol", (F.col("block") * (F.col("_last") + 1) + F.col("treeID")).alias("tree"), "nodes"))
