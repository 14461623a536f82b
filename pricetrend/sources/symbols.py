"""Series -> display-name pairing as an explicit dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The four series of the reference study and their display names.
REFERENCE_SYMBOLS = {
    "BHEL": "BHEL",
    "NIFTY BANK": "NIFTY BANK",
    "Sensex": "S&P BSE Sensex",
    "TATA": "TATA",
}


def symbol_dim(spark: SparkSession, names: dict[str, str] | None = None) -> DataFrame:
    names = names if names is not None else REFERENCE_SYMBOLS
    return spark.createDataFrame(sorted(names.items()), "symbol string, symbol_name string")


def with_symbol_names(df: DataFrame, dim: DataFrame, max_dim_rows: int = 100_000) -> DataFrame:
    """Left join the names; symbols without a name keep their key as name.

    The dimension is broadcast only when its row count is below the bound
    (it is one row per series); otherwise the planner picks a shuffle join.
    """
    n = dim.count()
    right = F.broadcast(dim) if n <= max_dim_rows else dim
    return (df.join(right, "symbol", "left")
            .withColumn("symbol_name", F.coalesce("symbol_name", "symbol")))
