"""The up/not-up movement label.

``movement`` = 1 iff close(t) > close(t-1), else 0 (the first bar gets 0),
computed from the same bar's ``price_change`` (horizon 0, as in the study:
features and label share bar t). ``horizon_label`` shifts it forward with a
``lead`` inside bounded blocks, so no task ever holds a whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pricetrend.functions.columns import sign_label


def with_movement(panel: DataFrame) -> DataFrame:
    return panel.withColumn("movement", sign_label(F.col("price_change")))


def horizon_label(panel: DataFrame, horizon: int = 1, name: str | None = None, block: int = 4096) -> DataFrame:
    """Label of bar t + horizon attached to bar t; rows without one are dropped.

    Each block of bars also gets copies of the first ``horizon`` bars of the next
    one, so ``lead`` inside (symbol, block) sees them: one shuffle, no self-join.
    """
    name = name or f"movement_h{horizon}"
    if not 0 < horizon < block:
        raise ValueError("the horizon must be positive and shorter than a block")
    k = F.col("bar_no") - 1
    ahead = F.explode(F.when((F.pmod(k, F.lit(block)) < horizon) & (k >= block), F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0))))
    w = Window.partitionBy("symbol", "_block").orderBy("bar_no")
    return (panel.withColumn("_ahead", ahead)
            .withColumn("_block", F.floor(k / F.lit(block)) - F.col("_ahead"))
            .withColumn(name, F.lead(sign_label(F.col("price_change")), horizon).over(w))
            .where((F.col("_ahead") == 0) & F.col(name).isNotNull())
            .drop("_ahead", "_block"))
