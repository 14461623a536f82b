"""Scans over the blocks of a series in two levels.

The blocks (or time chunks) of a series are numbered; a window over all of them
would put a series' whole block table into one task. Here blocks fall into
groups of ``GROUP`` consecutive numbers: sums run inside a group, the groups' totals
are summed in the same way, one row each, and added back. Every window is
partitioned by (series, group) or (series, group of groups) and holds ``GROUP``
rows at most. Numbers must be below ``GROUP`` squared, 16.8 million blocks: 8.6
billion bars of a series with 512 to a block; beyond that the query fails.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

GROUP = 4096


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(and_, [a.eqNullSafe(b) for a, b in zip(left, right)])


def _group(number: str, group: int) -> Column:
    fits = (F.col(number) >= 0) & (F.col(number) < group * group)
    return F.when(fits, F.floor(F.col(number) / group)).otherwise(F.raise_error(F.lit(f"{number} outside of the two levels' range")).cast("long"))


def sums_before(df: DataFrame, key: str, number: str, cols: dict[str, str], group: int = GROUP) -> DataFrame:
    """``df`` with the sums of columns over all rows of the key with a smaller number.

    ``cols`` maps a column to its sum's name; the number, from 0, is unique in a key (gaps are fine). Of
    a key's first row the sum is 0.
    """
    marked = df.withColumn("_group", _group(number, group))
    inside = Window.partitionBy(key, "_group").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    totals = (marked.groupBy(key, "_group").agg(*[F.sum(c).alias(f"_sum_{c}") for c in cols])
              .withColumn("_wide_group", F.floor(F.col("_group") / group)))
    over = Window.partitionBy(key, "_wide_group").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(key).alias("_key"), F.col("_group").alias("_of"), *[F.coalesce(F.sum(f"_sum_{c}").over(over), F.lit(0)).alias(f"_off_{c}") for c in cols])
    local = marked.withColumns({f"_loc_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in cols})
    joined = local.join(offsets, _same([F.col(key), F.col("_group")], [F.col("_key"), F.col("_of")]))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(name) for c, name in cols.items()])


def previous(df: DataFrame, key: str, number: str, cols: dict[str, str], group: int = GROUP) -> DataFrame:
    """``df`` with columns of the row before; numbers of a key are consecutive.

    The last row of a group is also copied to the next one, where it only serves as the row before."""
    at = _group(number, group)
    # A group's last row counts for the next group too.
    groups = F.when(F.col(number) % group == group - 1, F.array(at, at + 1)).otherwise(F.array(at))
    copied = df.withColumn("_group", F.explode(groups))
    order = Window.partitionBy(key, "_group").orderBy(number)
    lagged = copied.withColumns({name: F.lag(c).over(order) for c, name in cols.items()})
    return lagged.where(F.floor(F.col(number) / group) == F.col("_group")).drop("_group")
