"""Rows of many series dealt into shards, and sums over the shards.

Models that need several passes are fitted where the rows are. The rows of a
series are dealt by hash into as many shards as ``per_shard`` rows each need, so
a series that holds a third of all rows is spread like any other data. A series
of one shard is fitted by one task in one go; for wider ones a pass is a job
over (series, shard) groups whose sums are added in two steps, and the solver's
state is a written table with a row for each problem. Nothing that grows with
the series passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from pricetrend.operators.keyed import join_series
from pricetrend.session import cut_lineage

PER_SHARD = 65_536
FAN = 128       # shards whose sums one task of the first step adds
CHUNK = 8192    # doubles of a sum that travel as one row


def deal(rows: DataFrame, per_shard: int = PER_SHARD) -> DataFrame:
    """``rows`` (symbol, bar_no, ...) with ``shards`` and ``shard`` (from 0), as a written table."""
    sizes = rows.groupBy("symbol").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_shard)).cast("int").alias("shards"))
    dealt = join_series(rows, sizes)
    return cut_lineage(dealt.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "bar_no"), F.col("shards")).cast("int")), "shards")


BUCKETS = 256


def by_bucket(dealt: DataFrame) -> DataFrame:
    """The table laid out by a hash of the series, so that passes skip files without open problems."""
    return cut_lineage(dealt.withColumn("bucket", F.pmod(F.xxhash64("symbol"), F.lit(BUCKETS)).cast("int")), "wide-series", partition_by="bucket")


def of_open(table: DataFrame, live: DataFrame) -> DataFrame:
    """The rows of a ``by_bucket`` table whose series are in ``live``; other buckets' files aren't read."""
    symbols = live.select(F.col("symbol").alias("_its")).distinct()
    buckets = [r[0] for r in symbols.select(F.pmod(F.xxhash64("_its"), F.lit(BUCKETS)).cast("int")).distinct().collect()]  # at most BUCKETS
    return table.where(F.col("bucket").isin(buckets)).join(symbols, F.col("symbol").eqNullSafe(F.col("_its")), "left_semi").drop("bucket")


def every_shard(per_series: DataFrame) -> DataFrame:
    """The rows of a table with ``shards``, repeated for each shard."""
    return per_series.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))


def any_rows(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, "<f8").tobytes()


def unpacked(data: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(shape).copy()


def chunks(values: np.ndarray) -> list[bytes]:
    flat = values.ravel()
    return [packed(flat[i:i + CHUNK]) for i in range(0, max(1, len(flat)), CHUNK)]


def add_up(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the ``sums`` (binary doubles) of equal ``keys`` and ``chunk``; ``shard`` says what to add first.

    No task gets more than one chunk of FAN shards, or of what those gave."""
    def add(g: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, "<f8") for b in g.column("sums").to_pylist())
        return g.slice(0, 1).set_column(g.schema.get_field_index("sums"), "sums", pa.array([packed(total)], pa.binary()))

    by = [*keys, "chunk"]
    first = parts.select(*by, F.floor(F.col("shard") / FAN).cast("int").alias("shard"), "sums")
    fields = {f.name: f for f in first.schema.fields}
    one = first.groupBy(*by, "shard").applyInArrow(add, StructType([StructField(f.name, f.dataType) for f in first.schema.fields]))
    return one.drop("shard").groupBy(*by).applyInArrow(add, StructType([StructField(c, fields[c].dataType) for c in [*by, "sums"]]))


def joined(g: pa.Table) -> np.ndarray:
    """The chunks of one sum put together."""
    return np.concatenate([np.frombuffer(b, "<f8") for b in g.sort_by("chunk").column("sums").to_pylist()])
