"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricetrend.session import cut_lineage

__all__ = ["cut_lineage", "table", "slices", "words_in", "without", "fresh_name"]

# Fixed value: what separates words (space and the five ASCII controls 9-13).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most ``rows`` rows, so that a task holds
    the Python objects of one piece only."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def words_in(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that an output column replaces (names compare without case)."""
    new = {x.lower() for x in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name
