"""Shared model plumbing: feature vectors, the list of series, thread pool."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def series_of(prep: DataFrame) -> list[str]:
    """The series, one row each: the study fits its forests and networks per series."""
    return sorted(r["symbol"] for r in prep.select("symbol").distinct().collect() if r["symbol"] is not None)


def run_parallel(fns, parallelism: int | None = None):
    """Run independent fits concurrently (Spark schedules the jobs side by side)."""
    parallelism = parallelism or min(8, os.cpu_count() or 4)
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        return list(ex.map(lambda fn: fn(), fns))
