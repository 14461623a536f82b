"""Daily OHLC CSV files, one file per series.

Every file is read by its own header: one job takes all files' first lines, files are
grouped by header, one scan for each distinct one, and the frames are combined by name (S3). Every file has
one date layout, the one by which all its rows parse. Nothing is lost or
guessed silently; these raise a ``ValueError`` that names the file:

* a file without the needed columns;
* a missing date, or dates that no layout parses in full;
* dates that two layouts parse differently (say which with ``date_format``);
* two rows of a series on one date (allow them with ``duplicates="keep"``, and
  give ``number_bars`` a tie-break).
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The column names of the reference's input files.
DATE_COLUMN = "Date"
HIGH_COLUMN = "High Price"
LOW_COLUMN = "Low Price"
CLOSE_COLUMN = "Close Price"
OPEN_COLUMN = "Open Price"

# Date layouts that are tried when no explicit format is given.
DATE_FORMATS = ["yyyy-MM-dd", "d-MMM-yyyy", "d-MMMM-yyyy", "d-M-yyyy", "M/d/yyyy", "d/M/yyyy"]


def _parsed(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(F.trim(c), F.lit(fmt)).cast("timestamp_ntz")


def _snake(name: str) -> str:
    out = "".join(ch.lower() if ch.isalnum() else "_" for ch in name.strip())
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")


def _first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, line): the first line with content of every file, from one scan of the splits that
    start a file; lines come in order inside a split."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start") == 0).alias("starts"), "value")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            for f, v in zip(b.column("file").to_pylist(), b.column("value").to_pylist()):
                if f not in seen and v.strip():
                    seen.add(f)
                    yield pa.RecordBatch.from_arrays([pa.array([f]), pa.array([v])], ["file", "line"])

    return lines.where("starts").drop("starts").mapInArrow(first, "file string, line string")


def _by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files under ``paths`` by their header, from one job whatever their number.

    One row per file comes to the driver, which has their list anyway."""
    plain = lambda p: unquote(re.sub("^file:/+", "file:/", p))
    lines = {plain(f): "" for f in spark.read.text(paths).inputFiles()}
    lines |= {plain(r["file"]): r["line"] for r in _first_lines(spark, paths).collect()}
    distinct = sorted(set(lines.values()))
    parsed = {line: tuple(next(csv.reader([line.lstrip("\ufeff")]), [])) for line in distinct}
    out: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for f in sorted(lines):
        h = parsed[lines[f]]
        if missing := [c for c in (DATE_COLUMN, HIGH_COLUMN, LOW_COLUMN, CLOSE_COLUMN) if c not in h]:
            raise ValueError(f"{f}: no column {', '.join(missing)}")
        out[h].append(f)
    return out


def _layouts(raw: DataFrame, formats: list[str]) -> DataFrame:
    """file and layout of each file of ``raw`` (file, Date); raises as the module says."""
    date = F.col(f"`{DATE_COLUMN}`")
    read = [_parsed(date, f) for f in formats]
    differ = [F.sum((read[i] != read[j]).cast("int")).alias(f"d{i}_{j}") for i in range(len(formats)) for j in range(i)]
    rows = (raw.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count(date).alias("dated"),
                                    *[F.count(r).alias(f"f{i}") for i, r in enumerate(read)], *differ).collect())
    chosen = []
    for r in rows:
        if r["dated"] < r["n"]:
            raise ValueError(f"{r['file']}: {r['n'] - r['dated']} rows without a date")
        fit = [i for i in range(len(formats)) if r[f"f{i}"] == r["n"]]
        if not fit:
            best = max(range(len(formats)), key=lambda i: r[f"f{i}"])
            raise ValueError(f"{r['file']}: no date layout fits all {r['n']} rows; {formats[best]} fits {r[f'f{best}']}")
        if clash := [j for j in fit[1:] if r[f"d{j}_{fit[0]}"]]:
            raise ValueError(f"{r['file']}: dates read as {formats[fit[0]]} or {formats[clash[0]]}; give date_format")
        chosen.append((r["file"], fit[0]))
    return raw.sparkSession.createDataFrame(chosen, "file string, layout int")


def _read_group(spark: SparkSession, header: tuple[str, ...], files: list[str], formats: list[str],
                numeric_columns: list[str] | None) -> DataFrame:
    # The header is enforced: a file that differs would raise instead of shifting columns.
    raw = (spark.read.option("header", True).option("enforceSchema", False)
           .schema(", ".join(f"`{c}` STRING" for c in header)).csv(files)
           .select("*", F.col("_metadata.file_path").alias("file")))
    layouts = _layouts(raw.select("file", f"`{DATE_COLUMN}`"), formats)
    raw = raw.join(layouts, "file")  # a row per file
    date = F.col(f"`{DATE_COLUMN}`")
    when = F.coalesce(*[F.when(F.col("layout") == i, _parsed(date, f)) for i, f in enumerate(formats)])
    path = F.try_url_decode("file")
    folder = F.regexp_extract(path, r"/symbol=([^/]+)/[^/]+$", 1)
    name = F.when(folder != "", folder).otherwise(F.element_at(F.split(path, "/"), -1))
    number = lambda c: F.col(f"`{c}`").try_cast("double")
    cols = [F.regexp_replace(name, r"(?i)\.csv$", "").alias("symbol"), when.alias("bar_ts")]
    if OPEN_COLUMN in header:
        cols.append(number(OPEN_COLUMN).alias("open"))
    cols += [number(HIGH_COLUMN).alias("high"), number(LOW_COLUMN).alias("low"), number(CLOSE_COLUMN).alias("close")]
    known = {DATE_COLUMN, OPEN_COLUMN, HIGH_COLUMN, LOW_COLUMN, CLOSE_COLUMN}
    extras = [c for c in (numeric_columns if numeric_columns is not None else header) if c in header and c not in known]
    cols += [number(c).alias(_snake(c)) for c in extras]
    out = raw.select(*cols)
    # NaN is not a value in this engine: NULL marks every missing number.
    return out.select(*[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if t == "double" else F.col(c)
                        for c, t in out.dtypes])


def read_ohlc_csv(spark: SparkSession, paths: list[str] | str, date_format: str | None = None,
                  numeric_columns: list[str] | None = None, duplicates: str = "raise") -> DataFrame:
    """Read the series files; ``symbol`` is the file name without ``.csv``, or the name
    in a folder ``symbol=NAME`` that holds the file (as ``write_ohlc_csv`` lays them out).

    All columns are read as strings (no inference pass). High, low, close and,
    where present, open are parsed; ``numeric_columns`` (default: every other
    column) are cast with ``try_cast`` so text becomes NULL, and renamed to
    snake case; a file without a column has NULL there. Row order in the files
    is irrelevant: bars are ordered by the parsed date.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    formats = [date_format] if date_format else DATE_FORMATS
    frames = [_read_group(spark, h, files, formats, numeric_columns) for h, files in _by_header(spark, paths).items()]
    if not frames:
        raise ValueError("no files found")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if duplicates == "raise":
        twice = out.groupBy("symbol", "bar_ts").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if first := twice.orderBy("symbol", "bar_ts").first():
            raise ValueError(f"{first['symbol']}: {first['n']} rows on {first['bar_ts']:%Y-%m-%d}; {twice.count()} such dates in all")
    return out


def write_ohlc_csv(bars: DataFrame, path: str, date_format: str = "dd/MM/yyyy") -> None:
    """Write bars in the layout of the input files, one folder and file per series."""
    named = bars.select("symbol", F.date_format("bar_ts", date_format).alias(DATE_COLUMN),
                        F.col("open").alias(OPEN_COLUMN), F.col("high").alias(HIGH_COLUMN),
                        F.col("low").alias(LOW_COLUMN), F.col("close").alias(CLOSE_COLUMN))
    named.repartition("symbol").write.partitionBy("symbol").option("header", True).csv(path)
