"""Token counts by overlap resynchronisation.

Texts of up to ``chunk + overlap`` characters are encoded whole. Longer ones are cut
into chunks that overlap, and every chunk is a row of its own, so one huge text
spreads over many tasks. Two neighbouring chunks are spliced at a stable common
boundary inside their overlap: a position where both encodings start a token
and where the characters around it prove that the tokenizer always cuts
(blank after non-blank, or a change between letters, digits and other signs
that no contraction can bridge). Left of it the earlier chunk's tokens are
those of the whole text, right of it the later chunk's are. Where no such
position exists, the chunks of that text are joined in pairs and the overlap
is widened, again and again, until it aligns or is encoded whole.

Null texts count as empty, with 0 bytes and tokens. Repeated rows are counted
row by row; an empty table gives no rows. Special tokens are not added; their strings inside texts are
treated as the library does by default. An input column named as the output one
is replaced.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pricetrend.llm.common import cut_lineage, fresh_name, slices, without

LETTER, DIGIT, BLANK = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")


@dataclass(frozen=True)
class CountParams:
    chunk: int = 32768
    overlap: int = 1024
    limit: int = 1024


_TOKENIZERS: dict[str, object] = {}


def tokenizer(path: str):
    """The library's tokenizer, read once in each worker process; one thread a task."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def always_cut(before: str, after: str) -> bool:
    """Whether the pre-tokenizer cuts between these two characters in any context."""
    if BLANK.match(after):
        return not BLANK.match(before)
    if BLANK.match(before):
        return False
    kind = lambda c: "L" if LETTER.match(c) else "N" if DIGIT.match(c) else "O"
    # A sign before a letter may be the apostrophe of a contraction.
    return (kind(before), kind(after)) in {("L", "N"), ("N", "L"), ("L", "O"), ("N", "O"), ("O", "N")}


def stable(text: str, starts: list[int], low: int, high: int) -> dict[int, int]:
    """Provable boundaries from ``low`` to below ``high``: position -> tokens that start before it."""
    out: dict[int, int] = {}
    first = int(np.searchsorted(starts, low))
    for n in range(first, len(starts)):
        at = starts[n]
        if at >= high:
            break
        if at > 0 and (n == 0 or starts[n - 1] < at) and always_cut(text[at - 1], text[at]):
            out[at] = n
    return out


def _one_pass(df: DataFrame, path: str, text: str, most: int, count: str) -> DataFrame:
    """The other columns of ``df`` with the tokens of ``text``, or null where it is longer than ``most``."""
    carried = [c for c in df.columns if c.lower() != text.lower()]
    schema = StructType([*(df.schema[c] for c in carried), StructField(count, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for part in slices(batches):
            texts = [x or "" for x in part.column(text).to_pylist()]
            got = iter(t.encode_batch_fast([x for x in texts if len(x) <= most], add_special_tokens=False))
            n = [len(next(got)) if len(x) <= most else None for x in texts]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(n, pa.int64())], schema.names)

    return df.mapInArrow(run, schema)


def _cut(df: DataFrame, row: str, text: str, chunk: int) -> DataFrame:
    """row, piece (0, 1, ...), pieces and body: the consecutive pieces of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 16):
            for key, t in zip(part.column(row).to_pylist(), part.column(text).to_pylist()):
                n = -(-len(t) // chunk)
                for i in range(n):
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([i], pa.int64()), pa.array([n], pa.int64()),
                                                      pa.array([t[i * chunk:(i + 1) * chunk]], pa.string())], ["row", "piece", "pieces", "body"])

    return df.mapInArrow(run, "row long, piece long, pieces long, body string")


def _spliced(pieces: DataFrame, path: str, chunk: int, join: int, overlap: int) -> DataFrame:
    """row and n: the tokens of each text from chunks of ``join`` pieces with ``overlap``
    characters in common; n is null where two neighbours share no stable boundary."""
    width = chunk * join
    # The head of a chunk also belongs to the chunk before it.
    reach = -(-overlap // chunk)
    at = F.floor(F.col("piece") / join).cast("long")
    head = (F.col("piece") % join < reach) & (at > 0)
    member = F.explode(F.when(head, F.array(at, at - 1)).otherwise(F.array(at)))
    grouped = pieces.withColumn("chunk", member).select("row", "chunk", "piece", "pieces", "body")

    def encode(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("piece").to_numpy())
        body = group.column("body").to_pylist()
        text = "".join(body[i] for i in order)[:width + overlap]
        row, c = group.column("row")[0].as_py(), group.column("chunk")[0].as_py()
        chunks = -(-group.column("pieces")[0].as_py() // join)
        coded = tokenizer(path).encode(text, add_special_tokens=False)
        starts = [a for a, _ in coded.offsets]
        n = len(starts)
        out = [(row, c, "own", None, n)]
        if c > 0:  # what this chunk counts before the boundary is the earlier chunk's
            out += [(row, c, "right", p, k) for p, k in stable(text, starts, 1, overlap).items()]
        if c + 1 < chunks:  # and what it counts after the next boundary is the next one's
            out += [(row, c + 1, "left", p - width, n - k) for p, k in stable(text, starts, width + 1, width + overlap).items()]
        names = ["row", "seam", "side", "place", "n"]
        return pa.table({k: pa.array([r[i] for r in out], t) for i, (k, t) in enumerate(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())))})

    told = grouped.groupBy("row", "chunk").applyInArrow(encode, "row long, seam long, side string, place long, n long")
    told = cut_lineage(told, "token-seams")
    # At each seam the first place that both sides prove; both lose the tokens beyond it.
    places = (told.where("side <> 'own'").groupBy("row", "seam", "place").agg(F.count(F.lit(1)).alias("sides"), F.sum("n").alias("n"))
              .where("sides = 2"))
    seams = places.groupBy("row", "seam").agg(F.min_by("n", "place").alias("lost"))
    lost = seams.groupBy("row").agg(F.sum("lost").alias("lost"), F.count(F.lit(1)).alias("found"))
    own = told.where("side = 'own'").groupBy("row").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("chunks"))
    ok = F.coalesce(F.col("found"), F.lit(0)) == F.col("chunks") - 1
    return own.join(lost, "row", "left").select("row", F.when(ok, F.col("all") - F.coalesce("lost", F.lit(0))).alias("n"))


def count_tokens(df: DataFrame, path: str, text: str = "text", count: str = "n_tokens",
                 params: CountParams = CountParams()) -> DataFrame:
    """The other columns of ``df`` with the number of tokens of ``text``."""
    df = without(df, {count} - {text})
    most = params.chunk + params.overlap
    short = F.coalesce(F.length(text), F.lit(0)) <= most
    done = _one_pass(df.where(short), path, text, most, count)
    # The long texts alone get a key; the written table fixes it.
    key = fresh_name(df, "row")
    long = cut_lineage(df.where(~short).withColumn(key, F.monotonically_increasing_id()), "long-texts")
    if long.isEmpty():
        return done
    pieces = cut_lineage(_cut(long.select(key, text), key, text, params.chunk), "long-pieces")
    join, overlap, found, left = 1, params.overlap, None, pieces
    while True:
        got = cut_lineage(_spliced(left, path, params.chunk, join, overlap), "long-counts")
        fine = got.where("n is not null")
        found = fine if found is None else found.unionByName(fine)
        failed = got.where("n is null").select("row")
        if failed.isEmpty():
            break
        left = cut_lineage(left.join(failed, "row", "left_semi"), "long-pieces")
        join, overlap = join * 2, min(overlap * 4, params.chunk * join)
    its = fresh_name(long, "its_row")
    counts = found.select(F.col("row").alias(its), F.col("n").alias(count))
    return done.unionByName(long.drop(text).join(counts, F.col(key) == F.col(its)).drop(key, its))
