"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``distance`` bits apart have a common variant within
``distance / 2`` bits of each. Every distinct fingerprint therefore emits all
variants within that half radius, variants are brought together, and those of
different fingerprints that collide are verified by their bit distance.

Sending each of the 2,081 variants on its own (64 bits, two flips) would move
far more bytes than the texts. So variants travel by their leading bits: a
fingerprint is sent once to each prefix that its variants have, with the
flips it has left, and the receiving task writes out the variants below that
prefix, sorts them and reads the collisions off. The prefix length follows
the number of fingerprints, so a task's share stays alike at every size;
prefixes that hold many near copies are split by their next bits.

All fingerprints that share a variant are within the distance of each other
by the triangle inequality, so each is linked to one of them only, and a task
returns a spanning forest instead of all pairs.

Null texts count as empty; texts without words have fingerprint zero and are
linked like any other. Very long texts are read whole, the words of one section at a time.
Rows with a null id take part; the id of a component is the smallest non-null one
(null if there is none). Repeated rows have one fingerprint and one component, and ``keep_one``
keeps one of them. An empty table gives no rows. ``near_duplicates`` reads the two named columns
only; ``keep_one`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pricetrend.llm.common import cut_lineage, fresh_name, slices, without
from pricetrend.llm.graph import components

BITS = 64
SECTION = 1 << 22  # bytes of a text that are split into words at once
SEED = 42  # fixed value: the seed of the shingle hash


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 4
    distance: int = 4
    per_prefix: int = 2048      # distinct fingerprints to a prefix, on average
    least_prefix: int = 8
    variants_at_once: int = 1_500_000

    def __post_init__(self):
        if self.distance < 0 or self.distance % 2:
            raise ValueError("the distance must be even: each side takes half of it")


def shingle_hashes(text: str | None, k: int) -> Iterator[np.ndarray]:
    """XXH64 of every k-word shingle of the whole text, A-Z in lower case.

    Very long texts come in several arrays, cut between words; the last words of
    one section begin the next.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    start, carry, any_yet = 0, [], False
    while len(data) - start > SECTION:
        cut = data.rfind(b" ", start, start + SECTION)
        if cut <= start:
            cut = data.find(b" ", start + SECTION)
            if cut < 0:
                break
        words = carry + data[start:cut].split()
        if len(words) >= k:
            yield _hashed(words, k)
            carry, any_yet = words[len(words) - k + 1:], True
        else:
            carry = words
        start = cut
    words = carry + data[start:].split()
    if len(words) >= k or words and not any_yet:
        yield _hashed(words, k)


def _hashed(words: list[bytes], k: int) -> np.ndarray:
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    stops = (ends - 1).tolist()
    n, h = len(words) - k + 1, xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:n], stops[k - 1:])), np.uint64, n)


def fingerprint(text: str | None, k: int) -> int:
    """The SimHash as a signed 64-bit number: a bit is set if over half the hashes have it."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, k):
        n += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            part = np.ascontiguousarray(hashes[at:at + (1 << 16)].astype(">u8"))
            ones += np.unpackbits(part.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n)
    return int(bits.view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(df: DataFrame, k: int, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The other columns of ``df`` with the fingerprint of ``text`` (long) instead of it."""
    df = without(df, {name} - {text})
    carried = [c for c in df.columns if c.lower() != text.lower()]
    schema = StructType([*(df.schema[c] for c in carried), StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = [fingerprint(t, k) for t in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(got, pa.int64())], schema.names)

    return df.mapInArrow(run, schema)


def flips(bits: int, most: int) -> list[int]:
    """All masks of at most ``most`` of the lowest ``bits`` bits."""
    return [sum(1 << b for b in chosen) for n in range(min(most, bits) + 1) for chosen in combinations(range(bits), n)]


def _count_bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def collisions(fp: np.ndarray, left: np.ndarray, bits: int, at_once: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) between fingerprints that share a variant in their lowest
    ``bits`` bits, ``left[i]`` flips being allowed for ``fp[i]``: one chain for
    each variant. Above ``at_once`` variants the next bits split the work."""
    most = int(left.max(initial=0))
    spread = [len(flips(bits, r)) if r < 2 else sum(math.comb(bits, j) for j in range(r + 1)) for r in range(most + 1)]
    total = sum(int((left == r).sum()) * spread[r] for r in range(most + 1))
    none = np.zeros(0, np.int64)
    if len(fp) < 2:
        return none, none
    if total > at_once and bits > 6:
        found = []
        sub = (fp >> np.uint64(bits - 6)) & np.uint64(63)
        for j in range(64):
            used = _count_bits(sub ^ np.uint64(j)).astype(np.int64)
            sel = np.flatnonzero(used <= left)
            a, b = collisions(fp[sel], left[sel] - used[sel], bits - 6, at_once)
            found.append(np.unique((sel[a] << 32) | sel[b]))
        pairs = np.unique(np.concatenate(found))
        return pairs >> 32, pairs & 0xFFFFFFFF
    low = fp & np.uint64((1 << bits) - 1)
    values, owners = [], []
    for r in range(most + 1):
        sel = np.flatnonzero(left == r)
        masks = np.array(flips(bits, r), np.uint64)
        values.append((low[sel][:, None] ^ masks).ravel())
        owners.append(np.repeat(sel, len(masks)))
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(value, kind="stable")
    value = value[order]
    same = np.flatnonzero(value[1:] == value[:-1])
    a, b = owner[order[same]], owner[order[same + 1]]
    pairs = np.unique((np.minimum(a, b) << 32) | np.maximum(a, b))
    return pairs >> 32, pairs & 0xFFFFFFFF


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links thinned out to one from each linked position to the least one it reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    linked = np.flatnonzero(root != np.arange(n))
    return linked, root[linked]


def links(classes: DataFrame, params: SimHashParams = SimHashParams(), fp: str = "fingerprint") -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within the distance.

    ``classes`` has every fingerprint once. The links are verified pairs; they
    span each component but aren't all of its pairs.
    """
    n = classes.count()
    half = params.distance // 2
    prefix = max(params.least_prefix, math.ceil(math.log2(max(1, n / params.per_prefix))))
    masks = F.explode(F.array(*[F.lit(m) for m in flips(prefix, half)]))
    sent = (classes.select(F.col(fp).alias("fp"), masks.alias("mask"))
            .select(F.shiftrightunsigned("fp", BITS - prefix).bitwiseXOR(F.col("mask").cast("long")).cast("int").alias("prefix"),
                    (F.lit(half) - F.bit_count("mask")).cast("int").alias("spare"), "fp"))
    limit, most = params.variants_at_once, params.distance

    def meet(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        left = group.column("spare").to_numpy().astype(np.int64)
        order = np.argsort(fps)
        fps, left = fps[order], left[order]
        a, b = collisions(fps, left, BITS - prefix, limit)
        good = _count_bits(fps[a] ^ fps[b]) <= most
        a, b = forest(len(fps), a[good], b[good])
        return pa.table({"u": fps[a].view(np.int64), "v": fps[b].view(np.int64)})

    return sent.groupBy("prefix").applyInArrow(meet, "u long, v long")


def near_duplicates(df: DataFrame, params: SimHashParams = SimHashParams(), doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``fingerprint`` (long) and
    ``component_id``, the smallest id reachable over links of at most
    ``params.distance`` differing bits."""
    marked = cut_lineage(fingerprints(df.select(doc_id, text), params.shingle, text), "fingerprints")
    classes = cut_lineage(marked.groupBy("fingerprint").agg(F.min(doc_id).alias("first_id")), "classes")
    hung = components(links(classes, params))
    rooted = (classes.join(hung.withColumnRenamed("u", "fingerprint"), "fingerprint", "left")
              .select("fingerprint", "first_id", F.coalesce("v", "fingerprint").alias("root")))
    # Fingerprints in no link of two stand for themselves; only the others need their component's id.
    lone = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    lone = cut_lineage(lone, "component-ids")
    named = cut_lineage(rooted.join(lone, "root").select("fingerprint", "component_id"), "components")
    return marked.join(named, "fingerprint").select(doc_id, "fingerprint", "component_id")


def keep_one(df: DataFrame, params: SimHashParams = SimHashParams(), doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``df`` with one row of each near-duplicate component: that of the smallest
    id, and of rows that repeat it the first by text; all columns are kept."""
    found = cut_lineage(near_duplicates(df, params, doc_id, text), "near-duplicates")
    # Components without an id are told apart by their smallest fingerprint.
    keepers = (found.where(F.col(doc_id).eqNullSafe(F.col("component_id")))
               .groupBy(doc_id).agg(F.count(F.lit(1)).alias("rows"), F.min("fingerprint").alias("fingerprint")))
    keepers = cut_lineage(keepers.withColumnRenamed(doc_id, "kept_id"), "keepers")
    its, its_fp = fresh_name(df, "its_id"), fresh_name(df, "its_fp")
    single = keepers.where((F.col("rows") == 1) & F.col("kept_id").isNotNull()).select(F.col("kept_id").alias(its))
    # Merged at every size: the keepers grow with the documents, so they are never broadcast.
    once = df.join(single.hint("merge"), F.col(doc_id) == F.col(its), "left_semi")
    several = keepers.where((F.col("rows") > 1) | F.col("kept_id").isNull())
    if several.isEmpty():
        return once
    # Rows that share an id: one of each component, found by the fingerprint again.
    mark = fresh_name(df, "fp")
    copy = fresh_name(df, "body")
    twice = (df.join(several.select(F.col("kept_id").alias(its)), F.col(doc_id).eqNullSafe(F.col(its)), "left_semi")
             .withColumn(copy, F.col(text)))
    twice = fingerprints(twice, params.shingle, copy, mark)
    group = found.select(F.col(doc_id).alias("its_id"), F.col("fingerprint").alias("its_fp"), "component_id").distinct()
    return once.unionByName(
        twice.join(_one_fingerprint(group).toDF(its, its_fp), F.col(doc_id).eqNullSafe(F.col(its)) & (F.col(mark) == F.col(its_fp)), "left_semi")
        .dropDuplicates([doc_id, mark]).drop(mark))


def _one_fingerprint(group: DataFrame) -> DataFrame:
    """For each component the (id, fingerprint) whose row stays."""
    own = group.where(F.col("its_id").eqNullSafe(F.col("component_id")))
    with_id = own.where(F.col("its_id").isNotNull()).groupBy("its_id").agg(F.min("its_fp").alias("its_fp"))
    # Without an id, every fingerprint is a text of its own as far as can be told.
    return with_id.unionByName(own.where(F.col("its_id").isNull()).select("its_id", "its_fp"))
