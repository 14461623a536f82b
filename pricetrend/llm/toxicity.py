"""Toxicity by nearest labelled examples.

Labelled texts become TF-IDF vectors. A text's nearest examples by cosine are
found exactly with a block-max inverted index; their distance-weighted votes
are mapped to a probability learnt from the examples themselves (each one
scored by the others). Examples with the very text that is scored have no vote, in
learning and in scoring (texts compare by a 64-bit hash), so no text's own label or that of its
exact copy decides its score.

Bounds: at most ``per_class`` examples of each label (those with the smallest
hash of their id). Every term that at least ``min_examples`` of them contain is
kept, so the sample alone bounds the index, whose postings are sparse and which
can be sent to every task. Document counts for the IDF are taken over all
documents.

Terms are the lower-cased words, longer ones by their first seven letters, so
that unseen inflections of a stem count. A term's IDF is multiplied by the z-value
of its association with the label among the examples (the root of chi-square) where
that is above 1; no term weighs less than its TF-IDF. Null texts count as empty.
A text without any kept term has no neighbours; its score is the calibrated
rate of such examples. Very long texts are read whole, word by word; of an empty
document table no row comes back. Repeated rows are scored row by row; repeated labels of
one id count once, toxic if any is; labels other than 0 and 1 are ignored.
Input columns with the name of an output column are replaced, others kept.
Without examples of both labels every score is the share of toxic ones (0 if
there are none).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from pricetrend.llm.common import cut_lineage, slices, without

TERMS = re.compile(r"([^\W\d_]{1,7})[^\W\d_]*+")   # the first seven letters of each word
BLOCK = 64
FIRST = 8               # blocks of a query that are visited before any is left out
COMMON = 1024           # most frequent terms whose postings are dense
QUERIES = 256           # scored together, with at most AT_ONCE sparse postings (or alone)
AT_ONCE = 1_000_000


@dataclass(frozen=True)
class ToxicityParams:
    per_class: int = 3000
    min_examples: int = 5
    neighbours: int = 15
    threshold: float = 0.3


def text_key(text: str | None) -> int:
    """63 bits that tell texts apart."""
    return xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass"), 9) >> 1


def term_counts(text: str | None) -> Counter:
    """How often each term occurs in the whole text."""
    return Counter(TERMS.findall((text or "").lower()))


class Vocabulary:
    """Counts the kept terms of texts."""

    def __init__(self, terms: list[str]):
        self.place = {t: i for i, t in enumerate(terms)}

    def of(self, counts: Iterable[tuple[str, int]]) -> dict[int, int]:
        """Places of the kept terms, ascending, and their counts."""
        place = self.place
        return dict(sorted([(place[t], n) for t, n in counts if t in place]))

    def counts(self, text: str | None) -> dict[int, int]:
        return self.of(term_counts(text).items())


@dataclass
class Vectors:
    """Sparse rows: ``sizes`` says how many of the flat ``terms`` and ``weights`` each has."""

    sizes: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    n_terms: int

    @staticmethod
    def of(rows: "Vectors | np.ndarray") -> "Vectors":
        if isinstance(rows, Vectors):
            return rows
        at, terms = np.nonzero(rows)
        return Vectors(np.bincount(at, minlength=len(rows)), terms, rows[at, terms], rows.shape[1])

    def part(self, first: int, last: int) -> "Vectors":
        a, b = self.sizes[:first].sum(), self.sizes[:last].sum()
        return Vectors(self.sizes[first:last], self.terms[a:b], self.weights[a:b], self.n_terms)


def weigh(sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> Vectors:
    """Unit TF-IDF vectors (1 + ln tf, times idf), empty where no term is kept.

    ``sizes`` says how many of the flat ``terms`` and ``counts`` each row has.
    """
    weights = (1.0 + np.log(counts)) * idf[terms]
    rows = np.repeat(np.arange(len(sizes)), sizes)
    norm = np.sqrt(np.bincount(rows, weights * weights, minlength=len(sizes)))
    return Vectors(sizes, terms, weights / norm[rows], len(idf))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i] + 1, ... (sizes[i] of them), one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@dataclass
class BlockMaxIndex:
    """Postings (example, weight) by term, those of a term in blocks of 64 examples,
    each with its largest weight. They are sparse; tasks lay those of the most
    frequent terms out densely (at most ``COMMON`` numbers an example).

    Examples are ordered by their heaviest term, so blocks hold similar ones
    and their bounds are sharp.
    """

    ids: np.ndarray
    labels: np.ndarray
    of_term: np.ndarray     # where each term's runs start (a run: postings of one term in one block)
    block: np.ndarray       # of each run: its block, largest weight and first posting
    top: np.ndarray
    first: np.ndarray
    example: np.ndarray     # of each posting
    weight: np.ndarray
    keys: np.ndarray        # of each example: the hash of its text

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "common"}

    @cached_property
    def common(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each term's row among the dense ones (-1: sparse), their weights by block and
        example, and their largest weights by block."""
        n, reach = len(self.ids), self.first[self.of_term]
        held = reach[1:] - reach[:-1]
        terms = np.argsort(-held, kind="stable")[:COMMON]
        row = np.full(len(held), -1, np.int64)
        row[terms] = np.arange(len(terms))
        blocks = (n - 1) // BLOCK + 1
        dense, tops = np.zeros((blocks, len(terms), BLOCK)), np.zeros((len(terms), blocks))
        p = _spread(reach[terms], held[terms])
        example = self.example[p]
        dense[example // BLOCK, np.repeat(np.arange(len(terms)), held[terms]), example % BLOCK] = self.weight[p]
        size = self.of_term[terms + 1] - self.of_term[terms]
        r = _spread(self.of_term[terms], size)
        tops[np.repeat(np.arange(len(terms)), size), self.block[r]] = self.top[r]
        return row, dense, tops

    @staticmethod
    def build(ids: np.ndarray, labels: np.ndarray, vectors: Vectors | np.ndarray, keys: np.ndarray | None = None) -> "BlockMaxIndex":
        v, n = Vectors.of(vectors), len(ids)
        rows = np.repeat(np.arange(n), v.sizes)
        heavy, most = np.full(n, -1, np.int64), np.zeros(n)
        by_weight = np.lexsort((-v.terms, v.weights))
        heavy[rows[by_weight]], most[rows[by_weight]] = v.terms[by_weight], v.weights[by_weight]
        order = np.lexsort((ids, most, heavy))
        position = np.empty(n, np.int64)
        position[order] = np.arange(n)
        by_term = np.lexsort((position[rows], v.terms))
        terms, example, weight = v.terms[by_term], position[rows][by_term], v.weights[by_term]
        run = terms * (n // BLOCK + 1) + example // BLOCK
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
        top = np.maximum.reduceat(weight, first) if len(first) else np.zeros(0)
        return BlockMaxIndex(ids[order], labels[order], np.searchsorted(terms[first], np.arange(v.n_terms + 1)),
                             (example[first] // BLOCK).astype(np.int32), top, np.append(first, len(run)),
                             example.astype(np.int32), weight, (ids if keys is None else keys)[order])

    def equal(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs (query, example) of the same text."""
        order = np.argsort(self.keys, kind="stable")
        low, high = (np.searchsorted(self.keys[order], keys, side) for side in ("left", "right"))
        return np.repeat(np.arange(len(keys)), high - low), order[_spread(low, high - low)]

    def nearest(self, queries: Vectors | np.ndarray, k: int, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest positive cosine (ties: smaller id) of each
        query, as positions (-1: none) and cosines. With ``keys``, the hashes of the queries'
        texts, examples of the same text are left out.

        Every query visits the blocks of its largest bounds first, then all whose
        bound isn't below its k-th cosine, so no nearer example is missed.
        """
        v = Vectors.of(queries)
        n = len(v.sizes)
        at, sim = np.full((n, k), -1, np.int64), np.zeros((n, k))
        if not n or not len(self.ids):
            return at, sim
        reach = self.first[self.of_term]    # where each term's postings start
        ends = np.concatenate([[0], np.cumsum(v.sizes)])
        dear = np.concatenate([[0], np.cumsum(np.where(self.common[0][v.terms] < 0, reach[v.terms + 1] - reach[v.terms], 0))])[ends]
        a = 0
        while a < n:
            b = max(a + 1, min(a + QUERIES, n, int(np.searchsorted(dear, dear[a] + AT_ONCE, "right")) - 1))
            at[a:b], sim[a:b] = self._nearest(v.part(a, b), k, None if keys is None else self.equal(keys[a:b]))
            a = b
        return at, sim

    def _nearest(self, v: Vectors, k: int, same: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        m, n, slack = len(v.sizes), len(self.ids), 1e-12
        blocks = (n - 1) // BLOCK + 1
        place, dense, tops = self.common
        at_row, place = np.repeat(np.arange(m), v.sizes), place[v.terms]
        often = place >= 0
        thick = np.zeros((m, len(tops)))
        thick[at_row[often], place[often]] = v.weights[often]
        rare = v.terms[~often]
        size = self.of_term[rare + 1] - self.of_term[rare]
        runs = _spread(self.of_term[rare], size)
        row, weight = np.repeat(at_row[~often], size), np.repeat(v.weights[~often], size)
        cell = row * blocks + self.block[runs]
        bound = thick @ tops + np.bincount(cell, weight * self.top[runs], minlength=m * blocks).reshape(m, blocks)

        def visit(these: np.ndarray) -> np.ndarray:
            use = these.ravel()[cell]
            r = runs[use]
            size = self.first[r + 1] - self.first[r]
            p = _spread(self.first[r], size)
            got = np.bincount(np.repeat(row[use] * n, size) + self.example[p], np.repeat(weight[use], size) * self.weight[p], minlength=m * n)
            got = got.astype(np.float64, copy=False).reshape(m, n)
            for b in np.flatnonzero(these.any(0)):
                q, here = np.flatnonzero(these[:, b]), slice(b * BLOCK, min(n, (b + 1) * BLOCK))
                got[q, here] += (thick[q] @ dense[b])[:, :here.stop - here.start]
            got = np.round(got, 12, out=got)
            if same is not None:
                got[same] = 0.0
            return got

        def kth(sims: np.ndarray) -> np.ndarray:
            return np.partition(sims, n - k, axis=1)[:, n - k] if k <= n else np.zeros(m)

        now = bound > slack
        if blocks > FIRST:
            now &= bound >= np.partition(bound, blocks - FIRST, axis=1)[:, blocks - FIRST, None]
        sims = visit(now)
        later = ~now & (bound > slack) & (bound >= kth(sims)[:, None] - slack)
        if later.any():
            sims += visit(later)    # no example is in both
        q, e = np.nonzero((sims > slack) & (sims >= kth(sims)[:, None]))
        order = np.lexsort((self.ids[e], -sims[q, e], q))
        q, e = q[order], e[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        q, e, rank = q[rank < k], e[rank < k], rank[rank < k]
        at, sim = np.full((m, k), -1, np.int64), np.zeros((m, k))
        at[q, rank], sim[q, rank] = e, sims[q, e]
        return at, sim

    def votes(self, at: np.ndarray, sim: np.ndarray) -> np.ndarray:
        """Share of toxic neighbours, each weighted by its inverse distance; -1
        where there are none."""
        weight = np.where(at >= 0, 1.0 / (1.05 - sim), 0.0)
        total = weight.sum(1)
        toxic = (weight * (self.labels[at] == 1)).sum(1)
        return np.where(total > 0, toxic / np.where(total > 0, total, 1.0), -1.0)


@dataclass
class Calibration:
    """Monotone map from votes to probabilities: pooled adjacent violators, a line
    between one pool's last vote and the next one's first."""

    votes: np.ndarray
    values: np.ndarray
    without: float

    @staticmethod
    def fit(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> "Calibration":
        prior = float((weights * labels).sum() / weights.sum()) if len(labels) else 0.0
        lone = votes < 0
        without = float(((weights * labels)[lone].sum() + prior) / (weights[lone].sum() + 1.0))
        order = np.argsort(votes[~lone], kind="stable")
        pools: list[list[float]] = []  # first vote, last vote, toxic weight, weight
        for v, y, w in zip(votes[~lone][order], labels[~lone][order], weights[~lone][order]):
            pools.append([v, v, w * y, w])
            while len(pools) > 1 and (pools[-2][1] == pools[-1][0] or
                                      pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]):
                last = pools.pop()
                pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
        values = np.maximum.accumulate([(p[2] + prior) / (p[3] + 1.0) for p in pools]) if pools else np.zeros(0)
        return Calibration(np.array([v for p in pools for v in p[:2]]), np.repeat(values, 2), without)

    def __call__(self, votes: np.ndarray) -> np.ndarray:
        if not len(self.votes):
            return np.full(len(votes), self.without)
        return np.where(votes < 0, self.without, np.interp(votes, self.votes, self.values))


@dataclass
class ToxicityModel:
    params: ToxicityParams
    idf: np.ndarray
    index: BlockMaxIndex
    calibration: Calibration


@dataclass
class Examples:
    """The chosen examples: ``rows`` has id, y, terms and counts; ``share`` the number of
    usable labels of either kind, ``relevance`` what multiplies each term's IDF."""

    rows: DataFrame
    terms: list[str]
    share: dict[int, int]
    relevance: np.ndarray


def choose(documents: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(),
           doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
           learn_from: Column | None = None) -> Examples:
    """The examples, their terms and how well each tells the labels apart.

    ``learn_from`` (a condition on the label table) limits which labels may be
    used.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max(label).cast("int").alias("y"))
    known = cut_lineage(known, "toxic-labels")
    share = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        own = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(params.per_class)
        chosen = own if chosen is None else chosen.unionByName(own)
    # At most 2 * per_class rows of two numbers: safe to broadcast.
    bodies = (documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("body"))
              .join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("body").alias("body")))

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            got = [term_counts(t) for t in part.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("y"), pa.array([text_key(t) for t in part.column("body").to_pylist()]),
                 pa.array([list(c) for c in got], pa.list_(pa.string())),
                 pa.array([list(c.values()) for c in got], pa.list_(pa.int64()))], ["id", "y", "key", "terms", "counts"])

    rows = cut_lineage(bodies.mapInArrow(count_terms, "id long, y int, key long, terms array<string>, counts array<long>"), "toxic-examples")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not (n0 and n1):
        return Examples(rows, [], share, np.zeros(0))
    a, b, n = F.col("with1").cast("double"), F.col("with0").cast("double"), float(n0 + n1)
    chi = n * F.pow(a * n0 - b * n1, F.lit(2.0)) / ((a + b) * (n - a - b + 1.0) * n0 * n1)
    # Bounded: each term is in min_examples of at most 2 * per_class rows.
    kept = (rows.select("y", F.explode("terms").alias("term"))
            .groupBy("term").agg(F.sum("y").alias("with1"), F.sum(1 - F.col("y")).alias("with0"))
            .where(F.col("with1") + F.col("with0") >= params.min_examples)
            .select("term", F.greatest(F.lit(1.0), F.sqrt(chi)).alias("relevance")).collect())
    kept.sort(key=lambda r: r["term"])
    return Examples(rows, [r["term"] for r in kept], share, np.array([r["relevance"] for r in kept]))


def hits(documents: DataFrame, terms: list[str], text: str = "text", prefix: str = "toxicity_") -> DataFrame:
    """``documents`` with the kept terms of each whole text, their counts (two arrays) and the text's hash."""
    names = [prefix + "terms", prefix + "counts", prefix + "key"]
    documents = without(documents, names)
    schema = StructType([*documents.schema.fields, *(StructField(x, ArrayType(IntegerType())) for x in names[:2]), StructField(names[2], LongType())])
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        for part in slices(batches):
            texts = part.column(place).to_pylist()
            got = [vocabulary.counts(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([list(c) for c in got], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in got], pa.list_(pa.int32())), pa.array([text_key(t) for t in texts], pa.int64())], schema.names)

    return documents.mapInArrow(run, schema)


def document_idf(marked: DataFrame, n_terms: int, prefix: str = "toxicity_") -> np.ndarray:
    """ln((1 + N) / (1 + df)) + 1 of each term, over all rows of ``hits``."""
    seen = F.explode(F.concat(F.array(F.lit(-1)), F.col(prefix + "terms")))
    n = {r["term"]: r["n"] for r in marked.select(seen.alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    df = np.array([n.get(i, 0) for i in range(n_terms)], np.float64)
    return np.log((1.0 + n.get(-1, 0)) / (1.0 + df)) + 1.0


def fit(examples: Examples, marked: DataFrame, params: ToxicityParams = ToxicityParams(),
        prefix: str = "toxicity_") -> ToxicityModel:
    """Index the examples, with the IDF over all documents (``marked``: their ``hits``),
    and calibrate the votes, each example being scored by the others as any text is."""
    idf = document_idf(marked, len(examples.terms), prefix) * examples.relevance
    terms = examples.terms

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        for part in slices(batches, 64):
            got = [vocabulary.of(zip(t, c)) for t, c in zip(part.column("terms").to_pylist(), part.column("counts").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("y"), part.column("key"), pa.array([list(c) for c in got], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in got], pa.list_(pa.int32()))], ["id", "y", "key", "terms", "counts"])

    # Bounded: 2 * per_class rows.
    rows = examples.rows.mapInArrow(keep, "id long, y int, key long, terms array<int>, counts array<int>").toArrow().sort_by("id").combine_chunks()
    ids, y, keys = (rows.column(c).to_numpy().astype(np.int64) for c in ("id", "y", "key"))
    flat = [pc.list_flatten(rows.column(c)).to_numpy() for c in ("terms", "counts")]
    vectors = weigh(pc.list_value_length(rows.column("terms")).to_numpy().astype(np.int64), flat[0].astype(np.int64),
                    flat[1].astype(np.float64), idf)
    index = BlockMaxIndex.build(ids, y, vectors, keys)
    size = np.bincount(y, minlength=2)
    rate = np.array([examples.share.get(c, 0) / max(1, size[c]) for c in (0, 1)])
    votes = index.votes(*index.nearest(vectors, params.neighbours, keys)) if len(y) else np.zeros(0)
    return ToxicityModel(params, idf, index, Calibration.fit(votes, y.astype(float), rate[y]))


_OUTPUT = {"score": DoubleType(), "vote": DoubleType(), "examples": ArrayType(LongType()), "cosines": ArrayType(DoubleType())}


def _judged(m: ToxicityModel, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> list[pa.Array]:
    """The output columns of rows with the given kept terms and hashes of their texts."""
    at, sim = m.index.nearest(weigh(sizes, terms, counts, m.idf), m.params.neighbours, keys)
    votes = m.index.votes(at, sim) if len(m.index.ids) else np.full(len(sizes), -1.0)
    found = at >= 0
    offsets = pa.array(np.concatenate([[0], np.cumsum(found.sum(1))]), pa.int32())
    return [pa.array(m.calibration(votes)), pa.array(votes, mask=votes < 0),
            pa.ListArray.from_arrays(offsets, pa.array(m.index.ids[at[found]] if found.any() else np.zeros(0, np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(sim[found]))]


def score(marked: DataFrame, model: ToxicityModel, prefix: str = "toxicity_") -> DataFrame:
    """Rows of ``hits`` with ``<prefix>score``, ``<prefix>vote`` (null without neighbours)
    and the evidence instead of the terms: ``<prefix>examples`` and
    ``<prefix>cosines`` of the nearest examples."""
    used = [prefix + "terms", prefix + "counts", prefix + "key"]
    marked = without(marked, [prefix + x for x in _OUTPUT])
    rest = marked.drop(*used)
    carried = [marked.columns.index(c) for c in rest.columns]
    at_terms, at_counts, at_key = (marked.columns.index(c) for c in used)
    schema = StructType([*rest.schema.fields, *(StructField(prefix + x, k) for x, k in _OUTPUT.items())])
    shared = marked.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            made = _judged(shared.value, np.diff(part.column(at_terms).offsets.to_numpy()), part.column(at_terms).flatten().to_numpy().astype(np.int64),
                           part.column(at_counts).flatten().to_numpy().astype(np.float64), part.column(at_key).to_numpy())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *made], schema.names)

    return marked.mapInArrow(run, schema)


def score_texts(documents: DataFrame, terms: list[str], model: ToxicityModel, text: str = "text", prefix: str = "toxicity_") -> DataFrame:
    """``hits`` and ``score`` in one pass: ``documents`` with the columns that ``score`` adds."""
    documents = without(documents, [prefix + x for x in _OUTPUT])
    schema = StructType([*documents.schema.fields, *(StructField(prefix + x, k) for x, k in _OUTPUT.items())])
    place, shared = documents.columns.index(text), documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        for part in slices(batches):
            texts = part.column(place).to_pylist()
            got = [vocabulary.counts(t) for t in texts]
            made = _judged(shared.value, np.array([len(c) for c in got], np.int64), np.array([t for c in got for t in c], np.int64),
                           np.array([n for c in got for n in c.values()], np.float64), np.array([text_key(t) for t in texts], np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, *made], schema.names)

    return documents.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether an id's label is kept for testing: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
