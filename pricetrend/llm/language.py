"""Language identification by sparse multinomial logistic regression.

A text is lower-cased, everything but letters becomes one blank, and its
character n-grams (one to four characters, blanks included) are hashed into
``buckets`` features. A feature's value is TF-IDF: its share of the text's
n-grams (``scale`` times count / (n-grams + ``shrink``), so that very short
texts stay undecided) times log((1 + texts) / (1 + texts with it)) + 1.

Document frequencies cover every text that may be learnt from; tasks add theirs
up before they are shuffled. Weights are fitted on a bounded sample, about
``per_lang`` texts of each language (those with the smallest id hashes), by
follow-the-regularised-leader with elastic-net penalties: ``l1`` makes weights
exactly zero, ``l2`` shrinks the rest. The sample is dealt into ``shards``
by hash. In an epoch each shard runs through its rows in mini-batches from the
common state, and the states are averaged by rows; only nonzero features travel.
Every fifth sampled text is kept out of the fit and sets the temperature that
divides all scores before the softmax. Shards, order and batches follow hashes, so a
rerun gives the same model.

All texts are read whole, in sections of ``section`` characters that overlap by
an n-gram, so a very long text needs no more memory than its own characters.

Null texts, and those without a letter, are ``und`` with score 0, and so is
every text if nothing was learnt. One learnt language is sure of itself (score 1). Equal scores
go to the language whose name sorts first. Rows with a null id or language aren't learnt from but are
predicted. Repeated rows count and are predicted each. Invalid UTF-8 is read with replacement signs. Columns
named as an output column are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pricetrend.llm.common import cut_lineage, fresh_name, slices, without


@dataclass(frozen=True)
class LanguageParams:
    orders: int = 4
    buckets_log2: int = 18
    scale: float = 100.0
    shrink: float = 50.0
    per_lang: int = 1500        # sampled texts of a language, about
    shards: int = 6
    epochs: int = 4
    batch: int = 32
    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 2e-3
    l2: float = 1e-3
    section: int = 1 << 18

    @property
    def buckets(self) -> int:
        return 1 << self.buckets_log2


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once in a worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def signs(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with one blank for each run of other signs
    (and at both ends); empty without a letter."""
    if not text:
        return np.zeros(0, np.uint32)
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    known = _letters()[points]
    if not known.any():
        return np.zeros(0, np.uint32)
    points = np.concatenate([[32], np.where(known, points, 32), [32]]).astype(np.uint32)
    blank = points == 32
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


def _hashed(points: np.ndarray, first: int, params: LanguageParams) -> Iterator[np.ndarray]:
    """The features of all n-grams, an array per order; those that end before ``first`` are
    left out (the section before has them)."""
    h = np.zeros(len(points), np.uint32)
    for n in range(params.orders):
        if n >= len(points):
            return
        h = (h[:len(points) - n] if n == 0 else h[:-1]) * np.uint32(0x9E3779B1) + points[n:]
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77 + 2 * n)
        skip = max(0, first - n)
        yield (mixed[skip:] >> np.uint32(32 - params.buckets_log2)).astype(np.int64)


def sections(points: np.ndarray, params: LanguageParams) -> Iterator[np.ndarray]:
    """The features of a text, piece by piece; every n-gram comes once."""
    over = params.orders - 1
    for at in range(0, len(points), params.section):
        start = max(0, at - over)
        yield from _hashed(points[start:at + params.section], at - start, params)


def counts(text: str | None, params: LanguageParams) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text, ascending, and how often each occurs."""
    seen = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for f in sections(signs(text), params):
        u, n = np.unique(f, return_counts=True)
        both = np.concatenate([seen[0], u])
        u, back = np.unique(both, return_inverse=True)
        seen = u, np.bincount(back, weights=np.concatenate([seen[1], n]), minlength=len(u)).astype(np.int64)
    return seen


def values(features: np.ndarray, n: np.ndarray, idf: np.ndarray, params: LanguageParams) -> np.ndarray:
    return params.scale * n / (n.sum() + params.shrink) * idf[features]


class Leader:
    """FTRL-proximal state of all languages: sums of adjusted gradients and of their squares."""

    def __init__(self, z: np.ndarray, n: np.ndarray, params: LanguageParams):
        self.z, self.n, self.p = z, n, params

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, p = self.z[rows], self.p
        rate = (p.beta + np.sqrt(self.n[rows])) / p.alpha + p.l2
        return np.where(np.abs(z) <= p.l1, 0.0, (np.sign(z) * p.l1 - z) / rate)

    def learn(self, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> None:
        """One step on the mean gradient of a mini-batch (features and values of each text; none is empty)."""
        sizes = np.array([len(f) for f, _ in texts])
        at = np.repeat(np.arange(len(texts)), sizes)
        f, x = np.concatenate([f for f, _ in texts]), np.concatenate([v for _, v in texts])
        rows, of = np.unique(f, return_inverse=True)
        w = self.weights(rows)
        error = softmax(np.add.reduceat(x[:, None] * w[of], np.cumsum(sizes) - sizes))
        error[np.arange(len(texts)), y] -= 1.0
        error /= len(texts)
        g = np.stack([np.bincount(of, x * e[at], minlength=len(rows)) for e in error.T], axis=1)
        before = self.n[rows]
        after = before + g * g
        self.z[rows] += g - (np.sqrt(after) - np.sqrt(before)) / self.p.alpha * w
        self.n[rows] = after


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of all scores that makes the kept-out labels likeliest (golden section on its logarithm)."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(np.maximum(softmax(scores / math.exp(t))[np.arange(len(y)), y], 1e-300)).mean()
    low, high, g = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    features: np.ndarray    # those with a weight, ascending
    weights: np.ndarray     # their idf times weight for each language
    heat: float
    params: LanguageParams

    @property
    def nonzero(self) -> float:
        return len(self.features) / self.params.buckets

    def table(self) -> np.ndarray:
        """The weights of all features, a row each; a task makes it once."""
        out = np.zeros((self.params.buckets, len(self.langs)))
        out[self.features] = self.weights
        return out

    def predict(self, text: str | None, table: np.ndarray) -> tuple[str, float]:
        points = signs(text)
        if not len(points) or not self.langs:
            return "und", 0.0
        total, n = np.zeros(len(self.langs)), 0
        for f in sections(points, self.params):
            total += np.bincount(f, minlength=self.params.buckets) @ table if len(f) > self.params.buckets else table[f].sum(axis=0)
            n += len(f)
        p = softmax((self.params.scale / (n + self.params.shrink) * total / self.heat)[None, :])[0]
        best = int(p.argmax())
        return self.langs[best], float(min(1.0, p[best]))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether an id's language is kept for testing: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _text(b: bytes | None) -> str | None:
    return None if b is None else b.decode("utf-8", "replace")


def frequencies(texts: DataFrame, params: LanguageParams) -> tuple[int, np.ndarray]:
    """Number of ``texts`` (column ``t``, binary) and in how many of them each feature occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, mark = np.zeros(params.buckets, np.int64), 0, np.zeros(params.buckets, bool)
        for part in slices(batches):
            for b in part.column("t"):
                for f in sections(signs(_text(b.as_py())), params):
                    mark[f] = True
                here = np.flatnonzero(mark)
                df[here] += 1
                mark[here] = False
                n += 1
        here = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], here])), pa.array(np.concatenate([[n], df[here]]))], ["f", "n"])

    rows = texts.select("t").mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()  # a row per feature at most
    out = np.zeros(params.buckets, np.int64)
    known = rows["f"].to_numpy() >= 0
    out[rows["f"].to_numpy()[known]] = rows["n"].to_numpy()[known]
    return int(rows["n"].to_numpy()[~known].sum()), out


def fit(docs: DataFrame, learn_from: Column, params: LanguageParams = LanguageParams(), doc_id: str = "doc_id",
        text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model of the texts and languages of the rows for which ``learn_from`` holds."""
    spark, p = docs.sparkSession, params
    rows = (docs.where(F.coalesce(learn_from, F.lit(False)) & F.col(f"`{doc_id}`").isNotNull())
            .select(F.col(f"`{doc_id}`").cast("string").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("binary").alias("t"))
            .where("lang IS NOT NULL AND t IS NOT NULL"))
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    langs = sorted(per)
    if not langs:
        return LanguageModel([], np.zeros(0, np.int32), np.zeros((0, 0)), 1.0, p)
    n_texts, df = frequencies(rows, p)
    idf = np.log((1.0 + n_texts) / (1.0 + df)) + 1.0

    # The smallest hashes of each language: a share of its texts, so no language is sorted or held in one place.
    share = F.element_at(F.create_map(*[v for x in langs for v in (F.lit(x), F.lit(min(1.0, p.per_lang / per[x])))]), F.col("lang"))
    dealt = rows.withColumn("h", F.xxhash64(F.lit("language"), "id")).withColumn("u", F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)))
    sample = dealt.where(F.col("u") < share).select("h", "lang", "t")
    shared = spark.sparkContext.broadcast(idf.astype(np.float32))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = [counts(_text(b), p) for b in part.column("t").to_pylist()]
            some = [i for i, (f, _) in enumerate(got) if len(f)]     # texts without a letter teach nothing
            part, got = part.take(pa.array(some, pa.int64())), [got[i] for i in some]
            xs = [values(f, n, shared.value, p) for f, n in got]
            yield pa.RecordBatch.from_arrays([part.column("h"), pa.array([langs.index(x) for x in part.column("lang").to_pylist()], pa.int32()),
                                              pa.array([f.astype("<i4").tobytes() for f, _ in got], pa.binary()),
                                              pa.array([x.astype("<f4").tobytes() for x in xs], pa.binary())], ["h", "y", "f", "x"])

    texts = cut_lineage(sample.mapInArrow(featurise, "h long, y int, f binary, x binary"), "language-sample")
    shared.destroy()
    kept = F.pmod(F.shiftrightunsigned("h", 3), F.lit(5)) == 0
    learnt = (texts.where(~kept).withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(p.shards)).cast("int"))
              .repartition(p.shards, "shard").sortWithinPartitions("shard", "h", "f"))
    z, n = np.zeros((p.buckets, len(langs))), np.zeros((p.buckets, len(langs)))
    for _ in range(p.epochs):
        z, n = _epoch(learnt, z, n, p)
    w = Leader(z, n, p).weights()
    scored = texts.where(kept).orderBy("h", "f").select("y", "f", "x").toLocalIterator()  # a fifth of the sample, a row at a time
    scores, y = [], []
    for r in scored:
        scores.append(np.frombuffer(r["x"], "<f4").astype(float) @ w[np.frombuffer(r["f"], "<i4")])
        y.append(r["y"])
    heat = temperature(np.array(scores).reshape(-1, len(langs)), np.array(y, np.int64))
    some = np.flatnonzero((w != 0).any(axis=1)).astype(np.int32)
    return LanguageModel(langs, some, idf[some, None] * w[some], heat, p)


def _epoch(learnt: DataFrame, z: np.ndarray, n: np.ndarray, p: LanguageParams) -> tuple[np.ndarray, np.ndarray]:
    """All shards once, each from the common state; the average of where they end."""
    spark, k = learnt.sparkSession, z.shape[1]
    some = np.flatnonzero(n.any(axis=1)).astype(np.int32)
    state = spark.sparkContext.broadcast((some, z[some], n[some]))
    shape = z.shape

    def common() -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros(shape), np.zeros(shape)
        for whole, part in zip(out, state.value[1:]):
            whole[state.value[0]] = part
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[pa.RecordBatch]:
            if waiting:
                leader.learn([t[:2] for t in waiting], np.array([t[2] for t in waiting]))
            # What the shard has changed, times its rows.
            dz, dn = ((a - b) * seen for a, b in zip((leader.z, leader.n), common()))
            rows = np.flatnonzero((dz != 0).any(axis=1) | (dn != 0).any(axis=1))
            both = np.concatenate([dz[rows], dn[rows]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([[float(seen)] * (2 * k)], pa.list_(pa.float64()))], ["f", "d"])
            for at in range(0, len(rows), 8192):
                here = both[at:at + 8192]
                yield pa.RecordBatch.from_arrays([pa.array(rows[at:at + 8192]), pa.array(list(here), pa.list_(pa.float64()))], ["f", "d"])

        shard, leader, waiting, seen = None, None, [], 0
        for part in slices(batches):
            for s, y, f, x in zip(*(part.column(c).to_pylist() for c in ("shard", "y", "f", "x"))):
                if s != shard:
                    if leader is not None:
                        yield from done()
                    shard, leader, waiting, seen = s, Leader(*common(), p), [], 0
                waiting.append((np.frombuffer(f, "<i4").astype(np.int64), np.frombuffer(x, "<f4").astype(float), y))
                seen += 1
                if len(waiting) == p.batch:
                    leader.learn([t[:2] for t in waiting], np.array([t[2] for t in waiting]))
                    waiting = []
        if leader is not None:
            yield from done()

    moved = learnt.mapInArrow(run, "f long, d array<double>").groupBy("f").agg(
        F.array(*[F.sum(F.element_at("d", i + 1)) for i in range(2 * k)]).alias("d")).toPandas()  # a row per feature
    state.destroy()
    if not len(moved):
        return z, n
    f, d = moved["f"].to_numpy(), np.stack(moved["d"].to_numpy())
    rows = float(d[f < 0][0][0])
    z, n = z.copy(), n.copy()
    z[f[f >= 0]] += d[f >= 0][:, :k] / rows
    n[f[f >= 0]] += d[f >= 0][:, k:] / rows
    return z, n


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the calibrated probability of that language)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = without(docs, ["lang_pred", "score"])
    key = fresh_name(kept, "utf8")
    rows = kept.withColumn(key, F.col(f"`{text}`").cast("binary"))
    out = without(rows, [key])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = model.table()
        for part in slices(batches):
            got = [model.predict(_text(b.as_py()), table) for b in part.column(key)]
            left = [c for i, c in enumerate(part.columns) if part.schema.names[i] != key]
            names = [c for c in part.schema.names if c != key]
            yield pa.RecordBatch.from_arrays([*left, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                             [*names, "lang_pred", "score"])

    schema = out.schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)
