"""Quality classifier by co-training on two views of a document.

The text view sees proportions measured on the whole text (never its length);
the metadata view sees length, language and source. Both are logistic
regressions fitted by Newton steps whose sums are taken over all documents in
Spark. In every round each view labels the unlabelled documents that it is
confident about, at least ``sure`` either way, for the other view to learn from
in the next one. Then each view's scores are calibrated (monotone, by pooled
bins) on labelled documents kept out of the fits, and a last regression on the
two calibrated log-odds combines them.

Nothing is sampled. The driver holds sums of the size of the models, and the
bins. Null texts count as empty. Null lang or source is a value of its own; a
null length is a feature of its own. Repeated rows count as often as they
occur; repeated labels of one id count once, the lowest; labels other than 0
and 1 are ignored. Without labels of both kinds every score is their mean (0.5
if there are none). Very long texts are measured whole. An empty table gives an empty result.
Only the named columns are read; others are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from pricetrend.llm.common import cut_lineage, slices


@dataclass(frozen=True)
class QualityParams:
    rounds: int = 3
    steps: int = 6            # Newton steps a round
    sure: float = 0.95
    pseudo_weight: float = 0.3
    ridge: float = 1.0
    bins: int = 64
    smoothing: float = 20.0   # of the quality rates by source and language
    threshold: float = 0.5


_PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)
_SIGNS = [ord(c) for c in "#$%&*"]
_WORDS = re.compile(r"\S+")


def text_features(text: str | None) -> list[float]:
    """Proportions of the whole text: words, characters, lines, repetition."""
    text = text or ""
    words = _WORDS.findall(text)
    n = max(1, len(words))
    counts = Counter(words)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size = max(1, int(raw.sum()))
    letters = max(1, int(raw[_UPPER].sum() + raw[_LOWER].sum() + raw[128:].sum()))
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(counts) / n
    return [
        distinct, distinct ** 2,
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        np.sqrt(raw[_PUNCTUATION].sum() / size),
        np.sqrt(raw[_SIGNS].sum() / size), np.sqrt(raw[ord("!")] / size), np.sqrt(raw[ord("|")] / size),
        np.sqrt((raw[ord(".")] + raw[ord(",")]) / size),
        raw[_UPPER].sum() / letters,
        np.sqrt(raw[_DIGIT].sum() / size),
        sum(map(len, words)) / n / 10.0,
        1.0 - len(set(lines)) / max(1, len(lines)),
        1.0 / (1.0 + n / max(1, len(lines))),
        float(not words),
    ]


N_TEXT = len(text_features(""))
N_META = 6


def _fields(names: list[str]) -> list[StructField]:
    return [StructField(x, ArrayType(DoubleType())) for x in names]


def features(documents: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), doc_id: str = "doc_id",
             text: str = "text", lang: str = "lang", source: str = "source", n_chars: str = "n_chars",
             label: str = "quality", learn_from: Column | None = None) -> DataFrame:
    """id, text_view and meta_view (arrays), y (null: unlabelled) and part of each
    document: 0 to fit, 1 to calibrate, null if unlabelled."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.groupBy(F.col(doc_id).alias("its_id")).agg(F.min(label).cast("double").alias("y"))
    # A fifth of the labels, by hash, is for calibration only.
    known = known.withColumn("part", (F.pmod(F.xxhash64(F.lit("calibrate"), "its_id"), F.lit(5)) == 0).cast("int"))
    schema = StructType([*documents.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                                           F.col(n_chars).cast("double").alias("chars")).schema.fields, *_fields(["text_view"])])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = [text_features(t) for t in part.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "lang", "source", "chars")),
                                              pa.array(got, pa.list_(pa.float64()))], schema.names)

    rows = documents.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                            F.col(n_chars).cast("double").alias("chars"), F.col(text).alias("body"))
    rows = cut_lineage(rows.mapInArrow(measure, schema).join(known, F.col("id") == F.col("its_id"), "left").drop("its_id"), "quality-rows")
    fit = rows.where("part = 0")
    base = fit.agg(F.avg("y")).first()[0]
    base = 0.5 if base is None else min(max(base, 0.01), 0.99)
    for c in ("lang", "source"):  # a row for each value; Spark broadcasts it if it is small
        rate = (F.sum("y") + base * params.smoothing) / (F.count("y") + params.smoothing)
        rates = cut_lineage(fit.groupBy(F.col(c).alias("value")).agg(F.log(rate / (1 - rate)).alias(c + "_rate")), c + "-rates")
        rows = rows.join(rates, F.col(c).eqNullSafe(F.col("value")), "left").drop("value")
    unseen = F.lit(float(np.log(base / (1 - base))))
    size = F.log1p(F.greatest(F.coalesce("chars", F.lit(0.0)), F.lit(0.0)))
    meta = F.array(size, size * size / 10, F.greatest(size - 5.0, F.lit(0.0)), F.coalesce("lang_rate", unseen),
                   F.coalesce("source_rate", unseen), F.col("chars").isNull().cast("double"))
    return cut_lineage(rows.select("id", "text_view", meta.alias("meta_view"), "y", "part"), "quality-features")


def _design(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(batch.num_rows, width)
    return np.concatenate([np.ones((len(x), 1)), x], axis=1)


def _chance(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def _sums(rows: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """The sum of a vector over all batches; every task sends one vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += of_batch(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["i", "x"])

    got = rows.mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(width)
    for r in got:
        out[r["i"]] = r["x"]
    return out


def _newton_terms(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    p = _chance(x @ w)
    return np.concatenate([x.T @ (weight * (y - p)), ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()])


def _newton_step(sums: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    d = len(w)
    penalty = np.full(d, ridge)
    penalty[0] = 1e-6
    move = np.linalg.solve(sums[d:].reshape(d, d) + np.diag(penalty), sums[:d] - penalty * w)
    return w + move * min(1.0, 5.0 / max(1e-12, np.abs(move).max()))


@dataclass
class QualityModel:
    text: np.ndarray
    meta: np.ndarray
    curves: list[tuple[np.ndarray, np.ndarray]]
    mix: np.ndarray
    constant: float | None = None

    def views(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """The calibrated log-odds of the two views."""
        z = (_design(batch, "text_view", N_TEXT) @ self.text, _design(batch, "meta_view", N_META) @ self.meta)
        return tuple(np.interp(np.clip(v, -30, 30), *curve) for v, curve in zip(z, self.curves))

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _chance(self.mix[0] + self.mix[1] * a + self.mix[2] * b)


def calibrate(total: np.ndarray, good: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a monotone curve from raw to calibrated log-odds, pooled over bins."""
    prior = (good.sum() + 0.5) / (total.sum() + 1.0)
    pools: list[list[float]] = []
    for lo, hi, n, k in zip(edges, edges[1:], total, good):
        if n:
            pools.append([(lo + hi) / 2 * n, k, n])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    if not pools:
        return np.array([-30.0, 30.0]), np.array([-30.0, 30.0])
    rate = np.array([(k + prior) / (n + 1.0) for _, k, n in pools])
    return np.array([z / n for z, _, n in pools]), np.log(rate / (1 - rate))


def fit(rows: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Co-train the two views on the rows of ``features``, calibrate and combine them."""
    have = {r["y"]: r["n"] for r in rows.where("y is not null").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    da, db = N_TEXT + 1, N_META + 1
    a, b = np.zeros(da), np.zeros(db)
    if len(have) < 2:
        mean = have.get(1.0, 0) / max(1, sum(have.values())) if have else 0.5
        return QualityModel(a, b, [(np.array([-30.0, 30.0]),) * 2] * 2, np.zeros(3), mean)
    ridge, pseudo, bar = params.ridge, params.pseudo_weight, np.log(params.sure / (1 - params.sure))
    teacher_a = teacher_b = None

    def labelled(batch: pa.RecordBatch, teacher: np.ndarray | None, view: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Labels and weights: the given ones, and those the other view is sure of."""
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        part = batch.column("part").to_numpy(zero_copy_only=False).astype(float)
        weight = np.where(part == 0, 1.0, 0.0)
        if teacher is not None:
            z = view @ teacher
            told = np.isnan(part) & (np.abs(z) >= bar)
            y = np.where(told, z > 0, y)
            weight = np.where(told, pseudo, weight)
        return np.nan_to_num(y), weight

    for _ in range(params.rounds):
        for _ in range(params.steps):
            def terms(batch: pa.RecordBatch, a=a, b=b, ta=teacher_a, tb=teacher_b) -> np.ndarray:
                xa, xb = _design(batch, "text_view", N_TEXT), _design(batch, "meta_view", N_META)
                return np.concatenate([_newton_terms(xa, *labelled(batch, tb, xb), a), _newton_terms(xb, *labelled(batch, ta, xa), b)])

            sums = _sums(rows, terms, da + da * da + db + db * db)
            a, b = _newton_step(sums[:da + da * da], a, ridge), _newton_step(sums[da + da * da:], b, ridge)
        teacher_a, teacher_b = a.copy(), b.copy()

    edges = np.concatenate([[-30.0], np.linspace(-8, 8, params.bins - 1), [30.0]])
    held = rows.where("part = 1")

    def count(batch: pa.RecordBatch) -> np.ndarray:
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        out = []
        for x, w in ((_design(batch, "text_view", N_TEXT), a), (_design(batch, "meta_view", N_META), b)):
            z = np.clip(x @ w, -29.9, 29.9)
            out += [np.histogram(z, edges)[0], np.histogram(z, edges, weights=y)[0]]
        return np.concatenate(out)

    n = len(edges) - 1
    got = _sums(held, count, 4 * n)
    model = QualityModel(a, b, [calibrate(got[i:i + n], got[i + n:i + 2 * n], edges) for i in (0, 2 * n)], np.array([0.0, 1.0, 0.2]))
    for _ in range(params.steps):
        def both(batch: pa.RecordBatch, m=model) -> np.ndarray:
            u, v = m.views(batch)
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            return _newton_terms(np.stack([np.ones(len(u)), u, v], axis=1), y, np.ones(len(u)), m.mix)

        model = QualityModel(a, b, model.curves, _newton_step(_sums(held, both, 3 + 9), model.mix, 1.0))
    return model


def score(rows: DataFrame, model: QualityModel) -> DataFrame:
    """id, score, text_score and meta_score of each row of ``features``."""
    schema = StructType([rows.schema["id"], *(StructField(x, DoubleType()) for x in ("score", "text_score", "meta_score"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model.constant is not None:
                got = [np.full(batch.num_rows, model.constant)] * 3
            else:
                u, v = model.views(batch)
                got = [model.score(u, v), _chance(u), _chance(v)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(np.round(x, 9)) for x in got)], schema.names)

    return rows.mapInArrow(run, schema)
