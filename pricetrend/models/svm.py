"""M1-M3: support-vector classifiers with polynomial and RBF kernels.

Kernel solvers need all pairs of rows; here the kernels are explicit feature
maps, so training is sums over rows:

* poly, degree d: the monomials of total degree d, each weighted by
  ``sqrt(multinomial) * gamma^(d/2)`` with gamma = 1 / features. Products of
  two mapped rows equal the homogeneous kernel ``(gamma * x.z)^d`` exactly;
  Where that gives more than ``max_monomials`` (degree 4 of thirty features gives
  40,920), a tensor sketch (Pham & Pagh, 2013) stands in: each factor is a count
  sketch of ``sketch_width``, and their product is taken as a product of Fourier transforms;
* rbf, gamma: ``n_components`` random Fourier features (Rahimi & Recht, 2007) with
  a fixed seed.

The width of an approximation is reported, and so is ``kernel_error``: the norm of what its
kernel matrix misses, over the norm of the exact one, on up to ``probe`` rows of each shard.

Every (series, fold, C) is a problem of its own:
``mean(hinge) + |w|^2 / (2 * C * rows)`` with a free intercept, the hinge
smoothed over ``smooth`` around its corner. A row is mapped once for each kernel
setting and serves all folds and all C. The L-BFGS state, step and stop of a
problem depend on its own values only, so its answer is the same whichever
other series there are. A problem stops when its gradient or its gain
falls below the tolerance; ``converged`` says whether that was before
``max_passes``.

The problems of a (series, kernel setting) are solved together. Where the
series is one shard (see ``shards``) a task does all passes over its rows. For
a wider series a pass is a job over (series, setting, shard) groups that add up
values and gradients; iterates, gradients and histories are rows of a written
table, stepped by grouped tasks, and series without open problems aren't read
again. The driver holds grids and counters only.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetrend.models.shards import PER_SHARD, add_up, any_rows, by_bucket, chunks, deal, every_shard, joined, of_open, packed
from pricetrend.session import cut_lineage, last_written, release_table

# The study's SVM grids.
POLY_DEGREES = [1, 2, 3, 4]
POLY_C = [0.5, 1, 5, 10, 100]
RBF_GAMMAS = [0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 10.0]
RBF_C = [0.5, 1, 5, 10]


def poly_grid(degrees=POLY_DEGREES, cs=POLY_C) -> list[dict]:
    return [{"kernel": "poly", "degree": d, "C": c} for d in degrees for c in cs]


def rbf_grid(gammas=RBF_GAMMAS, cs=RBF_C) -> list[dict]:
    return [{"kernel": "rbf", "gamma": g, "C": c} for g in gammas for c in cs]


@dataclass(frozen=True)
class SvmParams:
    n_components: int = 128
    max_monomials: int = 10_000
    sketch_width: int = 2048
    probe: int = 256
    seed: int = 42
    smooth: float = 0.1
    tolerance: float = 1e-3     # of the largest gradient component
    gain: float = 1e-6          # relative gain of an accepted step
    max_passes: int = 120
    memory: int = 10
    per_shard: int = PER_SHARD
    mapped_bytes: int = 1 << 27     # mapped rows up to this size are kept between passes


class FeatureMap:
    """The mapped rows of one kernel setting, with a last column of ones."""

    def __init__(self, n_features: int, setting: tuple, params: SvmParams):
        self.kind, self.value = setting
        self.n_features, self.components = n_features, None
        if self.kind == "poly" and math.comb(n_features + self.value - 1, self.value) <= params.max_monomials:
            chosen = list(combinations_with_replacement(range(n_features), self.value))
            self.columns = np.array(chosen, np.int64).reshape(len(chosen), self.value)
            ways = [math.factorial(self.value) / math.prod(math.factorial(n) for n in Counter(c).values()) for c in chosen]
            self.weights = np.sqrt(ways) * n_features ** (-self.value / 2)
            self.width = len(chosen) + 1
            return
        rng = np.random.default_rng(params.seed)
        if self.kind == "poly":
            self.kind, self.components = "sketch", params.sketch_width
            # A count sketch for each factor: every feature goes to one place with a sign.
            self.sketches = np.zeros((self.value, n_features, self.components))
            at, sign = rng.integers(0, self.components, (self.value, n_features)), rng.choice([-1.0, 1.0], (self.value, n_features))
            for k in range(self.value):
                self.sketches[k, np.arange(n_features), at[k]] = sign[k]
        else:
            self.components = params.n_components
            self.w = rng.standard_normal((n_features, self.components)) * math.sqrt(2.0 * self.value)
            self.b = rng.uniform(0.0, 2.0 * math.pi, self.components)
        self.width = self.components + 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.kind == "poly":
            out = np.ones((len(x), len(self.columns)))
            for k in range(self.columns.shape[1]):
                out *= x[:, self.columns[:, k]]
            out *= self.weights
        elif self.kind == "sketch":
            product = np.fft.rfft(x @ self.sketches[0])
            for s in self.sketches[1:]:
                product *= np.fft.rfft(x @ s)
            out = np.fft.irfft(product, self.components) * self.n_features ** (-self.value / 2)
        else:
            out = math.sqrt(2.0 / len(self.b)) * np.cos(x @ self.w + self.b)
        return np.concatenate([out, np.ones((len(x), 1))], axis=1)

    def misses(self, x: np.ndarray) -> np.ndarray:
        """Squared norms of what the map's kernel matrix of these rows misses, and of the exact one."""
        if not self.components or not len(x):
            return np.zeros(2)
        phi = self(x)[:, :-1]
        if self.kind == "sketch":
            exact = (x @ x.T / self.n_features) ** self.value
        else:
            size = (x * x).sum(1)
            exact = np.exp(-self.value * np.maximum(0.0, size[:, None] + size - 2 * x @ x.T))
        return np.array([((phi @ phi.T - exact) ** 2).sum(), (exact ** 2).sum()])


class Problems:
    """L-BFGS for several independent problems at once (rows: problems)."""

    def __init__(self, n: int, width: int, params: SvmParams):
        self.p = params
        self.w, self.g = np.zeros((n, width)), np.zeros((n, width))
        self.f, self.step = np.full(n, np.inf), np.ones(n)
        self.move = np.zeros((n, width))
        self.s = np.zeros((params.memory, n, width))
        self.y = np.zeros((params.memory, n, width))
        self.rho = np.zeros((params.memory, n))
        self.active, self.converged = np.ones(n, bool), np.zeros(n, bool)
        self.passes = np.zeros(n, np.int64)

    FIELDS = ("w", "g", "f", "step", "move", "s", "y", "rho", "active", "converged", "passes")

    def pack(self) -> bytes:
        return packed(np.concatenate([np.asarray(getattr(self, f), float).ravel() for f in self.FIELDS]))

    @classmethod
    def unpack(cls, n: int, width: int, params: SvmParams, data: bytes) -> Problems:
        out, flat, at = cls(n, width, params), np.frombuffer(data, "<f8"), 0
        for name in cls.FIELDS:
            a = getattr(out, name)
            setattr(out, name, flat[at:at + a.size].reshape(a.shape).astype(a.dtype))
            at += a.size
        return out

    def point(self) -> np.ndarray:
        """Where the next pass is to evaluate."""
        return self.w + self.step[:, None] * self.move

    def _direction(self, rows: np.ndarray) -> np.ndarray:
        q = self.g[rows].copy()
        alphas = []
        for s, y, rho in zip(self.s[::-1], self.y[::-1], self.rho[::-1]):
            a = rho[rows] * (s[rows] * q).sum(1)
            q -= a[:, None] * y[rows]
            alphas.append(a)
        yy = (self.y[:, rows] ** 2).sum(2)
        last = np.argmax((self.rho[:, rows] > 0) * np.arange(1, len(self.rho) + 1)[:, None], axis=0)
        at = np.arange(q.shape[0])
        known = self.rho[last, rows] > 0
        scale = np.where(known, 1.0 / np.maximum(1e-300, self.rho[last, rows] * yy[last, at]),
                         1.0 / np.maximum(1.0, np.sqrt((q * q).sum(1))))
        q *= scale[:, None]
        for s, y, rho, a in zip(self.s, self.y, self.rho, alphas[::-1]):
            b = rho[rows] * (y[rows] * q).sum(1)
            q += (a - b)[:, None] * s[rows]
        return -q

    def learn(self, f: np.ndarray, g: np.ndarray) -> None:
        """Take the values and gradients at ``point()`` and choose the next points."""
        p, live = self.p, self.active
        self.passes[live] += 1
        slope = (self.move * self.g).sum(1)
        first = ~np.isfinite(self.f)
        good = live & (first | (f <= self.f + 1e-4 * self.step * slope + 1e-15))
        here = self.point()
        s, y = here - self.w, g - self.g
        sy = (s * y).sum(1)
        keep = good & ~first & (sy > 1e-12)
        self.s, self.y, self.rho = (np.roll(a, -1, axis=0) for a in (self.s, self.y, self.rho))
        self.s[-1], self.y[-1] = np.where(keep[:, None], s, 0.0), np.where(keep[:, None], y, 0.0)
        self.rho[-1] = np.where(keep, 1.0 / np.where(keep, sy, 1.0), 0.0)
        small = np.abs(g).max(1) <= p.tolerance
        last = np.where(first, 0.0, self.f)
        little = ~first & (last - f <= p.gain * np.maximum(1e-12, np.abs(last)))
        done = good & (small | little)
        self.w[good], self.f[good], self.g[good] = here[good], f[good], g[good]
        self.converged |= done
        worse = live & ~good
        self.step[worse] *= 0.5
        stuck = worse & (self.step < 1e-6)
        self.active &= ~(done | stuck)
        rows = np.flatnonzero(good & self.active)
        if len(rows):
            move = self._direction(rows)
            uphill = (move * self.g[rows]).sum(1) >= 0
            move[uphill] = -self.g[rows][uphill]
            self.move[rows], self.step[rows] = move, 1.0
        self.move[~self.active] = 0.0


def _settings(grid: list[dict]) -> dict[tuple, list[tuple[int, float]]]:
    """(kernel, degree or gamma) -> the grid points (index, C) that share its map; a point of a part
    of a grid may name its place in the whole as ``grid_index``."""
    out: dict[tuple, list[tuple[int, float]]] = {}
    for i, p in enumerate(grid):
        i = p.get("grid_index", i)
        key = ("poly", p["degree"]) if p["kernel"] == "poly" else ("rbf", p["gamma"])
        out.setdefault(key, []).append((i, float(p["C"])))
    return out


class Kernel:
    """One kernel setting of a grid: its map and the problems that share it (C outer, group inner).

    Group g < n_folds trains on the training rows of the other folds and is scored on
    its own; the last group trains on all and is scored on the test rows.
    """

    def __init__(self, n_features: int, setting: tuple, points: list[tuple[int, float]], n_folds: int, params: SvmParams):
        self.map, self.setting, self.points, self.p = FeatureMap(n_features, setting, params), setting, points, params
        self.groups, self.n = n_folds + 1, len(points) * (n_folds + 1)

    def start(self) -> Problems:
        return Problems(self.n, self.map.width, self.p)

    def uses(self, fold: np.ndarray, train: np.ndarray, score: bool) -> np.ndarray:
        """Which rows (first axis) each group learns from, or is scored on."""
        folds = range(self.groups - 1)
        own = [train & (fold == g) for g in folds] + [~train] if score else [train & (fold != g) for g in folds] + [train]
        return np.stack(own, axis=1).astype(np.float64)

    def sums(self, phi: np.ndarray, y: np.ndarray, use: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Rows of each group, then hinge and gradient of each problem, added up over rows."""
        margin = (phi @ w.T) * y[:, None]
        mask = np.tile(use, (1, len(self.points)))
        z, smooth = 1.0 - margin, self.p.smooth
        slope = np.clip(z / smooth, 0.0, 1.0) * mask
        loss = np.where(z <= 0, 0.0, np.where(z < smooth, z * z / (2 * smooth), z - smooth / 2)) * mask
        return np.concatenate([use.sum(0), loss.sum(0), (-(slope * y[:, None]).T @ phi).ravel()])

    def right(self, phi: np.ndarray, y: np.ndarray, use: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Right answers of each problem, then rows seen by each group."""
        margin = (phi @ w.T) * y[:, None]
        # no margin is class 0, as in a hard threshold at zero
        right = np.where(y[:, None] > 0, margin > 0, margin >= 0) * np.tile(use, (1, len(self.points)))
        return np.concatenate([right.sum(0), use.sum(0)])

    def learn(self, q: Problems, v: np.ndarray) -> None:
        """Take the sums at ``q.point()``."""
        rows = np.tile(np.maximum(1.0, v[:self.groups]), len(self.points))
        cost = np.repeat([c for _, c in self.points], self.groups) * rows
        loss, grad = v[self.groups:self.groups + self.n], v[self.groups + self.n:].reshape(self.n, -1)
        ridge = q.point()
        ridge[:, -1] = 0.0  # the intercept is free
        q.learn(loss / rows + 0.5 * (ridge ** 2).sum(1) / cost, grad / rows[:, None] + ridge / cost[:, None])

    def probed(self, x: np.ndarray) -> np.ndarray:
        return self.map.misses(x[::max(1, -(-len(x) // self.p.probe))])

    def results(self, symbol: str | None, q: Problems, v: np.ndarray) -> pa.Table:
        """A row per grid point from the sums of ``right`` and ``probed``."""
        v, (missed, whole) = v[:-2], v[-2:]
        right, seen = v[:self.n].reshape(-1, self.groups), np.tile(v[self.n:], (len(self.points), 1))
        error = math.sqrt(missed / whole) if whole > 0 else None
        acc = np.divide(right, seen, out=np.full_like(right, np.nan), where=seen > 0)
        kind, value = self.setting
        rows = []
        for j, (i, c) in enumerate(self.points):
            folds = acc[j, :-1][~np.isnan(acc[j, :-1])]
            own = slice(j * self.groups, (j + 1) * self.groups)
            rows.append((symbol, i, kind, value if kind == "poly" else None, float(value) if kind == "rbf" else None, c,
                         self.map.components, error, float(folds.mean()) if len(folds) else None,
                         None if np.isnan(acc[j, -1]) else float(acc[j, -1]), bool(q.converged[own].all()), int(q.passes[own].max()),
                         q.w[own][-1].tolist()))
        return _table(MODELS, rows)


MODELS = ("symbol string, grid_index int, kernel string, degree int, gamma double, C double, n_components int, kernel_error double, cv_accuracy double, "
          "test_accuracy double, converged boolean, passes int, weights array<double>")
TYPES = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema.split(", "))
    return pa.table({f.split()[0]: pa.array(list(v), TYPES[f.split()[1]]) for f, v in zip(schema.split(", "), columns)})


def _arrays(g: pa.Table, cols: list[str]) -> tuple[np.ndarray, ...]:
    """Features, signs of the labels, folds and training marks of a group, by bar."""
    g = g.sort_by("bar_no")
    x = np.stack([g.column(c).to_numpy().astype(np.float64) for c in cols], axis=1)
    fold = g.column("fold").fill_null(-1).to_numpy()
    return x, np.where(g.column("movement").to_numpy() == 1, 1.0, -1.0), fold, np.array(g.column("is_train").to_pylist(), bool)


def _mapped(kernel: Kernel, x: np.ndarray, y: np.ndarray, use: np.ndarray):
    """A function that gives the pieces (mapped rows, labels, uses) of a group, pass after pass."""
    cuts = [slice(i, i + 1024) for i in range(0, len(x), 1024)]
    kept = [kernel.map(x[c]) for c in cuts] if 8 * len(x) * kernel.map.width <= kernel.p.mapped_bytes else None
    return lambda: ((kept[i] if kept else kernel.map(x[c]), y[c], use[c]) for i, c in enumerate(cuts))


def _solve_whole(rows: DataFrame, cols: list[str], kernels: list[Kernel], max_passes: int) -> DataFrame:
    def solve(g: pa.Table) -> pa.Table:
        kernel = kernels[g.column("setting")[0].as_py()]
        x, y, fold, train = _arrays(g, cols)
        pieces, q = _mapped(kernel, x, y, kernel.uses(fold, train, False)), kernel.start()
        for _ in range(max_passes):
            if not q.active.any():
                break
            w = q.point()
            kernel.learn(q, sum(kernel.sums(*p, w) for p in pieces()))
        use = kernel.uses(fold, train, True)
        v = sum(kernel.right(phi, yy, use[1024 * i:1024 * i + 1024], q.w) for i, (phi, yy, _) in enumerate(pieces()))
        return kernel.results(g.column("symbol")[0].as_py(), q, np.concatenate([v, kernel.probed(x)]))

    settings = F.explode(F.sequence(F.lit(0), F.lit(len(kernels) - 1))).alias("setting")
    return rows.select("*", settings).groupBy("symbol", "setting").applyInArrow(solve, MODELS)


STATE = "symbol string, setting int, shards int, open int, state binary"


def _solve_wide(rows: DataFrame, cols: list[str], kernels: list[Kernel], max_passes: int) -> DataFrame:
    rows = by_bucket(rows)
    sums_schema = "symbol string, setting int, shard int, chunk int, sums binary"

    def state_row(symbol, setting, shards, q: Problems) -> pa.Table:
        return _table(STATE, [(symbol, setting, shards, int(q.active.any()), q.pack())])

    def problems(s: pa.Table) -> tuple[Kernel, Problems]:
        kernel = kernels[s.column("setting")[0].as_py()]
        return kernel, Problems.unpack(kernel.n, kernel.map.width, kernel.p, s.column("state")[0].as_py())

    def begin(g: pa.Table) -> pa.Table:
        setting = g.column("setting")[0].as_py()
        return state_row(g.column("symbol")[0].as_py(), setting, g.column("shards")[0].as_py(), kernels[setting].start())

    def one_pass(state: DataFrame, score: bool) -> DataFrame:
        """The sums of every (series, setting) of ``state`` over its shards."""
        def run(s: pa.Table, g: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if g.num_rows and s.num_rows:
                kernel, q = problems(s)
                x, y, fold, train = _arrays(g, cols)
                w, of = (q.w, kernel.right) if score else (q.point(), kernel.sums)
                v = sum(of(*p, w) for p in _mapped(kernel, x, y, kernel.uses(fold, train, score))())
                v = np.concatenate([v, kernel.probed(x)]) if score else v
                out = [(g.column("symbol")[0].as_py(), g.column("setting")[0].as_py(), g.column("shard")[0].as_py(), i, b) for i, b in enumerate(chunks(v))]
            return _table(sums_schema, out)

        # Rows meet the open settings of their series only.
        wanted = state.groupBy(F.col("symbol").alias("_of")).agg(F.collect_list("setting").alias("_open"))     # at most all settings
        here = of_open(rows, state).join(wanted, F.col("symbol").eqNullSafe(F.col("_of"))).select(
            "symbol", "shard", "bar_no", "movement", "fold", "is_train", *cols, F.explode("_open").alias("setting"))
        by = ["symbol", "setting", "shard"]
        parts = every_shard(state).groupBy(*by).cogroup(here.groupBy(*by)).applyInArrow(run, sums_schema)
        return add_up(parts, ["symbol", "setting"])

    settings = F.explode(F.sequence(F.lit(0), F.lit(len(kernels) - 1))).alias("setting")
    state = cut_lineage(rows.select("symbol", "shards").distinct().select("*", settings).groupBy("symbol", "setting").applyInArrow(begin, STATE), "svm-state")
    path = last_written()
    for _ in range(max_passes):
        live = state.where("open = 1")
        if not any_rows(live):
            break

        def step(s: pa.Table, g: pa.Table) -> pa.Table:
            if not g.num_rows:
                return s
            kernel, q = problems(s)
            kernel.learn(q, joined(g))
            return state_row(s.column("symbol")[0].as_py(), s.column("setting")[0].as_py(), s.column("shards")[0].as_py(), q)

        by = ["symbol", "setting"]
        state = cut_lineage(state.groupBy(*by).cogroup(one_pass(live, False).groupBy(*by)).applyInArrow(step, STATE), "svm-state")
        release_table(state.sparkSession, path)
        path = last_written()

    def finish(s: pa.Table, g: pa.Table) -> pa.Table:
        kernel, q = problems(s)
        return kernel.results(s.column("symbol")[0].as_py(), q, joined(g))
    return state.groupBy("symbol", "setting").cogroup(one_pass(state, True).groupBy("symbol", "setting")).applyInArrow(finish, MODELS)


def svm_fit(prep: DataFrame, cols: list[str], grid: list[dict], n_folds: int = 5, params: SvmParams = SvmParams()) -> DataFrame:
    """A row per (symbol, grid point), a written table: kernel, degree, gamma, C, n_components and
    kernel_error (null for an exact map), cv_accuracy, test_accuracy (the full-train model on the test rows), converged and
    passes (the most of the point's problems) and the weights of the full-train model."""
    kernels = [Kernel(len(cols), s, points, n_folds, params) for s, points in _settings(grid).items()]
    dealt = deal(prep.select("symbol", "bar_no", "movement", "fold", "is_train", *cols), params.per_shard)
    models = _solve_whole(dealt.where("shards = 1").drop("shards", "shard"), cols, kernels, params.max_passes)
    wide = dealt.where("shards > 1")
    if any_rows(wide):
        models = models.unionByName(_solve_wide(wide, cols, kernels, params.max_passes))
    return cut_lineage(models, "svm-models")


def svm_cv(prep: DataFrame, cols: list[str], grid: list[dict], n_folds: int = 5, params: SvmParams = SvmParams()) -> DataFrame:
    """``svm_fit`` without the weights."""
    return svm_fit(prep, cols, grid, n_folds, params).drop("weights")
