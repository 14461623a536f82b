"""Networks with one hidden layer, trained by mini-batches.

A network has ReLU units with dropout and one sigmoid output. It is trained by
stochastic gradient descent with momentum on the cross-entropy, in mini-batches
of 32 reshuffled every epoch. Training of a network stops when its training loss
has not fallen for ``patience`` epochs; the weights of its best epoch count.

All networks of a series are trained side by side on the same batches. Grid
points that differ in the number of epochs only are one network looked at after
10, 20, ... epochs: start weights and draws are seeded by series and size, so
the shorter run is the beginning of the longer one.

A series of one shard (see ``shards``) is trained by one task. Of a wider series
every shard runs an epoch from the common weights, which are then averaged by
rows, as are the losses; the state of each such series is a row of a written
table, and only rows of series with an open network are read again.
"""

from __future__ import annotations

import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricetrend.models.shards import PER_SHARD, add_up, any_rows, by_bucket, chunks, deal, every_shard, joined, of_open, packed
from pricetrend.session import cut_lineage, last_written, release_table

# The study's ANN grid and its patience; the batch size is its library's default.
MLP_GRID = {
    "n_neurons": [10, 20, 30, 40],
    "epochs": [10, 20, 30, 40],
    "lr": [0.01],
    "momentum": [0.1, 0.2, 0.3],
    "dropout_rate": [0.5],
}
PATIENCE = 3
BATCH = 32

MODELS = ("symbol string, grid_index int, n_neurons int, epochs int, lr double, momentum double, dropout_rate double, "
          "epochs_used int, best_epoch int, train_loss double, weights array<double>, shards int")


def mlp_grid(grid: dict = MLP_GRID) -> list[dict]:
    return [dict(zip(MLP_GRID, v)) for v in itertools.product(*[grid[k] for k in MLP_GRID])]


@dataclass(frozen=True)
class MlpParams:
    seed: int = 42
    patience: int = PATIENCE
    batch: int = BATCH
    per_shard: int = PER_SHARD


def unpack(w: np.ndarray, d: int, h: int) -> tuple[np.ndarray, ...]:
    """Hidden weights and biases, output weights and bias of flat weights (networks x values)."""
    return w[:, :d * h].reshape(-1, d, h), w[:, d * h:d * h + h], w[:, d * h + h:d * h + 2 * h], w[:, -1]


class Networks:
    """The distinct networks of a grid. Smaller ones are filled up with units of weight zero,
    which stay zero: nothing flows through them."""

    def __init__(self, grid: list[dict], d: int, params: MlpParams):
        key = lambda p: (p["n_neurons"], p["lr"], p["momentum"], p["dropout_rate"])
        self.nets = sorted({key(p) for p in grid})
        self.points = [(self.nets.index(key(p)), p["epochs"]) for p in grid]
        self.until = np.array([max(e for n, e in self.points if n == i) for i in range(len(self.nets))])
        self.looks = sorted({e for _, e in self.points})
        self.d, self.h, self.p, self.grid = d, max(n for n, *_ in self.nets), params, grid
        self.k = d * self.h + 2 * self.h + 1
        self.size, self.lr, self.momentum, self.drop = (np.array(c) for c in zip(*self.nets))

    def _draws(self, symbol: str | None, *more: int) -> dict[int, np.random.Generator]:
        """A generator for each hidden size, so that a network doesn't depend on the rest of the grid."""
        name = zlib.crc32((symbol or "").encode())
        return {int(n): np.random.default_rng([self.p.seed, name, int(n), *more]) for n in np.unique(self.size)}

    def start(self, symbol: str | None) -> np.ndarray:
        """Uniform start weights within sqrt(6 / (inputs + outputs)) of a layer, biases zero."""
        w = np.zeros((len(self.nets), self.k))
        w1, _, w2, _ = unpack(w, self.d, self.h)
        for n, rng in self._draws(symbol).items():
            a = rng.uniform(-1, 1, (self.d, n)) * np.sqrt(6 / (self.d + n))
            b = rng.uniform(-1, 1, n) * np.sqrt(6 / (n + 1))
            w1[self.size == n, :, :n], w2[self.size == n, :n] = a, b
        return w

    def epoch(self, w: np.ndarray, v: np.ndarray, live: np.ndarray, x: np.ndarray, y: np.ndarray, symbol: str | None, epoch: int, shard: int) -> np.ndarray:
        """One pass in mini-batches; changes the weights and velocities of the live networks
        and returns the sums of their losses."""
        rng = self._draws(symbol, epoch, shard)
        order = np.random.default_rng([self.p.seed, zlib.crc32((symbol or "").encode()), epoch, shard]).permutation(len(x))
        on = np.flatnonzero(live)
        at, vel = w[on], v[on]
        w1, b1, w2, b2 = unpack(at, self.d, self.h)
        grad = np.empty_like(at)
        g1, gb1, g2, gb2 = unpack(grad, self.d, self.h)
        lr, momentum, drop, size = self.lr[on, None], self.momentum[on, None], self.drop[on, None, None], self.size[on]
        loss = np.zeros(len(on))
        for i in range(0, len(x), self.p.batch):
            pick = order[i:i + self.p.batch]
            xb, yb = x[pick], y[pick]
            u = np.zeros((len(on), len(pick), self.h))
            for n, r in rng.items():
                u[size == n, :, :n] = r.random((len(pick), n))      # drawn for every size, live or not
            keep = (u >= drop) / (1 - drop)
            z = xb @ w1 + b1[:, None, :]
            hidden = np.maximum(z, 0) * keep
            out = (hidden @ w2[:, :, None])[:, :, 0] + b2[:, None]
            loss += (np.logaddexp(0, out) - yb * out).sum(1)
            e = (1 / (1 + np.exp(-np.clip(out, -500, 500))) - yb) / len(pick)
            back = e[:, :, None] * w2[:, None, :] * keep * (z > 0)
            g1[:], gb1[:] = xb.T @ back, back.sum(1)
            g2[:], gb2[:] = (e[:, None, :] @ hidden)[:, 0], e.sum(1)
            vel *= momentum
            vel -= lr * grad
            at += vel
        w[on], v[on] = at, vel
        out = np.zeros(len(self.nets))
        out[on] = loss
        return out


class Training:
    """Weights, velocities and stopping state of the networks of one series."""

    FIELDS = ("best_loss", "wait", "best_epoch", "used", "open")

    def __init__(self, nets: Networks, w: np.ndarray):
        n = len(nets.nets)
        self.nets, self.w, self.v, self.best_w = nets, w, np.zeros_like(w), w.copy()
        self.best_loss, self.wait, self.best_epoch, self.used = np.full(n, np.inf), np.zeros(n), np.zeros(n), np.zeros(n)
        self.open = np.ones(n)
        # What each network had come to at every number of epochs that the grid asks for.
        self.seen = np.zeros((len(nets.looks), n, nets.k + 3))

    def learn(self, epoch: int, loss: np.ndarray) -> None:
        """Take the mean training losses of an epoch (from 1): remember the best, count the rest, stop."""
        live = self.open > 0
        better = live & (loss < self.best_loss)
        self.best_w[better], self.best_loss[better], self.best_epoch[better] = self.w[better], loss[better], epoch
        self.wait[live] += 1
        self.wait[better] = 0
        self.used[live] = epoch
        self.open[live & ((self.wait >= self.nets.p.patience) | (epoch >= self.nets.until))] = 0
        about = np.stack([self.used, self.best_epoch, self.best_loss], axis=1)
        for i, e in enumerate(self.nets.looks):
            if epoch <= e:
                self.seen[i] = np.concatenate([self.best_w, about], axis=1)

    def pack(self) -> bytes:
        return packed(np.concatenate([a.ravel() for a in (self.w, self.v, self.best_w, *(getattr(self, f) for f in self.FIELDS), self.seen)]))

    @classmethod
    def unpack(cls, nets: Networks, data: bytes) -> Training:
        n, flat = len(nets.nets), np.frombuffer(data, "<f8")
        out = cls(nets, np.zeros((n, nets.k)))
        at = 0
        for name in ("w", "v", "best_w", *cls.FIELDS, "seen"):
            a = getattr(out, name)
            setattr(out, name, flat[at:at + a.size].reshape(a.shape).copy())
            at += a.size
        return out

    def models(self, symbol: str | None, shards: int) -> pa.Table:
        """A row for each grid point."""
        nets, rows = self.nets, []
        for i, ((net, epochs), p) in enumerate(zip(nets.points, nets.grid)):
            s, n = self.seen[nets.looks.index(epochs), net], p["n_neurons"]
            w1, b1, w2, b2 = (a[0] for a in unpack(s[None, :nets.k], nets.d, nets.h))
            w = np.concatenate([w1[:, :n].ravel(), b1[:n], w2[:n], [b2]])
            rows.append((symbol, i, n, epochs, float(p["lr"]), float(p["momentum"]), float(p["dropout_rate"]),
                         int(s[nets.k]), int(s[nets.k + 1]), float(s[nets.k + 2]), w.tolist(), shards))
        names = [f.split()[0] for f in MODELS.split(", ")]
        types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 3, pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.int32()]
        return pa.table({c: pa.array(list(v), t) for c, v, t in zip(names, zip(*rows), types)})


def features(g: pa.Table, cols: list[str]) -> np.ndarray:
    """Feature matrix of a group; a missing value counts as zero (the mean, as features are scaled)."""
    return np.nan_to_num(np.stack([g.column(c).to_numpy().astype(np.float64) for c in cols], axis=1)) if g.num_rows else np.zeros((0, len(cols)))


def probability(x: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    w1, b1, w2, b2 = (a[0] for a in unpack(np.asarray(weights)[None], x.shape[1], n))
    return 1 / (1 + np.exp(-np.clip(np.maximum(x @ w1 + b1, 0) @ w2 + b2, -500, 500)))


def _train_whole(rows: DataFrame, cols: list[str], nets: Networks) -> DataFrame:
    def fit(g: pa.Table) -> pa.Table:
        g = g.sort_by("bar_no")
        symbol, x, y = g.column("symbol")[0].as_py(), features(g, cols), g.column("movement").to_numpy().astype(np.float64)
        t = Training(nets, nets.start(symbol))
        epoch = 0
        while t.open.any():
            epoch += 1
            t.learn(epoch, nets.epoch(t.w, t.v, t.open > 0, x, y, symbol, epoch, 0) / len(x))
        return t.models(symbol, 1)

    return rows.groupBy("symbol").applyInArrow(fit, MODELS)


def _train_wide(rows: DataFrame, cols: list[str], nets: Networks) -> DataFrame:
    """Epoch by epoch: shards run from the common state, which is averaged between epochs."""
    state_schema = "symbol string, shards int, open int, state binary"
    n, k = len(nets.nets), nets.k

    def begin(g: pa.Table) -> pa.Table:
        symbol = g.column("symbol")[0].as_py()
        return _state(symbol, g.column("shards")[0].as_py(), Training(nets, nets.start(symbol)))

    def _state(symbol, shards, t: Training) -> pa.Table:
        return pa.table({"symbol": pa.array([symbol], pa.string()), "shards": pa.array([shards], pa.int32()),
                         "open": pa.array([int(t.open.any())], pa.int32()), "state": pa.array([t.pack()], pa.binary())})

    rows = by_bucket(rows)
    state = cut_lineage(rows.select("symbol", "shards").distinct().groupBy("symbol").applyInArrow(begin, state_schema), "mlp-state")
    path = last_written()
    for epoch in range(1, int(nets.until.max()) + 1):
        live = state.where("open = 1")
        if not any_rows(live):
            break

        def run(g: pa.Table, s: pa.Table) -> pa.Table:
            out: dict[str, list] = {"symbol": [], "shard": [], "chunk": [], "sums": []}
            if g.num_rows and s.num_rows:
                g = g.sort_by("bar_no")
                symbol, shard = g.column("symbol")[0].as_py(), g.column("shard")[0].as_py()
                t = Training.unpack(nets, s.column("state")[0].as_py())
                x, y = features(g, cols), g.column("movement").to_numpy().astype(np.float64)
                loss = nets.epoch(t.w, t.v, t.open > 0, x, y, symbol, epoch, shard)
                for i, b in enumerate(chunks(np.concatenate([[len(x)], loss, (len(x) * t.w).ravel(), (len(x) * t.v).ravel()]))):
                    for c, value in zip(out, (symbol, shard, i, b)):
                        out[c].append(value)
            return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.string(), pa.int32(), pa.int32(), pa.binary()))})

        def step(s: pa.Table, g: pa.Table) -> pa.Table:
            t = Training.unpack(nets, s.column("state")[0].as_py())
            if g.num_rows:
                v = joined(g)
                on, count = t.open > 0, v[0]
                t.w[on], t.v[on] = ((v[1 + n + i * n * k:1 + n + (i + 1) * n * k].reshape(n, k) / count)[on] for i in range(2))
                t.learn(epoch, v[1:1 + n] / count)
            return _state(s.column("symbol")[0].as_py(), s.column("shards")[0].as_py(), t)

        parts = (of_open(rows, live).groupBy("symbol", "shard").cogroup(every_shard(live).groupBy("symbol", "shard"))
                 .applyInArrow(run, "symbol string, shard int, chunk int, sums binary"))
        state = cut_lineage(state.groupBy("symbol").cogroup(add_up(parts, ["symbol"]).groupBy("symbol")).applyInArrow(step, state_schema), "mlp-state")
        release_table(state.sparkSession, path)
        path = last_written()

    def finish(g: pa.Table) -> pa.Table:
        return Training.unpack(nets, g.column("state")[0].as_py()).models(g.column("symbol")[0].as_py(), g.column("shards")[0].as_py())
    return state.groupBy("symbol").applyInArrow(finish, MODELS)


def mlp_fit(dealt: DataFrame, cols: list[str], grid: list[dict], params: MlpParams = MlpParams()) -> DataFrame:
    """The fitted network of every (symbol, grid point), with epochs used, best epoch and its training loss.

    ``dealt`` is a table of ``shards.deal`` with movement and is_train; series without training rows have no model.
    """
    nets = Networks(grid, len(cols), params)
    train = dealt.where("is_train").select("symbol", "bar_no", "movement", "shards", "shard", *cols)
    models = _train_whole(train.where("shards = 1"), cols, nets)
    wide = train.where("shards > 1")
    if any_rows(wide):
        models = models.unionByName(_train_wide(wide, cols, nets))
    return cut_lineage(models, "mlp-models")


def mlp_accuracy(dealt: DataFrame, cols: list[str], models: DataFrame) -> DataFrame:
    """``models`` (without weights) with the accuracy on the test rows; class 1 iff P(1) > 0.5."""
    def count(g: pa.Table, m: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if g.num_rows and m.num_rows:
            x, y = features(g, cols), g.column("movement").to_numpy()
            for i, n, w in zip(*(m.column(c).to_pylist() for c in ("grid_index", "n_neurons", "weights"))):
                for c, v in zip(out, (g.column("symbol")[0].as_py(), i, int(((probability(x, w, n) > 0.5) == (y == 1)).sum()), len(x))):
                    c.append(v)
        return pa.table({"symbol": pa.array(out[0], pa.string()), "grid_index": pa.array(out[1], pa.int32()), "correct": pa.array(out[2], pa.int64()), "n": pa.array(out[3], pa.int64())})

    test = dealt.where("is_test").select("symbol", "shard", "movement", *cols)
    each = every_shard(models.select("symbol", "grid_index", "n_neurons", "weights", "shards"))
    scored = (test.groupBy("symbol", "shard").cogroup(each.groupBy("symbol", "shard")).applyInArrow(count, "symbol string, grid_index int, correct long, n long")
              .groupBy("symbol", "grid_index").agg((F.sum("correct") / F.sum("n")).alias("accuracy")))
    scored = scored.select(F.col("symbol").alias("_its"), F.col("grid_index").alias("_index"), "accuracy")
    same = F.col("symbol").eqNullSafe(F.col("_its")) & (F.col("grid_index") == F.col("_index"))
    return models.drop("weights", "shards").join(scored, same, "left").drop("_its", "_index")


def mlp_scores(prep: DataFrame, cols: list[str], grid: list[dict], params: MlpParams = MlpParams()) -> DataFrame:
    """Test accuracy per (symbol, grid_index), with the grid point and how its training went."""
    dealt = deal(prep.select("symbol", "bar_no", "movement", "is_train", "is_test", *cols), params.per_shard)
    return mlp_accuracy(dealt, cols, mlp_fit(dealt, cols, grid, params))
