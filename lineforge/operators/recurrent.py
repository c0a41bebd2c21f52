"""A recurrent network for the sequence forecast, trained data-parallel.

Two LSTM layers and two dense ones over an account's months.  The training sequences are packed in
blocks, a written table.  In each epoch every task runs its blocks forward and back through the
network as it stands and adds up the gradient; the tasks' sums meet slice by slice, and the driver
takes one Adam step with the total, which has the size of the network.  The same job gives the
validation rows' loss, on which training stops; the best weights are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

BLOCK = 1024     # sequences of a block
CHUNK = 256      # of them that go through the network at once
SLICE = 4096     # numbers of the gradient that travel together


@dataclass
class RecurrentSettings:
    first: int = 64          # units of the layers
    second: int = 32
    dense: int = 16
    dropout: float = 0.3     # after each recurrent layer
    epochs: int = 100
    patience: int = 15
    rate: float = 0.01
    clip: float = 1.0        # length of the gradient
    val_share: float = 0.15
    seed: int = 42


def shapes(channels: int, s: RecurrentSettings) -> dict[str, tuple]:
    return {"x1": (channels, 4 * s.first), "h1": (s.first, 4 * s.first), "b1": (4 * s.first,),
            "x2": (s.first, 4 * s.second), "h2": (s.second, 4 * s.second), "b2": (4 * s.second,),
            "w3": (s.second, s.dense), "b3": (s.dense,), "w4": (s.dense, 1), "b4": (1,)}


def initial(channels: int, s: RecurrentSettings) -> np.ndarray:
    """Uniform weights by the layers' sizes; the forget gates start open."""
    rng, out = np.random.default_rng(s.seed), []
    for name, shape in shapes(channels, s).items():
        if len(shape) == 1:
            w = np.zeros(shape)
            if name in ("b1", "b2"):
                w[shape[0] // 4:shape[0] // 2] = 1.0
        else:
            span = np.sqrt(6.0 / (shape[0] + shape[1] / (4 if name[0] in "xh" else 1)))
            w = rng.uniform(-span, span, shape)
        out.append(w.ravel())
    return np.concatenate(out)


def unpack(flat: np.ndarray, channels: int, s: RecurrentSettings) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(channels, s).items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def _scaled(w: np.ndarray) -> np.ndarray:
    """Weights of the gates for exp(-z): tanh(z) = 2 sigmoid(2 z) - 1, so the cell's are doubled (which is
    exact) and one exponential does for all gates."""
    units = w.shape[-1] // 4
    scale = np.full(w.shape[-1], -1.0)
    scale[2 * units:3 * units] = -2.0
    return w * scale


def _logistic(minus_z: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-z)), in place."""
    with np.errstate(over="ignore"):  # far on the negative side it is 0
        np.exp(minus_z, out=minus_z)
    minus_z += 1.0
    return np.divide(1.0, minus_z, out=minus_z)


def _tanh(x: np.ndarray) -> np.ndarray:
    out = _logistic(-2.0 * x)
    out *= 2.0
    out -= 1.0
    return out


def _lstm(x, wx, wh, b):
    """Outputs (steps, units, rows) and what the way back needs, of ``x`` (steps, channels, rows): a gate's
    values of all rows lie side by side.  Gates: in, forget, cell, out."""
    steps, n, units = x.shape[0], x.shape[2], wh.shape[0]
    z_all = np.matmul(_scaled(wx).T, x)
    z_all += _scaled(b)[:, None]
    back = np.ascontiguousarray(_scaled(wh).T)
    c, out, kept = np.zeros((units, n)), np.empty((steps, units, n)), []
    for t in range(steps):
        z = z_all[t]
        if t:
            z += back @ out[t - 1]
        _logistic(z)
        i, f, g, o = z[:units], z[units:2 * units], z[2 * units:3 * units], z[3 * units:]
        g *= 2.0
        g -= 1.0
        new = f * c + i * g
        tc = _tanh(new)
        kept.append((i, f, g, o, c, tc))
        c = new
        np.multiply(o, tc, out=out[t])
    return out, kept


def _lstm_back(d_out, x, out, kept, wx, wh, with_input: bool = True):
    """Gradients of input (if asked for) and weights from those of all outputs."""
    steps, units, n = d_out.shape
    z_all = np.empty((steps, 4 * units, n))
    d_h, d_c = 0.0, 0.0
    for t in range(steps - 1, -1, -1):
        i, f, g, o, c, tc = kept[t]
        d, z = d_out[t] + d_h, z_all[t]
        d_c = d_c + d * o * (1 - tc * tc)
        np.multiply(d_c * g, i * (1 - i), out=z[:units])
        np.multiply(d_c * c, f * (1 - f), out=z[units:2 * units])
        np.multiply(d_c * i, 1 - g * g, out=z[2 * units:3 * units])
        np.multiply(d * tc, o * (1 - o), out=z[3 * units:])
        if t:
            d_h, d_c = wh @ z, d_c * f
    turned = z_all.transpose(0, 2, 1)
    g_x = np.matmul(x, turned).sum(0)
    g_h = np.matmul(out[:-1], turned[1:]).sum(0)
    return np.matmul(wx, z_all) if with_input else None, g_x, g_h, z_all.sum((0, 2))


def _turned(x: np.ndarray, a: int) -> np.ndarray:
    """``CHUNK`` rows from ``a`` on of (rows, steps, channels), as (steps, channels, rows)."""
    return np.ascontiguousarray(x[a:a + CHUNK].transpose(1, 2, 0))


def forward(flat: np.ndarray, x: np.ndarray, s: RecurrentSettings) -> np.ndarray:
    """Normalised predictions, without dropout."""
    w, found = unpack(flat, x.shape[2], s), [np.zeros(0)]
    for a in range(0, len(x), CHUNK):
        one, _ = _lstm(_turned(x, a), w["x1"], w["h1"], w["b1"])
        two, _ = _lstm(one, w["x2"], w["h2"], w["b2"])
        found.append((np.maximum(two[-1].T @ w["w3"] + w["b3"], 0.0) @ w["w4"] + w["b4"])[:, 0])
    return np.concatenate(found)


def gradient(flat: np.ndarray, x: np.ndarray, y: np.ndarray, s: RecurrentSettings, rng=None) -> tuple[np.ndarray, float]:
    """(gradient, sum) of the squared errors; with ``rng`` units are dropped out.  Rows go through in
    chunks that stay in a core's cache."""
    w = unpack(flat, x.shape[2], s)
    drop = lambda shape: np.ones(shape) if rng is None else (rng.random(shape) >= s.dropout) / (1.0 - s.dropout)
    all1, all2 = drop((len(x), s.first)).T, drop((len(x), s.second)).T
    total, loss = {k: np.zeros(v) for k, v in shapes(x.shape[2], s).items()}, 0.0
    for a in range(0, len(x), CHUNK):
        rows, m1, m2 = _turned(x, a), np.ascontiguousarray(all1[:, a:a + CHUNK]), np.ascontiguousarray(all2[:, a:a + CHUNK])
        one, kept1 = _lstm(rows, w["x1"], w["h1"], w["b1"])
        fed = one * m1
        two, kept2 = _lstm(fed, w["x2"], w["h2"], w["b2"])
        last = two[-1] * m2
        z3 = w["w3"].T @ last + w["b3"][:, None]
        a3 = np.maximum(z3, 0.0)
        err = (w["w4"].T @ a3 + w["b4"][:, None])[0] - y[a:a + CHUNK]
        d = 2.0 * err
        g = {"w4": (a3 @ d)[:, None], "b4": d.sum(keepdims=True)}
        d3 = w["w4"] * d * (z3 > 0)
        g["w3"], g["b3"] = last @ d3.T, d3.sum(1)
        d_two = np.zeros_like(two)
        d_two[-1] = (w["w3"] @ d3) * m2
        d_fed, g["x2"], g["h2"], g["b2"] = _lstm_back(d_two, fed, two, kept2, w["x2"], w["h2"])
        d_fed *= m1
        _, g["x1"], g["h1"], g["b1"] = _lstm_back(d_fed, rows, one, kept1, w["x1"], w["h1"], False)
        for k, v in g.items():
            total[k] += v
        loss += float((err * err).sum())
    return np.concatenate([v.ravel() for v in total.values()]), loss


@dataclass
class RecurrentModel:
    """Weights and the scales of input and target."""
    weights: np.ndarray
    settings: RecurrentSettings
    x_mean: np.ndarray
    x_std: np.ndarray
    y_mean: float
    y_std: float
    losses: list[float] = field(default_factory=list)  # of the validation rows, by epoch

    def normalised(self, x: np.ndarray) -> np.ndarray:
        return (x - self.x_mean) / self.x_std

    def raw(self, x: np.ndarray) -> np.ndarray:
        return forward(self.weights, self.normalised(x), self.settings) * self.y_std + self.y_mean


def _sequences(column, channels: int) -> np.ndarray:
    """(rows, steps, channels) of a list column that holds one channel after the other."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), channels, -1).transpose(0, 2, 1)


def fit_recurrent(seq: DataFrame, channels: int, order: list[str], settings: RecurrentSettings | None = None,
                  features: str = "features", target: str = "target") -> RecurrentModel:
    """Fits on ``seq`` (features: array, one channel after the other; target), stops by the tail of
    its rows in ``order``.  Sequences are of one length, without nulls."""
    from .matrix import positional_tail
    s = settings or RecurrentSettings()
    rows = positional_tail(seq.select(*order, F.col(features).alias("_x"), F.col(target).cast("double").alias("_y")), s.val_share, order, "_val")
    rows = materialise(rows, "recurrent-input")
    step = F.size("_x") / channels
    part = [F.slice(F.col("_x"), (F.lit(k) * step + 1).cast("int"), step.cast("int")) for k in range(channels)]
    stats = [rows.select(F.explode(p).alias("v")).agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).first() for p in part]
    of_y = rows.agg(F.avg("_y").alias("m"), F.stddev_pop("_y").alias("s"), F.count_if(~F.col("_val")).alias("n"),
                    F.count_if(F.col("_val")).alias("v")).first()
    model = RecurrentModel(initial(channels, s), s, np.array([float(r.m or 0.0) for r in stats]),
                           np.array([float(r.s or 0.0) + 1e-8 for r in stats]), float(of_y.m or 0.0), float(of_y.s or 0.0) + 1e-8)
    if not of_y.n:
        return model

    def pack(batches):
        for b in batches:
            x = model.normalised(_sequences(b.column("_x"), channels))
            y = (b.column("_y").to_numpy(zero_copy_only=False) - model.y_mean) / model.y_std
            val = b.column("_val").to_numpy(zero_copy_only=False)
            for held in (False, True):
                at = np.flatnonzero(val == held)
                for a in range(0, len(at), BLOCK):
                    k = at[a:a + BLOCK]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([held]), pa.array([len(k)], pa.int32()), pa.array([int(abs(y[k]).sum() * 1e6) & 0x7FFFFFFF], pa.int64()),
                        pa.array([x[k].tobytes()], pa.binary()), pa.array([y[k].tobytes()], pa.binary())], names=["val", "n", "seed", "x", "y"])

    blocks = materialise(rows.select("_x", "_y", "_val").mapInArrow(pack, "val boolean, n int, seed long, x binary, y binary"), "recurrent-blocks")
    # an epoch's work does not follow its bytes: the blocks are dealt out, not packed by size
    parts = max(1, min(-(-(of_y.n + of_y.v) // BLOCK), 4 * seq.sparkSession.sparkContext.defaultParallelism))
    blocks = blocks.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    flat, best = model.weights, (np.inf, model.weights)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for epoch in range(s.epochs + 1):
        total, loss, val_loss = _epoch(blocks, flat, channels, s, epoch)
        model.losses.append(val_loss / of_y.v if of_y.v else loss / of_y.n)
        if model.losses[-1] < best[0]:
            best = model.losses[-1], flat
        if len(model.losses) - 1 - int(np.argmin(model.losses)) >= s.patience:
            break
        g = total / of_y.n
        g *= min(1.0, s.clip / (np.linalg.norm(g) + 1e-12))
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        k = epoch + 1
        flat = flat - s.rate * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.999 ** k)) + 1e-8)
    blocks.unpersist()
    model.weights = best[1]
    return model


def _epoch(blocks: DataFrame, flat: np.ndarray, channels: int, s: RecurrentSettings, epoch: int):
    """(gradient, loss, validation loss), summed over all blocks by Spark."""
    size = len(flat)
    shared = blocks.sparkSession.sparkContext.broadcast(flat)  # of the network's size

    def run(batches):
        total, losses = np.zeros(size), np.zeros(2)
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in b.schema.names}
                x = np.frombuffer(r["x"]).reshape(r["n"], -1, channels)
                y = np.frombuffer(r["y"])
                if r["val"]:
                    losses[1] += ((forward(shared.value, x, s) - y) ** 2).sum()
                else:
                    g, loss = gradient(shared.value, x, y, s, np.random.default_rng([s.seed, epoch, r["seed"]]))
                    total += g
                    losses[0] += loss
        parts = {-1: losses} | {k: total[a:a + SLICE] for k, a in enumerate(range(0, size, SLICE))}
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(parts), pa.int32()), "body": pa.array([v.tobytes() for v in parts.values()], pa.binary())})

    def summed(key, t):
        body = sum(np.frombuffer(v) for v in t.column("body").to_pylist()).tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([body], pa.binary())], names=["part", "body"])

    rows = blocks.mapInArrow(run, "part int, body binary").groupBy("part").applyInArrow(summed, "part int, body binary").collect()
    shared.unpersist()
    got = {r.part: np.frombuffer(r.body) for r in rows}
    losses = got.pop(-1)
    return np.concatenate([got[k] for k in sorted(got)]), float(losses[0]), float(losses[1])


def predict_recurrent(model: RecurrentModel, seq: DataFrame, channels: int, floor: float | None = 0.0,
                      features: str = "features", out: str = "prediction") -> DataFrame:
    shared = seq.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(x):
        import pandas as pd
        rows = np.stack(x.to_numpy()).reshape(len(x), channels, -1).transpose(0, 2, 1) if len(x) else np.zeros((0, 1, channels))
        return pd.Series(shared.value.raw(rows))

    raw = scored(F.col(features))
    return seq.withColumn(out, raw if floor is None else F.greatest(raw, F.lit(floor)))
