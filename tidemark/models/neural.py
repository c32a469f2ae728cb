"""Neural stress regressor (ML6): a dense ReLU network trained by mini-batches inside partitions.

MLlib has no MLP regressor.  The scaled training rows are written once, dealt by a hash of their key into tasks
of ``rows_per_task`` rows.  An epoch is one job: every task starts from the same weights and Adam moments, goes
through its rows in a seeded order in batches of ``batch`` rows, and returns its weights, moments and
losses; they are averaged by rows in groups of tasks, then on the driver (parameter-sized vectors, never rows).
With one task this is plain mini-batch training; with many, parameter averaging once an epoch.

The validation loss of the weights that an epoch starts from comes with its job.  Training ends when it has
not improved for ``patience`` epochs (the best weights stay); the rate is halved after ``plateau`` epochs without
improvement, down to 1e-6.  Under ``MIN_SPLIT_ROWS`` rows all are trained on, for half the epochs, without
validation.  Scoring is a pandas UDF over the numeric columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.models.features import fill_zero, hash_split, population_scaler
from tidemark.session import discard, stored

MIN_SPLIT_ROWS = 10
ROWS_PER_TASK = 100_000
LEAST_RATE = 1e-6


def _init(sizes: Sequence[int], seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    params = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        params.append(rng.normal(0.0, np.sqrt(2.0 / a), size=(a, b)))  # He initialisation
        params.append(np.zeros(b))
    return params


def _flat(params: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params])


def _unflat(vec: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, k = [], 0
    for p in like:
        out.append(vec[k:k + p.size].reshape(p.shape))
        k += p.size
    return out


def _forward(params, x, dropout=0.0, rng=None):
    acts, masks = [x], []
    h = x
    n_layers = len(params) // 2
    for j in range(n_layers):
        w, b = params[2 * j], params[2 * j + 1]
        z = h @ w + b
        if j < n_layers - 1:
            h = np.maximum(z, 0.0)
            if dropout > 0 and rng is not None:
                m = (rng.random(h.shape) >= dropout) / (1.0 - dropout)
                h = h * m
                masks.append(m)
            else:
                masks.append(None)
        else:
            h = z
        acts.append(h)
    return acts, masks


def _gradients(params, x, y, dropout, rng):
    acts, masks = _forward(params, x, dropout, rng)
    pred = acts[-1][:, 0]
    err = pred - y
    grads = [None] * len(params)
    delta = (2.0 * err)[:, None]  # d(sum of squared error)/d(pred)
    n_layers = len(params) // 2
    for j in reversed(range(n_layers)):
        grads[2 * j] = acts[j].T @ delta
        grads[2 * j + 1] = delta.sum(axis=0)
        if j > 0:
            delta = delta @ params[2 * j].T
            if masks[j - 1] is not None:
                delta = delta * masks[j - 1]
            delta = delta * (acts[j] > 0)
    return float((err ** 2).sum()), grads


@dataclass
class NeuralModel:
    features: list[str]
    stats: dict
    params: list[np.ndarray]
    history: list[tuple[int, float, float]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions of a matrix of the features (not scaled)."""
        mean = np.array([self.stats[f][0] for f in self.features])
        scale = np.array([self.stats[f][1] for f in self.features])
        z = np.where(scale > 0, (x - mean) / np.where(scale > 0, scale, 1.0), 0.0)
        return _forward(self.params, z)[0][-1][:, 0]

    def coalition_values(self, sets: np.ndarray, centres: np.ndarray, shares: np.ndarray, cells: int = 1 << 16):
        """Function from a matrix of the features to its (row, set) mean predictions over the weighted centres, a row keeping
        the features of the set and taking the others from the centre.

        The first layer is linear: the row's part in it is worked out once for all centres, and the centres' part once."""
        mean = np.array([self.stats[f][0] for f in self.features])
        scale = np.array([self.stats[f][1] for f in self.features])
        weight = np.where(scale > 0, 1.0 / np.where(scale > 0, scale, 1.0), 0.0)
        (first, bias), rest = self.params[:2], self.params[2:]
        others = [(1 - sets) @ (((c - mean) * weight)[:, None] * first) + bias for c in centres]
        step = max(1, cells // max(1, first.shape[1] * len(sets)))

        def values(x: np.ndarray) -> np.ndarray:
            out = np.zeros((len(x), len(sets)))
            for lo in range(0, len(x), step):
                own = sets @ (((x[lo:lo + step] - mean) * weight)[:, :, None] * first)
                for other, share in zip(others, shares, strict=True):
                    h = (own + other).reshape(-1, first.shape[1])
                    for w, b in zip(rest[::2], rest[1::2], strict=True):
                        h = np.maximum(h, 0.0, out=h) @ w
                        h += b
                    out[lo:lo + step] += share * h[:, 0].reshape(-1, len(sets))
            return out

        return values

    def transform(self, df: DataFrame, out: str = "neural_network_prediction") -> DataFrame:
        feats = self.features
        x = fill_zero(df, feats)

        @F.pandas_udf(T.DoubleType())
        def score(*columns: pd.Series) -> pd.Series:
            return pd.Series(self.predict(np.column_stack([c.to_numpy(float) for c in columns])))

        return x.withColumn(out, score(*feats))  # only the numeric columns go to Python


class _Adam:
    """Weights with their moments, each one vector; ``params`` are views of the weights, ``step`` counts updates."""

    def __init__(self, state: np.ndarray, like: list[np.ndarray], step: int):
        self.flat, self.m, self.v = (part.copy() for part in np.array_split(state, 3))
        self.params = _unflat(self.flat, like)
        self.step = step

    def update(self, grads: list[np.ndarray], rate: float) -> None:
        self.step += 1
        g = _flat(grads)
        self.m *= 0.9
        self.m += 0.1 * g
        self.v *= 0.999
        self.v += 0.001 * g * g
        mh, vh = self.m / (1 - 0.9 ** self.step), self.v / (1 - 0.999 ** self.step)
        self.flat -= rate * mh / (np.sqrt(vh) + 1e-8)

    def state(self) -> np.ndarray:
        return np.concatenate([self.flat, self.m, self.v])


def _epoch(batches, state: np.ndarray, like: list[np.ndarray], step: int, epoch: int, rate: float, dropout: float, batch: int, seed: int):
    """One task's epoch: (rows, training loss, rows and loss of validation before the epoch, updates, new state)."""
    from pyspark import TaskContext

    data = [b for b in batches if b.num_rows]
    if not data:
        return
    x = np.concatenate([np.frombuffer(b"".join(b.column("x").to_pylist()), dtype="<f8").reshape(b.num_rows, -1) for b in data])
    y = np.concatenate([np.asarray(b.column("y")) for b in data])
    fit = np.concatenate([b.column("fit").to_numpy(zero_copy_only=False) for b in data])
    adam = _Adam(state, like, step)
    held = _forward(adam.params, x[~fit])[0][-1][:, 0] - y[~fit] if (~fit).any() else np.zeros(0)
    rng = np.random.default_rng([seed, epoch, TaskContext.get().partitionId()])
    order, loss = rng.permutation(np.flatnonzero(fit)), 0.0
    for lo in range(0, len(order), batch):
        rows = order[lo:lo + batch]
        own, grads = _gradients(adam.params, x[rows], y[rows], dropout, rng)
        loss += own
        adam.update([g / len(rows) for g in grads], rate)
    yield pa.RecordBatch.from_arrays(
        [pa.array([len(order)]), pa.array([loss]), pa.array([len(held)]), pa.array([float((held ** 2).sum())]),
         pa.array([adam.step - step]), pa.array([adam.state() * len(order)], pa.list_(pa.float64()))],
        names=["n", "loss", "held", "held_loss", "steps", "state"])


_EPOCH = "n long, loss double, held long, held_loss double, steps long, state array<double>"


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """The results of a group of tasks as one; states are weighted by rows already."""
    return pd.DataFrame({"n": [rows["n"].sum()], "loss": [rows["loss"].sum()], "held": [rows["held"].sum()],
                         "held_loss": [rows["held_loss"].sum()], "steps": [rows["steps"].max()],
                         "state": [np.sum(np.stack(rows["state"].to_list()), axis=0).tolist()]})


def fit_neural(df: DataFrame, features: Sequence[str], target: str = "weighted_stress_score",
               hidden: Sequence[int] = (64, 32, 16), dropout: float = 0.2, lr: float = 1e-3, epochs: int = 100,
               patience: int = 10, plateau: int = 5, batch: int = 32, seed: int = 42, rows_per_task: int = ROWS_PER_TASK,
               key: str = "row_id") -> NeuralModel:
    """Fits on the training split (80 % of the rows by ``hash_split``), a fifth of which validates."""
    feats = list(features)
    base = hash_split(fill_zero(df.select(key, *feats, target), feats + [target]), key=key)
    small = base.limit(MIN_SPLIT_ROWS).count() < MIN_SPLIT_ROWS
    train = base if small else base.where("is_train")
    scaled, stats = population_scaler(train, feats, "_z")
    fit = F.lit(True) if small else F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(100)) < 80
    zcols = [f"{c}_z" for c in feats]

    def packed(batches):
        for b in batches:
            x = np.ascontiguousarray(np.stack([np.asarray(c, dtype="<f8") for c in b.columns[2:]], axis=1))
            yield pa.RecordBatch.from_arrays([b.column("fit"), b.column("y"), pa.array([r.tobytes() for r in x], pa.binary())], names=["fit", "y", "x"])

    rows = scaled.select(fit.alias("fit"), F.col(target).alias("y"), *zcols, key)
    tasks = max(1, -(-scaled.count() // rows_per_task))
    data = stored(rows.repartition(tasks, key).drop(key).mapInArrow(packed, "fit boolean, y double, x binary"))
    like = _init([len(feats), *hidden, 1], seed)
    state = np.concatenate([_flat(like), np.zeros(2 * sum(p.size for p in like))])
    best, best_state, since_best, since_improve, step, history = np.inf, state, 0, 0, 0, []
    for epoch in range(1, (epochs // 2 if small else epochs) + 2):
        parts = data.mapInArrow(lambda b, s=state, k=step, e=epoch, r=lr: _epoch(b, s, like, k, e, r, dropout, batch, seed), _EPOCH)
        if tasks > 16:  # about sqrt(tasks) groups before the driver
            parts = parts.groupBy(F.pmod(F.xxhash64("loss", "held_loss"), F.lit(int(tasks ** 0.5))).alias("g")) \
                .applyInPandas(_add_up, _EPOCH)
        parts = parts.collect()
        n, held = sum(r["n"] for r in parts), sum(r["held"] for r in parts)
        if not n:
            break
        loss = sum(r["loss"] for r in parts) / n
        watched = sum(r["held_loss"] for r in parts) / held if held else loss
        history.append((epoch, loss, watched))  # the loss of the weights that this epoch began with
        if watched < best - 1e-12:
            best, best_state, since_best, since_improve = watched, state, 0, 0
        else:
            since_best, since_improve = since_best + 1, since_improve + 1
            if since_improve >= plateau:
                lr, since_improve = max(lr * 0.5, LEAST_RATE), 0
            if since_best >= patience and not small:
                break
        state = np.sum([np.array(r["state"]) for r in parts if r["n"]], axis=0) / n
        step += max(r["steps"] for r in parts)
    discard(data)
    return NeuralModel(feats, stats, _Adam(state if small else best_state, like, step).params, history)
