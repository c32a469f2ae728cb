"""Attributions of boosted trees and of any model, for every row (XAI2, XAI3).

**Trees** - exact path-dependent Shapley values.  A leaf's path asks for each of its d features (d is at most the
depth) whether the row's value lies in an interval; a feature left out is followed by the share of the cover.
With o_j = 1 if the row meets feature j and z_j = the product of its cover shares, the leaf gives feature i

    value * (o_i - z_i) * sum over sets S of the other features of |S|! (d-1-|S|)! / d! * prod_S o_j * prod_not S z_j.

The sum over S is read off the coefficients of prod_j (o_j x + z_j).  As o has only 2^d patterns, every leaf
has a table of 2^d x d contributions; a row is looked up by its pattern, which is put together for all leaves of a tree from
one table per feature and bin.  Rows go through Arrow in batches.

**Any model** - kernel attributions: the background is ``k`` weighted k-means centres (MLlib, over all rows); a
coalition keeps some features of the row and takes the others from the centres; the attributions are the weighted
least squares fit to the coalitions' values that adds up to f(x) - E f.  The coalitions are the same for all
rows, so the fit is one matrix, made once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.boosting import BoostedModel, Tree
from tidemark.models.features import assemble, fill_zero

CELLS = 1 << 18
ROWS_PER_TASK, LEAST_ROWS = 8192, 512


def leaf_paths(tree: Tree) -> list[tuple[float, dict[int, tuple[int, int, float]]]]:
    """(value, {feature: (lowest bin, highest bin, share of the cover)}) of each leaf."""
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        f = int(tree.feature[node])
        if f < 0:
            out.append((float(tree.value[node]), path))
            continue
        low, high, share = path.get(f, (0, 1 << 30, 1.0))
        cut = int(tree.bin[node])
        for child, bounds in ((int(tree.left[node]), (low, min(high, cut))), (int(tree.right[node]), (max(low, cut + 1), high))):
            stack.append((child, path | {f: (*bounds, share * tree.cover[child] / tree.cover[node])}))
    return out


def _tables(values: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """(leaf, pattern, feature) contributions of leaves with d features each."""
    leaves, d = shares.shape
    pattern = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
    weight = [math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)]
    out = np.empty((leaves, 1 << d, d))
    for i in range(d):
        poly = np.zeros((leaves, 1 << d, d))
        poly[:, :, 0] = 1.0
        for j in range(d):
            if j != i:
                grown = poly * shares[:, None, j:j + 1]
                grown[:, :, 1:] += poly[:, :, :-1] * pattern[None, :, j:j + 1]
                poly = grown
        out[:, :, i] = values[:, None] * (pattern[None, :, i] - shares[:, None, i]) * (poly @ weight)
    return out


class TreeAttributions:
    """Attributions of a boosted model's margins: ``base`` per class, and ``of(bins)`` as (row, class, feature)."""

    def __init__(self, model: BoostedModel):
        self.model, self.trees = model, []
        self.base = np.zeros(model.classes)
        width = max((len(c) for c in model.cuts), default=0) + 1
        for trees in model.trees:
            for k, tree in enumerate(trees):
                leaves = leaf_paths(tree)
                self.base[k] += sum(value * math.prod(share for _, _, share in path.values()) for value, path in leaves)
                if leaves := [leaf for leaf in leaves if leaf[1]]:
                    self.trees.append((k, *self._tree(leaves, width)))

    @staticmethod
    def _tree(leaves: list, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(features of the tree; per feature and bin, the pattern bits of every leaf; contributions by leaf and pattern, and
        which feature each goes to)."""
        d = max(len(path) for _, path in leaves)
        used = sorted({f for _, path in leaves for f in path})
        bits = np.zeros((len(used), width, len(leaves)), dtype=np.min_scalar_type((1 << d) - 1))
        table, goes_to = np.zeros((len(leaves), 1 << d, d)), np.zeros((len(leaves), d, len(used)))
        by_size: dict[int, list[int]] = {}
        for i, (_, path) in enumerate(leaves):
            by_size.setdefault(len(path), []).append(i)
            for j, (f, (low, high, _)) in enumerate(path.items()):
                bits[used.index(f), low:high + 1, i] |= 1 << j
                goes_to[i, j, used.index(f)] = 1.0
        for size, at in by_size.items():
            shares = np.array([[share for _, _, share in leaves[i][1].values()] for i in at])
            table[at, :1 << size, :size] = _tables(np.array([leaves[i][0] for i in at]), shares)
        return np.array(used), bits, table.reshape(-1, d), goes_to.reshape(-1, len(used))

    def of(self, bins: np.ndarray) -> np.ndarray:
        n = len(bins)
        out = np.zeros((n, self.model.classes, len(self.model.features)))
        for k, used, bits, table, goes_to in self.trees:
            leaves, d = bits.shape[2], table.shape[1]
            first, step = np.arange(leaves) << d, max(1, CELLS // (leaves * d))
            for lo in range(0, n, step):
                part = bins[lo:lo + step]
                pattern = bits[0].take(part[:, used[0]], axis=0)
                for own, f in zip(bits[1:], used[1:], strict=True):
                    pattern |= own.take(part[:, f], axis=0)
                given = table.take(pattern + first, axis=0)
                out[lo:lo + step, k, used] += given.reshape(len(part), leaves * d) @ goes_to
        return out


def tree_attributions(df: DataFrame, model: BoostedModel, key: str = "row_id") -> DataFrame:
    """(key, class, base, margin, attributions): one row per row and class; attributions in the model's feature order."""
    explain = TreeAttributions(model)
    kind = dict(df.dtypes)[key]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                bins = model.binned([np.asarray(c, dtype=np.float64) for c in part.columns[1:]])
                given, margins = explain.of(bins), model.margins(bins)
                keys = part.column(0).take(pa.array(np.repeat(np.arange(len(bins)), model.classes)))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.tile(np.arange(model.classes, dtype=np.int32), len(bins))), pa.array(np.tile(explain.base, len(bins))),
                     pa.array(margins.ravel()), pa.array(list(given.reshape(-1, given.shape[2])), pa.list_(pa.float64()))],
                    names=[key, "class", "base", "margin", "attributions"])

    rows = fill_zero(df.select(key, *model.features), model.features)
    return rows.mapInArrow(run, f"{key} {kind}, class int, base double, margin double, attributions array<double>")


def importance(attributions: DataFrame, features: Sequence[str], top: int = 10) -> DataFrame:
    """XAI4: mean absolute attribution per feature over all rows (and classes), the largest ``top`` with share %."""
    names = F.array(*[F.lit(f) for f in features])
    means = attributions.select(F.posexplode("attributions").alias("at", "value")) \
        .groupBy(F.get(names, F.col("at")).alias("feature")).agg(F.avg(F.abs("value")).alias("mean_abs_attribution"))
    best = means.orderBy(F.col("mean_abs_attribution").desc(), "feature").limit(top)
    total = best.agg(F.sum("mean_abs_attribution").alias("total"))
    return best.crossJoin(F.broadcast(total)).select(  # one row
        "feature", "mean_abs_attribution", F.try_divide(F.col("mean_abs_attribution") * 100, F.col("total")).alias("share_pct"))


def coalitions(n_features: int, samples: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Feature sets (0/1 rows) and weights.  Sizes are taken whole, smallest and largest first, while the samples
    suffice; the rest are drawn with their complements in the proportions of the kernel and share its remaining
    weight."""
    m = n_features
    sizes = [s for s in range(1, m // 2 + 1)]
    mass = {s: (m - 1) / (s * (m - s)) * (1 if 2 * s == m else 2) for s in sizes}
    total = sum(mass.values())
    rows, weights, left = [], [], samples
    while sizes:
        s = sizes[0]
        members = list(combinations(range(m), s)) if math.comb(m, s) <= left else None
        count = math.comb(m, s) * (1 if 2 * s == m else 2)
        if members is None or count > left:
            break
        for members_of in members:
            z = np.zeros(m)
            z[list(members_of)] = 1
            for row in ([z] if 2 * s == m else [z, 1 - z]):
                rows.append(row)
                weights.append(mass[s] / total / count)
        left -= count
        sizes.pop(0)
    if sizes and left >= 2:
        rng = np.random.default_rng(seed)
        rest = np.array([mass[s] for s in sizes])
        drawn: dict[bytes, list] = {}
        for _ in range(left // 2):
            z = np.zeros(m)
            z[rng.choice(m, int(rng.choice(sizes, p=rest / rest.sum())), replace=False)] = 1
            for row in (z, 1 - z):
                drawn.setdefault(row.tobytes(), [row, 0])[1] += 1
        times = sum(n for _, n in drawn.values())
        for row, n in drawn.values():
            rows.append(row)
            weights.append(rest.sum() / total * n / times)
    return np.array(rows).reshape(-1, m), np.array(weights)


def kernel_solver(sets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Matrix from the coalitions' values (less the share of the last feature) to all attributions but the last."""
    reduced = sets[:, :-1] - sets[:, -1:]
    weighted = reduced * weights[:, None]
    return np.linalg.pinv(reduced.T @ weighted) @ weighted.T


def background(df: DataFrame, features: Sequence[str], k: int = 10, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """k-means centres over all rows, and the shares of rows they stand for."""
    x = assemble(fill_zero(df.select(*features), features), features, "_x").select("_x")
    fitted = KMeans(k=k, seed=seed, featuresCol="_x").fit(x)
    return np.array(fitted.clusterCenters()), np.array(fitted.summary.clusterSizes) / sum(fitted.summary.clusterSizes)


def kernel_attributions(df: DataFrame, predict: Callable[[np.ndarray], np.ndarray], features: Sequence[str],
                        centres: np.ndarray, shares: np.ndarray, samples: int = 100, key: str = "row_id", seed: int = 42,
                        coalition_values: Callable | None = None) -> DataFrame:
    """(key, base, prediction, attributions) of every row; ``predict`` takes a matrix of the features.

    ``coalition_values`` (sets, centres, shares) is for models that know a shorter way to the coalitions' values: it gives a function
    from the matrix to their (row, set) means over the centres, as ``predict`` would give them."""
    feats = list(features)
    base = float(shares @ predict(centres))
    sets, weights = coalitions(len(feats), samples, seed) if len(feats) > 1 else (np.zeros((0, 1)), np.zeros(0))
    solver = kernel_solver(sets, weights) if len(feats) > 1 else None
    kind = dict(df.dtypes)[key]

    def mixed_values(x: np.ndarray) -> np.ndarray:
        values = np.zeros((len(x), len(sets)))
        for centre, share in zip(centres, shares, strict=True):
            mixed = np.where(sets[None, :, :] > 0, x[:, None, :], centre)
            values += share * predict(mixed.reshape(-1, x.shape[1])).reshape(len(x), -1)
        return values

    values_of = mixed_values if coalition_values is None or solver is None else coalition_values(sets, centres, shares)

    def explain(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fx = predict(x)
        gap = fx - base
        if solver is None:
            return fx, gap[:, None]
        first = (values_of(x) - base - gap[:, None] * sets[:, -1]) @ solver.T
        return fx, np.concatenate([first, (gap - first.sum(axis=1))[:, None]], axis=1)

    def run(batches):
        step = max(1, 8 * CELLS // max(1, len(sets) * len(feats)))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                fx, given = explain(np.stack([np.asarray(c, dtype=np.float64) for c in part.columns[1:]], axis=1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(fx), base)), pa.array(fx),
                                                  pa.array(list(given), pa.list_(pa.float64()))], names=[key, "base", "prediction", "attributions"])

    rows = fill_zero(df.select(key, *feats), feats)
    n = rows.count()  # a few numbers a row are read as one task, but cost as much as many: they are dealt by rows, not bytes
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-n // ROWS_PER_TASK), min(cores, -(-n // LEAST_ROWS)))
    return rows.repartition(tasks, key).mapInArrow(run, f"{key} {kind}, base double, prediction double, attributions array<double>")
