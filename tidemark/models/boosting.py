"""Multi-class softmax boosting (ML7): one tree per class and round, grown level by level.

Features are cut into at most ``bins`` bins at quantiles over all rows, once; the binned rows are written to
the shared folder.  One job per level sums gradients and hessians per (class, node, feature, bin), of two
sister nodes for the lighter one only (the other has the rest of their parent's sums, exactly): each task sums its own rows, a shuffle adds the sums up, and the driver, which sees (classes x nodes x features x bins)
numbers whatever the number of rows, picks the splits.  Gradients are rounded to multiples of 2^-26 before
they are summed, so any partitioning gives the same trees.

Objective as in the reference's model: softmax log-loss with p - y and 2 p (1 - p), L2 weight 1 on leaves, least
hessian 1 in a child, no split without gain.  Margins begin at 0.  Trees are flat arrays (``nodes``), which the
attributions and the stored form use as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.models.features import fill_zero
from tidemark.session import discard, stored

UNIT = float(1 << 26)
L2 = 1.0
MIN_HESSIAN = 1.0
MIN_GAIN = 1e-6
STORE_ROUNDS = 10
#: With many rows the margins are written more often: trees that are not yet in them are walked again at every level.
MANY_ROWS, MANY_STORE_ROUNDS = 100_000, 2
ROWS_PER_TASK = 100_000
LEAST_ROWS_PER_TASK = 20_000
FEW_TASKS = 16


@dataclass
class Tree:
    """Node i splits on ``feature[i]`` (-1: leaf): bins up to ``bin[i]`` go to ``left[i]``, others to ``right[i]``."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """Node that each row (of bin numbers) ends in."""
        inner = self.feature >= 0
        if not inner.any():
            return np.zeros(len(bins), dtype=np.int64)
        own = np.arange(len(inner))
        feature, most = np.maximum(self.feature, 0), np.where(inner, self.bin, 1 << 15).astype(np.int32)
        # children side by side; a leaf is its own child, so that all rows take as many steps
        child = np.stack([np.where(inner, self.left, own), np.where(inner, self.right, own)], axis=1).ravel()
        flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        at = np.zeros(len(bins), dtype=np.int64)
        for _ in range(self.depth()):
            at = child.take(2 * at + (flat.take(first + feature.take(at)) > most.take(at)))
        return at

    def depth(self) -> int:
        """Splits on the longest path."""
        level, steps = np.zeros(1, dtype=np.int64), 0
        while len(level := level[self.feature[level] >= 0]):
            level, steps = np.concatenate([self.left[level], self.right[level]]), steps + 1
        return steps


class _Growing:
    """A tree while its levels are added."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.value, self.cover = [-1], [0], [-1], [-1], [0.0], [0.0]
        self.open = [0]
        self.sisters: dict[int, tuple[int, int]] = {}  # open node: (its open sister, their parent)

    def asked(self) -> list[int]:
        """Open nodes whose sums are needed: all but the heavier of two sisters."""
        return [n for n in self.open if n not in self.sisters or (self.cover[n], n) < (self.cover[self.sisters[n][0]], self.sisters[n][0])]

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int64), np.array(self.bin, np.int64), np.array(self.left, np.int64),
                    np.array(self.right, np.int64), np.array(self.value), np.array(self.cover))

    def split(self, node: int, feature: int, at: int, sums: list[tuple[float, float]], rate: float) -> None:
        """Adds both children with their (gradient, hessian) sums; those that may split again are open."""
        self.feature[node], self.bin[node] = feature, at
        for side, (g, h) in zip((self.left, self.right), sums, strict=True):
            side[node] = len(self.feature)
            for column, first in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1)):
                column.append(first)
            self.value.append(-rate * g / (h + L2))
            self.cover.append(h)
            if h >= 2 * MIN_HESSIAN:
                self.open.append(side[node])
        a, b = self.left[node], self.right[node]
        if self.open[-2:] == [a, b]:
            self.sisters |= {a: (b, node), b: (a, node)}


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rounded gradients and hessians (rows x classes), and the log-loss of each row."""
    p = softmax(margins)
    y = labels[:, None] == np.arange(p.shape[1])
    loss = -np.log(np.maximum(p[y], 1e-300))
    return np.rint((p - y) * UNIT), np.rint(np.maximum(2 * p * (1 - p), 1e-16) * UNIT), np.rint(loss * UNIT)


def best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best cut of a node from its (feature, bin) sums; ties: first feature, lowest bin."""
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    all_g, all_h = g[0].sum(), h[0].sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g ** 2 / (left_h + L2) + right_g ** 2 / (right_h + L2) - all_g ** 2 / (all_h + L2)
    gain[(left_h < MIN_HESSIAN) | (right_h < MIN_HESSIAN)] = -np.inf
    if not gain.size:
        return None
    feature, at = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[feature, at]), int(feature), int(at)) if gain[feature, at] > MIN_GAIN else None


def grow(growing: list[_Growing], g: np.ndarray, h: np.ndarray, rate: float) -> None:
    """One level: ``g``, ``h`` hold (class, open node, feature, bin) sums.  Nodes without a gainful cut stay leaves."""
    for k, tree in enumerate(growing):
        frontier, tree.open = tree.open, []
        for i, node in enumerate(frontier):
            if node == 0:
                total_g, total_h = g[k][i][0].sum(), h[k][i][0].sum()
                tree.cover[0], tree.value[0] = float(total_h), float(-rate * total_g / (total_h + L2))
            if found := best_split(g[k][i], h[k][i]):
                _, f, at = found
                sums = [(float(g[k][i][f][part].sum()), float(h[k][i][f][part].sum())) for part in (slice(0, at + 1), slice(at + 1, None))]
                tree.split(node, f, at, sums, rate)


@dataclass
class BoostedModel:
    features: list[str]
    classes: int
    cuts: list[np.ndarray]
    trees: list[list[Tree]] = field(default_factory=list)  # per round, one for each class
    history: list[float] = field(default_factory=list)  # training log-loss before each round, and after the last

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bin of a value: the number of cuts below it."""
        return np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(self.cuts, columns, strict=True)], axis=1) \
            if columns else np.zeros((0, 0), dtype=np.int64)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), self.classes))
        add_margins(out, bins, self.trees)
        return out

    def apply(self, df: DataFrame, fn, names: Sequence[str], key: str = "row_id") -> DataFrame:
        """(key, *names): ``fn(bins)`` of each row, a matrix of doubles.  Only key and features go through Arrow."""
        schema = ", ".join([f"{key} {dict(df.dtypes)[key]}", *[f"`{n}` double" for n in names]])

        def run(batches):
            for batch in batches:
                columns = [np.asarray(c, dtype=np.float64) for c in batch.columns[1:]]
                out = fn(self.binned(columns))
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(out[:, i]) for i in range(len(names))]],
                                                 names=[key, *names])

        return fill_zero(df.select(key, *self.features), self.features).mapInArrow(run, schema)

    def probabilities(self, df: DataFrame, names: Sequence[str], key: str = "row_id") -> DataFrame:
        """(key, one probability column per class)."""
        return self.apply(df, lambda bins: softmax(self.margins(bins)), names, key)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The flat node table: one row per node of every tree."""
        rows = []
        for r, trees in enumerate(self.trees):
            for k, t in enumerate(trees):
                for i in range(len(t.feature)):
                    f = int(t.feature[i])
                    rows.append((r, k, i, f, self.features[f] if f >= 0 else None, int(t.bin[i]),
                                 float(self.cuts[f][t.bin[i]]) if f >= 0 else None, int(t.left[i]), int(t.right[i]),
                                 float(t.value[i]), float(t.cover[i])))
        return spark.createDataFrame(rows, "round int, class int, node int, feature_index int, feature string, bin int, "
                                           "threshold double, left int, right int, value double, cover double")


def add_margins(margins: np.ndarray, bins: np.ndarray, rounds: list[list[Tree]]) -> None:
    for trees in rounds:
        for k, tree in enumerate(trees):
            margins[:, k] += tree.value[tree.leaf_of(bins)]


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int) -> tuple[int, list[np.ndarray]]:
    """The number of rows, and at most ``bins`` - 1 cut values per feature, from quantiles over all rows in one aggregate; below the largest
    value, so that no bin is empty by construction."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(features)],
                 *[F.max(c).alias(f"m{i}") for i, c in enumerate(features)], F.count(F.lit(1)).alias("n")).first()
    return row["n"], [np.array(sorted({v for v in (row[f"q{i}"] or []) if v < row[f"m{i}"]}), dtype=np.float64) for i in range(len(features))]


def _level(batches, classes: int, width: int, rounds: list[list[Tree]], current: list[Tree], slots: list[np.ndarray]):
    """Sums of one task's rows per cell ((class, open node, feature, bin) flattened); cell -1 has the log-loss."""
    cells = sum(int(s.max(initial=-1)) + 1 for s in slots)
    total_g = total_h = None
    loss = rows = 0
    for batch in batches:
        bins, labels, margins = _unpacked(batch, classes)
        add_margins(margins, bins, rounds)
        g, h, own = gradients(margins, labels)
        loss, rows = loss + own.sum(), rows + len(labels)
        n_features = bins.shape[1]
        if total_g is None:
            total_g, total_h = np.zeros((cells, n_features, width)), np.zeros((cells, n_features, width))
        columns = np.ascontiguousarray(bins.T)
        first = 0
        for k, (tree, slot) in enumerate(zip(current, slots, strict=True)):
            n_slots = int(slot.max(initial=-1)) + 1
            at = slot.take(tree.leaf_of(bins))
            here = np.flatnonzero(at >= 0)
            if len(here):
                base, g_here, h_here = at.take(here) * width, g[:, k].take(here), h[:, k].take(here)
                for f in range(n_features):  # a column at a time: its cells stay in the cache
                    cell = base + columns[f].take(here)
                    total_g[first:first + n_slots, f] += np.bincount(cell, g_here, n_slots * width).reshape(n_slots, width)
                    total_h[first:first + n_slots, f] += np.bincount(cell, h_here, n_slots * width).reshape(n_slots, width)
            first += n_slots
    if rows:
        total_g, total_h = total_g.ravel(), total_h.ravel()
        some = np.flatnonzero(total_h)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-1], some))), pa.array(np.concatenate(([loss], total_g[some])).astype(np.int64)),
             pa.array(np.concatenate(([rows], total_h[some])).astype(np.int64))], names=["cell", "g", "h"])


def _unpacked(batch: pa.RecordBatch, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = _matrix(batch.column("bins"), np.dtype(np.uint8))
    margins = _matrix(batch.column("margins"), np.dtype("<f8")).reshape(-1, classes).copy()
    return bins, np.asarray(batch.column("label"), dtype=np.int64), margins


def _matrix(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """Equally long binary values as the rows of a matrix, read from the column's buffers."""
    if not len(column):
        return np.zeros((0, 0), dtype)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]].view(dtype).reshape(len(column), -1)


def _packed_rows(matrix: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(matrix)
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * (raw.itemsize * raw.shape[1])
    return pa.BinaryArray.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


_ROWS = "bins binary, label int, margins binary"


def _names(columns) -> list[str]:
    return ["bins", "label", "margins"][:len(columns)]


def fit_boosted(df: DataFrame, features: Sequence[str], label: str = "label", classes: int = 3, rounds: int = 100,
                depth: int = 6, rate: float = 0.1, bins: int = 64,
                rows_per_task: int = ROWS_PER_TASK) -> BoostedModel:
    """Fit on all rows of ``df``; ``label`` holds 0 to classes - 1, features that are null count as 0."""
    if not features:
        raise ValueError("no numeric features")
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")
    x = fill_zero(df.select(*features, F.col(label).cast("int").alias("_label")), features)
    n, cuts = quantile_cuts(x, features, bins)
    model = BoostedModel(list(features), classes, cuts)
    if not n:
        return model
    width = max(len(c) for c in model.cuts) + 1

    def binned(batches):
        for batch in batches:
            columns = [np.asarray(c, dtype=np.float64) for c in batch.columns[:-1]]
            own = model.binned(columns).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([_packed_rows(own), batch.column(batch.num_columns - 1),
                                              _packed_rows(np.zeros((len(own), classes), dtype="<f8"))], names=_names(range(3)))

    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-n // rows_per_task), min(cores, -(-n // LEAST_ROWS_PER_TASK)))
    tasks = -(-tasks // cores) * cores if tasks > cores else tasks  # whole waves
    store_rounds = MANY_STORE_ROUNDS if n >= MANY_ROWS else STORE_ROUNDS
    table = stored(x.mapInArrow(binned, _ROWS).repartition(tasks))
    pending: list[list[Tree]] = []
    for _ in range(rounds):
        growing = [_Growing() for _ in range(classes)]
        above: list[dict[int, tuple[np.ndarray, np.ndarray]]] = [{} for _ in range(classes)]  # the last level's sums by node
        for level in range(depth):
            current, slots = [t.tree() for t in growing], []
            asked = [t.asked() for t in growing]
            for t, nodes in zip(growing, asked, strict=True):
                slot = np.full(len(t.feature), -1, dtype=np.int64)
                slot[nodes] = np.arange(len(nodes))
                slots.append(slot)
            if not any(t.open for t in growing):
                break
            sums = table.mapInArrow(lambda batches, c=current, s=slots: _level(batches, classes, width, pending, c, s),
                                    "cell long, g long, h long")
            if tasks > FEW_TASKS:  # the sums of a few tasks are added up here, those of many in a shuffle
                sums = sums.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            sums = sums.toArrow()
            cell = sums["cell"].to_numpy()
            g, h = sums["g"].to_numpy(), sums["h"].to_numpy()
            if level == 0:
                model.history.append(float(g[cell == -1].sum()) / UNIT / n)
            counts = [len(nodes) for nodes in asked]
            dense_g, dense_h = (np.zeros((sum(counts), len(features), width), dtype=np.int64) for _ in range(2))
            inner = cell >= 0
            np.add.at(dense_g.reshape(-1), cell[inner], g[inner])
            np.add.at(dense_h.reshape(-1), cell[inner], h[inner])
            cut = np.cumsum([0, *counts])
            level_sums = []
            for t, nodes, a, over in zip(growing, asked, cut, above, strict=False):
                sums = {node: (dense_g[a + i], dense_h[a + i]) for i, node in enumerate(nodes)}
                for node in t.open:
                    if node not in sums:  # the heavier sister has what is left of their parent's sums
                        sister, parent = t.sisters[node]
                        sums[node] = tuple(p - s for p, s in zip(over[parent], sums[sister], strict=True))
                level_sums.append(sums)
            above = level_sums
            stacked = [[np.array([sums[node][i] for node in t.open]) / UNIT for t, sums in zip(growing, level_sums, strict=True)] for i in (0, 1)]
            grow(growing, *stacked, rate)
        trees = [t.tree() for t in growing]
        model.trees.append(trees)
        pending = [*pending, trees]
        if len(pending) >= store_rounds:
            table, pending = _advanced(table, classes, pending), []
    end = table.mapInArrow(lambda batches: _losses(batches, classes, pending), "loss long").agg(F.sum("loss")).first()
    model.history.append(end[0] / UNIT / n)
    discard(table)
    return model


def _advanced(table: DataFrame, classes: int, pending: list[list[Tree]]) -> DataFrame:
    """The rows with the margins of the pending trees added, written anew."""
    def add(batches):
        for batch in batches:
            bins, _, margins = _unpacked(batch, classes)
            add_margins(margins, bins, pending)
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("label"), _packed_rows(margins)], names=_names(range(3)))

    out = stored(table.mapInArrow(add, _ROWS))
    discard(table)
    return out


def _losses(batches, classes: int, pending: list[list[Tree]]):
    for batch in batches:
        bins, labels, margins = _unpacked(batch, classes)
        add_margins(margins, bins, pending)
        yield pa.RecordBatch.from_arrays([pa.array([int(gradients(margins, labels)[2].sum())])], names=["loss"])
