"""Grid searches over k folds from one pass of the data (ML2, ML3, ML4, ML4b).

For every fold the number of rows, the sums and the products of (1, features, target) are summed in tasks, added
up in a shuffle, and brought to the driver: (features + 2)^2 / 2 numbers a fold, whatever the number of rows.
Training sums of a fold are the total less its own, so every alpha and fold is solved from sums: ridge in closed
form, lasso by coordinate descent on the Gram matrix, polynomials by least squares.  The squared error of the
held-out fold follows from its sums as well.  Features are centred and scaled before their products are
summed, which keeps the sums well conditioned, and scaled back before a penalty is applied.

Polynomials of degree d take all features.  Two terms' product is a product of at most 2d features, and many pairs
share one, so only the different ones are summed: 593,775 for 24 features and degree 3, where the terms make 4.3
million pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.models.features import fill_zero, population_scaler

RIDGE_ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0)
LASSO_ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0)
DEGREES = (1, 2, 3)
FOLDS = 5
POLYNOMIAL_FOLDS = 3
SIGNIFICANT = 0.01
#: Directions of the terms, each scaled to the same mean square, that hold less than this share of the largest count as empty.
EMPTY = 1e-12
#: Sums of products move as arrays of so many, and a task that makes them gets about so many rows.
PART, TASK_ROWS = 4096, 65_536


def fold_of(key: str, folds: int) -> Column:
    """Fold of a row by the first 16 bits of the md5 of its key: the same for any partitioning."""
    nibbles = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 4)
    return (F.conv(nibbles, 16, 10).cast("int") % folds).cast("int")


@dataclass
class FoldSums:
    """Per fold the matrix of summed products of (1, terms..., target)."""

    names: list[str]
    sums: np.ndarray
    scale: np.ndarray
    centre: np.ndarray

    @property
    def folds(self) -> int:
        return len(self.sums)

    def total(self, without: int | None = None) -> np.ndarray:
        out = self.sums.sum(axis=0)
        return out if without is None else out - self.sums[without]


def monomials(n: int, degree: int) -> list[tuple[int, ...]]:
    """Feature numbers of every product of up to ``degree`` features, lower degrees first."""
    return [c for d in range(1, degree + 1) for c in combinations_with_replacement(range(n), d)]


def monomial_name(features: Sequence[str], term: tuple[int, ...]) -> str:
    powers = {f: term.count(f) for f in term}
    return " ".join(features[f] if p == 1 else f"{features[f]}^{p}" for f, p in powers.items())


def _prepared(df: DataFrame, features: Sequence[str], target: str, folds: int, key: str, scaled: bool) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Rows of (fold, features, target), and the features' scale and centre."""
    feats = list(features)
    x = fill_zero(df.select(key, *feats, target), [*feats, target])
    if scaled:
        x, stats = population_scaler(x, feats, "_z")
        columns = [f"{c}_z" for c in feats]
        scale = np.array([stats[c][1] or 1.0 for c in feats])
        centre = np.array([stats[c][0] for c in feats])
    else:
        columns, scale, centre = feats, np.ones(len(feats)), np.zeros(len(feats))
    return x.select(fold_of(key, folds).alias("fold"), *columns, target), scale, centre


def fold_sums(df: DataFrame, features: Sequence[str], target: str, folds: int, key: str = "row_id", scaled: bool = True) -> FoldSums:
    """One pass: sums of products of (1, features, target) per fold."""
    x, scale, centre = _prepared(df, features, target, folds, key, scaled)
    width = len(features) + 2
    upper = np.triu_indices(width)

    def run(batches):
        sums = np.zeros((folds, width, width))
        for batch in batches:
            fold = np.asarray(batch.column(0))
            raw = [np.asarray(c, dtype=np.float64) for c in batch.columns[1:]]
            for lo in range(0, len(fold), 4096):
                own = [c[lo:lo + 4096] for c in raw]
                z = np.stack([np.ones(len(own[-1])), *own], axis=1)
                for k in np.unique(fold[lo:lo + 4096]):
                    part = z[fold[lo:lo + 4096] == k]
                    sums[k] += part.T @ part
        for k in range(folds):
            if sums[k, 0, 0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(upper[0]), k, np.int32)), pa.array(np.arange(len(upper[0]))),
                                                  pa.array(sums[k][upper])], names=["fold", "cell", "value"])

    found = x.mapInArrow(run, "fold int, cell long, value double").groupBy("fold", "cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((folds, width, width))
    cell = found["cell"].to_numpy()
    out[found["fold"].to_numpy(), upper[0][cell], upper[1][cell]] = found["value"].to_numpy()
    out = out + np.triu(out, 1).transpose(0, 2, 1)
    return FoldSums(list(features), out, scale, centre)


class ProductSums:
    """Places of the sums of all products of 2 * ``degree`` out of (1, features), each once.

    With the numbers of its factors in order (0 for the constant), a product is a first half, whose last number is
    some m, and a second half, whose numbers are all m at least.  So for every m the halves that end with m are
    multiplied by those that start with m or later, and no product is summed twice.  The halves are the
    polynomial's terms; in lexicographic order, those that start with m or later come last."""

    def __init__(self, n: int, degree: int):
        self.n, self.degree = n, degree
        self.halves = np.array(list(combinations_with_replacement(range(n + 1), degree)))
        self.width = len(self.halves)
        self.starts = [np.searchsorted(h, np.arange(n + 1)) for h in (  # by length: where the tuples from m on begin
            np.array([t[0] for t in combinations_with_replacement(range(n + 1), d)]) for d in range(1, degree + 1))]
        self.ending = [np.flatnonzero(self.halves[:, -1] == m) for m in range(n + 1)]
        sizes = [len(e) * (self.width - s) for e, s in zip(self.ending, self.starts[-1], strict=True)]
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.size = int(self.offsets[-1]) + self.width + 1  # then the halves by the target, and its square

    def terms(self, x: np.ndarray) -> np.ndarray:
        """(halves, rows) from (1 and features, rows): products of one factor more from those of its last factors."""
        out = x
        for start in self.starts[:-1]:
            out = np.concatenate([out[s:] * x[f] for f, s in enumerate(start)])
        return out

    def add(self, sums: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        z = self.terms(x)
        for m, end in enumerate(self.ending):
            sums[self.offsets[m]:self.offsets[m + 1]] += (z[end] @ z[self.starts[-1][m]:].T).ravel()
        sums[self.offsets[-1]:-1] += z @ y
        sums[-1] += y @ y

    @cached_property
    def _ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of a half from its factors as digits; its place among those with its last factor."""
        number = np.zeros((self.n + 1) ** self.degree, np.int32)
        number[self._digits(self.halves)] = np.arange(self.width)
        place = np.zeros(self.width, np.int64)
        for end in self.ending:
            place[end] = np.arange(len(end))
        return number, place

    def _digits(self, halves: np.ndarray) -> np.ndarray:
        return halves @ (self.n + 1) ** np.arange(self.degree - 1, -1, -1)

    def numbers(self, terms: Sequence[tuple[int, ...]]) -> np.ndarray:
        """The halves that are the terms: those of fewer features are filled up with ones."""
        factors = np.array([(0,) * (self.degree - len(t)) + tuple(f + 1 for f in t) for t in terms]).reshape(-1, self.degree)
        return self._ranks[0][self._digits(factors)]

    def matrix(self, sums: np.ndarray, halves: np.ndarray) -> np.ndarray:
        """Summed products of (halves..., target)."""
        number, place = self._ranks
        start, own = self.starts[-1], self.halves[halves]
        out = np.empty((len(halves) + 1,) * 2)
        for i, half in enumerate(halves):
            both = np.sort(np.concatenate([np.broadcast_to(self.halves[half], own.shape), own], axis=1), axis=1)
            m = both[:, self.degree - 1]
            first, second = number[self._digits(both[:, :self.degree])], number[self._digits(both[:, self.degree:])]
            out[i, :-1] = sums[self.offsets[m] + place[first] * (self.width - start[m]) + second - start[m]]
        out[-1, :-1] = out[:-1, -1] = sums[self.offsets[-1]:-1][halves]
        out[-1, -1] = sums[-1]
        return out


def fold_products(df: DataFrame, features: Sequence[str], target: str, folds: int, degree: int, key: str = "row_id") -> tuple[ProductSums, np.ndarray]:
    """One pass: per fold the sums that hold every product of two polynomial terms of scaled features, and of the target."""
    x, _, _ = _prepared(df, features, target, folds, key, True)
    products = ProductSums(len(features), degree)
    parts = -(-products.size // PART)

    def run(batches):
        sums, seen = np.zeros((folds, parts * PART)), set()
        for batch in batches:
            fold = np.asarray(batch.column(0))
            raw = np.stack([np.ones(len(fold)), *[np.asarray(c, dtype=np.float64) for c in batch.columns[1:]]])
            for k in np.unique(fold):
                seen.add(k)
                own = raw[:, fold == k]
                for lo in range(0, own.shape[1], 1024):
                    products.add(sums[k, :products.size], own[:-1, lo:lo + 1024], own[-1, lo:lo + 1024])
        for k in seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(parts, k, np.int32)), pa.array(np.arange(parts, dtype=np.int32)),
                                              pa.FixedSizeListArray.from_arrays(sums[k], PART).cast(pa.list_(pa.float64()))], names=["fold", "part", "sums"])

    def add_up(group: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(s.values) for s in group["sums"]], axis=0)
        return pa.table({"fold": group["fold"][:1], "part": group["part"][:1], "sums": pa.array([total], pa.list_(pa.float64()))})

    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    schema = "fold int, part int, sums array<double>"
    found = x.coalesce(tasks).mapInArrow(run, schema).groupBy("fold", "part").applyInArrow(add_up, schema).toArrow()
    out = np.zeros((folds, parts * PART))
    for k, part, sums in zip(found["fold"].to_pylist(), found["part"].to_pylist(), found["sums"], strict=True):
        out[k, part * PART:(part + 1) * PART] = np.asarray(sums.values)
    return products, out[:, :products.size]


def _moments(sums: np.ndarray) -> tuple[float, np.ndarray, float, np.ndarray, np.ndarray]:
    """(n, mean x, mean y, centred Gram, centred x'y)."""
    n = sums[0, 0]
    x, y = sums[0, 1:-1] / n, sums[0, -1] / n
    return n, x, y, sums[1:-1, 1:-1] - n * np.outer(x, x), sums[1:-1, -1] - n * x * y


def _least_squares(gram: np.ndarray, xy: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(gram, xy, rcond=1e-10)[0]


def _polynomial(sums: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of the least squares; of several, those of the least norm.  Uses ``sums`` up, as room for them.

    Mean squares of the terms differ by many powers of ten, so what is empty is found among terms scaled to the same."""
    n, square = sums[0, 0], np.diag(sums)[1:-1].copy()
    x, y = sums[0, 1:-1] / n, sums[0, -1] / n
    xy, gram = sums[1:-1, -1] - n * x * y, sums[1:-1, 1:-1]
    if not len(xy):
        return xy, float(y)
    scale = np.where(square > 0, np.sqrt(square), 1.0)
    for i in range(len(x)):
        gram[i] = (gram[i] - n * x[i] * x) / (scale[i] * scale)
    level, v = np.linalg.eigh(gram)
    rank = int((level <= EMPTY * level[-1]).sum())
    w = v[:, rank:] @ ((xy / scale) @ v[:, rank:] / level[rank:]) / scale
    empty = np.linalg.qr(v[:, :rank] / scale[:, None])[0]
    w -= empty @ (w @ empty)
    w[square == 0] = 0.0
    return w, float(y - x @ w)


def lasso_on_gram(gram: np.ndarray, xy: np.ndarray, n: float, alpha: float, sweeps: int = 10_000, tol: float = 1e-12) -> np.ndarray:
    """Coordinate descent for 1/(2n) SSE + alpha |w|_1, given the centred Gram matrix."""
    w, scale = np.zeros(len(xy)), np.diag(gram)
    residual = xy.copy()  # x'(y - Xw)
    for _ in range(sweeps):
        most = 0.0
        for j in np.flatnonzero(scale > 0):
            rho = residual[j] + scale[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - n * alpha, 0.0) / scale[j]
            if new != w[j]:
                residual -= gram[j] * (new - w[j])
                most = max(most, abs(new - w[j]) * np.sqrt(scale[j]))
                w[j] = new
        if most <= tol * max(1.0, np.sqrt(n)):
            break
    return w


def solve(sums: np.ndarray, model: str, alpha: float, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept on the summed scale, penalised on the features' own scale."""
    n, x, y, gram, xy = _moments(sums)
    if model == "ridge":
        w = _least_squares(gram + alpha * np.diag(1 / scale ** 2), xy)
    elif model == "lasso":
        w = lasso_on_gram(gram * np.outer(scale, scale), xy * scale, n, alpha) * scale
    else:
        raise ValueError(f"unknown model {model}")
    return w, float(y - x @ w)


def squared_error(sums: np.ndarray, w: np.ndarray, intercept: float) -> float:
    """Mean squared error of the rows behind ``sums``."""
    v = np.concatenate(([-intercept], -w, [1.0]))
    return float(max(v @ sums @ v, 0.0) / sums[0, 0])


@dataclass
class GridResult:
    """``scores`` holds (parameter, fold, mse); ``best`` is the parameter of the least mean error (the first of equals)."""

    model: str
    scores: list[tuple[float, int, float]]
    best: float
    names: list[str]
    coefficients: np.ndarray
    intercept: float

    def nonzero(self) -> int:
        return int((self.coefficients != 0).sum())

    def significant(self) -> int:
        return int((np.abs(self.coefficients) > SIGNIFICANT).sum())

    def interactions(self, top: int = 10) -> list[tuple[str, float]]:
        """ML4b: the products of different features with the largest coefficients."""
        rows = [(n, float(c)) for n, c in zip(self.names, self.coefficients, strict=True) if " " in n]
        return sorted(rows, key=lambda r: (-abs(r[1]), r[0]))[:top]


def _best(scores: list[tuple[float, int, float]], sums: np.ndarray) -> float:
    """The parameter of the least mean error.  Errors taken from sums are not told apart below 1e-10 of the target's
    mean square; of parameters that are equal in this sense the first is taken."""
    least = 1e-10 * sums[-1, -1] / max(sums[0, 0], 1.0)
    means: dict[float, list[float]] = {}
    for parameter, _, mse in scores:
        means.setdefault(parameter, []).append(mse)
    level = {p: sum(m) / len(m) for p, m in means.items()}
    return next(p for p in level if level[p] <= min(level.values()) + least)


def alpha_grid(data: FoldSums, model: str, alphas: Sequence[float]) -> GridResult:
    """Every alpha on every fold from the fold sums; coefficients of the best on all rows, on the features' own scale."""
    scores = []
    for alpha in alphas:
        for k in range(data.folds):
            if data.sums[k, 0, 0] and data.total(k)[0, 0]:
                w, b = solve(data.total(k), model, alpha, data.scale)
                scores.append((float(alpha), k, squared_error(data.sums[k], w, b)))
    best = _best(scores, data.total())
    w, b = solve(data.total(), model, best, data.scale)
    own = w / data.scale
    return GridResult(model, scores, best, data.names, own, float(b - own @ data.centre))


def degree_grid(df: DataFrame, features: Sequence[str], target: str, degrees: Sequence[int] = DEGREES, folds: int = POLYNOMIAL_FOLDS,
                key: str = "row_id") -> GridResult:
    """Polynomials of each degree on every fold, of all features.  The sums of the highest degree hold those of the lower
    ones.  Coefficients are those of the centred and scaled features' products.

    A fit takes a few times the square of the number of terms as memory, so each runs in a task of its own."""
    products, sums = fold_products(df, features, target, folds, max(degrees), key)
    total = sums.sum(axis=0)
    held = [k for k in range(folds) if sums[k, 0] and total[0] > sums[k, 0]]
    terms = {d: monomials(len(features), d) for d in degrees}
    halves = {d: products.numbers([(), *terms[d]]) for d in degrees}
    fits = [(d, k) for d in sorted(degrees, reverse=True) for k in [*held, None]]  # None: a fit of all rows

    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                d, k = fits[i]
                w, b = _polynomial(products.matrix(total if k is None else total - sums[k], halves[d]))
                error = None if k is None else squared_error(products.matrix(sums[k], halves[d]), w, b)
                yield pa.RecordBatch.from_pylist([{"fit": i, "mse": error, "weights": w if k is None else [], "intercept": b}], schema=out)

    out = pa.schema([("fit", pa.int64()), ("mse", pa.float64()), ("weights", pa.list_(pa.float64())), ("intercept", pa.float64())])
    rows = df.sparkSession.range(0, len(fits), 1, len(fits)).mapInArrow(run, "fit long, mse double, weights array<double>, intercept double").collect()
    found = {fits[r["fit"]]: r for r in rows}
    scores = [(float(d), k, found[d, k]["mse"]) for d in degrees for k in held]
    best = _best(scores, products.matrix(total, halves[degrees[0]][:1]))
    chosen = found[int(best), None]
    return GridResult("polynomial", scores, best, [monomial_name(features, t) for t in terms[int(best)]], np.array(chosen["weights"]), chosen["intercept"])
