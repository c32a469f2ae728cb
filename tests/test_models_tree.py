"""Boosting, attributions, grids, network training and persistence against plain computations."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.models import attributions as A
from tidemark.models import boosting as B
from tidemark.models import grid as G
from tidemark.models.features import hash_split, stratified_split
from tidemark.models.neural import NeuralModel, fit_neural
from tidemark.models.persistence import load_model, model_table, save_model
from tidemark.models.regression import fit_lasso, fit_linear, fit_polynomial, fit_ridge

FEATURES = ["a", "b", "c", "d"]


def data(n=240, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(int) + (x[:, 2] > 0.5)
    return x, y


def frame(spark, x, y, parts=4):
    rows = [(i, *map(float, r), int(k), float(2 * r[0] - r[1] + 0.5 * r[2])) for i, (r, k) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, label int, y double").repartition(parts)


def plain_boosting(bins, y, classes, rounds, depth, rate):
    """The trees' margins, row by row, without histograms."""
    margins, losses = np.zeros((len(y), classes)), []
    for _ in range(rounds):
        p = np.exp(margins - margins.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        losses.append(float(-np.log(p[np.arange(len(y)), y]).mean()))
        step = np.zeros_like(margins)
        for k in range(classes):
            g = np.rint((p[:, k] - (y == k)) * B.UNIT) / B.UNIT
            h = np.rint(np.maximum(2 * p[:, k] * (1 - p[:, k]), 1e-16) * B.UNIT) / B.UNIT

            def build(rows, level):
                best = (1e-6, None)
                if level < depth and h[rows].sum() >= 2:
                    for f in range(bins.shape[1]):
                        for cut in range(bins[:, f].max()):
                            low = rows[bins[rows, f] <= cut]
                            high = rows[bins[rows, f] > cut]
                            if h[low].sum() >= 1 and h[high].sum() >= 1:
                                gain = (g[low].sum() ** 2 / (h[low].sum() + 1) + g[high].sum() ** 2 / (h[high].sum() + 1)
                                        - g[rows].sum() ** 2 / (h[rows].sum() + 1))
                                if gain > best[0] + 1e-12:
                                    best = (gain, (low, high))
                if best[1] is None:
                    step[rows, k] = -rate * g[rows].sum() / (h[rows].sum() + 1)
                else:
                    for part in best[1]:
                        build(part, level + 1)

            build(np.arange(len(y)), 0)
        margins = margins + step
    return margins, losses


@pytest.fixture(scope="module")
def fitted(spark):
    x, y = data()
    return x, y, B.fit_boosted(frame(spark, x, y), FEATURES, rounds=4, depth=3, rate=0.3, bins=8)


def test_boosting_equals_plain_version(spark, fitted):
    x, y, model = fitted
    bins = model.binned(list(x.T))
    margins, losses = plain_boosting(bins, y, 3, 4, 3, 0.3)
    assert np.allclose(model.margins(bins), margins, atol=1e-9)
    assert np.allclose(model.history[:4], losses, atol=1e-6) and all(b < a for a, b in itertools.pairwise(model.history))
    many = B.fit_boosted(frame(spark, x, y, 3), FEATURES, rounds=4, depth=3, rate=0.3, bins=8, rows_per_task=40)
    assert all((t.feature == u.feature).all() and (t.bin == u.bin).all() and np.array_equal(t.value, u.value)
               for r, s in zip(model.trees, many.trees, strict=True) for t, u in zip(r, s, strict=True))


def test_probabilities(spark, fitted):
    x, y, model = fitted
    names = ["p0", "p1", "p2"]
    rows = model.probabilities(frame(spark, x, y), names).collect()
    assert len(rows) == len(x) and all(abs(r.p0 + r.p1 + r.p2 - 1) < 1e-12 for r in rows)
    right = np.mean([y[r.row_id] == int(np.argmax([r.p0, r.p1, r.p2])) for r in rows])
    assert right > np.bincount(y).max() / len(y) + 0.2  # four rounds: well above the commonest class


def test_no_rows_and_no_features(spark):
    empty = spark.createDataFrame([], "row_id long, a double, label int")
    assert B.fit_boosted(empty, ["a"], rounds=2).trees == []
    with pytest.raises(ValueError):
        B.fit_boosted(empty, [], rounds=1)


def shapley(tree_value, m):
    """Shapley values of a set function over m features, over all subsets."""
    out = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for size in range(m):
            for s in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(m - 1 - size) / math.factorial(m)
                out[i] += w * (tree_value(set(s) | {i}) - tree_value(set(s)))
    return out


def expected_value(tree, row, known, node=0):
    f = int(tree.feature[node])
    if f < 0:
        return tree.value[node]
    left, right = int(tree.left[node]), int(tree.right[node])
    if f in known:
        return expected_value(tree, row, known, left if row[f] <= tree.bin[node] else right)
    return sum(tree.cover[c] / tree.cover[node] * expected_value(tree, row, known, c) for c in (left, right))


def test_tree_attributions_are_shapley_values(spark, fitted):
    x, y, model = fitted
    bins = model.binned(list(x.T))
    rows = A.tree_attributions(frame(spark, x, y), model).collect()
    assert len(rows) == 3 * len(x)
    for r in rows:
        assert abs(r.base + sum(r.attributions) - r.margin) < 1e-9
    for r in rows[:60]:
        want = sum(shapley(lambda s, t=trees[r["class"]]: expected_value(t, bins[r.row_id], s), 4) for trees in model.trees)
        assert np.allclose(r.attributions, want, atol=1e-9)
    best = A.importance(A.tree_attributions(frame(spark, x, y), model), FEATURES, 3).collect()
    assert len(best) == 3 and {r.feature for r in best} == {"a", "b", "c"} and abs(sum(r.share_pct for r in best) - 100) < 1e-9


def test_coalition_values_of_a_network():
    rng = np.random.default_rng(7)
    feats = [f"f{i}" for i in range(6)]
    for hidden in ((8, 4), ()):
        params = [rng.normal(size=s) for a, b in zip((6, *hidden), (*hidden, 1), strict=True) for s in ((a, b), b)]
        model = NeuralModel(feats, {f: (0.2 * i, 0.0 if i == 2 else 1 + i / 3) for i, f in enumerate(feats)}, params, [])
        x, centres, shares = rng.normal(size=(23, 6)), rng.normal(size=(4, 6)), np.array([0.1, 0.2, 0.3, 0.4])
        sets, _ = A.coalitions(6, 30)
        plain = sum(p * model.predict(np.where(sets[None] > 0, x[:, None], c).reshape(-1, 6)).reshape(23, -1)
                    for c, p in zip(centres, shares, strict=True))
        for cells in (1 << 16, 1):
            assert np.allclose(model.coalition_values(sets, centres, shares, cells)(x), plain, rtol=0, atol=1e-12)


def test_kernel_attributions_of_a_network(spark):
    rng = np.random.default_rng(8)
    feats = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(50, 4)))], "row_id long, a double, b double, c double, d double")
    model = NeuralModel(feats, {f: (0.1, 2.0) for f in feats}, [rng.normal(size=s) for s in ((4, 5), 5, (5, 1), 1)], [])
    centres, shares = A.background(df, feats, k=3)
    plain = {r.row_id: r for r in A.kernel_attributions(df, model.predict, feats, centres, shares).collect()}
    short = A.kernel_attributions(df, model.predict, feats, centres, shares, coalition_values=model.coalition_values).collect()
    assert len(short) == 50
    for r in short:
        assert np.allclose(r.attributions, plain[r.row_id].attributions, atol=1e-12) and r.prediction == plain[r.row_id].prediction


def test_kernel_attributions_deal_rows_over_tasks(spark):
    df = spark.range(5000).selectExpr("id as row_id", "cast(id % 7 as double) as a", "cast(id % 11 as double) as b").coalesce(1)
    found = A.kernel_attributions(df, lambda m: m.sum(axis=1), ["a", "b"], np.zeros((1, 2)), np.ones(1))
    assert found.rdd.getNumPartitions() >= min(spark.sparkContext.defaultParallelism, 9)
    assert found.count() == 5000


def test_kernel_attributions(spark):
    x, y = data(60)
    docs = frame(spark, x, y)
    centres, shares = A.background(docs, FEATURES, 5)
    assert abs(shares.sum() - 1) < 1e-12 and len(centres) == 5
    coef = np.array([2.0, -1.0, 0.5, 0.0])
    for r in A.kernel_attributions(docs, lambda m: m @ coef + 3, FEATURES, centres, shares, 100).collect():
        assert np.allclose(r.attributions, coef * (x[r.row_id] - shares @ centres), atol=1e-9)
    curved = lambda m: m[:, 0] * m[:, 1] + np.maximum(m[:, 2], 0)
    for r in A.kernel_attributions(docs, curved, FEATURES, centres, shares, 100).collect()[:10]:
        row = x[r.row_id]
        value = lambda s: float(shares @ curved(np.where([j in s for j in range(4)], row, centres)))  # noqa: E731,B023
        assert abs(r.base + sum(r.attributions) - r.prediction) < 1e-9
        assert np.allclose(r.attributions, shapley(value, 4), atol=1e-9)  # all coalitions of 4 features fit in 100


def test_coalitions():
    for m, n in ((4, 100), (10, 100), (24, 100), (2, 10)):
        sets, weights = A.coalitions(m, n)
        assert len(sets) <= n and abs(weights.sum() - 1) < 1e-9 and ((sets.sum(axis=1) > 0) & (sets.sum(axis=1) < m)).all()
        assert np.linalg.matrix_rank(sets[:, :-1] - sets[:, -1:]) == m - 1


def test_stratified_split(spark):
    rows = [(i, 0 if i % 10 == 0 else 1 if i % 3 else 2, i * 1.0) for i in range(1003)]
    one = stratified_split(spark.createDataFrame(rows, "row_id long, label int, v double"), "label")
    two = stratified_split(spark.createDataFrame(rows[::-1], "row_id long, label int, v double").repartition(7), "label")
    a, b = ({r.row_id: r.is_train for r in s.collect()} for s in (one, two))
    assert a == b and len(a) == 1003
    for c in range(3):
        own = [i for i, k, _ in rows if k == c]
        assert abs(sum(not a[i] for i in own) - 0.2 * len(own)) <= 1
    lone = stratified_split(spark.createDataFrame([(1, 0, 1.0)] + [(i, 1, 1.0) for i in range(2, 12)], "row_id long, label int, v double"), "label")
    assert lone.where("NOT is_train").count() == 2


def numpy_folds(x, k):
    import hashlib

    return np.array([int(hashlib.md5(str(i).encode()).hexdigest()[:4], 16) % k for i in range(len(x))])


def test_grids_equal_refits_on_each_fold(spark):
    x, y = data(150)
    t = 2 * x[:, 0] - x[:, 1] + 0.5 * x[:, 2]
    docs = frame(spark, x * [1, 100, 0.01, 1], y)
    x = x * [1, 100, 0.01, 1]
    docs = docs.withColumn("y", F.col("a") * 2 - F.col("b") / 100 + F.col("d") * F.col("a"))
    t = 2 * x[:, 0] - x[:, 1] / 100 + x[:, 3] * x[:, 0]
    sums = G.fold_sums(docs, FEATURES, "y", 5)
    fold = numpy_folds(x, 5)
    ridge = G.alpha_grid(sums, "ridge", G.RIDGE_ALPHAS)
    lasso = G.alpha_grid(sums, "lasso", (0.01, 0.1))
    assert len(ridge.scores) == 25
    for alpha, k, mse in ridge.scores:
        a, b = x[fold != k], t[fold != k]
        c = a - a.mean(axis=0)
        w = np.linalg.solve(c.T @ c + alpha * np.eye(4), c.T @ (b - b.mean()))
        want = np.mean((t[fold == k] - b.mean() - (x[fold == k] - a.mean(axis=0)) @ w) ** 2)
        assert abs(mse - want) < 1e-8 * max(1, want)
    means = {a: np.mean([m for p, _, m in ridge.scores if p == a]) for a in G.RIDGE_ALPHAS}
    assert ridge.best == min(means, key=means.get)
    full = fit_ridge(docs, FEATURES, "y", ridge.best, use_split=False)
    assert np.allclose(full.model.coefficients.toArray(), ridge.coefficients, atol=1e-6) and abs(full.model.intercept - ridge.intercept) < 1e-6
    by_mllib = fit_lasso(docs, FEATURES, "y", lasso.best, use_split=False)
    assert np.allclose(by_mllib.model.coefficients.toArray(), lasso.coefficients, atol=1e-4) and lasso.nonzero() <= 4
    degrees = G.degree_grid(docs, FEATURES, "y")
    fold = numpy_folds(x, 3)
    for d, k, mse in degrees.scores:
        terms = G.monomials(4, int(d))
        z = (x - x.mean(axis=0)) / x.std(axis=0)
        p = np.stack([np.ones(len(z)), *[np.prod(z[:, list(m)], axis=1) for m in terms]], axis=1)
        w = np.linalg.lstsq(p[fold != k], t[fold != k], rcond=None)[0]
        want = np.mean((t[fold == k] - p[fold == k] @ w) ** 2)
        assert abs(mse - want) < 1e-6 * max(1, want), (d, k)
    assert degrees.best == 2.0 and degrees.interactions(1)[0][0] == "a d" and degrees.significant() >= 3
    assert len(degrees.names) == 14


def test_degrees_take_every_column(spark):
    from tidemark.plans.queries_learning import regression_grid
    from tests.conftest import SF

    rows = [r for r in regression_grid(spark, SF).collect() if r.model == "polynomial"]
    assert len(rows) == 9 and {r.parameter for r in rows if r.chosen} == {1.0}
    assert {r.nonzero for r in rows} == {23}  # of 24 columns, one of them constant


def test_degrees_of_many_uneven_columns_equal_plain_least_squares(spark):
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 2, 400), *rng.standard_t(3, (10, 400)), np.full(400, 7.0)], axis=1)
    t = x[:, 0] * x[:, 10] + x[:, 9] ** 2 - 3 * x[:, 8]
    names = [f"f{i}" for i in range(12)]
    docs = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, t, strict=True))],
                                 "row_id long, " + ", ".join(f"{c} double" for c in [*names, "y"]))
    found = G.degree_grid(docs, names, "y")
    fold, z = numpy_folds(x, 3), (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    for d, k, mse in found.scores:
        p = np.stack([np.prod(z[:, list(m)], axis=1) for m in G.monomials(12, int(d))], axis=1)
        p, rest = p - p[fold != k].mean(axis=0), t - t[fold != k].mean()
        w = np.linalg.lstsq(p[fold != k], rest[fold != k], rcond=1e-12)[0]  # 454 terms at degree 3: the least norm of many
        want = np.mean((rest[fold == k] - p[fold == k] @ w) ** 2)
        assert abs(mse - want) < 1e-6 * max(1, want), (d, k)
    assert len(found.scores) == 9 and found.best == 2.0 and len(found.names) == 90 and {n for n, _ in found.interactions(1)} == {"f0 f10"}


def test_mini_batches_beat_full_batch_steps(spark):
    x, y = data(400)
    docs = frame(spark, x, y)
    test = hash_split(docs).where("NOT is_train")

    def error(model):
        return model.transform(test).agg(F.avg(F.pow(F.col("y") - F.col("neural_network_prediction"), 2))).first()[0]

    batches = fit_neural(docs, FEATURES, "y", dropout=0.0, epochs=25)
    full = fit_neural(docs, FEATURES, "y", dropout=0.0, epochs=25, batch=10 ** 9)
    assert error(batches) < 0.3 * error(full)
    averaged = fit_neural(docs, FEATURES, "y", dropout=0.0, epochs=25, rows_per_task=100)
    assert averaged.history[-1][2] < 0.5 * averaged.history[0][2]
    few = fit_neural(docs.limit(8), FEATURES, "y", epochs=10)
    assert len(few.history) == 6


def test_saved_models_predict_alike(spark, tmp_path, fitted):
    from tidemark.models.iforest import feature_importance, fit_isolation_forest

    x, y, boosted = fitted
    docs = frame(spark, x, y)
    network = fit_neural(docs, FEATURES, "y", epochs=2)
    forest = fit_isolation_forest(docs, FEATURES, trees=5)
    lines = [fit_linear(docs, FEATURES, "y"), fit_ridge(docs, FEATURES, "y"), fit_polynomial(docs, FEATURES, "y")]

    def scores(model):
        if model is boosted or isinstance(model, B.BoostedModel):
            out = model.probabilities(docs, ["p", "q", "r"])
        else:
            out = model.transform(docs)
        keep = [c for c in out.columns if c in ("row_id", "p", "q", "r", "anomaly_score") or c.endswith("_prediction")]
        return sorted(tuple(r) for r in out.select(*keep).collect())

    paths = []
    for i, model in enumerate((boosted, network, forest, *lines)):
        paths.append(str(tmp_path / f"m{i}"))
        save_model(spark, model, paths[-1])
        assert scores(load_model(spark, paths[-1])) == scores(model)
    assert [r.kind for r in model_table(spark, paths).collect()] == ["boosted", "neural", "forest"] + ["regression"] * 3
    with pytest.raises(TypeError):
        save_model(spark, object(), str(tmp_path / "x"))
    top = feature_importance(forest, docs).collect()
    assert len(top) == 4 and top[0].importance >= top[-1].importance > 0


def test_sister_nodes_share_their_parents_sums(spark):
    """Only the lighter of two open sisters is summed over the rows; rows are dealt to all cores; trees are those of summing every node."""
    import numpy as np

    from tidemark.models import boosting as B

    rng = np.random.default_rng(5)
    rows = [(int(i), float(a), float(b), float(c), int(a + b * c > 0) + int(a > 1)) for i, (a, b, c) in enumerate(rng.normal(size=(3000, 3)))]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, label int")
    seen = []
    whole = B._Growing.asked

    def watched(self):
        found = whole(self)
        seen.append((len(found), len(self.open)))
        return found

    try:
        B._Growing.asked = watched
        model = B.fit_boosted(df, ["a", "b", "c"], rounds=3, depth=4)
        B._Growing.asked = lambda self: list(self.open)
        plain = B.fit_boosted(df, ["a", "b", "c"], rounds=3, depth=4)
    finally:
        B._Growing.asked = whole
    assert any(asked < opened for asked, opened in seen)
    assert model.history == plain.history
    for one, two in zip(sum(model.trees, []), sum(plain.trees, []), strict=True):
        for name in ("feature", "bin", "left", "right", "value", "cover"):
            assert np.array_equal(getattr(one, name), getattr(two, name))


def test_attributions_go_tree_by_tree():
    """The work space is one tree's, whatever the number of leaves in the model; the values add up to the margins."""
    import tracemalloc

    import numpy as np

    from tidemark.models.attributions import TreeAttributions
    from tidemark.models.boosting import BoostedModel, Tree

    rng = np.random.default_rng(2)
    cover = np.ones(31)
    for i in range(14, -1, -1):
        cover[i] = cover[2 * i + 1] + cover[2 * i + 2]
    side = [np.array([2 * i + s if i < 15 else -1 for i in range(31)]) for s in (1, 2)]

    def tree():
        feature = np.where(np.arange(31) < 15, rng.integers(0, 6, 31), -1)
        return Tree(feature, rng.integers(2, 14, 31), *side, rng.normal(size=31), cover)

    model = BoostedModel([f"f{i}" for i in range(6)], 2, [np.arange(15.0)] * 6, [[tree(), tree()] for _ in range(40)])
    explain, bins = TreeAttributions(model), rng.integers(0, 16, (4096, 6))
    tracemalloc.start()
    try:
        found = explain.of(bins)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 16 << 20
    assert np.abs(found.sum(axis=2) + explain.base - model.margins(bins)).max() < 1e-9
