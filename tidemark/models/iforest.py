"""Isolation-forest anomaly detection, distributed (ML9, TOP2, AGG25 proxy truth).

MLlib has no isolation forest, so:

1. **Sampling** -- tree ``t`` takes the ``psi`` rows with the smallest ``xxhash64(row_id, seed, t)``.
   Each row proposes itself only to the trees whose 64-bit hash falls under a threshold slightly above
   ``psi / n`` of its range, so the exploded candidate set is about ``trees * psi`` rows whatever the data size.
2. **Growing** -- ``groupBy(tree).applyInPandas``: one task per tree builds its isolation tree with
   numpy on its <= ``psi`` rows (the forest is bounded by ``trees * (2 * psi - 1)`` nodes).
3. **Scoring** -- the forest (a few hundred KB) is shipped with a pandas UDF over the numeric
   columns: ``s = -2 ** (-E[h(x)] / c(psi))`` (higher = more normal).
4. **Threshold** -- the ``contamination`` quantile of the training scores; ``is_anomaly`` = score
   below it, ``anomaly_score`` = score - threshold (negative for anomalies).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.models.features import fill_zero, population_scaler
from tidemark.operators.quantiles import exact_quantiles

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, size long")


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(pdf: pd.DataFrame, feats: list[str], seed: int, max_depth: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    rng = np.random.default_rng([seed, tree])
    x = pdf[feats].to_numpy(dtype=float)
    nodes = []  # node, feature, threshold, left, right, size

    def build(idx: np.ndarray, depth: int) -> int:
        nid = len(nodes)
        nodes.append([nid, -1, 0.0, -1, -1, len(idx)])
        if depth >= max_depth or len(idx) <= 1:
            return nid
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return nid
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < thr]
        right = idx[sub[:, f] >= thr]
        nodes[nid][1], nodes[nid][2] = f, thr
        nodes[nid][3] = build(left, depth + 1)
        nodes[nid][4] = build(right, depth + 1)
        return nid

    build(np.arange(len(x)), 0)
    out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size"])
    out.insert(0, "tree", tree)
    return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32",
                       "size": "int64"})


class IsolationForestModel:
    def __init__(self, features: list[str], stats: dict, nodes: pd.DataFrame, psi: int, threshold: float | None):
        self.features, self.stats, self.psi, self.threshold, self.nodes = features, stats, psi, threshold, nodes
        trees = []
        for _, g in nodes.groupby("tree"):
            g = g.sort_values("node")
            leaf = np.array([_c(s) for s in g["size"]])  # expected depth below each node
            trees.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                          g["right"].to_numpy(), leaf))
        self.trees = trees

    def _scaled(self, df: DataFrame) -> DataFrame:
        cols = []
        for c in self.features:
            m, s = self.stats[c]
            cols.append(((F.col(c) - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0)).alias(c + "_z"))
        return fill_zero(df, self.features).select("*", *cols)

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``_iso_score`` (sklearn's score_samples convention) with an Arrow-batched function."""
        trees, cpsi = self.trees, _c(self.psi)
        zcols = [c + "_z" for c in self.features]
        x = self._scaled(df)

        def path_lengths(batch: np.ndarray) -> np.ndarray:
            total = np.zeros(len(batch))
            for feat, thr, left, right, leaf in trees:
                node = np.zeros(len(batch), dtype=np.int64)
                depth = np.zeros(len(batch))
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    go_left = batch[np.flatnonzero(active), f] < thr[node[active]]
                    nxt = np.where(go_left, left[node[active]], right[node[active]])
                    node[active] = nxt
                    depth[active] += 1
                    active = feat[node] >= 0
                total += depth + leaf[node]
            return total / len(trees)

        @F.pandas_udf(T.DoubleType())
        def score_rows(*columns: pd.Series) -> pd.Series:
            arr = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            h = path_lengths(arr)
            return pd.Series(-np.power(2.0, -h / cpsi) if cpsi > 0 else -np.ones(len(arr)))

        # only the scaled numeric columns go to Python
        return x.withColumn("_iso_score", score_rows(*zcols))

    def transform(self, df: DataFrame, top_features: int = 3) -> DataFrame:
        """``is_anomaly``, ``anomaly_score`` (= score - threshold) and TOP2 ``top_anomaly_features``."""
        s = self.score(df)
        thr = F.lit(self.threshold)
        s = s.withColumn("anomaly_score", F.col("_iso_score") - thr).withColumn(
            "is_anomaly", F.when(F.col("_iso_score") < thr, 1).otherwise(0))
        items = F.array(*[F.struct(F.abs(F.col(c + "_z")).alias("contribution"), F.lit(c).alias("feature"),
                                   F.col(c).cast("double").alias("original_value"),
                                   F.col(c + "_z").alias("scaled_value")) for c in self.features])
        top = F.slice(F.sort_array(items, asc=False), 1, top_features)
        return s.withColumn("top_anomaly_features", top).drop("_iso_score", *[c + "_z" for c in self.features])


def feature_importance(model: IsolationForestModel, df: DataFrame) -> DataFrame:
    """ML9: standard deviation of each feature times the mean absolute anomaly score, over all rows; the largest first."""
    scored = model.transform(df, 1)
    sums = scored.agg(F.avg(F.abs("anomaly_score")).alias("level"), *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(model.features)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(f"s{i}") * F.col("level")).alias("importance")) for i, c in enumerate(model.features)])
    return sums.select(F.explode(rows).alias("r")).select("r.*").orderBy(F.col("importance").desc(), "feature")


def hash_bound(psi: int, n: int) -> int:
    """Upper bound of the signed 64-bit hash under which a row proposes itself to a tree: 1.5 * psi + 64
    rows expected of n, and a few standard deviations above psi at any n."""
    share = min(1.0, (1.5 * psi + 64.0) / max(n, 1))
    return min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))


def fit_isolation_forest(df: DataFrame, features: Sequence[str], trees: int = 100, psi: int = 256,
                         contamination: float = 0.1, seed: int = 42, key: str = "row_id") -> IsolationForestModel:
    feats = list(features)
    base = fill_zero(df, feats)
    scaled, stats = population_scaler(base, feats, "_z")
    n = scaled.count()
    psi = max(1, min(psi, n))
    zcols = [c + "_z" for c in feats]
    bound = hash_bound(psi, n)
    cand = scaled.select(key, *zcols, F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.xxhash64(F.col(key), F.lit(seed), t) <= F.lit(bound)).alias("_trees"))
    cand = cand.select(key, *zcols, F.explode("_trees").alias("tree"))
    cand = cand.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed), F.col("tree")))
    # per tree about psi * 1.5 candidates: the window below is small by construction
    cand = cand.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_h", key))) \
        .where(F.col("_r") <= psi)
    depth = int(math.ceil(math.log2(max(psi, 2))))
    renamed = cand.select("tree", *[F.col(z).alias(c) for z, c in zip(zcols, feats)])
    nodes = renamed.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, feats, seed, depth), NODE_SCHEMA)
    forest = nodes.toPandas()  # bounded by trees * (2 * psi - 1) rows, independent of the data size
    model = IsolationForestModel(feats, stats, forest, psi, None)
    scores = model.score(df).select(key, "_iso_score")
    model.threshold = exact_quantiles(scores, ["_iso_score"], [contamination], key)["_iso_score"][0]
    return model


def proxy_truth(df: DataFrame, score: str = "weighted_stress_score") -> DataFrame:
    """AGG25 ground-truth proxy: 1 outside the 5 %-95 % quantile band of the score."""
    lo, hi = exact_quantiles(df, [score], (0.05, 0.95))[score]
    return df.withColumn("proxy_anomaly", F.when((F.col(score) > F.lit(hi)) | (F.col(score) < F.lit(lo)), 1)
                         .otherwise(0))
