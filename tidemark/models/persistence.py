"""Saving and loading fitted models (ML0d).

A model is a folder: ``meta`` (one row of JSON), and the tables or MLlib folders of its kind.  All of it is
written by Spark's committed writers into any store that Spark reaches; a folder is never overwritten.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.models.boosting import BoostedModel, Tree
from tidemark.models.iforest import NODE_SCHEMA, IsolationForestModel
from tidemark.models.neural import NeuralModel
from tidemark.models.regression import FittedRegression


def save_model(spark: SparkSession, model, path: str) -> None:
    path = path.rstrip("/")
    if isinstance(model, BoostedModel):
        meta = {"kind": "boosted", "features": model.features, "classes": model.classes, "cuts": [c.tolist() for c in model.cuts],
                "rounds": len(model.trees), "history": model.history}
        model.nodes(spark).write.parquet(f"{path}/nodes")
    elif isinstance(model, IsolationForestModel):
        meta = {"kind": "forest", "features": model.features, "stats": model.stats, "psi": model.psi, "threshold": model.threshold}
        spark.createDataFrame(model.nodes, NODE_SCHEMA).write.parquet(f"{path}/nodes")
    elif isinstance(model, NeuralModel):
        meta = {"kind": "neural", "features": model.features, "stats": model.stats, "history": model.history}
        rows = [(i, [int(s) for s in p.shape], [float(v) for v in p.ravel()]) for i, p in enumerate(model.params)]
        spark.createDataFrame(rows, "layer int, shape array<int>, weights array<double>").write.parquet(f"{path}/weights")
    elif isinstance(model, FittedRegression):
        meta = {"kind": "regression", "name": model.name, "features": model.features, "target": model.target,
                "degree": model.expansion.getDegree() if model.expansion else None}
        model.model.write().save(f"{path}/mllib")
    else:
        raise TypeError(f"cannot save {type(model).__name__}")
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.parquet(f"{path}/meta")


def _trees(nodes: DataFrame, rounds: int, classes: int) -> list[list[Tree]]:
    """The flat node table (bounded by rounds, classes and depth) as trees."""
    table = nodes.orderBy("round", "class", "node").toPandas()
    out: list[list[Tree]] = [[None] * classes for _ in range(rounds)]  # type: ignore[list-item]
    for (r, k), g in table.groupby(["round", "class"]):
        column = lambda name, kind: g[name].to_numpy(dtype=kind)
        out[int(r)][int(k)] = Tree(column("feature_index", np.int64), column("bin", np.int64), column("left", np.int64),
                                   column("right", np.int64), column("value", float), column("cover", float))
    return out


def load_model(spark: SparkSession, path: str):
    path = path.rstrip("/")
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    kind = meta["kind"]
    if kind == "boosted":
        trees = _trees(spark.read.parquet(f"{path}/nodes"), meta["rounds"], meta["classes"])
        return BoostedModel(meta["features"], meta["classes"], [np.array(c) for c in meta["cuts"]], trees, meta["history"])
    if kind == "forest":
        stats = {c: tuple(v) for c, v in meta["stats"].items()}
        return IsolationForestModel(meta["features"], stats, spark.read.parquet(f"{path}/nodes").toPandas(), meta["psi"], meta["threshold"])
    if kind == "neural":
        rows = spark.read.parquet(f"{path}/weights").orderBy("layer").collect()
        params = [np.array(r["weights"]).reshape(r["shape"]) for r in rows]
        return NeuralModel(meta["features"], {c: tuple(v) for c, v in meta["stats"].items()}, params, [tuple(h) for h in meta["history"]])
    if kind == "regression":
        expansion = PolynomialExpansion(degree=meta["degree"], inputCol="_x", outputCol="_px") if meta["degree"] else None
        return FittedRegression(meta["name"], meta["features"], LinearRegressionModel.load(f"{path}/mllib"), meta["target"], expansion)
    raise ValueError(f"unknown model kind {kind}")


def model_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, kind, features) of saved models."""
    out = None
    for path in paths:
        row = spark.read.parquet(f"{path.rstrip('/')}/meta").select(
            F.lit(path).alias("path"), F.get_json_object("meta", "$.kind").alias("kind"), F.get_json_object("meta", "$.features").alias("features"))
        out = row if out is None else out.unionByName(row)
    return out
