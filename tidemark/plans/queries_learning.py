"""Registered queries of grids, attributions and the quick update.

Where SQL cannot fit the model, it checks what must hold of it for every row: an identity is reported as a boolean
column of the rows, and the SQL lists the rows with ``true``.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import r6
from tidemark.models import attributions as A
from tidemark.models import classifier as CL
from tidemark.models import grid as G
from tidemark.models import regression as RG
from tidemark.models.features import fill_zero
from tidemark.models.neural import fit_neural
from tidemark.operators.views import most_recent, quick_update
from tidemark.plans import oracle as O
from tidemark.plans.queries_models import NUMERIC, TARGET, _features, _gold, _risk_model
from tidemark.plans.registry import register
from tidemark.session import checkpoint_dir, cut_lineage
from tidemark.sources.snapshots import export_csv, export_json, published_runs, read_best_gold, read_latest_snapshot, write_snapshot

QUICK_ROWS = 500


def _fold_sql(folds: int) -> str:
    h = "md5(CAST(row_id AS VARCHAR))"
    return "CAST((" + " + ".join(f"(strpos('0123456789abcdef', substr({h}, {i + 1}, 1)) - 1) * {16 ** (3 - i)}" for i in range(4)) + f") % {folds} AS INTEGER)"


@register("grid_fold_sums", f"""
WITH {O.gold_ctes()},
x AS (SELECT {_fold_sql(G.FOLDS)} AS fold, coalesce({TARGET}, 0.0) AS y,
             {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}' for c in NUMERIC)} FROM gold)
{' UNION ALL '.join(f"SELECT fold, '{c}' AS feature, count(*) AS n, round(avg(y), 6) AS mean_y, round(avg({c}), 6) AS mean_x, "
                    f"round(avg({c} * y), 6) AS mean_xy, round(avg({c} * {c}), 4) AS mean_xx FROM x GROUP BY fold" for c in NUMERIC)}""")
def grid_fold_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2 + ML3: the sums per fold that every alpha is solved from."""
    g = _gold(spark, sf_dir)
    feats = _features(g)
    data = G.fold_sums(g, feats, TARGET, G.FOLDS, scaled=False)
    rows = [(k, f, int(s[0, 0]), *(float(v / s[0, 0]) for v in (s[0, -1], s[0, i + 1], s[i + 1, -1], s[i + 1, i + 1])))
            for k, s in enumerate(data.sums) if s[0, 0] for i, f in enumerate(feats)]
    out = spark.createDataFrame(rows, "fold int, feature string, n long, mean_y double, mean_x double, mean_xy double, mean_xx double")
    return out.select("fold", "feature", "n", *[r6(F.col(c)).alias(c) for c in ("mean_y", "mean_x", "mean_xy")],
                      (F.round("mean_xx", 4) + F.lit(0.0)).alias("mean_xx"))


@register("regression_grid")
def regression_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2 + ML3 + ML4 + ML4b: error of every (alpha, fold) and (degree, fold), the chosen ones, non-zero and significant
    coefficients and the largest interactions.  Degrees are tried on all columns, in order of their correlation with the
    target (AGG11); constant ones, which have none, come last."""
    from tidemark.operators.correlation import target_correlations

    g = _gold(spark, sf_dir)
    feats = _features(g)
    data = G.fold_sums(g, feats, TARGET, G.FOLDS)
    ranked = [r["feature"] for r in target_correlations(fill_zero(g, [*feats, TARGET]), feats, TARGET, None).collect()]
    ranked += [f for f in feats if f not in ranked]
    rows = []
    for result in (G.alpha_grid(data, "ridge", G.RIDGE_ALPHAS), G.alpha_grid(data, "lasso", G.LASSO_ALPHAS), G.degree_grid(g, ranked, TARGET)):
        words = ", ".join(f"{n} {c:.6f}" for n, c in result.interactions()) if result.model == "polynomial" else None
        rows += [(result.model, p, k, mse, p == result.best, result.nonzero(), result.significant(), words) for p, k, mse in result.scores]
    return spark.createDataFrame(rows, "model string, parameter double, fold int, mse double, chosen boolean, nonzero int, "
                                       "significant int, interactions string")


def _least_squares_hold(df: DataFrame, feats: list[str], w: np.ndarray, intercept: float, alpha: float, l1: float) -> list[bool]:
    """Whether x'(y - Xw) = alpha w (ridge), or lies in n * l1 * [-1, 1] and at its end where w is not 0 (lasso), per feature:
    the conditions of the optimum, over all rows in one aggregate, with 1e-5 of the sums' size as margin."""
    x = fill_zero(df, [*feats, TARGET])
    rest = F.col(TARGET) - F.lit(float(intercept))
    for c, v in zip(feats, w, strict=True):
        rest = rest - F.col(c) * F.lit(float(v))
    x = x.withColumn("_rest", rest)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(feats):
        aggs += [F.sum(F.col(c) * F.col("_rest")).alias(f"g{i}"), F.sqrt(F.sum(F.col(c) * F.col(c)) * F.sum(F.col(TARGET) * F.col(TARGET))).alias(f"s{i}")]
    row = x.agg(*aggs).first()
    out = []
    for i, v in enumerate(w):
        gap = row[f"g{i}"] - alpha * float(v)
        if l1:
            gap = max(abs(gap) - row["n"] * l1, 0.0) if v == 0 else gap - row["n"] * l1 * float(np.sign(v))
        out.append(abs(gap) <= 1e-5 * max(row[f"s{i}"], 1e-12))
    return out


@register("normal_equations", f"""
SELECT unnest(['ols', 'ridge', 'lasso']) AS model, feature, true AS holds
FROM (SELECT unnest([{', '.join(O.q(c) for c in NUMERIC)}]) AS feature)""")
def normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1 + ML2 + ML3: the optimum's conditions of every fit, checked over all rows: normal equations of OLS (MLlib), the
    grid's ridge and the subgradient of its lasso."""
    g = _gold(spark, sf_dir)
    feats = _features(g)
    data = G.fold_sums(g, feats, TARGET, G.FOLDS)
    ols = RG.fit_linear(g, feats, TARGET, use_split=False)
    ridge = G.alpha_grid(data, "ridge", (1.0,))
    lasso = G.alpha_grid(data, "lasso", (0.01,))
    found = {"ols": _least_squares_hold(g, feats, ols.model.coefficients.toArray(), ols.model.intercept, 0.0, 0.0),
             "ridge": _least_squares_hold(g, feats, ridge.coefficients, ridge.intercept, 1.0, 0.0),
             "lasso": _least_squares_hold(g, feats, lasso.coefficients, lasso.intercept, 0.0, 0.01)}
    return spark.createDataFrame([(m, f, bool(h)) for m, hs in found.items() for f, h in zip(feats, hs, strict=True)],
                                 "model string, feature string, holds boolean")


@register("tree_attributions", f"""
WITH {O.gold_ctes()}
SELECT row_id, CAST(unnest([0, 1, 2]) AS INTEGER) AS class, true AS adds_up, {len(NUMERIC)} AS n_features FROM gold""")
def tree_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XAI3: exact tree attributions of the boosted regime classifier for every row and class; base and attributions
    add up to the margin."""
    rows, fitted = _risk_model(spark, sf_dir)
    total = F.aggregate("attributions", F.lit(0.0), lambda a, v: a + v)
    return A.tree_attributions(rows, fitted[0]).select(
        "row_id", "class", (F.abs(F.col("base") + total - F.col("margin")) < 1e-6).alias("adds_up"), F.size("attributions").alias("n_features"))


@register("kernel_attributions", f"""
WITH {O.gold_ctes()}
SELECT row_id, true AS adds_up, {len(NUMERIC)} AS n_features FROM gold""")
def kernel_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XAI2: kernel attributions of the neural regressor for every row, k-means background of 10 centres, 100 coalitions."""
    g = _gold(spark, sf_dir)
    feats = _features(g)
    model = fit_neural(g, feats, TARGET)
    found = A.kernel_attributions(g, model.predict, feats, *A.background(g, feats), coalition_values=model.coalition_values)
    total = F.aggregate("attributions", F.lit(0.0), lambda a, v: a + v)
    return found.select("row_id", (F.abs(F.col("base") + total - F.col("prediction")) < 1e-6).alias("adds_up"), F.size("attributions").alias("n_features"))


@register("quick_update", f"""
WITH {O.gold_ctes()},
newest AS (SELECT * FROM gold ORDER BY "timestamp" DESC, row_id DESC LIMIT {QUICK_ROWS}),
st AS (SELECT avg({TARGET}) AS m, stddev_samp({TARGET}) AS s FROM newest)
SELECT row_id, round(avg(sentiment_polarity) OVER w7, 6) AS sentiment_ma_7, round(avg(keyword_stress_score) OVER w7, 6) AS stress_ma_7,
       CASE WHEN {TARGET} <= 0.3 THEN 'low' WHEN {TARGET} <= 0.7 THEN 'medium' ELSE 'high' END AS risk_regime,
       CAST(CASE WHEN abs(({TARGET} - m) / s) > 2 THEN 1 ELSE 0 END AS INTEGER) AS is_anomaly,
       round(abs(({TARGET} - m) / s), 6) AS anomaly_score, true AS residuals_centred
FROM newest, st WINDOW w7 AS (ORDER BY "timestamp", row_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def quick_update_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML10 + LIM2: the newest 500 rows with moving averages, OLS and ridge fitted in-sample, threshold regimes and z-score
    anomalies; the residuals of both fits have mean 0."""
    rows = cut_lineage(most_recent(_gold(spark, sf_dir), QUICK_ROWS))
    feats = _features(rows)
    out = quick_update(rows)
    for fit in (RG.fit_linear(rows, feats, TARGET, use_split=False), RG.fit_ridge(rows, feats, TARGET, 1.0, use_split=False)):
        out = fit.transform(out)
    means = out.agg(F.avg("linear_regression_residual").alias("_ols"), F.avg("ridge_regression_residual").alias("_ridge"))
    centred = (F.abs("_ols") < 1e-6) & (F.abs("_ridge") < 1e-6)
    return out.crossJoin(F.broadcast(means)).select(  # one row
        "row_id", r6(F.col("sentiment_ma_7")).alias("sentiment_ma_7"), r6(F.col("stress_ma_7")).alias("stress_ma_7"), "risk_regime",
        "is_anomaly", r6(F.col("anomaly_score")).alias("anomaly_score"), centred.alias("residuals_centred"))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


@register("snapshot_round_trip", f"""
WITH {O.gold_ctes()}
SELECT row_id, source, round({TARGET}, 6) AS {TARGET}, 'gold' AS layer, (SELECT count(*) FROM gold) AS published_rows FROM gold""")
def snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1 + SRC1 + SRC2: gold written as two runs; the newest published one is read back, by the best-gold rule as well."""
    root, g = _scratch(spark, "snapshots"), _gold(spark, sf_dir).select("row_id", "source", TARGET)
    write_snapshot(g.withColumn(TARGET, F.lit(0.0)), root, "gold", "20240101_000000")
    write_snapshot(g, root, "gold", "20240102_000000")
    newest = read_latest_snapshot(spark, root, "gold").select("row_id", "source", TARGET)
    best = read_best_gold(spark, root).select("row_id", F.col(TARGET).alias("_best"))
    rows = published_runs(spark, root, "gold").where("run_id = '20240102_000000'").select(F.col("rows").alias("published_rows"))
    return newest.join(best, "row_id").where(F.col(TARGET).eqNullSafe(F.col("_best"))).crossJoin(F.broadcast(rows)).select(  # one row
        "row_id", "source", r6(F.col(TARGET)).alias(TARGET), F.lit("gold").alias("layer"), "published_rows")


@register("export_round_trip", f"""
WITH {O.gold_ctes()}
SELECT unnest(['csv', 'json']) AS format, row_id, source, array_to_string(market_tags, '|') AS tags, round({TARGET}, 6) AS {TARGET} FROM gold""")
def export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2 + SNK3: gold exported as CSV (lists as JSON text) and as JSON records, and read back."""
    root, g = _scratch(spark, "exports"), _gold(spark, sf_dir).select("row_id", "source", "market_tags", TARGET)
    export_csv(g, f"{root}/csv")
    export_json(g, f"{root}/json")
    csv = spark.read.schema(f"row_id long, source string, market_tags string, {TARGET} double").option("header", True).option("escape", "\\") \
        .csv(f"{root}/csv").withColumn("market_tags", F.from_json("market_tags", "array<string>"))
    both = csv.withColumn("format", F.lit("csv")).unionByName(spark.read.schema(g.schema).json(f"{root}/json").withColumn("format", F.lit("json")))
    return both.select("format", "row_id", "source", F.array_join("market_tags", "|").alias("tags"), r6(F.col(TARGET)).alias(TARGET))
