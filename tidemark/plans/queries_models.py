"""Registered queries for the models (fits run on the gold rows of the driver tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import r6
from tidemark.models import classifier as CL
from tidemark.models import iforest as IF
from tidemark.models import knn as KNN
from tidemark.models import lagged as LG
from tidemark.models import regression as RG
from tidemark.models.features import hash_split, numeric_features
from tidemark.models.training import default_trainers
from tidemark.models.training import train_all as run_training
from tidemark.operators.clean import clean_articles
from tidemark.operators.composite import engineer_features
from tidemark.operators.validate import validate
from tidemark.plans import oracle as O
from tidemark.plans.pipeline import gold_features
from tidemark.plans.registry import register
from tidemark.session import stored
from tidemark.sources.views import articles

TARGET = "weighted_stress_score"


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows without the texts, written once to the shared checkpoint folder by columns: every fit and report of a
    query reads what it needs of that."""
    return stored(gold_features(spark, sf_dir, texts=False))


@register("linear_fit_1f", f"""
WITH {O.gold_ctes()}
SELECT round(regr_slope(weighted_stress_score, keyword_stress_score), 6) AS slope,
       round(regr_intercept(weighted_stress_score, keyword_stress_score), 6) AS intercept FROM gold""")
def linear_fit_1f(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1 with one feature on all rows: MLlib OLS against the SQL least-squares line."""
    fit = RG.fit_linear(_gold(spark, sf_dir), ["keyword_stress_score"], TARGET, use_split=False)
    return spark.createDataFrame([(float(fit.model.coefficients[0]), float(fit.model.intercept))],
                                 "slope double, intercept double").select(
        r6(F.col("slope")).alias("slope"), r6(F.col("intercept")).alias("intercept"))


def _features(g: DataFrame) -> list[str]:
    return numeric_features(g)


@register("regression_coefficients")
def regression_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1 + ML2 + ML3 + TOP1: coefficient tables of OLS, ridge (alpha 1) and lasso (alpha .01)."""
    g = _gold(spark, sf_dir)
    feats = _features(g)
    out = None
    for fit in (RG.fit_linear(g, feats), RG.fit_ridge(g, feats), RG.fit_lasso(g, feats)):
        c = fit.coefficients(spark).withColumn("model", F.lit(fit.name))
        out = c if out is None else out.unionByName(c)
    return out


@register("model_metrics")
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML0a + ML0e + J1 + NUM7 + AGG8: fit the three linear models and the degree-2 polynomial on the
    training split, score every row, MSE/MAE/R^2 on the held-out rows."""
    g = _gold(spark, sf_dir)
    feats = _features(g)
    fits = [RG.fit_linear(g, feats), RG.fit_ridge(g, feats), RG.fit_lasso(g, feats),
            RG.fit_polynomial(g, feats)]
    scored = g
    for fit in fits:
        scored = fit.transform(scored)
    test = hash_split(scored).where(~F.col("is_train"))
    return RG.evaluate(test, TARGET, [f"{f.name}_prediction" for f in fits])


@register("polynomial_terms")
def polynomial_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML4 + ML4b: the 15 largest degree-2 terms (interaction terms contain a space)."""
    g = _gold(spark, sf_dir)
    fit = RG.fit_polynomial(g, _features(g))
    c = fit.coefficients(spark).where(F.col("feature") != "(intercept)")
    return c.withColumn("is_interaction", F.col("feature").contains(" ")).limit(15)


#: Numeric columns of the gold rows (PRJ11).
NUMERIC = ("price", "change_percent", "sentiment_subjectivity", "combined_sentiment", "keyword_stress_score", "headline_length",
           "word_count", "mentions_equities", "mentions_bonds", "mentions_commodities", "mentions_forex", "mentions_volatility",
           "hour", "day_of_week", "is_weekend", "month", "daily_article_count", "rolling_7d_mean", "rolling_7d_volatility",
           "lag_1d", "lag_3d", "lag_7d", "market_breadth", "sentiment_volatility_7d")
LAGS, ROLL = 3, 3


def _lag_names(columns) -> list[str]:
    return [f"{c}_{s}" for c in columns for s in (*[f"lag_{k}" for k in range(1, LAGS + 1)], "roll_mean", "roll_std")]


def _lagged_cte(columns) -> str:
    """Lagged rows without gaps."""
    return f"""
lagged AS (SELECT row_id, {', '.join(columns)},
  {', '.join(f'lag({c}, {k}) OVER w AS {c}_lag_{k}' for c in columns for k in range(1, LAGS + 1))},
  {', '.join(f'avg({c}) OVER wr AS {c}_roll_mean, CASE WHEN count({c}) OVER wr = 1 THEN 0.0 ELSE stddev_samp({c}) OVER wr END AS {c}_roll_std' for c in columns)}
  FROM gold WINDOW w AS (ORDER BY "timestamp", row_id),
                   wr AS (ORDER BY "timestamp", row_id ROWS BETWEEN {ROLL} PRECEDING AND 1 PRECEDING)),
whole AS (SELECT * FROM lagged WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*columns, *_lag_names(columns)])})"""


@register("lag_features", f"""
WITH {O.gold_ctes()}, {_lagged_cte(NUMERIC)}
SELECT row_id, {', '.join(f'round({c}, 6) AS {c}_current' for c in NUMERIC)},
       {', '.join(f'round({c}, 6) AS {c}' for c in _lag_names(NUMERIC))} FROM whole""")
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W9 on the row grain: current value, lags 1-3 and the rolling mean/std of the 3 previous rows of every numeric
    column, over the global (timestamp, row_id) order through the blocked window; rows with a gap dropped."""
    return _all_lagged(_gold(spark, sf_dir))


def _all_lagged(gold: DataFrame, lag_window: int = LAGS) -> DataFrame:
    columns = numeric_features(gold)
    rows = LG.lagged_features(gold, columns, *LG.lag_sizes(gold.count(), lag_window))
    return rows.select("row_id", *[r6(F.col(c)).alias(c) for c in rows.columns[1:]])


@register("variance_ranking", f"""
WITH {O.gold_ctes()},
v AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, var_samp(CAST({c} AS DOUBLE)) AS variance FROM gold" for c in NUMERIC)})
SELECT feature, round(variance, 6) AS variance,
       CAST(row_number() OVER (ORDER BY variance DESC NULLS LAST, feature) AS INTEGER) AS rank FROM v""")
def variance_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG23: numeric columns by their variance."""
    g = _gold(spark, sf_dir)
    return LG.variance_ranking(g, _features(g)).withColumn("variance", r6(F.col("variance")))


@register("lagged_regression")
def lagged_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML5: OLS of the stress score on the scaled W9 features of all numeric columns (coefficients, rows-only check)."""
    return LG.fit_lagged(_gold(spark, sf_dir), TARGET, LAGS).fit.coefficients(spark)


@register("lagged_predictions", f"""
WITH {O.gold_ctes()}, {_lagged_cte([*NUMERIC, TARGET])}
SELECT row_id, row_id NOT IN (SELECT row_id FROM whole) AS mean_filled, true AS has_prediction FROM gold""")
def lagged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML5 + J4: a prediction for every row; rows without a full set of lags get the mean."""
    g = _gold(spark, sf_dir)
    p = LG.predict_lagged(g, LG.fit_lagged(g, TARGET, LAGS))
    return p.select("row_id", F.col("time_lagged_prediction_filled").alias("mean_filled"),
                    F.col("time_lagged_prediction").isNotNull().alias("has_prediction"))


def _labels_sql() -> str:
    """Labels by the score quantiles, and the stratified split."""
    return f"""{O.gold_ctes()},
qs AS (SELECT quantile_cont(weighted_stress_score, 0.33) AS lo, quantile_cont(weighted_stress_score, 0.67) AS hi FROM gold),
labelled AS (
  SELECT row_id, weighted_stress_score, CAST(CASE WHEN weighted_stress_score < lo THEN 0 WHEN weighted_stress_score > hi THEN 2
                           ELSE 1 END AS INTEGER) AS label FROM gold, qs),
split AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(row_id AS VARCHAR)), row_id)
            > floor(0.2 * count(*) OVER (PARTITION BY label) + 0.5) AS is_train FROM labelled)"""


@register("regime_split", f"WITH {_labels_sql()} SELECT row_id, label, is_train FROM split")
def regime_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML7b + ML0b: regime label of every row, and the stratified split."""
    return CL.regime_split(_gold(spark, sf_dir)).select("row_id", F.col("label").cast("int").alias("label"), "is_train")


@register("regime_by_position", f"""
WITH {O.gold_ctes()},
i AS (SELECT row_id, row_number() OVER (ORDER BY "timestamp", row_id) AS idx, count(*) OVER () AS n FROM gold)
SELECT row_id, CASE WHEN n < 3 THEN 'medium' WHEN idx > n - ceil(n / 3) THEN 'high' WHEN idx <= floor(n / 3) THEN 'low'
                    ELSE 'medium' END AS regime_label FROM i""")
def regime_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML7b without a stress score: labels by position in time."""
    return CL.regime_labels(_gold(spark, sf_dir).drop(TARGET)).select("row_id", "regime_label")


#: Models of the registered train-all; the two slow ones have queries of their own.
TRAINED = ("linear_regression", "ridge_regression", "lasso_regression", "polynomial_regression", "time_lagged_regression", "isolation_forest")


@register("train_all", f"""
WITH {O.gold_ctes()}
SELECT model, 'success' AS status, (SELECT CAST(count(*) AS BIGINT) FROM gold) AS predictions, CAST(NULL AS VARCHAR) AS error
FROM (VALUES {', '.join(f"('{m}')" for m in TRAINED)}) AS t(model)""")
def train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML0e + PRJ13: every model fitted and applied on the written gold rows; status and number of predictions."""
    trainers = default_trainers(TARGET)
    return run_training(_gold(spark, sf_dir), {m: trainers[m] for m in TRAINED})[1]


def _risk_model(spark: SparkSession, sf_dir: str):
    """Labelled rows with the split, and the boosted model of the training rows (100 rounds, depth 6, rate 0.1)."""
    g = _gold(spark, sf_dir)
    rows = stored(CL.regime_split(g))
    return rows, CL.fit_classifier(rows, _features(g))


@register("risk_classifier")
def risk_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML7 + ML7b + ML0b + AGG25: boosted regime classifier and its per-class report on the held-out rows."""
    rows, fitted = _risk_model(spark, sf_dir)
    return CL.classification_report(CL.predict_regimes(rows.where("NOT is_train"), fitted))


@register("risk_predictions")
def risk_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML7 scoring: regime and class probabilities per row (probabilities sum to 1)."""
    rows, fitted = _risk_model(spark, sf_dir)
    p = CL.predict_regimes(rows, fitted)
    return p.select("row_id", "risk_regime", *[r6(F.col(f"prob_{c}")).alias(f"prob_{c}") for c in CL.CLASSES])


def _sim_sql() -> str:
    feats = KNN.DAILY_FEATURES
    means = ", ".join(f"avg({c}) AS {c}" for c in KNN.MEAN_COLS)
    firsts = ", ".join(f"arg_min({c}, (\"timestamp\", row_id)) AS {c}" for c in KNN.FIRST_COLS)
    dv2 = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in feats)
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in feats)
    z = lambda c, src: f"(CASE WHEN st.s_{c} > 0 THEN ({src}.{c} - st.m_{c}) / st.s_{c} ELSE 0.0 END)"
    dist = " + ".join(f"pow({z(c, 'd')} - {z(c, 't')}, 2)" for c in feats)
    total = " + ".join(f"abs(d.{c} - t.{c})" for c in feats)
    gaps = " UNION ALL ".join(
        f"SELECT date, {i} AS idx, '{c}' AS feature, CASE WHEN total > 0 THEN g{i} / total ELSE 0.0 END AS contribution "
        f"FROM near" for i, c in enumerate(feats))
    gcols = ", ".join(f"abs(d.{c} - t.{c}) AS g{i}" for i, c in enumerate(feats))
    return f"""
WITH {O.gold_ctes()},
dv AS (SELECT CAST("timestamp" AS DATE) AS date, {means}, {firsts} FROM gold GROUP BY 1),
dv2 AS (SELECT date, {dv2} FROM dv),
st AS (SELECT {st}, max(date) AS latest FROM dv2),
t AS (SELECT dv2.* FROM dv2, st WHERE dv2.date = st.latest),
dd AS (SELECT d.date, t.date AS target_date, sqrt({dist}) AS distance, {total} AS total, {gcols}
       FROM dv2 d, t, st WHERE d.date <> t.date),
near AS (SELECT * FROM dd ORDER BY distance, date LIMIT 5),
g AS ({gaps}),
top AS (SELECT date, string_agg(feature || ':' || {O.fmt_sql('contribution', 6)}, '|' ORDER BY contribution DESC, idx DESC)
          AS top_features
        FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY contribution DESC, idx DESC) AS rn FROM g)
        WHERE rn <= 3 GROUP BY date)
SELECT strftime(target_date, '%Y-%m-%d') AS target_date, strftime(near.date, '%Y-%m-%d') AS date,
       round(distance, 6) AS distance, round(1.0 / (1.0 + distance), 6) AS similarity_score,
       CAST(target_date - near.date AS INTEGER) AS days_apart, top_features
FROM near JOIN top USING (date)"""


@register("similar_periods", _sim_sql())
def similar_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2 + ML0c + ML8 + J8 + TOP3 + NUM5 + DT4: the 5 days most similar to the latest day."""
    s = KNN.similar_periods(_gold(spark, sf_dir), 5)
    tf = F.array_join(F.transform("top_similarity_features", lambda x: F.concat(
        x["feature"], F.lit(":"), F.format_string("%.6f", F.round(x["contribution"], 6) + F.lit(0.0)))), "|")
    return s.select(F.date_format("target_date", "yyyy-MM-dd").alias("target_date"),
                    F.date_format("date", "yyyy-MM-dd").alias("date"), r6(F.col("distance")).alias("distance"),
                    r6(F.col("similarity_score")).alias("similarity_score"), F.col("days_apart").cast("int"),
                    tf.alias("top_features"))


@register("anomaly_forest")
def anomaly_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML9 + TOP2: isolation-forest flags, scores and the three most deviating features per row."""
    g = _gold(spark, sf_dir)
    model = IF.fit_isolation_forest(g, _features(g), trees=100)
    out = model.transform(g)
    return out.select("row_id", "is_anomaly", r6(F.col("anomaly_score")).alias("anomaly_score"),
                      F.array_join(F.transform("top_anomaly_features", lambda x: x["feature"]), "|")
                      .alias("top_anomaly_features"))


@register("anomaly_importance", f"""
WITH {O.gold_ctes()},
s AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) AS sd FROM gold" for c in NUMERIC)})
SELECT feature, round(sd / max(sd) OVER (), 6) AS relative_importance FROM s""")
def anomaly_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML9 importance (deviation times the mean absolute anomaly score), relative to the largest."""
    g = _gold(spark, sf_dir)
    table = IF.feature_importance(IF.fit_isolation_forest(g, _features(g)), g)
    top = table.agg(F.max("importance").alias("top"))  # one row
    return table.crossJoin(F.broadcast(top)).select("feature", r6(F.col("importance") / F.col("top")).alias("relative_importance"))


@register("anomaly_evaluation")
def anomaly_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG25: precision/recall/F1 of the forest against the 5 %/95 % stress-band proxy."""
    g = IF.proxy_truth(_gold(spark, sf_dir))
    model = IF.fit_isolation_forest(g, _features(g), trees=100)
    return CL.binary_report(model.transform(g), "proxy_anomaly", "is_anomaly")


@register("linear_attributions")
def linear_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XAI1 + XAI4: mean |coef * (x - mean)| per feature, top 10 with share %."""
    g = _gold(spark, sf_dir)
    fit = RG.fit_linear(g, _features(g), use_split=False)
    return RG.linear_attributions(g, fit, 10)


@register("run_metrics", f"""
WITH {O.gold_ctes()}
SELECT (SELECT CAST(count(*) AS BIGINT) FROM articles) AS bronze_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM mvalid) AS valid_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM msilver) AS silver_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM gold) AS gold_rows,
       round((SELECT 100.0 * (1 - (SELECT count(*) FROM msilver) / count(*)) FROM articles), 6) AS removed_pct,
       (SELECT strftime(min("timestamp"), '%Y-%m-%d') FROM gold) AS first_day,
       (SELECT strftime(max("timestamp"), '%Y-%m-%d') FROM gold) AS last_day""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG21: rows of each stage, counted while the stages run (``observe``): the bronze to silver plan runs once, as its
    result is written, and gold is aggregated once.  (A stage that Spark runs again after losing an executor may be
    counted again; the written rows are not.)"""
    seen = {name: Observation(name) for name in ("bronze", "valid", "silver")}
    watch = lambda df, name: df.observe(seen[name], F.count(F.lit(1)).alias("rows"))
    valid, _ = validate(watch(articles(spark, sf_dir), "bronze"), kind="market")
    silver = stored(watch(clean_articles(watch(valid, "valid"), kind="market"), "silver"))
    rows = {name: seen[name].get["rows"] for name in seen}
    g = engineer_features(silver, row_order=False)  # the counts need no row order
    removed = F.lit(100.0 * (1 - rows["silver"] / rows["bronze"]) if rows["bronze"] else None).cast("double")
    return g.agg(F.count(F.lit(1)).cast("long").alias("gold_rows"),
                 F.date_format(F.min("timestamp"), "yyyy-MM-dd").alias("first_day"),
                 F.date_format(F.max("timestamp"), "yyyy-MM-dd").alias("last_day")).select(
        *[F.lit(rows[n]).cast("long").alias(f"{n}_rows") for n in seen], "gold_rows", r6(removed).alias("removed_pct"), "first_day", "last_day")


@register("neural_regression")
def neural_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML6: dense 64-32-16 ReLU regressor (32-row batches, averaged over tasks once an epoch, early stopping), and OLS
    beside it; metrics of the held-out rows."""
    from tidemark.models.neural import fit_neural

    g = _gold(spark, sf_dir)
    model = fit_neural(g, _features(g), TARGET)
    scored = RG.fit_linear(g, _features(g)).transform(hash_split(model.transform(g)))
    return RG.evaluate(scored.where(~F.col("is_train")), TARGET, ["neural_network_prediction", "linear_regression_prediction"]) \
        .withColumn("epochs_run", F.lit(len(model.history)))
