"""Registered queries for the analytical views (dashboard tables) over the gold rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import r6
from tidemark.operators import views as V
from tidemark.plans import oracle as O
from tidemark.plans.pipeline import gold_features
from tidemark.plans.registry import register
from tidemark.sources.views import articles

PRED_SQL = f"""{O.gold_ctes()},
qs AS (SELECT avg(weighted_stress_score) AS m, stddev_samp(weighted_stress_score) AS s FROM gold),
pred0 AS (
  SELECT g.*,
         CASE WHEN weighted_stress_score IS NULL THEN NULL WHEN weighted_stress_score <= 0.3 THEN 'low'
              WHEN weighted_stress_score <= 0.7 THEN 'medium' ELSE 'high' END AS risk_regime,
         CASE WHEN s IS NULL OR s = 0 THEN NULL ELSE abs((weighted_stress_score - m) / s) END AS anomaly_score,
         avg(sentiment_polarity) OVER w7 AS sentiment_ma_7, avg(keyword_stress_score) OVER w7 AS stress_ma_7
  FROM gold g CROSS JOIN qs
  WINDOW w7 AS (ORDER BY "timestamp", row_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
pred AS (
  SELECT *, CASE WHEN risk_regime = 'low' THEN 1.0 ELSE 0.0 END AS prob_low,
         CASE WHEN risk_regime = 'medium' THEN 1.0 ELSE 0.0 END AS prob_medium,
         CASE WHEN risk_regime = 'high' THEN 1.0 ELSE 0.0 END AS prob_high,
         CASE WHEN coalesce(anomaly_score > 2, false) THEN 1 ELSE 0 END AS is_anomaly
  FROM pred0)"""


def predictions(spark: SparkSession, sf_dir: str, row_order: bool = False) -> DataFrame:
    """Gold rows with regimes and flags; only ``row_order`` consumers pay for the row index."""
    return V.quick_update(gold_features(spark, sf_dir, row_order=row_order), moving_averages=row_order)


@register("quick_predictions", f"""
WITH {PRED_SQL}
SELECT row_id, risk_regime, prob_low, prob_medium, prob_high, is_anomaly, round(anomaly_score, 6) AS anomaly_score,
       round(sentiment_ma_7, 6) AS sentiment_ma_7, round(stress_ma_7, 6) AS stress_ma_7
FROM pred""")
def quick_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML10 rule part: PRJ16 regimes + flags, NUM6 z-score anomalies, W10 7-row moving averages."""
    p = V.quick_update(gold_features(spark, sf_dir, row_order=False))
    return p.select("row_id", "risk_regime", "prob_low", "prob_medium", "prob_high", "is_anomaly",
                    *[r6(F.col(c)).alias(c) for c in ("anomaly_score", "sentiment_ma_7", "stress_ma_7")])


@register("filtered_view", f"""
WITH {PRED_SQL},
b AS (SELECT min(CAST("timestamp" AS DATE)) AS lo, max(CAST("timestamp" AS DATE)) AS hi FROM pred),
r AS (SELECT CASE WHEN hi - lo > 30 THEN hi - 30 ELSE lo END AS s, hi AS e FROM b)
SELECT row_id, risk_regime FROM pred CROSS JOIN r
WHERE CAST("timestamp" AS DATE) >= s AND CAST("timestamp" AS DATE) <= e AND is_anomaly = 0
  AND greatest(prob_low, prob_medium, prob_high) >= 0.7""")
def filtered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ10: default 30-day range, anomalies excluded, confidence >= 0.7."""
    p = predictions(spark, sf_dir)
    start, end = V.default_date_range(p)
    return V.apply_filters(p, start, end, anomaly="exclude").select("row_id", "risk_regime")


@register("kpi_summary", f"""
WITH {PRED_SQL}
SELECT round(arg_max(weighted_stress_score, ("timestamp", row_id)), 6) AS current_stress,
       round(avg(weighted_stress_score), 6) AS mean_stress, round(max(weighted_stress_score), 6) AS max_stress,
       round(min(weighted_stress_score), 6) AS min_stress,
       round(arg_max(weighted_stress_score, ("timestamp", row_id)) - avg(weighted_stress_score), 6) AS delta_vs_mean,
       arg_max(risk_regime, ("timestamp", row_id)) AS current_regime,
       CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count, round(avg(is_anomaly) * 100, 6) AS anomaly_rate,
       CAST(count(*) AS BIGINT) AS articles,
       round(count(*) / greatest(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 86400e6), 1), 6)
         AS articles_per_day
FROM pred""")
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7 + AGG6: the KPI row."""
    k = V.kpis(predictions(spark, sf_dir))
    return k.select(*[r6(F.col(c)).alias(c) for c in ("current_stress", "mean_stress", "max_stress", "min_stress",
                                                       "delta_vs_mean")],
                    "current_regime", "anomaly_count", r6(F.col("anomaly_rate")).alias("anomaly_rate"),
                    "articles", r6(F.col("articles_per_day")).alias("articles_per_day"))


@register("regime_distribution", f"""
WITH {PRED_SQL}
SELECT risk_regime, CAST(count(*) AS BIGINT) AS count FROM pred WHERE risk_regime IS NOT NULL GROUP BY risk_regime""")
def regime_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5 + AGG26: regime counts (the distinct regimes are the filter choices)."""
    p = predictions(spark, sf_dir).where(F.col("risk_regime").isNotNull())
    return p.groupBy("risk_regime").agg(F.count(F.lit(1)).cast("long").alias("count"))


DESCRIBE_COLS = ("weighted_stress_score", "keyword_stress_score", "sentiment_polarity", "vader_compound")


def _describe_sql() -> str:
    parts = []
    for c in DESCRIBE_COLS:
        h = O.half_up_sql
        parts.append(
            f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, {h(f'avg({c})', 3)} AS mean, "
            f"{h(f'stddev_samp({c})', 3)} AS std, {h(f'min({c})', 3)} AS min, "
            f"{h(f'quantile_cont({c}, 0.25)', 3)} AS p25, {h(f'quantile_cont({c}, 0.5)', 3)} AS p50, "
            f"{h(f'quantile_cont({c}, 0.75)', 3)} AS p75, {h(f'max({c})', 3)} AS max FROM pred")
    return " UNION ALL ".join(parts)


@register("describe_stats", f"WITH {PRED_SQL} {_describe_sql()}")
def describe_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9: descriptive statistics of the main scores."""
    d = V.describe(predictions(spark, sf_dir), DESCRIBE_COLS)
    return d.select("column", "count", *[(F.col(c) + F.lit(0.0)).alias(c) for c in
                                         ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("data_quality", f"""
WITH {O.ARTICLES}
SELECT CAST(count(*) AS BIGINT) AS rows, 7 AS columns,
       round(1 - (count_if(row_id IS NULL) + count_if(headline IS NULL) + count_if("timestamp" IS NULL)
             + count_if(source IS NULL) + count_if(asset_type IS NULL) + count_if(price IS NULL)
             + count_if(change_percent IS NULL)) / (count(*) * 7.0), 6) AS completeness,
       strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') AS min_timestamp
FROM articles""")
def data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG18: size, completeness and time start of the article table."""
    q = V.data_quality(articles(spark, sf_dir))
    return q.select("rows", F.col("columns").cast("int").alias("columns"),
                    r6(F.col("completeness")).alias("completeness"),
                    F.date_format("min_timestamp", "yyyy-MM-dd HH:mm:ss").alias("min_timestamp"))


@register("stress_trend", f"""
WITH {PRED_SQL},
i AS (SELECT weighted_stress_score AS y, CAST(row_number() OVER (ORDER BY "timestamp", row_id) - 1 AS DOUBLE) AS x
      FROM pred)
SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, CAST(count(*) AS BIGINT) AS n
FROM i""")
def stress_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG20 (+ W0): linear trend of the stress score over the row order."""
    t = V.linear_trend(predictions(spark, sf_dir))
    return t.select(r6(F.col("slope")).alias("slope"), r6(F.col("intercept")).alias("intercept"), "n")


@register("recent_items", f"""
WITH {PRED_SQL}
SELECT row_id, strftime("timestamp", '%Y-%m-%d %H:%M') AS time, headline, round(sentiment_polarity, 6) AS sentiment_polarity,
       round(weighted_stress_score, 6) AS weighted_stress_score
FROM pred ORDER BY "timestamp" DESC, row_id DESC LIMIT 10""")
def recent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIM1 + PRJ19: the ten newest rows for display (a top-k report)."""
    r = V.recent_items(predictions(spark, sf_dir), 10)
    return r.select("row_id", "time", "headline", r6(F.col("sentiment_polarity")).alias("sentiment_polarity"),
                    r6(F.col("weighted_stress_score")).alias("weighted_stress_score"))


@register("preview_rows", f"""
WITH {PRED_SQL}
SELECT row_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS ts FROM pred ORDER BY "timestamp", row_id LIMIT 5""")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIM3: the first five rows (a preview)."""
    f = V.first_rows(predictions(spark, sf_dir), 5)
    return f.select("row_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts"))


ARTICLE_COLUMNS = ("row_id", "headline", "timestamp", "source", "asset_type", "price", "change_percent")


@register("column_profile", f"""
WITH {O.ARTICLES}
{' UNION ALL '.join(f"""
SELECT {i + 1} AS position, '{c}' AS "column",
       CASE WHEN any_value(typeof("{c}")) IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric'
            WHEN any_value(typeof("{c}")) = 'VARCHAR' THEN 'categorical' ELSE 'other' END AS kind,
       concat_ws('|', CASE WHEN '{c}' LIKE '%price%' OR '{c}' LIKE '%close%' OR '{c}' LIKE '%value%' THEN 'price' END,
                 CASE WHEN '{c}' LIKE '%volume%' THEN 'volume' END,
                 CASE WHEN '{c}' LIKE '%date%' OR '{c}' LIKE '%time%' THEN 'date' END) AS roles,
       CAST(count("{c}") AS BIGINT) AS "values" FROM articles""" for i, c in enumerate(ARTICLE_COLUMNS))}""")
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG18 column lists + PRJ17 roles found by name, over every article."""
    return V.column_profile(articles(spark, sf_dir).select(*ARTICLE_COLUMNS))
