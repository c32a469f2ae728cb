"""Registered queries for return/risk analytics and correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import r6
from tidemark.operators import correlation as C
from tidemark.operators import risk as R
from tidemark.plans import oracle as O
from tidemark.plans.pipeline import gold_features
from tidemark.plans.registry import register
from tidemark.session import cut_lineage
from tidemark.sources.views import EVENT_TYPES, daily_events, series_daily, series_multi

SERIES_SQL = """
sd AS (SELECT CAST(o_orderdate AS DATE) AS "timestamp", 'orders' AS instrument, sum(o_totalprice) AS price
       FROM orders GROUP BY 1),
de AS (SELECT CAST(ts AS DATE) AS "timestamp", event_type AS instrument, avg(value) AS price
       FROM events GROUP BY 1, 2),
allser AS (SELECT * FROM sd UNION ALL SELECT * FROM de),
rets AS (SELECT *, price / lag(price) OVER (PARTITION BY instrument ORDER BY "timestamp") - 1.0 AS ret FROM allser),
sret AS (SELECT * FROM rets WHERE instrument = 'orders')"""

D = "strftime(\"timestamp\", '%Y-%m-%d')"


def _all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series_daily(spark, sf_dir).unionByName(daily_events(spark, sf_dir))


@register("returns_rolling", f"""
WITH {SERIES_SQL},
w AS (
  SELECT *, count(ret) OVER w20 AS n20, count(ret) OVER w60 AS n60,
         stddev_samp(ret) OVER w20 AS sd20, avg(ret) OVER w20 AS m20,
         stddev_samp(ret) OVER w60 AS sd60, avg(ret) OVER w60 AS m60
  FROM sret WINDOW w20 AS (PARTITION BY instrument ORDER BY "timestamp" ROWS 19 PRECEDING),
                   w60 AS (PARTITION BY instrument ORDER BY "timestamp" ROWS 59 PRECEDING))
SELECT {D} AS date, round(ret, 6) AS ret,
       round(CASE WHEN n20 = 20 THEN sd20 * sqrt(252) END, 6) AS volatility,
       round(CASE WHEN n20 = 20 THEN m20 * 252 END, 6) AS rolling_return,
       round(CASE WHEN n60 = 60 AND sd60 <> 0 THEN (m60 * 252) / (sd60 * sqrt(252)) END, 6) AS rolling_sharpe
FROM w""")
def returns_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 + W6 + W7 on the daily order-value series."""
    rr = R.rolling_risk(R.returns(series_daily(spark, sf_dir)))
    return rr.select(F.date_format("timestamp", "yyyy-MM-dd").alias("date"),
                     *[r6(F.col(c)).alias(c) for c in ("ret", "volatility", "rolling_return", "rolling_sharpe")])


@register("drawdown", f"""
WITH {SERIES_SQL},
c AS (SELECT *, product(1.0 + ret) OVER (PARTITION BY instrument ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS cum
      FROM sret WHERE ret IS NOT NULL),
m AS (SELECT *, max(cum) OVER (PARTITION BY instrument ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS rmax FROM c)
SELECT {D} AS date, round(cum - 1.0, 6) AS cumulative_return, round(rmax, 6) AS running_max,
       round((cum - rmax) / rmax, 6) AS drawdown
FROM m""")
def drawdown_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8: cumulative return, running maximum and drawdown."""
    d = R.drawdown(R.returns(series_daily(spark, sf_dir)))
    return d.select(F.date_format("timestamp", "yyyy-MM-dd").alias("date"),
                    r6(F.col("cumulative_return")).alias("cumulative_return"),
                    r6(F.col("running_max")).alias("running_max"), r6(F.col("drawdown")).alias("drawdown"))


RISK_COLS = ("annual_return", "annual_volatility", "sharpe_ratio", "var_95", "var_99", "cvar_95", "cvar_99",
             "skewness", "kurtosis", "max_drawdown")


@register("risk_metrics", f"""
WITH {SERIES_SQL},
r AS (SELECT * FROM rets WHERE ret IS NOT NULL),
st AS (SELECT instrument, avg(ret) * 252 AS annual_return, stddev_samp(ret) * sqrt(252) AS annual_volatility,
              quantile_cont(ret, 0.05) AS var_95, quantile_cont(ret, 0.01) AS var_99,
              skewness(ret) AS skewness, kurtosis(ret) AS kurtosis, count(ret) AS n_returns
       FROM r GROUP BY instrument),
tl AS (SELECT r.instrument, avg(CASE WHEN ret <= var_95 THEN ret END) AS cvar_95,
              avg(CASE WHEN ret <= var_99 THEN ret END) AS cvar_99
       FROM r JOIN st USING (instrument) GROUP BY r.instrument),
c AS (SELECT *, product(1.0 + ret) OVER (PARTITION BY instrument ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS cum
      FROM r),
dd AS (SELECT instrument, min((cum - rmax) / rmax) AS max_drawdown FROM
       (SELECT *, max(cum) OVER (PARTITION BY instrument ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS rmax FROM c)
       GROUP BY instrument)
SELECT instrument, CAST(n_returns AS BIGINT) AS n_returns, round(annual_return, 6) AS annual_return,
       round(annual_volatility, 6) AS annual_volatility,
       round(CASE WHEN annual_volatility > 0 THEN annual_return / annual_volatility ELSE 0.0 END, 6) AS sharpe_ratio,
       round(var_95, 6) AS var_95, round(var_99, 6) AS var_99, round(cvar_95, 6) AS cvar_95,
       round(cvar_99, 6) AS cvar_99, round(skewness, 6) AS skewness, round(kurtosis, 6) AS kurtosis,
       round(max_drawdown, 6) AS max_drawdown
FROM st JOIN tl USING (instrument) JOIN dd USING (instrument)""")
def risk_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG13 for every series (orders and each event type)."""
    m = R.risk_metrics(_all_series(spark, sf_dir))
    return m.select("instrument", "n_returns", *[r6(F.col(c)).alias(c) for c in RISK_COLS])


@register("autocorrelation", f"""
WITH {SERIES_SQL},
r AS (SELECT instrument, "timestamp", ret FROM sret WHERE ret IS NOT NULL),
l AS (SELECT r.*, k, lag(ret, k) OVER (PARTITION BY instrument, k ORDER BY "timestamp") AS lr
      FROM r CROSS JOIN range(1, 21) t(k))
SELECT instrument, CAST(k AS INTEGER) AS lag, round(corr(ret, lr), 6) AS autocorr FROM l GROUP BY instrument, k""")
def autocorrelation_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14: autocorrelation of the daily returns at lags 1-20."""
    a = R.autocorrelation(series_daily(spark, sf_dir))
    return a.select("instrument", "lag", r6(F.col("autocorr")).alias("autocorr"))


@register("return_histogram", f"""
WITH {SERIES_SQL},
r AS (SELECT ret FROM sret WHERE ret IS NOT NULL),
b AS (SELECT min(ret) AS lo, max(ret) AS hi FROM r),
x AS (SELECT CAST(CASE WHEN (hi - lo) / 50 > 0 THEN least(floor((ret - lo) / ((hi - lo) / 50)), 49) ELSE 0 END
              AS INTEGER) AS bin, lo, hi FROM r CROSS JOIN b)
SELECT bin, CAST(count(*) AS BIGINT) AS count, round(min(lo) + bin * (min(hi) - min(lo)) / 50, 6) AS bin_start
FROM x GROUP BY bin""")
def return_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG16: 50-bin histogram of the daily returns."""
    h = R.histogram(R.returns(series_daily(spark, sf_dir)), "ret", 50)
    return h.select("bin", "count", r6(F.col("bin_start")).alias("bin_start"))


@register("return_overlay", f"""
WITH {SERIES_SQL},
s AS (SELECT min(ret) AS lo, max(ret) AS hi, avg(ret) AS m, stddev_samp(ret) AS sd FROM sret),
x AS (SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 99 AS x, m, sd FROM s, range(100) t(i))
SELECT point, round(x, 6) AS x, round(exp(-0.5 * pow((x - m) / sd, 2)) / (sd * sqrt(2 * pi())), 6) AS density FROM x""")
def return_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG16: normal density over the range of the daily returns."""
    o = R.normal_overlay(R.returns(series_daily(spark, sf_dir)), "ret", 100)
    return o.select("point", r6(F.col("x")).alias("x"), r6(F.col("density")).alias("density"))


@register("vol_regimes", f"""
WITH {SERIES_SQL},
w AS (SELECT *, CASE WHEN count(ret) OVER w20 = 20 THEN stddev_samp(ret) OVER w20 * sqrt(252) END AS vol,
             CASE WHEN count(ret) OVER w20 = 20 THEN avg(ret) OVER w20 * 252 END AS rr
      FROM sret WINDOW w20 AS (PARTITION BY instrument ORDER BY "timestamp" ROWS 19 PRECEDING)),
t AS (SELECT instrument, quantile_cont(vol, 0.75) AS thr FROM w GROUP BY instrument),
g AS (SELECT CASE WHEN vol > thr AND rr > 0 THEN 'High Vol, High Return'
                  WHEN vol > thr AND rr <= 0 THEN 'High Vol, Low Return'
                  WHEN vol <= thr AND rr > 0 THEN 'Low Vol, High Return'
                  WHEN vol <= thr AND rr <= 0 THEN 'Low Vol, Low Return' ELSE 'Unknown' END AS regime
      FROM w JOIN t USING (instrument))
SELECT regime, CAST(count(*) AS BIGINT) AS count FROM g GROUP BY regime""")
def vol_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG17 + PRJ15 + AGG5: volatility/return regimes and their counts."""
    return R.regime_counts(R.regimes(series_daily(spark, sf_dir)))


@register("qq_points", f"""
WITH {SERIES_SQL},
p AS (SELECT i, 0.01 + 0.98 * i / 99 AS prob FROM range(100) t(i)),
s AS (SELECT instrument, quantile_cont(ret, [0.01 + 0.98 * x / 99 for x in range(100)]) AS q FROM sret GROUP BY instrument)
SELECT s.instrument, CAST(p.i AS INTEGER) AS point, round(q[p.i + 1], 6) AS sample_quantile, round(prob, 6) AS probability FROM p, s""")
def qq_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG15: QQ points of the daily returns against the normal distribution.  The theoretical quantile is checked by its
    probability: the normal distribution function there, integrated numerically."""
    q = R.qq_points(series_daily(spark, sf_dir), 100)
    z = F.col("theoretical_quantile")
    steps = 4000  # midpoint rule
    area = F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), F.lit(0.0), lambda acc, k: acc + F.exp(-F.pow(z * (k + 0.5) / steps, F.lit(2)) / 2))
    cdf = F.lit(0.5) + z / steps * area / F.sqrt(F.lit(2.0) * F.pi())
    return q.select("instrument", "point", r6(F.col("sample_quantile")).alias("sample_quantile"), r6(cdf).alias("probability"))


PAIRS = [(a, b) for i, a in enumerate(EVENT_TYPES) for b in EVENT_TYPES[i + 1:]]
MULTI_SQL = "sm AS (SELECT CAST(ts AS DATE) AS date, " + ", ".join(
    f"avg(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in EVENT_TYPES) + " FROM events GROUP BY 1)"
PAIRS_SQL = " UNION ALL ".join(f"SELECT '{a}' AS source, '{b}' AS target, corr({a}, {b}) AS corr FROM sm"
                               for a, b in PAIRS)


@register("correlation_matrix", f"""
WITH {MULTI_SQL}, p AS ({PAIRS_SQL})
SELECT source, target, round(corr, 6) AS corr FROM p""")
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10 + J6: pairwise correlations of the per-type daily averages."""
    p = C.correlation_pairs(series_multi(spark, sf_dir), EVENT_TYPES)
    return p.select("source", "target", r6(F.col("corr")).alias("corr"))


NETWORK_THRESHOLD = 0.2  # the driver data is random: a low threshold so the network has edges


@register("correlation_network", f"""
WITH {MULTI_SQL}, p AS ({PAIRS_SQL}),
e AS (SELECT source, target, abs(corr) AS weight FROM p WHERE abs(corr) > {NETWORK_THRESHOLD}),
n AS (SELECT node, count(*) AS degree FROM (SELECT source AS node FROM e UNION ALL SELECT target FROM e) GROUP BY node)
SELECT e.source, e.target, round(e.weight, 6) AS weight,
       CASE WHEN e.weight > 0.8 THEN 'red' WHEN e.weight > 0.6 THEN 'orange' ELSE 'blue' END AS color,
       CAST(ns.degree AS BIGINT) AS source_degree, CAST(nt.degree AS BIGINT) AS target_degree
FROM e JOIN n ns ON ns.node = e.source JOIN n nt ON nt.node = e.target""")
def correlation_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG12: correlation edges above the threshold with the degree of both ends."""
    edges, nodes = C.correlation_network(series_multi(spark, sf_dir), EVENT_TYPES, NETWORK_THRESHOLD)
    s = nodes.select(F.col("node").alias("source"), F.col("degree").alias("source_degree"))
    t = nodes.select(F.col("node").alias("target"), F.col("degree").alias("target_degree"))
    return edges.join(s, "source").join(t, "target").select(
        "source", "target", r6(F.col("weight")).alias("weight"), "color", "source_degree", "target_degree")


@register("market_breadth", f"""
WITH {SERIES_SQL},
r AS (SELECT * FROM rets WHERE instrument <> 'orders')
SELECT {D} AS date, CAST(sum(CASE WHEN ret > 0 THEN 1 ELSE 0 END) AS BIGINT) AS advances,
       CAST(sum(CASE WHEN ret < 0 THEN 1 ELSE 0 END) AS BIGINT) AS declines,
       CAST(sum(CASE WHEN ret > 0 THEN 1 WHEN ret < 0 THEN -1 ELSE 0 END) AS BIGINT) AS breadth
FROM r GROUP BY "timestamp" """)
def market_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG24: advance-decline breadth across the event-type series."""
    b = C.advance_decline(R.returns(daily_events(spark, sf_dir)))
    return b.select(F.date_format("timestamp", "yyyy-MM-dd").alias("date"), "advances", "declines", "breadth")


FEATURES = ("sentiment_polarity", "sentiment_subjectivity", "vader_compound", "combined_sentiment",
            "keyword_stress_score", "headline_length", "word_count", "hour", "day_of_week", "daily_article_count",
            "rolling_7d_mean", "rolling_7d_volatility", "lag_1d", "lag_3d", "lag_7d", "market_breadth",
            "sentiment_volatility_7d", "price", "change_percent")


@register("feature_histograms", f"""
WITH {O.gold_ctes()},
v AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM gold" for f in FEATURES)}),
b AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature),
x AS (SELECT feature, lo, hi, CAST(CASE WHEN (hi - lo) / 30 > 0 THEN least(floor((value - lo) / ((hi - lo) / 30)), 29) ELSE 0 END
              AS INTEGER) AS bin FROM v JOIN b USING (feature) WHERE value IS NOT NULL)
SELECT feature, bin, CAST(count(*) AS BIGINT) AS count, round(min(lo) + bin * (min(hi) - min(lo)) / 30, 6) AS bin_start
FROM x GROUP BY feature, bin""")
def feature_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG16: 30-bin histograms of all features."""
    h = R.feature_histograms(cut_lineage(gold_features(spark, sf_dir, texts=False).select(*FEATURES)), FEATURES, 30)
    return h.select("feature", "bin", "count", r6(F.col("bin_start")).alias("bin_start"))


@register("feature_target_corr", f"""
WITH {O.gold_ctes()},
c AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, corr(CAST({f} AS DOUBLE), weighted_stress_score) AS corr FROM gold"
                          for f in FEATURES)})
SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM c WHERE corr IS NOT NULL
ORDER BY abs(corr) DESC, feature LIMIT 10""")
def feature_target_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG11: the 10 features most correlated (in absolute value) with the stress score."""
    t = C.target_correlations(gold_features(spark, sf_dir, texts=False), FEATURES, "weighted_stress_score", 10)
    return t.select("feature", r6(F.col("corr")).alias("corr"), r6(F.col("abs_corr")).alias("abs_corr"))
