"""Return and risk analytics over price series (W5-W8, AGG13-AGG17, PRJ15, AGG5).

Input is the long form ``(timestamp, instrument, price)``.  Windows are partitioned by instrument and
ordered by time; a series is one row per period (daily grain after aggregation), so a partition holds
the number of periods of one instrument, not the raw data behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import TRADING_DAYS

SQRT_DAYS = math.sqrt(TRADING_DAYS)

# FIXED VALUES: regime labels of the volatility/return classification.
REGIMES = ("High Vol, High Return", "High Vol, Low Return", "Low Vol, High Return", "Low Vol, Low Return")


def _w(part: str = "instrument", order: str = "timestamp") -> Window:
    return Window.partitionBy(part).orderBy(order)


def returns(series: DataFrame, value: str = "price") -> DataFrame:
    """W5: period return = value / previous value - 1 (NULL on the first row and on a 0 base)."""
    prev = F.lag(value).over(_w())
    return series.withColumn("ret", F.try_divide(F.col(value), prev) - F.lit(1.0))


def rolling_risk(ret: DataFrame, vol_window: int = 20, sharpe_window: int = 60) -> DataFrame:
    """W6 + W7: annualised rolling volatility/return (NULL until ``vol_window`` returns) and rolling
    Sharpe over ``sharpe_window`` returns."""
    w = _w()
    wv = w.rowsBetween(-(vol_window - 1), 0)
    ws = w.rowsBetween(-(sharpe_window - 1), 0)
    full_v = F.count("ret").over(wv) == vol_window
    full_s = F.count("ret").over(ws) == sharpe_window
    return ret.select(
        "*",
        F.when(full_v, F.stddev_samp("ret").over(wv) * SQRT_DAYS).alias("volatility"),
        F.when(full_v, F.avg("ret").over(wv) * TRADING_DAYS).alias("rolling_return"),
        F.when(full_s, F.try_divide(F.avg("ret").over(ws) * TRADING_DAYS,
                                    F.stddev_samp("ret").over(ws) * SQRT_DAYS)).alias("rolling_sharpe"),
    )


def drawdown(ret: DataFrame) -> DataFrame:
    """W8 on the non-null returns: cumulative growth, running max, drawdown = (c - m) / m."""
    r = ret.where(F.col("ret").isNotNull())
    w = _w().rowsBetween(Window.unboundedPreceding, 0)
    cum = F.product(F.lit(1.0) + F.col("ret")).over(w)
    r = r.withColumn("cumulative", cum)
    r = r.withColumn("running_max", F.max("cumulative").over(w))
    return r.withColumn("drawdown", (F.col("cumulative") - F.col("running_max")) / F.col("running_max")) \
        .withColumn("cumulative_return", F.col("cumulative") - F.lit(1.0))


def _bias_adjusted(n: Column, g1: Column, g2: Column) -> tuple[Column, Column]:
    """Sample skewness G1 and excess kurtosis G2 from Spark's population g1, g2."""
    skew = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return skew, kurt


def risk_metrics(series: DataFrame, exact: bool = True) -> DataFrame:
    """AGG13 per instrument: annual return/volatility, Sharpe (0 if volatility is 0), VaR and CVaR at
    95/99 %, sample skew/kurtosis, max drawdown.  ``exact=False`` uses ``approx_percentile``."""
    r = returns(series).where(F.col("ret").isNotNull())
    q = (F.percentile("ret", [0.05, 0.01]) if exact
         else F.percentile_approx("ret", [0.05, 0.01], 100000))
    n = F.count("ret").cast("double")
    stats = r.groupBy("instrument").agg(
        F.avg("ret").alias("_m"), F.stddev_samp("ret").alias("_s"), n.alias("_n"),
        F.skewness("ret").alias("_g1"), F.kurtosis("ret").alias("_g2"), q.alias("_q"))
    skew, kurt = _bias_adjusted(F.col("_n"), F.col("_g1"), F.col("_g2"))
    stats = stats.select(
        "instrument", (F.col("_m") * TRADING_DAYS).alias("annual_return"),
        (F.col("_s") * SQRT_DAYS).alias("annual_volatility"),
        F.col("_q")[0].alias("var_95"), F.col("_q")[1].alias("var_99"),
        skew.alias("skewness"), kurt.alias("kurtosis"), F.col("_n").cast("long").alias("n_returns"))
    stats = stats.withColumn("sharpe_ratio", F.when(F.col("annual_volatility") > 0,
                                                    F.col("annual_return") / F.col("annual_volatility"))
                             .otherwise(F.lit(0.0)))
    # second pass: CVaR needs the thresholds (one row per instrument, joined back)
    tail = r.join(stats.select("instrument", "var_95", "var_99"), "instrument").groupBy("instrument").agg(
        F.avg(F.when(F.col("ret") <= F.col("var_95"), F.col("ret"))).alias("cvar_95"),
        F.avg(F.when(F.col("ret") <= F.col("var_99"), F.col("ret"))).alias("cvar_99"))
    dd = drawdown(returns(series)).groupBy("instrument").agg(F.min("drawdown").alias("max_drawdown"))
    return stats.join(tail, "instrument").join(dd, "instrument", "left")


def autocorrelation(series: DataFrame, max_lag: int = 20) -> DataFrame:
    """AGG14: corr(r, r shifted by k) for k = 1..max_lag over the non-null returns (one sort)."""
    r = returns(series).where(F.col("ret").isNotNull())
    w = _w()
    lagged = r.select("instrument", "ret", *[F.lag("ret", k).over(w).alias(f"l{k}") for k in range(1, max_lag + 1)])
    from tidemark.operators.correlation import safe_corr

    wide = lagged.groupBy("instrument").agg(*[safe_corr("ret", f"l{k}").alias(f"c{k}") for k in range(1, max_lag + 1)])
    stack = ", ".join(f"{k}, c{k}" for k in range(1, max_lag + 1))
    return wide.selectExpr("instrument", f"stack({max_lag}, {stack}) as (lag, autocorr)") \
        .withColumn("lag", F.col("lag").cast("int"))


def histogram(values: DataFrame, col: str, bins: int = 50, group: Sequence[str] = ()) -> DataFrame:
    """AGG16: equal-width bins between min and max (last bin closed); empty bins are not listed."""
    g = list(group)
    bounds = values.groupBy(*g).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")) if g else \
        values.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = values.where(F.col(col).isNotNull())
    x = x.join(bounds, g) if g else x.crossJoin(F.broadcast(bounds))  # one row per group
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width > 0, F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    x = x.withColumn("bin", b.cast("int"))
    return x.groupBy(*g, "bin").agg(F.count(F.lit(1)).cast("long").alias("count"),
                                    F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")) \
        .withColumn("bin_start", F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins) \
        .drop("_lo", "_hi")


def normal_overlay(values: DataFrame, col: str, points: int = 100) -> DataFrame:
    """AGG16: the normal density with the mean and sample deviation of ``col`` at ``points`` even places from its minimum
    to its maximum: (point, x, density).  Fewer than two different values: densities are NULL; no value: no rows."""
    s = values.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
    x = s.where("lo IS NOT NULL").select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = x.withColumn("x", F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(max(points - 1, 1)))
    z = (F.col("x") - F.col("m")) / F.col("s")
    density = F.exp(-z * z / 2) / (F.col("s") * F.sqrt(F.lit(2.0) * F.pi()))
    return x.select(F.col("point").cast("int"), "x", F.when(F.col("s") > 0, density).alias("density"))


def feature_histograms(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """AGG16: (feature, bin, count, bin_start) of every column: one aggregate for all bounds, and one count by (feature, bin)
    that is reduced where the rows are.  Empty bins and columns without values are not listed."""
    bounds = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("_lo", F.min), ("_hi", F.max))])
    one = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi"))
           for i, c in enumerate(columns)]
    x = df.select(*columns).crossJoin(F.broadcast(bounds)).select(F.inline(F.array(*one))).where("value IS NOT NULL")  # bounds: one row
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return x.groupBy("feature", b.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).cast("long").alias("count")).select(
        "feature", "bin", "count", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"))


def regimes(series: DataFrame, window: int = 20, q: float = 0.75) -> DataFrame:
    """AGG17 + PRJ15: rolling volatility/return regimes against the volatility quantile ``q``."""
    rr = rolling_risk(returns(series), window, max(window, 2))
    thr = rr.groupBy("instrument").agg(F.percentile("volatility", q).alias("_thr"))
    x = rr.join(thr, "instrument")
    hi = F.col("volatility") > F.col("_thr")
    lo = F.col("volatility") <= F.col("_thr")
    up = F.col("rolling_return") > 0
    down = F.col("rolling_return") <= 0
    regime = (F.when(hi & up, REGIMES[0]).when(hi & down, REGIMES[1]).when(lo & up, REGIMES[2])
              .when(lo & down, REGIMES[3]).otherwise("Unknown"))
    return x.withColumn("regime", regime).withColumnRenamed("_thr", "vol_threshold")


def regime_counts(reg: DataFrame, col: str = "regime") -> DataFrame:
    """AGG5: value counts."""
    return reg.groupBy(col).agg(F.count(F.lit(1)).cast("long").alias("count"))


def normal_quantile(p: Column) -> Column:
    """Inverse standard normal CDF by Acklam's rational approximation (|error| < 1.2e-9)."""
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]

    def poly(coef, x):
        acc = F.lit(coef[0])
        for k in coef[1:]:
            acc = acc * x + F.lit(k)
        return acc

    plow = 0.02425
    ql = F.sqrt(-2 * F.log(p))
    low = poly(c, ql) / (poly(d, ql) * ql + 1)
    qh = F.sqrt(-2 * F.log(1 - p))
    high = -poly(c, qh) / (poly(d, qh) * qh + 1)
    qc = p - 0.5
    r = qc * qc
    central = poly(a, r) * qc / (poly(b, r) * r + 1)
    return F.when(p < plow, low).when(p > 1 - plow, high).otherwise(central)


def qq_points(series: DataFrame, points: int = 100) -> DataFrame:
    """AGG15: sample quantiles of the returns at ``points`` evenly spaced probabilities in
    [0.01, 0.99] against the standard normal quantiles."""
    probs = [0.01 + (0.98 * i / (points - 1) if points > 1 else 0.0) for i in range(points)]
    r = returns(series).where(F.col("ret").isNotNull())
    qs = r.groupBy("instrument").agg(F.percentile("ret", probs).alias("_s"))
    z = qs.select("instrument", F.posexplode("_s").alias("i", "sample_quantile"))
    p = F.lit(0.01) + F.col("i") * F.lit(0.98 / (points - 1) if points > 1 else 0.0)
    return z.select("instrument", F.col("i").cast("int").alias("point"),
                    normal_quantile(p).alias("theoretical_quantile"), "sample_quantile")
