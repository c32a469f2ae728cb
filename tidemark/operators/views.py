"""Analytical views over gold/prediction rows (PRJ10, PRJ16, PRJ19, NUM6, W10, AGG5-AGG9, AGG18,
AGG20, AGG26, LIM1-LIM3).

Each view is ``scan -> filter (pushed down) -> aggregate``; "current" / "most recent" values use
``max_by`` on (timestamp, row_id) or a top-k ``orderBy().limit()`` (TakeOrderedAndProject), never a
global sort followed by a collect.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import CONFIDENCE_THRESHOLD, REGIME_BINS
from tidemark.operators.ordering import blocked_window, global_index
from tidemark.operators.quantiles import exact_quantiles

ORDER = ("timestamp", "row_id")


def threshold_regime(score: Column, bins: tuple[float, float] = REGIME_BINS) -> Column:
    """PRJ16: right-closed bins (-inf, .3], (.3, .7], (.7, inf) -> low / medium / high."""
    lo, hi = bins
    return F.when(score.isNull(), F.lit(None)).when(score <= lo, "low").when(score <= hi, "medium").otherwise("high")


def regime_flags(regime: Column) -> list[Column]:
    """PRJ16 indicator columns derived from the regime itself (D16)."""
    return [F.when(regime == r, 1.0).otherwise(0.0).alias(f"prob_{r}") for r in ("low", "medium", "high")]


def quick_update(gold: DataFrame, score: str = "weighted_stress_score", block: int = 65536,
                 moving_averages: bool = True) -> DataFrame:
    """ML10 minus the model fits: threshold regimes + flags (PRJ16), z-score anomalies |z| > 2 with
    score |z| (NUM6) and, for consumers that need the row order, 7-row moving averages (W10)."""
    stats = gold.agg(F.avg(score).alias("_m"), F.stddev_samp(score).alias("_s"))
    x = gold.crossJoin(F.broadcast(stats))  # one row
    z = F.abs(F.try_divide(F.col(score) - F.col("_m"), F.col("_s")))
    x = x.withColumn("risk_regime", threshold_regime(F.col(score)))
    x = x.select("*", *regime_flags(F.col("risk_regime")))
    x = x.withColumn("anomaly_score", z).withColumn(
        "is_anomaly", F.when(F.coalesce(z > 2, F.lit(False)), 1).otherwise(0)).drop("_m", "_s")
    if not moving_averages:
        return x
    idx = global_index(x, list(ORDER), "_idx")

    def build(w):
        w7 = w.rowsBetween(-6, 0)
        return [F.avg("sentiment_polarity").over(w7).alias("sentiment_ma_7"),
                F.avg("keyword_stress_score").over(w7).alias("stress_ma_7")]

    return blocked_window(idx, "_idx", build, preceding=6, block=block).drop("_idx")


def default_date_range(df: DataFrame, days: int = 30) -> tuple[_dt.date, _dt.date]:
    """Last ``days`` days up to the newest date, or the whole range when shorter (one 1-row job)."""
    lo, hi = df.agg(F.min(F.to_date("timestamp")), F.max(F.to_date("timestamp"))).first()
    if lo is None:
        today = _dt.date.today()
        return today, today
    return (hi - _dt.timedelta(days=days), hi) if (hi - lo).days > days else (lo, hi)


def apply_filters(df: DataFrame, start: _dt.date | str | None = None, end: _dt.date | str | None = None,
                  regime: str | None = None, anomaly: str = "all",
                  confidence: float = CONFIDENCE_THRESHOLD, regime_col: str = "risk_regime") -> DataFrame:
    """PRJ10: inclusive date range, regime equality, anomaly tri-state ('all', 'only', 'exclude'),
    max(prob_*) >= confidence.  All are plain filters, pushed to the scan when the input is one."""
    d = F.to_date("timestamp")
    if start is not None:
        df = df.where(d >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(d <= F.lit(end).cast("date"))
    if regime and regime_col in df.columns:
        df = df.where(F.col(regime_col) == regime)
    if "is_anomaly" in df.columns:
        if anomaly == "only":
            df = df.where(F.col("is_anomaly") == 1)
        elif anomaly == "exclude":
            df = df.where(F.col("is_anomaly") == 0)
    probs = [c for c in df.columns if c.startswith("prob_")]
    if probs:
        df = df.where(F.greatest(*[F.col(c) for c in probs]) >= confidence) if len(probs) > 1 \
            else df.where(F.col(probs[0]) >= confidence)
    return df


def kpis(df: DataFrame, score: str = "weighted_stress_score", regime_col: str = "risk_regime") -> DataFrame:
    """AGG7 + AGG6: current/mean/max/min stress, delta vs mean, current regime, anomaly count and
    rate, number of rows and rows per day — one aggregation."""
    key = F.struct(*[F.col(c) for c in ORDER])
    span_days = F.floor((F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(86400e6))
    n = F.count(F.lit(1))
    out = df.agg(
        F.max_by(score, key).alias("current_stress"), F.avg(score).alias("mean_stress"),
        F.max(score).alias("max_stress"), F.min(score).alias("min_stress"),
        F.max_by(regime_col, key).alias("current_regime"),
        F.sum("is_anomaly").cast("long").alias("anomaly_count"),
        (F.avg("is_anomaly") * 100).alias("anomaly_rate"),
        n.cast("long").alias("articles"),
        (n / F.greatest(span_days, F.lit(1))).alias("articles_per_day"))
    return out.withColumn("delta_vs_mean", F.col("current_stress") - F.col("mean_stress"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """AGG26: the filter choices of a column."""
    return df.where(F.col(col).isNotNull()).select(col).distinct()


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG9: count, mean, std, min, 25/50/75 %, max per column (exact percentiles), rounded to 3: one
    aggregate over all columns, and one row index for all quantiles."""
    quantiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    x = {c: F.col(c).cast("double") for c in columns}
    stats = df.agg(*[f(x[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (
        ("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    rows = [F.struct(
        F.lit(c).alias("column"), F.col(f"count{i}").cast("long").alias("count"),
        *[F.round(F.col(f"{n}{i}"), 3).alias(n) for n in ("mean", "std", "min")],
        *[F.round(F.lit(v).cast("double"), 3).alias(n) for n, v in zip(("p25", "p50", "p75"), quantiles[c], strict=True)],
        F.round(F.col(f"max{i}"), 3).alias("max")) for i, c in enumerate(columns)]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def data_quality(df: DataFrame) -> DataFrame:
    """AGG18: rows, columns, overall null rate, first timestamp — one pass."""
    n = F.count(F.lit(1))
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total_nulls = nulls[0]
    for e in nulls[1:]:
        total_nulls = total_nulls + e
    ncols = len(df.columns)
    return df.agg(n.cast("long").alias("rows"), F.lit(ncols).alias("columns"),
                  F.when(n > 0, 1 - total_nulls / (n * F.lit(ncols))).alias("completeness"),
                  F.min("timestamp").alias("min_timestamp"))


def columns_named(df: DataFrame, *patterns: str) -> list[str]:
    """PRJ17: columns whose lower-cased name contains one of the patterns, in schema order."""
    return [c for c in df.columns if any(p in c.lower() for p in patterns)]


#: PRJ17: the name patterns of each role.
ROLES = {"price": ("price", "close", "value"), "volume": ("volume",), "date": ("date", "time")}


def column_profile(df: DataFrame) -> DataFrame:
    """AGG18 column lists, one row per column in one pass: ``kind`` (numeric, categorical for texts, else other), the roles its name
    gives it (PRJ17, joined by ``|``) and its number of values that are not null."""
    def kind(t: T.DataType) -> str:
        return "numeric" if isinstance(t, T.NumericType) else "categorical" if isinstance(t, T.StringType) else "other"

    named = {role: set(columns_named(df, *patterns)) for role, patterns in ROLES.items()}
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"n{i}") for i, f in enumerate(df.schema.fields)])
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"), F.lit(kind(f.dataType)).alias("kind"),
                     F.lit("|".join(r for r in ROLES if f.name in named[r])).alias("roles"), F.col(f"n{i}").cast("long").alias("values"))
            for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*rows)))


def linear_trend(df: DataFrame, y: str = "weighted_stress_score") -> DataFrame:
    """AGG20: least-squares line of y against the 0-based row position (global order)."""
    idx = global_index(df.select(*ORDER, y), list(ORDER), "_idx")
    x = (F.col("_idx") - 1).cast("double")
    return idx.agg(F.regr_slope(F.col(y), x).alias("slope"), F.regr_intercept(F.col(y), x).alias("intercept"),
                   F.count(F.lit(1)).cast("long").alias("n"))


def most_recent(df: DataFrame, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """LIM1 / LIM2: the ``n`` newest rows by (timestamp, row_id) (top-k, no global sort)."""
    out = df.orderBy(F.col("timestamp").desc(), F.col("row_id").desc()).limit(n)
    return out.select(*columns) if columns else out


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """LIM3: the ``n`` oldest rows."""
    return df.orderBy(*[F.col(c) for c in ORDER]).limit(n)


def recent_items(df: DataFrame, n: int = 10) -> DataFrame:
    """PRJ19 + LIM1: the display columns of the newest rows, time as ``yyyy-MM-dd HH:mm``."""
    r = most_recent(df, n)
    cols = [c for c in ("headline", "sentiment_polarity", "weighted_stress_score") if c in df.columns]
    return r.select("row_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("time"), *cols)
