"""Temporal features (AGG1, J2, J3, W1, W2, DT2).

The article grain is reduced to the *daily* grain first (partial aggregation), the calendar spine
and the 7-day / lag windows run on that table (one row per day between the first and last day, so
its size is the date range, not the data), and the result is joined back on the date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import calendar_columns

LAGS = (1, 3, 7)


def daily_counts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """AGG1: date, daily_article_count."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("daily_article_count"))


def fill_calendar(counts: DataFrame) -> DataFrame:
    """J3 spine: every calendar day from the first to the last counted day (D1/D2 contract), 0 on empty
    days.  Each counted day brings the days up to the next one, so the counts are read once."""
    w = Window.orderBy("date")  # one row per counted day: small by construction
    end = F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.col("date"))
    days = counts.where(F.col("date").isNotNull()).select("date", "daily_article_count", end.alias("_end")).select(
        F.col("date").alias("_own"), "daily_article_count",
        F.explode(F.sequence("date", "_end", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select("date", F.when(F.col("date") == F.col("_own"), F.col("daily_article_count")).otherwise(F.lit(0))
                       .cast("long").alias("daily_article_count"))


def daily_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """date, daily_article_count (0 on empty days), rolling_7d_mean, rolling_7d_volatility
    (sample std, 0 for a single value), lag_1d, lag_3d, lag_7d (0 before the start)."""
    d = fill_calendar(daily_counts(df, ts))
    # one row per calendar day: an ordered window over this table is small by construction
    w = Window.orderBy("date")
    w7 = w.rowsBetween(-6, 0)
    cnt = F.col("daily_article_count").cast("double")
    out = d.select(
        "date", "daily_article_count",
        F.avg(cnt).over(w7).alias("rolling_7d_mean"),
        F.coalesce(F.stddev_samp(cnt).over(w7), F.lit(0.0)).alias("rolling_7d_volatility"),
        *[F.coalesce(F.lag("daily_article_count", k).over(w), F.lit(0)).cast("long").alias(f"lag_{k}d")
          for k in LAGS],
    )
    return out


def temporal_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows with a timestamp, plus DT2 calendar columns and the daily features of their date (J2)."""
    df = df.where(F.col(ts).isNotNull())
    daily = daily_features(df, ts)
    rows = df.select("*", *calendar_columns(ts)).withColumn("date", F.to_date(ts))
    return rows.join(daily, "date", "left")
