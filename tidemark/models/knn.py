"""Similar historical periods (AGG2, ML8, J8, TOP3, NUM5, DT4).

Rows are reduced to the daily grain first (one vector per day), scaled with population statistics,
and every day's Euclidean distance to the target day is an expression against the target vector
(fetched as one row of literals).  The k nearest are a top-k, the rest never leave the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_apart
from tidemark.functions.numeric import similarity

MEAN_COLS = ("sentiment_polarity", "keyword_stress_score", "weighted_stress_score", "market_breadth")
FIRST_COLS = ("daily_article_count", "rolling_7d_mean", "rolling_7d_volatility")
DAILY_FEATURES = ("sentiment_polarity", "keyword_stress_score", "daily_article_count", "rolling_7d_mean",
                  "rolling_7d_volatility", "weighted_stress_score", "market_breadth")


def daily_vectors(gold: DataFrame) -> DataFrame:
    """AGG2: per date the mean of the scores and the first row's daily features."""
    first_key = F.struct("timestamp", "row_id")
    return gold.groupBy(F.to_date("timestamp").alias("date")).agg(
        *[F.avg(c).alias(c) for c in MEAN_COLS],
        *[F.min_by(c, first_key).cast("double").alias(c) for c in FIRST_COLS]).select(
        "date", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in DAILY_FEATURES])


def similar_periods(gold: DataFrame, k: int = 5, target_date=None,
                    features: Sequence[str] = DAILY_FEATURES) -> DataFrame:
    """ML8: the ``k`` days nearest to ``target_date`` (default: the latest day), with similarity
    1/(1+d), days apart and the three features differing most (share of the raw absolute gaps)."""
    d = daily_vectors(gold)
    feats = list(features)
    stats = d.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)],
                  *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(feats)],
                  F.max("date").alias("latest")).first()
    target = stats["latest"] if target_date is None else target_date
    trow = d.where(F.col("date") == F.lit(target)).first()  # one row of literals
    if trow is None:
        return d.limit(0).select("date")
    dist2 = F.lit(0.0)
    gaps = []
    for i, c in enumerate(feats):
        m, s = stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 0.0
        z = ((F.col(c) - F.lit(m)) / F.lit(s)) if s > 0 else F.lit(0.0)
        tz = ((trow[c] - m) / s) if s > 0 else 0.0
        dist2 = dist2 + F.pow(z - F.lit(tz), 2)
        gaps.append(F.abs(F.col(c) - F.lit(trow[c])))
    total = gaps[0]
    for g in gaps[1:]:
        total = total + g
    contrib = F.array(*[F.struct(
        F.when(total > 0, gaps[i] / total).otherwise(F.lit(0.0)).alias("contribution"),
        F.lit(i).alias("idx"), F.lit(c).alias("feature")) for i, c in enumerate(feats)])
    ranked = F.sort_array(contrib, asc=False)  # by contribution, then index (descending)
    top3 = F.slice(F.transform(ranked, lambda x: F.struct(x["feature"].alias("feature"),
                                                        x["contribution"].alias("contribution"))), 1, 3)
    out = d.where(F.col("date") != F.lit(target)).select(
        "date", F.sqrt(dist2).alias("distance"), top3.alias("top_similarity_features"))
    out = out.orderBy("distance", "date").limit(k)
    return out.select(F.lit(target).cast("date").alias("target_date"), "date", "distance",
                      similarity("distance").alias("similarity_score"),
                      days_apart(F.lit(target).cast("date"), "date").alias("days_apart"),
                      "top_similarity_features")
