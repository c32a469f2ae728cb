"""End-to-end compositions over the views of the driver tables.

The bronze -> silver -> gold chain is declared as one lazy plan per consumer; callers that reuse a
stage for several outputs persist or write it (``write_snapshot``) themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import r6

from tidemark.config import BINDING_CATEGORIES, BINDING_KEYWORDS, BINDING_LEXICON, WEIGHTS
from tidemark.operators.clean import clean_articles
from tidemark.operators.composite import engineer_features
from tidemark.operators.validate import validate
from tidemark.sources.views import articles

# Asset types of the events binding that set a mention flag (STR7 through an explicit map, D17).
BINDING_TYPE_TO_CATEGORY = {"click": "commodities", "error": "volatility"}


def silver_articles(spark: SparkSession, sf_dir: str, kind: str = "market", columns: Sequence[str] | None = None) -> DataFrame:
    """Valid, cleaned, de-duplicated articles (of their input columns only ``columns``, if given); the market rules keep
    whole texts of any length."""
    a = articles(spark, sf_dir)
    valid, _ = validate(a, kind=kind)
    return clean_articles(valid, kind=kind, columns=columns)


def gold_features(spark: SparkSession, sf_dir: str, kind: str = "market", block: int = 65536,
                  row_order: bool = True, texts: bool = True) -> DataFrame:
    """Gold rows; ``row_order=False`` leaves out the columns that need the row order, ``texts=False`` the texts themselves."""
    silver = silver_articles(spark, sf_dir, kind)
    return engineer_features(silver, BINDING_KEYWORDS, BINDING_CATEGORIES, BINDING_LEXICON, WEIGHTS,
                             block=block, type_to_category=BINDING_TYPE_TO_CATEGORY, row_order=row_order,
                             texts=texts)


def daily_stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: validate -> clean -> dedup -> text features -> daily counts/spine/rolling ->
    z-scores -> weighted score -> per-day summary."""
    gold = gold_features(spark, sf_dir, texts=False)
    return gold.groupBy(F.to_date("timestamp").alias("d")).agg(
        F.count(F.lit(1)).cast("long").alias("n_articles"),
        F.max("daily_article_count").cast("long").alias("daily_article_count"),
        r6(F.max("rolling_7d_mean")).alias("rolling_7d_mean"),
        r6(F.max("rolling_7d_volatility")).alias("rolling_7d_volatility"),
        F.max("lag_1d").cast("long").alias("lag_1d"),
        F.max("lag_3d").cast("long").alias("lag_3d"),
        F.max("lag_7d").cast("long").alias("lag_7d"),
        r6(F.avg("weighted_stress_score")).alias("mean_stress"),
        r6(F.max("weighted_stress_score")).alias("max_stress"),
        r6(F.avg("keyword_stress_score")).alias("mean_keyword_stress"),
        r6(F.avg("vader_compound")).alias("mean_compound"),
        r6(F.avg("sentiment_polarity")).alias("mean_polarity"),
        r6(F.avg("target_stress_next")).alias("mean_target_next"),
        r6(F.avg("sentiment_volatility_7d")).alias("mean_sentiment_vol"),
        F.sum("market_breadth").cast("long").alias("sum_breadth"),
    ).select(F.date_format("d", "yyyy-MM-dd").alias("date"), "*").drop("d")
