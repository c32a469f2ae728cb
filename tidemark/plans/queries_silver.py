"""Registered queries for validation, cleaning and features (bronze -> silver -> gold)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import r6

from tidemark.config import BINDING_CATEGORIES, BINDING_KEYWORDS, BINDING_LEXICON
from tidemark.operators.composite import text_features
from tidemark.operators.ordering import global_index
from tidemark.operators.temporal import daily_features
from tidemark.operators.term_tables import category_table, keyword_table, lexicon_table, text_features_from_tables
from tidemark.operators.validate import detect_kind, violation_counts
from tidemark.plans import oracle as O
from tidemark.plans.pipeline import BINDING_TYPE_TO_CATEGORY, gold_features, silver_articles
from tidemark.plans.registry import register
from tidemark.session import stored
from tidemark.sources.views import articles

TS_FMT = "yyyy-MM-dd HH:mm:ss"


# ---------------------------------------------------------------- PRJ1-PRJ5, PRJ4, SET1 (counts)

def _counts_sql(kind: str) -> str:
    if kind == "news":
        rules = {
            "missing_headline": "headline IS NULL",
            "missing_timestamp": '"timestamp" IS NULL',
            "short_text": "coalesce(length(headline) < 20, false)",
            "long_text": "coalesce(length(headline) > 1000, false)",
            "invalid_date": '"timestamp" IS NULL',
        }
        crit = " OR ".join(f"({v})" for v in rules.values())
    else:
        rules = {
            "missing_headline": "(headline IS NULL OR headline = '')",
            "short_headline": "coalesce(length(headline) < 10, false)",
            "missing_timestamp": '"timestamp" IS NULL',
            "invalid_date": '"timestamp" IS NULL',
            "invalid_price": "(price IS NULL OR price <= 0)",
        }
        crit = "(headline IS NULL OR headline = '') OR \"timestamp\" IS NULL"
    cols = ",\n       ".join(f"CAST(count_if({v}) AS BIGINT) AS {k}" for k, v in rules.items())
    return f"""
WITH {O.ARTICLES}
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count_if(NOT ({crit})) AS BIGINT) AS n_valid,
       CAST(count_if({crit}) AS BIGINT) AS n_invalid,
       {cols},
       '{kind}' AS kind
FROM articles"""


@register("validate_news", _counts_sql("news"))
def validate_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ3 + PRJ4 + SET1: rule counts of the news validation over every article."""
    return violation_counts(articles(spark, sf_dir), kind="news")


@register("validate_market", _counts_sql("market"))
def validate_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1 (kind detected from the schema) + PRJ2 + PRJ4."""
    a = articles(spark, sf_dir)
    return violation_counts(a, kind=detect_kind(a))


# ------------------------------------------------------------------ silver (market kind)

MARKET_SILVER = O.MARKET_SILVER


def market_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_articles(spark, sf_dir, kind="market")


@register("silver_articles", f"""
WITH {O.ARTICLES}, {MARKET_SILVER}
SELECT row_id, headline, snippet, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS ts,
       array_to_string(asset_tags, '|') AS asset_tags, array_to_string(market_tags, '|') AS market_tags,
       CAST(length(headline) AS INTEGER) AS n_chars
FROM msilver""")
def silver_articles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT1, STR1, STR8, ARR1, ARR2, W11 over whole texts (market rules keep every text)."""
    s = market_silver(spark, sf_dir)
    return s.select("row_id", "headline", "snippet", F.date_format("timestamp", TS_FMT).alias("ts"),
                    F.array_join("asset_tags", "|").alias("asset_tags"),
                    F.array_join("market_tags", "|").alias("market_tags"),
                    F.length("headline").cast("int").alias("n_chars"))


@register("dedup_articles", f"""
WITH {O.ARTICLES},
c AS (SELECT row_id, {O.clean_sql('headline')} AS headline, date_trunc('month', "timestamp") AS m FROM articles)
SELECT CAST(min(row_id) AS BIGINT) AS row_id, CAST(count(*) AS BIGINT) AS copies
FROM c GROUP BY headline, m""")
def dedup_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W11 keep-first on (cleaned text, month): surviving row and the size of its copy group."""
    a = articles(spark, sf_dir).select(
        "row_id", F.col("headline"), F.date_trunc("month", "timestamp").alias("m"))
    from tidemark.functions.text import clean_text
    a = a.withColumn("headline", clean_text("headline"))
    return a.groupBy(F.sha2("headline", 256), "m").agg(
        F.min("row_id").alias("row_id"), F.count(F.lit(1)).cast("long").alias("copies")).select("row_id", "copies")


# ------------------------------------------------------------------ text features on whole texts

def _text_cols_sql() -> str:
    mentions = ", ".join(f"mentions_{c}" for c in BINDING_CATEGORIES)
    return f"""row_id, round(sentiment_polarity, 6) AS sentiment_polarity,
       round(sentiment_subjectivity, 6) AS sentiment_subjectivity,
       round(vader_compound, 6) AS vader_compound, round(combined_sentiment, 6) AS combined_sentiment,
       round(keyword_stress_score, 6) AS keyword_stress_score, headline_length, word_count, {mentions}"""


@register("text_features", f"""
WITH {O.ARTICLES}, {MARKET_SILVER}, {O.text_features_cte('msilver')}
SELECT {_text_cols_sql()} FROM textf2""")
def text_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2-STR7, NUM1-NUM3 on every silver article, whole text."""
    t = text_features(market_silver(spark, sf_dir), BINDING_KEYWORDS, BINDING_CATEGORIES, BINDING_LEXICON,
                      BINDING_TYPE_TO_CATEGORY)
    return t.select("row_id", *[r6(F.col(c)).alias(c) for c in (
        "sentiment_polarity", "sentiment_subjectivity", "vader_compound", "combined_sentiment",
        "keyword_stress_score")], "headline_length", "word_count",
        *[f"mentions_{c}" for c in BINDING_CATEGORIES])


@register("text_features_from_tables", f"""
WITH {O.ARTICLES}, {MARKET_SILVER}, {O.text_features_cte('msilver')}
SELECT {_text_cols_sql()} FROM textf2""")
def text_features_from_tables_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC9 + J5: the same features with the keywords, categories and the lexicon as tables joined to the texts."""
    t = text_features_from_tables(
        stored(market_silver(spark, sf_dir).select("row_id", "headline", "asset_type", "change_percent")), keyword_table(spark, BINDING_KEYWORDS),
        category_table(spark, BINDING_CATEGORIES), lexicon_table(spark, BINDING_LEXICON), BINDING_TYPE_TO_CATEGORY)
    return t.select("row_id", *[r6(F.col(c)).alias(c) for c in (
        "sentiment_polarity", "sentiment_subjectivity", "vader_compound", "combined_sentiment",
        "keyword_stress_score")], "headline_length", "word_count",
        *[f"mentions_{c}" for c in BINDING_CATEGORIES])


@register("daily_features", f"""
WITH {O.ARTICLES}, {MARKET_SILVER}, {O.temporal_cte('msilver')}
SELECT strftime(date, '%Y-%m-%d') AS date, daily_article_count, round(rolling_7d_mean, 6) AS rolling_7d_mean,
       round(rolling_7d_volatility, 6) AS rolling_7d_volatility, lag_1d, lag_3d, lag_7d
FROM daily_f""")
def daily_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1 + J3 spine + W1 7-day mean/volatility + W2 lags on the daily grain."""
    d = daily_features(market_silver(spark, sf_dir))
    return d.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "daily_article_count",
                    r6(F.col("rolling_7d_mean")).alias("rolling_7d_mean"),
                    r6(F.col("rolling_7d_volatility")).alias("rolling_7d_volatility"),
                    "lag_1d", "lag_3d", "lag_7d")


@register("article_order", f"""
WITH {O.ARTICLES}, {MARKET_SILVER}
SELECT row_id, CAST(row_number() OVER (ORDER BY "timestamp", row_id) AS BIGINT) AS idx FROM msilver""")
def article_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W0 global row index by (timestamp, row_id) without a single-partition window.  The keys of the silver rows are made
    once and written: counting, sampling and placing them read that."""
    keys = stored(silver_articles(spark, sf_dir, columns=["row_id", "timestamp"]))
    return global_index(keys, ["timestamp", "row_id"]).select("row_id", F.col("idx").cast("long"))


GOLD_COLS = ("weighted_stress_score", "target_stress_next", "sentiment_volatility_7d", "combined_sentiment",
             "keyword_stress_score", "rolling_7d_mean", "rolling_7d_volatility")


@register("gold_features", f"""
WITH {O.gold_ctes()}
SELECT row_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS ts, hour, day_of_week, is_weekend, month,
       daily_article_count, lag_1d, lag_3d, lag_7d, market_breadth,
       {', '.join(f'round({c}, 6) AS {c}' for c in GOLD_COLS)}
FROM gold""")
def gold_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows: DT2, J2, AGG19, DT3, NUM4, PRJ18, W3, W4 over whole texts."""
    g = gold_features(spark, sf_dir, texts=False)
    return g.select("row_id", F.date_format("timestamp", TS_FMT).alias("ts"), "hour", "day_of_week",
                    "is_weekend", "month", "daily_article_count", "lag_1d", "lag_3d", "lag_7d",
                    "market_breadth", *[r6(F.col(c)).alias(c) for c in GOLD_COLS])
