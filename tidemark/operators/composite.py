"""Text features, composite score and target (STR2-STR7, NUM1-NUM4, AGG19, DT3, PRJ18, W3, W4).

Global statistics are one-row aggregates cross-joined back (a one-row side is always safe to
broadcast); row-order windows (7-row volatility, next-row target) go through the global index and
the blocked window, never a single-partition window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import ASSET_CATEGORIES, SEED_LEXICON, STRESS_KEYWORDS, WEIGHTS, Lexicon
from tidemark.functions.dates import recency
from tidemark.functions.keywords import (DEFAULT_TYPE_TO_CATEGORY, keyword_points, mention_columns,
                                         price_stress)
from tidemark.functions.numeric import combined_sentiment, zscore
from tidemark.functions.sentiment import compound, polarity_subjectivity, scored_tokens
from tidemark.functions.text import headline_length, tokens, word_count
from tidemark.operators.ordering import blocked_window, global_index
from tidemark.session import stored

TEXT_COLUMNS = ("headline", "snippet")
NORM_COLUMNS = ("sentiment_polarity", "keyword_stress_score", "combined_sentiment")


def text_features(df: DataFrame, keywords: Mapping[str, Sequence[str]] = STRESS_KEYWORDS,
                  categories: Mapping[str, Sequence[str]] = ASSET_CATEGORIES,
                  lexicon: Lexicon = SEED_LEXICON,
                  type_to_category: Mapping[str, str] = DEFAULT_TYPE_TO_CATEGORY) -> DataFrame:
    h = F.col("headline")
    has_change = "change_percent" in df.columns
    type_col = "asset_type" if "asset_type" in df.columns else ("type" if "type" in df.columns else None)
    # lower-cased text and tokens once per row; the expressions below refer to these columns
    df = df.withColumn("_low", F.lower(h))
    low = F.col("_low")
    df = df.withColumn("_toks", tokens(h, low))
    toks = F.col("_toks")
    df = df.withColumn("_scored", scored_tokens(toks, lexicon))
    pol, subj = polarity_subjectivity(h, lexicon, F.col("_scored"))
    out = df.select(
        "*",
        pol.alias("sentiment_polarity"),
        subj.alias("sentiment_subjectivity"),
        compound(h, lexicon, F.col("_scored")).alias("vader_compound"),
    ).drop("_toks", "_scored")
    out = out.withColumn("combined_sentiment", combined_sentiment(
        "vader_compound", "change_percent" if has_change else None))
    kw = keyword_points(h, keywords, low=low)
    if has_change:
        kw = kw + price_stress("change_percent")
    out = out.withColumn("keyword_stress_score", kw)
    out = out.select("*", headline_length(h).alias("headline_length"), word_count(h).alias("word_count"),
                     *mention_columns(h, categories, type_col, type_to_category, low))
    return out.drop("_low")


def global_stats(df: DataFrame) -> DataFrame:
    """AGG19 + DT3 inputs: one row of means, sample stds, time bounds and the row count."""
    aggs = []
    for c in (*NORM_COLUMNS, "daily_article_count"):
        if c in df.columns:
            aggs += [F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_std_{c}")]
    aggs += [F.min("timestamp").alias("_min_ts"), F.max("timestamp").alias("_max_ts"),
             F.count(F.lit(1)).alias("_n")]
    return df.agg(*aggs)


def composite_features(df: DataFrame, weights: Mapping[str, float] = WEIGHTS,
                       block: int = 65536, row_order: bool = True) -> DataFrame:
    """weighted_stress_score, market_breadth and, with ``row_order``, sentiment_volatility_7d and
    target_stress_next."""
    stats = global_stats(df)
    x = df.crossJoin(F.broadcast(stats))  # one row
    norm = {c: zscore(c, f"_mean_{c}", f"_std_{c}") for c in NORM_COLUMNS if c in df.columns}
    score = F.lit(0.0)
    if "combined_sentiment" in norm:
        score = score + F.lit(weights["sentiment"]) * norm["combined_sentiment"]
    if "keyword_stress_score" in norm:
        score = score + F.lit(weights["keyword_stress"]) * norm["keyword_stress_score"]
    if "daily_article_count" in df.columns:
        score = score + F.lit(weights["volume"]) * zscore(
            "daily_article_count", "_mean_daily_article_count", "_std_daily_article_count")
    score = score + F.lit(weights["recency"]) * recency("timestamp", "_min_ts", "_max_ts")
    x = x.withColumn("weighted_stress_score", score)
    mention_cols = [c for c in df.columns if c.startswith("mentions_")]
    if mention_cols:
        breadth = F.lit(0)
        for c in mention_cols:
            breadth = breadth + F.coalesce(F.col(c), F.lit(0))
        x = x.withColumn("market_breadth", breadth.cast("int"))
    x = x.withColumn("_enough", F.col("_n") >= 7)
    x = x.drop(*[c for c in x.columns if c.startswith(("_mean_", "_std_"))], "_min_ts", "_max_ts", "_n")
    return row_order_features(x, block=block) if row_order else x.drop("_enough")


def row_order_features(df: DataFrame, block: int = 65536) -> DataFrame:
    """W4 sentiment_volatility_7d (7-row sample std, 0 if fewer than 7 rows in total) and
    W3 target_stress_next (next row's score, the row's own score on the last row), ordered by
    (timestamp, row_id).  Texts are not ordered with the rest: they are joined to the result by the key, so that they
    move once."""
    key = ["timestamp", "row_id"]
    texts = [c for c in TEXT_COLUMNS if c in df.columns]
    idx = global_index(df.drop(*texts), key, "_idx")

    def build(w):
        return [F.coalesce(F.stddev_samp("sentiment_polarity").over(w.rowsBetween(-6, 0)), F.lit(0.0))
                .alias("_vol7"),
                F.lead("weighted_stress_score", 1).over(w).alias("_next")]

    out = blocked_window(idx, "_idx", build, preceding=6, following=1, block=block)
    out = (out.withColumn("sentiment_volatility_7d",
                          F.when(F.col("_enough"), F.col("_vol7")).otherwise(F.lit(0.0)))
           .withColumn("target_stress_next", F.coalesce(F.col("_next"), F.col("weighted_stress_score")))
           .drop("_vol7", "_next", "_enough", "_idx"))
    if not texts:
        return out
    order = [c for c in df.columns if c != "_enough"]
    return out.join(df.select(*key, *texts), key).select(*order, "sentiment_volatility_7d", "target_stress_next")


def engineer_features(silver: DataFrame, keywords=STRESS_KEYWORDS, categories=ASSET_CATEGORIES,
                      lexicon: Lexicon = SEED_LEXICON, weights=WEIGHTS, block: int = 65536,
                      type_to_category: Mapping[str, str] = DEFAULT_TYPE_TO_CATEGORY,
                      materialize: bool = True, row_order: bool = True, texts: bool = True) -> DataFrame:
    """Silver -> gold: text, temporal, composite, target; temporary columns dropped.  ``texts=False`` leaves out the texts
    themselves once they are scored, for consumers of the numbers."""
    from tidemark.operators.temporal import temporal_features

    t = text_features(silver, keywords, categories, lexicon, type_to_category)
    if not texts:
        t = t.drop(*TEXT_COLUMNS)
    if materialize:
        # daily counts, global statistics, key sample and the main pass all read this: the texts are
        # scanned and scored once, and the result is written to the shared checkpoint folder, by columns
        t = stored(t)
    t = temporal_features(t)
    g = composite_features(t, weights, block=block, row_order=row_order)
    return g.drop("date")
