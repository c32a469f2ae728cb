"""Validation (PRJ1-PRJ5, PRJ4 counts, SET1).

One projection adds an ``array<string>`` of violated rules; valid rows have no *critical* violation.
Valid and invalid are two filters on that column, so their union is exactly the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import MARKET_SOURCE_PATTERN, MAX_TEXT_LENGTH, MIN_TEXT_LENGTH, SHORT_HEADLINE
from tidemark.functions.dates import parse_timestamp

MARKET_COLUMNS = ("price", "change_percent", "asset_type", "market_stress_score")
MARKET_RULES = ("missing_headline", "short_headline", "missing_timestamp", "invalid_date", "invalid_price")
MARKET_CRITICAL = ("missing_headline", "missing_timestamp", "invalid_date")
NEWS_RULES = ("missing_headline", "missing_timestamp", "short_text", "long_text", "invalid_date")


def detect_kind(df: DataFrame) -> str:
    """PRJ1: 'market' if a market column exists (schema only, no job), else if any source matches
    the market-source pattern (one ``bool_or`` job), else 'news'."""
    if any(c in df.columns for c in MARKET_COLUMNS):
        return "market"
    if "source" in df.columns:
        hit = df.agg(F.bool_or(F.coalesce(F.col("source").rlike(MARKET_SOURCE_PATTERN), F.lit(False)))).first()[0]
        if hit:
            return "market"
    return "news"


def _ts(df: DataFrame) -> Column:
    return parse_timestamp(F.col("timestamp"), df.schema["timestamp"].dataType)


def rule_columns(df: DataFrame, kind: str, min_len: int = MIN_TEXT_LENGTH,
                 max_len: int = MAX_TEXT_LENGTH) -> dict[str, Column]:
    """Boolean column per rule (NULL comparisons count as not violated, as in pandas)."""
    h = F.col("headline")
    ts_raw = F.col("timestamp")
    parsed = _ts(df)
    rules: dict[str, Column] = {}
    if kind == "market":
        rules["missing_headline"] = h.isNull() | (h == "")
        rules["short_headline"] = F.coalesce(F.length(h) < SHORT_HEADLINE, F.lit(False))
        rules["missing_timestamp"] = ts_raw.isNull()
        rules["invalid_date"] = parsed.isNull()
        if "price" in df.columns:
            rules["invalid_price"] = F.col("price").isNull() | (F.col("price") <= 0)
    else:
        rules["missing_headline"] = h.isNull()
        rules["missing_timestamp"] = ts_raw.isNull()
        rules["short_text"] = F.coalesce(F.length(h) < min_len, F.lit(False))
        rules["long_text"] = F.coalesce(F.length(h) > max_len, F.lit(False))
        rules["invalid_date"] = parsed.isNull()
    return rules


def with_violations(df: DataFrame, kind: str | None = None, **limits) -> DataFrame:
    """Adds ``violations`` (all rules hit) and ``is_valid`` (no critical rule hit)."""
    kind = kind or detect_kind(df)
    rules = rule_columns(df, kind, **limits)
    critical = MARKET_CRITICAL if kind == "market" else tuple(rules)
    names = F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])
    viol = F.filter(names, lambda x: x.isNotNull())
    crit = None
    for n in critical:
        if n in rules:
            crit = rules[n] if crit is None else (crit | rules[n])
    return df.withColumn("violations", viol).withColumn("is_valid", ~crit)


def validate(df: DataFrame, kind: str | None = None, **limits) -> tuple[DataFrame, DataFrame]:
    """PRJ2/PRJ3/PRJ5 -> (valid, invalid) (SET1)."""
    v = with_violations(df, kind, **limits)
    return (v.where(F.col("is_valid")).drop("violations", "is_valid"),
            v.where(~F.col("is_valid")))


def violation_counts(df: DataFrame, kind: str | None = None, **limits) -> DataFrame:
    """PRJ4: one row, one count per rule (incl. the non-rejecting ones) plus valid/invalid counts,
    in a single pass."""
    kind = kind or detect_kind(df)
    rules = rule_columns(df, kind, **limits)
    v = with_violations(df, kind, **limits)
    aggs = [F.count(F.lit(1)).cast("long").alias("n_rows"),
            F.count_if(F.col("is_valid")).cast("long").alias("n_valid"),
            F.count_if(~F.col("is_valid")).cast("long").alias("n_invalid")]
    aggs += [F.count_if(F.array_contains("violations", n)).cast("long").alias(n) for n in rules]
    return v.agg(*aggs).withColumn("kind", F.lit(kind))
