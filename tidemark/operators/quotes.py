"""Quotes -> bronze articles (PRJ6-PRJ9, AGG3, AGG4, TOP5, STR9, SET2, AGG22).

A "run" is one scrape: all quotes sharing ``run_id``.  Per-run work is a grouped aggregation whose
groups are bounded by the instrument dimension (a run holds at most one quote per instrument).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import fmt_fixed, fmt_signed


def derive_quotes(q: DataFrame) -> DataFrame:
    """PRJ6: prev_close = price - change (price itself when change is 0); all rounded to 4."""
    prev = F.when(F.col("change") != 0, F.col("price") - F.col("change")).otherwise(F.col("price"))
    return q.select(
        *[c for c in q.columns if c not in ("price", "change", "change_percent")],
        F.round("price", 4).alias("price"), F.round("change", 4).alias("change"),
        F.round("change_percent", 4).alias("change_percent"), F.round(prev, 4).alias("prev_close"))


def filter_priority(q: DataFrame, max_priority: int | None) -> DataFrame:
    """PRJ9: keep instruments with priority <= p (missing priority counts as 3)."""
    if not max_priority:
        return q
    return q.where(F.coalesce(F.col("priority"), F.lit(3)) <= max_priority)


def _stress_factors(q: DataFrame) -> tuple[Column, Column]:
    """Sum and number of the 1-3 stress factors one quote contributes (AGG3)."""
    chg = F.coalesce(F.col("change_percent"), F.lit(0.0))
    price = F.coalesce(F.col("price"), F.lit(0.0))
    prio = F.coalesce(F.col("priority"), F.lit(3))
    is_vix = F.col("asset").contains("VIX")
    vix = F.when(is_vix, F.least(price / 10, F.lit(10.0)) * 3.0)
    move = F.least(F.abs(chg) / 2, F.lit(10.0)) * (F.lit(4) - prio)
    neg = F.when(chg < -3, F.least(F.abs(chg), F.lit(10.0)) * 1.5)
    total = F.coalesce(vix, F.lit(0.0)) + move + F.coalesce(neg, F.lit(0.0))
    n = F.when(is_vix, 1).otherwise(0) + F.lit(1) + F.when(chg < -3, 1).otherwise(0)
    return total, n


def market_stress(q: DataFrame, run_col: str = "run_id") -> DataFrame:
    """AGG3: per run, mean of all stress factors, rounded to 2 and capped at 10 (no quotes -> 0)."""
    total, n = _stress_factors(q)
    return q.groupBy(run_col).agg(F.sum(total).alias("_s"), F.sum(n).alias("_n"),
                                  F.count(F.lit(1)).alias("data_points")).select(
        run_col,
        F.when(F.col("_n") > 0, F.least(F.round(F.col("_s") / F.col("_n"), 2), F.lit(10.0)))
        .otherwise(F.lit(0.0)).alias("market_stress_score"),
        F.col("data_points").cast("int").alias("data_points"))


def is_mover(q: DataFrame) -> Column:
    """PRJ7: abs(change%) > 2, or priority 1 and > 1, or a VIX instrument."""
    a = F.abs(F.coalesce(F.col("change_percent"), F.lit(0.0)))
    return (a > 2.0) | ((F.col("priority") == 1) & (a > 1.0)) | F.col("asset").contains("VIX")


def direction(chg: Column) -> Column:
    """PRJ8 direction word."""
    return (F.when(chg > 3, "surges").when(chg > 0, "rises").when(chg < -3, "plunges").otherwise("falls"))


def mover_articles(q: DataFrame) -> DataFrame:
    """PRJ7 + PRJ8 + STR9: one article per significant mover."""
    m = q.where(is_mover(q))
    chg = F.col("change_percent")
    a = F.abs(chg)
    d = direction(chg)
    verb = F.concat(F.substring(d, 1, F.length(d) - 1), F.lit("ing"))
    headline = F.concat_ws(" ", F.col("asset"), d, F.concat(fmt_fixed(a, 1), F.lit("%")),
                           F.lit("to"), F.concat(F.lit("$"), fmt_fixed("price", 2)))
    parts = [
        F.concat(F.col("asset"), F.lit(" ("), F.col("asset_type"), F.lit(") is trading at $"),
                 fmt_fixed("price", 2), F.lit(", ")),
        F.concat(verb, F.lit(" "), fmt_fixed(a, 2), F.lit("% from the previous close of $"),
                 fmt_fixed("prev_close", 2), F.lit(". ")),
        F.when(F.coalesce(F.col("change"), F.lit(0.0)) != 0,
               F.concat(F.lit("Absolute change: $"), fmt_fixed(F.abs(F.col("change")), 2), F.lit(". ")))
        .otherwise(F.lit("")),
        F.when(F.col("asset").contains("VIX") & (F.col("price") > 30), F.lit("High volatility detected. "))
        .when(F.col("asset").contains("VIX") & (F.col("price") < 15), F.lit("Low volatility environment. "))
        .otherwise(F.lit("")),
    ]
    return m.select(
        "run_id", headline.alias("headline"), F.concat(*parts).alias("snippet"),
        F.col("timestamp"), F.array(F.col("asset")).alias("asset_tags"), F.col("url"), F.col("source"),
        F.col("timestamp").alias("scraped_at"), F.col("price"), F.col("change"), F.col("change_percent"),
        F.col("asset_type"), F.col("priority"), F.lit("mover").alias("article_kind"))


def overview_articles(q: DataFrame, run_col: str = "run_id", max_chars: int | None = None,
                      stats: DataFrame | None = None) -> DataFrame:
    """AGG4 + TOP5: one overview article per run; per asset type (alphabetical) the quotes ordered by
    abs(change%) descending; ``max_chars`` cuts the snippet (default: whole).  ``stats`` (``extraction_stats`` by run) adds
    ``scraper_stats``, NULL for a run without statistics."""
    chg = F.coalesce(F.col("change_percent"), F.lit(0.0))
    line = F.concat(F.lit("  "), F.when(chg > 0, "UP").otherwise("DOWN"), F.lit(" "), F.col("asset"),
                    F.lit(": $"), fmt_fixed("price", 2), F.lit(" ("), fmt_signed(chg, 2), F.lit("%)"))
    per_type = q.groupBy(run_col, "asset_type").agg(
        F.array_sort(F.collect_list(F.struct(
            (-F.abs(chg)).alias("k"), F.col("asset").alias("a"), line.alias("l")))).alias("items"))
    per_type = per_type.select(
        run_col, "asset_type",
        F.concat(F.upper("asset_type"), F.lit(":\n"),
                 F.concat_ws("\n", F.transform("items", lambda x: x["l"])), F.lit("\n")).alias("block"))
    runs = q.groupBy(run_col).agg(
        F.max("timestamp").alias("timestamp"), F.first("source").alias("source"),
        F.array_sort(F.collect_list("asset")).alias("asset_tags"))
    stress = market_stress(q, run_col)
    blocks = per_type.groupBy(run_col).agg(
        F.array_sort(F.collect_list(F.struct("asset_type", "block"))).alias("bl"))
    j = runs.join(stress, run_col).join(blocks, run_col)
    score = fmt_fixed("market_stress_score", 1)
    header = F.concat_ws("\n", F.lit("MARKET DATA"),
                         F.concat(F.lit("Market Stress Score: "), score, F.lit("/10")),
                         F.concat(F.lit("Data Points: "), F.col("data_points").cast("string")),
                         F.concat(F.lit("Source: "), F.col("source")),
                         F.concat(F.lit("Timestamp: "), F.col("timestamp")), F.lit(""))
    body = F.concat_ws("\n", F.transform("bl", lambda x: x["block"]))
    snippet = F.concat(header, F.lit("\n"), body)
    if max_chars is not None:
        snippet = F.substring(snippet, 1, max_chars)
    if stats is not None:
        j = j.join(stats.select(run_col, F.struct(*[c for c in stats.columns if c != run_col]).alias("scraper_stats")), run_col, "left")
    extra = ["scraper_stats"] if stats is not None else []
    return j.select(
        run_col, *extra, F.concat(F.lit("Market Overview - Stress Level "), score, F.lit("/10")).alias("headline"),
        snippet.alias("snippet"), "timestamp", "asset_tags", F.lit("overview://").alias("url"), "source",
        F.col("timestamp").alias("scraped_at"), "market_stress_score", "data_points",
        F.transform("bl", lambda x: x["asset_type"]).alias("asset_types"),
        F.lit("overview").alias("article_kind"))


def create_articles(q: DataFrame, run_col: str = "run_id") -> DataFrame:
    """SET2: overview rows and mover rows in one frame (missing columns are NULL)."""
    dq = derive_quotes(q)
    return overview_articles(dq, run_col).unionByName(mover_articles(dq), allowMissingColumns=True)


def extraction_stats(extracted: DataFrame, run_col: str | None = None) -> DataFrame:
    """AGG22: attempted / successful / failed and the success rate text (one row, or one per run)."""
    ok = F.count_if(F.col("price").isNotNull())
    n = F.count(F.lit(1))
    rate = F.when(n > 0, F.concat(fmt_fixed(ok * 100.0 / n, 1), F.lit("%"))).otherwise(F.lit("0%"))
    groups = extracted.groupBy(*([run_col] if run_col else []))
    return groups.agg(n.cast("long").alias("total_requests"), ok.cast("long").alias("successful"),
                         (n - ok).cast("long").alias("failed"), rate.alias("success_rate"))
