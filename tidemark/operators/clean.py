"""Bronze -> silver cleaning (DT1, STR1, STR8, ARR1, ARR2, W11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import parse_timestamp
from tidemark.functions.text import clean_text, first_word_tag, parse_list, price_suffix, single_tag
from tidemark.operators.validate import detect_kind


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_col: str = "row_id",
                     columns: Sequence[str] | None = None) -> DataFrame:
    """W11: keep the row with the smallest ``order_col`` per key, all its columns or those named.

    ``min_by(struct(row), order_col)`` is a partial aggregate: each map task first reduces its
    share of a key to one row, so a key holding a third of the table does not land in one task.  Text
    keys are grouped by their 256-bit digest, so a text moves once, in its row.
    """
    packed = F.min_by(F.struct(*[F.col(c) for c in (columns or df.columns)]), F.col(order_col)).alias("_r")
    by = [F.sha2(F.col(k), 256) if isinstance(df.schema[k].dataType, T.StringType) else F.col(k) for k in keys]
    return df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(by)]).agg(packed).select("_r.*")


def _list_column(df: DataFrame, name: str):
    dt = df.schema[name].dataType
    if isinstance(dt, T.ArrayType):
        return F.col(name).cast("array<string>")  # arrays stay arrays (D3)
    if isinstance(dt, T.StringType):
        return parse_list(F.col(name))
    return F.array().cast("array<string>")


def enrich_market(df: DataFrame) -> DataFrame:
    """Snippet fallback + price suffix (STR8), asset/market tags (ARR1)."""
    cols = set(df.columns)
    if "snippet" not in cols:
        df = df.withColumn("snippet", F.col("headline"))
    else:
        # the reference replaces the snippet only when the whole column is empty; per row is the
        # same for every non-empty column and needs no extra job
        df = df.withColumn("snippet", F.coalesce(F.col("snippet"), F.col("headline")))
    if "price" in cols:
        df = df.withColumn("snippet", price_suffix("snippet", "price"))
    if "asset_tags" not in cols:
        if "asset" in cols:
            df = df.withColumn("asset_tags", single_tag("asset"))
        else:
            df = df.withColumn("asset_tags", first_word_tag("headline"))
    if "market_tags" not in cols:
        type_col = "asset_type" if "asset_type" in cols else ("type" if "type" in cols else None)
        df = df.withColumn("market_tags", single_tag(type_col) if type_col
                           else F.array().cast("array<string>"))
    return df


def clean_articles(df: DataFrame, kind: str | None = None,
                   dedup_keys: Sequence[str] = ("headline", "timestamp"), columns: Sequence[str] | None = None) -> DataFrame:
    """Silver rows: parsed timestamp, cleaned text, keep-first dedup, tags, parsed list columns.
    Ordering is not materialised here: consumers order by (timestamp, row_id).  What derives from a row alone is made
    after the dedup, so that a text moves once.  ``columns``: only these of the cleaned input columns are needed (a text
    that is not among them does not move)."""
    kind = kind or detect_kind(df)
    df = df.withColumn("timestamp", parse_timestamp(F.col("timestamp"), df.schema["timestamp"].dataType))
    df = df.withColumn("headline", clean_text("headline"))
    if "snippet" in df.columns:
        df = df.withColumn("snippet", clean_text("snippet"))
    if columns is not None:
        return dedup_keep_first(df, dedup_keys, columns=columns)
    late = set(dedup_keys) <= set(df.columns) - {"snippet", "asset_tags", "market_tags"}
    if late:
        df = dedup_keep_first(df, dedup_keys)
    if kind == "market":
        df = enrich_market(df)
    for name in ("asset_tags", "market_tags"):
        if name in df.columns:
            df = df.withColumn(name, _list_column(df, name))
    return df if late else dedup_keep_first(df, dedup_keys)
