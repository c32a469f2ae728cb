"""Readers for the driver tables.  Always select the needed columns right at the scan so the
Parquet ``ReadSchema`` is pruned, and normalise NaN to NULL once, at the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas treats NaN as missing; Spark orders NaN above every number and lets it poison
    ``corr``.  Convert once, right after the source."""
    out = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name))
                       .cast(f.dataType).alias(f.name))
            changed = True
        else:
            out.append(F.col(f.name))
    return df.select(*out) if changed else df


def to_utc_timestamp_col(c: Column) -> Column:
    """``timestamp_ntz`` inputs become session (UTC) timestamps once."""
    return c.cast(T.TimestampType())
