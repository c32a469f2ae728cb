"""Feature matrix helpers for the models (PRJ11, PRJ12, ML0a, ML0c)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
# target itself, the scores it is built from directly, identifiers and the next-row target (D7)
DEFAULT_EXCLUDE = ("weighted_stress_score", "sentiment_polarity", "vader_compound", "target_stress_next", "row_id")


def numeric_features(df: DataFrame, exclude: Sequence[str] = DEFAULT_EXCLUDE) -> list[str]:
    """PRJ11: numeric columns minus the exclusions (driver-side, schema only)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in set(exclude) and not f.name.startswith("_")]


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRJ12: NULL (NaN already normalised at the source) -> 0."""
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in columns else F.col(c)
                       for c in df.columns])


def hash_split(df: DataFrame, train_pct: int = 80, seed: int = 42, key: str = "row_id") -> DataFrame:
    """ML0a: deterministic split column ``is_train`` from a hash of the row key (independent of the
    partitioning, unlike ``randomSplit``)."""
    return df.withColumn("is_train", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100)) < train_pct)


def stratified_split(df: DataFrame, label: str, test_share: float = 0.2, key: str = "row_id") -> DataFrame:
    """ML0b: ``is_train`` with the exact share of every class held out, whatever the partitioning.

    Rows are ranked within their class by the md5 of their (unique) key through the row index, so no class is
    sorted in one task; the first ``test_share`` (rounded) are held out.  If a class has a single row, all rows are
    ranked together."""
    from tidemark.operators.ordering import global_index

    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    single = min(counts.values(), default=0) < 2
    ranked = df.select(key, F.lit(0).alias("_class") if single else F.col(label).cast("int").alias("_class"),
                       F.md5(F.col(key).cast("string").cast("binary")).alias("_hash"))
    index = global_index(ranked, ["_class", "_hash", key], "_idx")
    sizes = [(0, sum(counts.values()))] if single else [(int(c), n) for c, n in sorted(counts.items())]
    before, held = 0, F.lit(False)
    for c, n in sizes:
        held = held | ((F.col("_class") == c) & (F.col("_idx") <= before + int(n * test_share + 0.5)))
        before += n
    return df.join(index.select(key, (~held).alias("is_train")), key)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def population_scaler(df: DataFrame, features: Sequence[str], suffix: str = "_z") -> tuple[DataFrame, dict]:
    """ML0c: (x - mean) / population std (0 when the std is 0), statistics from one aggregation."""
    stats_row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                       *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)]).first()
    stats = {c: (stats_row[f"m_{i}"] or 0.0, stats_row[f"s_{i}"] or 0.0) for i, c in enumerate(features)}
    cols = []
    for c in features:
        m, s = stats[c]
        cols.append(((F.col(c) - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0)).alias(c + suffix))
    return df.select("*", *cols), stats
