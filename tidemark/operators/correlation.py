"""Correlation analytics (AGG10, AGG11, AGG12, J6, AGG24).

The "all column pairs i < j" self join of the reference is a set of ``corr`` aggregates computed in
one pass over the rows (k columns -> k(k-1)/2 aggregates) and unpivoted with ``stack``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def safe_corr(a, b):
    """Pearson correlation over rows where both are non-NULL; NULL (not an ANSI division error) when
    either side is constant."""
    a = F.col(a).cast("double") if isinstance(a, str) else a.cast("double")
    b = F.col(b).cast("double") if isinstance(b, str) else b.cast("double")
    both = a.isNotNull() & b.isNotNull()
    sa, sb = F.stddev_samp(F.when(both, a)), F.stddev_samp(F.when(both, b))
    return F.try_divide(F.covar_samp(F.when(both, a), F.when(both, b)), sa * sb)


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG10 + J6: Pearson correlation for every pair (i < j), pairwise-complete rows."""
    cols = list(columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "source string, target string, corr double")
    wide = df.agg(*[safe_corr(a, b).alias(f"_c{k}") for k, (a, b) in enumerate(pairs)])
    esc = lambda s: s.replace("\\", "\\\\").replace("'", "\\'")
    stack = ", ".join(f"'{esc(a)}', '{esc(b)}', _c{k}" for k, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (source, target, corr)")


def correlation_network(df: DataFrame, columns: Sequence[str], threshold: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """AGG12: edges with |corr| > threshold (weight = |corr|, colour band .8/.6) and node degree."""
    pairs = correlation_pairs(df, columns)
    edges = pairs.select("source", "target", F.abs("corr").alias("weight")).where(F.col("weight") > threshold)
    edges = edges.withColumn("color", F.when(F.col("weight") > 0.8, "red")
                             .when(F.col("weight") > 0.6, "orange").otherwise("blue"))
    nodes = edges.select(F.explode(F.array("source", "target")).alias("node")).groupBy("node") \
        .agg(F.count(F.lit(1)).cast("long").alias("degree"))
    return edges, nodes


def target_correlations(df: DataFrame, features: Sequence[str], target: str, top: int | None = 20) -> DataFrame:
    """AGG11: corr(feature, target) for each feature, ranked by |corr| (top ``top``)."""
    feats = [f for f in features if f != target]
    wide = df.agg(*[safe_corr(f, target).alias(f"_c{k}") for k, f in enumerate(feats)])
    stack = ", ".join(f"'{f}', _c{k}" for k, f in enumerate(feats))
    long = wide.selectExpr(f"stack({len(feats)}, {stack}) as (feature, corr)") \
        .withColumn("abs_corr", F.abs("corr")).where(F.col("corr").isNotNull())
    ranked = long.orderBy(F.col("abs_corr").desc(), F.col("feature"))
    return ranked.limit(top) if top else ranked


def advance_decline(ret_long: DataFrame, date: str = "timestamp") -> DataFrame:
    """AGG24: per period, #instruments with a positive return minus #with a negative one."""
    return ret_long.groupBy(date).agg(
        F.count_if(F.col("ret") > 0).cast("long").alias("advances"),
        F.count_if(F.col("ret") < 0).cast("long").alias("declines")) \
        .withColumn("breadth", F.col("advances") - F.col("declines"))
