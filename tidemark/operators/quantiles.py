"""Exact quantiles at row grain without gathering the values (AGG9, AGG25, ML7b, ML9).

All columns become (name, value, key) rows of one table, which gets one global index; the two ranks around
each quantile position are looked up in it and interpolated, as the usual continuous percentile does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import global_index


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    key: str = "row_id") -> dict[str, list[float | None]]:
    """{column: values at the probabilities}; nulls are left out, a column without values gives None."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) as (name, value)", f"`{key}` as key").where("value is not null")
    indexed = global_index(long, ["name", "value", "key"], "idx")
    ranges = indexed.groupBy("name").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n"))
    spots = ranges.select("name", "first", "n", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"))
    spots = spots.withColumn("at", (F.col("n") - 1) * F.col("p"))
    wanted = spots.select("name", "p", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank"), "first", "at") \
        .select("name", "p", "at", "rank", (F.col("first") + F.col("rank")).alias("idx")).distinct()
    # columns x probabilities x 2 rows at most
    found = indexed.select("idx", "value").join(F.broadcast(wanted), "idx").collect()
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c in columns:
        for i, p in enumerate(probabilities):
            own = {r["rank"]: r for r in found if r["name"] == c and r["p"] == float(p)}
            if own:
                lo, hi = own[min(own)], own[max(own)]
                out[c][i] = lo["value"] + (hi["value"] - lo["value"]) * (lo["at"] - lo["rank"])
    return out
