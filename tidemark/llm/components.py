"""Connected components of an edge table, in Spark: alternating large-star and small-star rounds.

Every round is two pre-aggregated minima joined back to the edges (no per-node collection), and its
result is stored in the shared folder, so a lost executor costs at most one round.  No round has more edges than
the table had at first, so its files follow that number, not the number of shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import discard, few_files, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges between longs -> (node, component), a stored table: the smallest node reachable.

    Self loops and nulls are ignored; a node without edges has no row; repeated edges count once."""
    edges = edges.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows = edges.count()
    now = stored(few_files(edges.distinct(), rows))
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a != b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(lowest.select("a", F.col("m").alias("b")))
        before, now = now, stored(few_files(small.distinct(), rows))
        discard(before)
        previous, state = state, _state(now)
        if state == previous:
            break
    leaves = now.groupBy("a").agg(F.min("b").alias("b"))
    out = stored(few_files(leaves.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        leaves.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), 2 * rows))
    discard(now)
    return out
