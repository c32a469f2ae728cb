"""Order-dependent operators without a single-partition window (W0, W3, W4, W10, carried lags).

A plain ``Window.orderBy(ts)`` puts every row in one task.  Instead:

* ``global_index`` takes a bounded sample of the full, unique order key (rows chosen by key hash), turns
  it into literal split points, and gives every row the bucket of its key by a balanced comparison tree.
  The bucket is a deterministic expression, so every execution, task retry and plan branch agrees; a hot
  timestamp is split by ``row_id``.  The index is the row number inside the bucket plus the prefix sum of
  the bucket counts (one row per bucket).
* ``blocked_window`` evaluates row-frame windows over that index in blocks of ``block`` rows; the
  ``halo`` rows preceding (or following) a block are copied into it so frames crossing a block edge
  are exact.  Every block holds exactly ``block`` rows, so the shuffle is balanced whatever the skew.
* ``carried_lag`` is a partitioned ``lag`` over a numeric order key: rows are grouped into
  (partition, key-range block) pieces, lag runs inside each piece, and the first row of a piece takes
  the last value of the nearest earlier non-empty piece (computed on the small per-piece table).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 65_536
MAX_BUCKETS = 1_024
SAMPLES_PER_BUCKET = 32


def split_points(df: DataFrame, order_by: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> list[tuple]:
    """Literal bounds of about equal shares of the keys: at most MAX_BUCKETS * SAMPLES_PER_BUCKET keys,
    chosen by their hash over the whole table, are sorted on the driver."""
    keys = df.select(*order_by)
    n = keys.count()
    buckets = min(MAX_BUCKETS, -(-n // rows_per_bucket))
    if buckets <= 1:
        return []
    share = min(1.0, buckets * SAMPLES_PER_BUCKET / n)
    rank = F.pmod(F.xxhash64(*order_by), F.lit(1 << 40))
    sample = sorted((tuple(r) for r in keys.where(rank < int(share * (1 << 40))).collect()),
                    key=lambda r: tuple((v is not None, v) for v in r))
    cuts = {sample[i * len(sample) // buckets] for i in range(1, buckets)} if sample else set()
    return sorted((c for c in cuts if None not in c))


def _before(order_by: Sequence[str], bound: tuple) -> Column:
    """key < bound, nulls first."""
    out = F.lit(False)
    for name, value in reversed(list(zip(order_by, bound, strict=True))):
        col = F.col(name)
        out = F.coalesce(col < F.lit(value), F.lit(True)) | ((col == F.lit(value)) & out)
    return out


def bucket_of(order_by: Sequence[str], bounds: list[tuple], first: int = 0) -> Column:
    """Number of bounds at or below the key, by a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(_before(order_by, bounds[mid]), bucket_of(order_by, bounds[:mid], first)).otherwise(
        bucket_of(order_by, bounds[mid + 1:], first + mid + 1))


def global_index(df: DataFrame, order_by: Sequence[str], idx_col: str = "idx",
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Dense 1-based row index over ``order_by`` (which must be unique, e.g. ``(ts, row_id)``)."""
    bounds = split_points(df, order_by, rows_per_bucket)
    keyed = df.withColumn("_bucket", bucket_of(order_by, bounds))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per bucket, MAX_BUCKETS at most: safe to broadcast
    offsets = counts.select("_bucket", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by))
    out = keyed.withColumn("_pos", place).join(F.broadcast(offsets), "_bucket")
    return out.withColumn(idx_col, F.col("_off") + F.col("_pos")).drop("_bucket", "_pos", "_off")


def blocked_window(df: DataFrame, idx_col: str, build: Callable[[Window], list[Column]],
                   preceding: int = 0, following: int = 0, block: int = 65536) -> DataFrame:
    """Apply row-frame window columns ordered by ``idx_col`` without a global partition.

    ``build(w)`` receives ``Window.partitionBy(block).orderBy(idx)`` and returns aliased columns whose
    frames reach at most ``preceding`` rows back and ``following`` rows ahead.
    """
    if block <= max(preceding, following):
        raise ValueError("block must exceed the frame reach")
    blk = F.floor((F.col(idx_col) - 1) / F.lit(block)).cast("long")
    pos = (F.col(idx_col) - 1) % F.lit(block)
    places = [F.struct(blk.alias("_blk"), F.lit(True).alias("_own"))]
    if preceding:
        # last `preceding` rows of block b are copied into block b+1
        places.append(F.when(pos >= F.lit(block - preceding), F.struct((blk + 1).alias("_blk"), F.lit(False).alias("_own"))))
    if following:
        # first `following` rows of block b are copied into block b-1
        places.append(F.when((pos < F.lit(following)) & (blk > 0), F.struct((blk - 1).alias("_blk"), F.lit(False).alias("_own"))))
    # the copies come out of one pass over the rows
    allrows = df.withColumn("_place", F.explode(F.array_compact(F.array(*places)))).select(*df.columns, "_place.*")
    w = Window.partitionBy("_blk").orderBy(idx_col)
    out = allrows.select("*", *build(w))
    return out.where(F.col("_own")).drop("_blk", "_own")


def carried_lag(df: DataFrame, value: str, partition_by: Sequence[str], order_by: str,
                out_col: str, block_size: int = 1 << 16) -> DataFrame:
    """``lag(value) over (partition by partition_by order by order_by)`` for a numeric, unique
    ``order_by``, computed piecewise so no partition key value ends up in a single task."""
    piece = F.floor(F.col(order_by) / F.lit(block_size)).cast("long").alias("_piece")
    keyed = df.withColumn("_piece", piece)
    keys = list(partition_by) + ["_piece"]
    w_in = Window.partitionBy(*keys).orderBy(order_by)
    inner = keyed.withColumn("_lag", F.lag(value).over(w_in)).withColumn(
        "_first", F.row_number().over(w_in) == 1)
    tails = keyed.groupBy(*keys).agg(F.max_by(value, order_by).alias("_tail"))
    carry = tails.select(*keys, F.lag("_tail").over(
        Window.partitionBy(*partition_by).orderBy("_piece")).alias("_carry"))
    # no hint: the inner side is already hash-partitioned on `keys`, so only the small carry table
    # moves; AQE turns this into a broadcast from measured sizes when it is small.
    out = inner.join(carry, keys, "left")
    return out.withColumn(out_col, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))) \
        .drop("_piece", "_lag", "_first", "_carry")
