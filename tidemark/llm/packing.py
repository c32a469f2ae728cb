"""Optimal length buckets: dynamic programming over the global length histogram, token-budget batches.

All documents are padded to the upper length of their bucket.  The histogram (one row per different length,
made by a pre-aggregated count) goes to the driver.  It is small whatever the longest text: m different
lengths need more than m * m / 2 tokens.  The dynamic program finds the ``n_buckets`` upper lengths that
minimise the padding over all documents exactly (divide and conquer over the split points, which is valid
because the padding cost satisfies the quadrangle inequality), weighing ``MAX_BINS`` split points at a time.

Inside a bucket, batches hold ``budget // upper length`` documents (at least one).  A document's place is
an offset of its hash slice plus its number within the slice, so no bucket is ever sorted in one task,
and repeated executions give the same batches.  Rows of one id and length are counted first and take consecutive
places, so no id or length, nor rows without id, fill a slice.

Defined results: a null or empty text has length 1 (its end id or mark); an empty table gives no rows; repeated
rows and rows without id each take a place.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.quality import words_of
from tidemark.llm.tables import cut
from tidemark.llm.token_files import token_ids

N_BUCKETS = 16
TOKEN_BUDGET = 65_536
MAX_BINS = 1 << 16
SLICE_ROWS = 50_000
COPIES_PER_CHUNK = 10_000


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Upper lengths (ascending) of at most ``n_buckets`` buckets with the least total padding."""
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    m = len(lengths)
    if not m:
        return []
    number = np.concatenate(([0], np.cumsum(counts)))
    total = np.concatenate(([0], np.cumsum(counts * lengths)))

    def padding(i, j):
        """Bins i..j-1 padded to length j-1."""
        return lengths[j - 1] * (number[j] - number[i]) - (total[j] - total[i])

    def cheapest(left, right, j):
        """(cost, i) of the cheapest split point i from left to right, the lowest of equals."""
        found = []
        for lo in range(left, right + 1, MAX_BINS):
            i = np.arange(lo, min(lo + MAX_BINS, right + 1))
            cost = best[i] + padding(i, j)
            at = int(cost.argmin())
            found.append((int(cost[at]), int(i[at])))
        return min(found)

    best = np.concatenate(([0], padding(0, np.arange(1, m + 1))))
    splits = [np.zeros(m + 1, dtype=np.int64)]
    for _ in range(1, min(n_buckets, m)):
        new, split = best.copy(), np.arange(m + 1)
        split[:] = splits[-1]
        new[0], split[0] = 0, 0
        stack = [(1, m, 0, m - 1)]
        while stack:
            lo, hi, left, right = stack.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            new[j], at = cheapest(left, min(right, j - 1), j)
            split[j] = at
            stack += [(lo, j - 1, left, at), (j + 1, hi, at, right)]
        splits.append(split)
        best = new
    bounds, j = [], m
    for split in reversed(splits):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(split[j])
    return sorted(bounds)


def word_lengths(documents: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): words of the whole text and one end mark."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            (F.size(words_of(F.col("text"))) + 1).cast("long").alias("n_tokens"))


def token_lengths(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens): token ids of the whole text and its end id."""
    return token_ids(documents, tokenizer_path).select("doc_id", F.expr("octet_length(ids) div 2").alias("n_tokens"))


def pack(lengths: DataFrame, n_buckets: int = N_BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """(doc_id, n_tokens) -> the same rows with bucket, padded_to, batch (within the bucket), place (within
    the batch)."""
    lengths = cut(lengths.select("doc_id", "n_tokens"))
    histogram = lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).toArrow()  # one row per different length
    counts = histogram["n"].to_numpy()
    bounds = optimal_bounds(histogram["n_tokens"].to_numpy(), counts, n_buckets)
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    n_slices = max(1, -(-int(counts.sum()) // SLICE_ROWS))
    # rows of one id and length, such as all without id, are one key with a count until they have their places
    keys = lengths.groupBy("doc_id", "n_tokens").agg(F.count("*").alias("n"))
    keys = keys.withColumn("bucket", sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))) \
        .withColumn("slice", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(n_slices)))
    sizes = keys.groupBy("bucket", "slice").agg(F.sum("n").alias("n"))  # buckets x slices rows
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("bucket", "slice", before(Window.partitionBy("bucket").orderBy("slice")).alias("offset"))
    numbered = keys.withColumn("number", before(Window.partitionBy("bucket", "slice").orderBy("doc_id", "n_tokens"))) \
        .join(offsets, ["bucket", "slice"])
    chunks = numbered.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES_PER_CHUNK}")))) \
        .repartition("doc_id", "n_tokens", "chunk")  # the copies of a hot key are dealt over the tasks
    first = F.col("chunk") * COPIES_PER_CHUNK
    numbered = chunks.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES_PER_CHUNK, F.col("n")) - 1)))
    placed = numbered.withColumn("padded_to", F.get(edges, F.col("bucket"))) \
        .withColumn("per_batch", F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded_to")))) \
        .withColumn("rank", F.col("offset") + F.col("number") + F.col("copy"))
    return placed.select("doc_id", "n_tokens", F.col("bucket").cast("int").alias("bucket"), "padded_to",
                         F.floor(F.col("rank") / F.col("per_batch")).cast("long").alias("batch"),
                         F.pmod("rank", "per_batch").cast("long").alias("place"))
