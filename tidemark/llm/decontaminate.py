"""Benchmark decontamination: Wu-Manber multi-pattern search over word sequences.

Patterns are the windows of ``window`` consecutive words of every benchmark item (an item of fewer
words, but not none, is one shorter window).  For each pattern length there is one machine:

* a block-shift table indexed by the hash of a two-word block tells how many words the search can
  skip, because no pattern holds the block nearer to its end;
* where the shift is 0, the bucket of the patterns that end in this block (suffix hash) gives the
  test strings;
* each test string is compared word by word (hashes first, then the bytes themselves).

Texts are scanned in many lanes at once (numpy), a lane being a run of ``LANE_WORDS`` window ends, so
one very long text costs no more than many short ones.  The benchmark is cut into shards of about
``SHARD_WORDS`` words; one shard is one broadcast, and the documents pass the shards one after the
other, so the size of what is broadcast is bounded whatever the size of the benchmark.

Defined results: a null text has no words; an empty benchmark gives no hits; benchmark rows with a null
id or text are ignored; repeated document rows each give their row; repeated items count once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrowtext import (LOWER, NOT_ALNUM, POSITION_CODE, U64, chunks, hash_words, mix,
                                    span_hashes, words)

WINDOW = 13
SHARD_WORDS = 2_000_000
LANE_WORDS = 512
SLOT_BITS = 20
SPANS, ITEMS, N_WORDS, N_HIT = "__spans", "__items", "__n_words", "__n_hit"


def split_words(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    clean = np.where(NOT_ALNUM[data], 32, data).astype(np.uint8)
    return clean.tobytes().split()


class WuManber:
    """Search machine for distinct patterns of one length (in words)."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], length: int):
        self.length = length
        self.block = min(2, length)
        self.texts = [b" ".join(p) for p in patterns]
        self.items = list(patterns.values())
        hashes = hash_words([w for p in patterns for w in p]).reshape(len(patterns), length)
        self.hashes = hashes
        skip = length - self.block + 1
        self.shift = np.full(1 << SLOT_BITS, skip, dtype=np.int64)
        for end in range(self.block - 1, length):
            np.minimum.at(self.shift, self.slot(hashes, end), length - 1 - end)
        last = self.slot(hashes, length - 1)
        self.bucket = np.argsort(last, kind="stable")
        self.bucket_slots, starts = np.unique(last[self.bucket], return_index=True)
        self.bucket_bounds = np.append(starts, len(last))

    def slot(self, hashes: np.ndarray, end) -> np.ndarray:
        """Table slot of the block of words that ends at position ``end``."""
        with np.errstate(over="ignore"):
            h = hashes[..., end] * POSITION_CODE[0]
            if self.block == 2:
                h = h + hashes[..., end - 1] * POSITION_CODE[1]
            return (mix(h) >> U64(64 - SLOT_BITS)).astype(np.int64)

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window end, slot) where the shift is 0; text i holds words first[i]:first[i + 1]."""
        lo, hi = first[:-1] + self.length - 1, first[1:]
        n_lanes = np.maximum(0, -(-(hi - lo) // LANE_WORDS))
        text = np.repeat(np.arange(len(lo)), n_lanes)
        rank = np.arange(len(text)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
        at = lo[text] + rank * LANE_WORDS
        stop = np.minimum(at + LANE_WORDS, hi[text])
        ends, slots = [], []
        while at.size:
            slot = self.slot(hashes, at)
            shift = self.shift[slot]
            zero = shift == 0
            if zero.any():
                ends.append(at[zero])
                slots.append(slot[zero])
            at = at + np.maximum(shift, 1)
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ends), np.concatenate(slots)

    def search(self, chunk, spans, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence in the chunk."""
        end, slot = self.candidates(hashes, spans.first)
        k = np.searchsorted(self.bucket_slots, slot)
        n = self.bucket_bounds[k + 1] - self.bucket_bounds[k]
        end = np.repeat(end, n)
        order = np.repeat(self.bucket_bounds[k] - (np.cumsum(n) - n), n) + np.arange(len(end))
        pattern = self.bucket[order]
        start = end - self.length + 1
        for j in range(self.length):
            same = hashes[start + j] == self.hashes[pattern, j]
            start, pattern = start[same], pattern[same]
        data = chunk.data.tobytes() if len(start) else b""
        exact = np.fromiter(
            (b" ".join(data[spans.starts[i]:spans.ends[i]] for i in range(s, s + self.length)) == self.texts[p]
             for s, p in zip(start.tolist(), pattern.tolist(), strict=True)), dtype=bool, count=len(start))
        return start[exact], pattern[exact]


def machines(rows, window: int) -> list[WuManber]:
    """One machine per pattern length of the given (item id, text) rows."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in rows:
        tokens = split_words(text)
        if tokens:
            length = min(window, len(tokens))
            for i in range(len(tokens) - length + 1):
                by_length.setdefault(length, {}).setdefault(tuple(tokens[i:i + length]), set()).add(item)
    return [WuManber({p: sorted(ids) for p, ids in patterns.items()}, length)
            for length, patterns in sorted(by_length.items())]


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Disjoint word ranges of one text."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts.tolist(), ends.tolist(), strict=True)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


def _scan_batch(batch: pa.RecordBatch, text_col: str, tools: list[WuManber], kept: list[str]):
    n_words: list[int] = []
    spans_out: list[list[dict]] = []
    items_out: list[list[str]] = []
    for chunk in chunks(batch.column(batch.schema.get_field_index(text_col))):
        found = words(chunk, NOT_ALNUM)
        hashes = span_hashes(chunk, found.starts, found.ends)
        n_words.extend(found.counts().tolist())
        spans: list[list[dict]] = [[] for _ in range(len(chunk))]
        items: list[list[str]] = [[] for _ in range(len(chunk))]
        hits = [(tool, *tool.search(chunk, found, hashes)) for tool in tools]
        starts = np.concatenate([h[1] for h in hits] or [np.zeros(0, np.int64)])
        ends = np.concatenate([h[1] + h[0].length for h in hits] or [np.zeros(0, np.int64)])
        ids = [h[0].items[p] for h in hits for p in h[2].tolist()]
        text = np.searchsorted(found.first, starts, side="right") - 1
        for t in np.unique(text).tolist():
            own = np.flatnonzero(text == t)
            spans[t] = _merged(starts[own] - found.first[t], ends[own] - found.first[t])
            items[t] = sorted({x for i in own.tolist() for x in ids[i]})
        spans_out.extend(spans)
        items_out.extend(items)
    if SPANS in batch.schema.names:  # hits of earlier shards
        for i, (old, old_items) in enumerate(zip(batch.column(SPANS).to_pylist(), batch.column(ITEMS).to_pylist(),
                                                 strict=True)):
            if old and spans_out[i]:
                both = old + spans_out[i]
                spans_out[i] = _merged(np.array([x["start"] for x in both]), np.array([x["end"] for x in both]))
            elif old:
                spans_out[i] = old
            items_out[i] = sorted({*old_items, *items_out[i]})
    made = {N_WORDS: n_words, N_HIT: [sum(x["end"] - x["start"] for x in s) for s in spans_out],
            SPANS: spans_out, ITEMS: items_out}
    fields = [batch.schema.field(c) for c in kept] + [pa.field(c, t) for c, t in HIT_TYPES.items()]
    arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(made[c], type=t) for c, t in HIT_TYPES.items()],
                                      schema=pa.schema(fields))


HIT_TYPES = {N_WORDS: pa.int64(), N_HIT: pa.int64(),
             SPANS: pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), ITEMS: pa.list_(pa.string())}
HIT_FIELDS = [
    T.StructField(N_WORDS, T.LongType()), T.StructField(N_HIT, T.LongType()),
    T.StructField(SPANS, T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                   T.StructField("end", T.LongType())]))),
    T.StructField(ITEMS, T.ArrayType(T.StringType())),
]


def with_occurrences(documents: DataFrame, benchmark: DataFrame, text_col: str = "text",
                     item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                     shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of ``documents`` with the word count, the number of hit words, the merged word ranges of
    all occurrences and the sorted ids (as strings) of the items that occur."""
    spark = documents.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("body")) \
        .where("item is not null and body is not null").distinct()
    n_chars = items.agg(F.sum(F.length("body"))).first()[0] or 0
    n_shards = max(1, math.ceil(n_chars / 2 / shard_words))  # a word takes two characters at least, with its separator
    shard = F.pmod(F.xxhash64("item"), F.lit(n_shards))
    out = documents
    base = [f for f in documents.schema.fields if f.name not in (N_WORDS, N_HIT, SPANS, ITEMS)]
    out = out.select(*[f"`{f.name}`" for f in base])
    schema = T.StructType(base + HIT_FIELDS)
    kept = [f.name for f in base]
    for i in range(n_shards):
        rows = items.where(shard == i).collect()  # bounded by shard_words
        tools = spark.sparkContext.broadcast(machines([(r["item"], r["body"]) for r in rows], window))

        def run(batches, tools=tools):
            for batch in batches:
                if batch.num_rows:
                    yield _scan_batch(batch, text_col, tools.value, kept)

        out = out.mapInArrow(run, schema)
    return out


def is_contaminated():
    """The contract's rule: some hit, and at least one word in twenty hit."""
    return (F.col(N_HIT) > 0) & (20 * F.col(N_HIT) >= F.col(N_WORDS))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: ids, word and hit counts, occurring items (with digest), verdict, word ranges."""
    hits = with_occurrences(documents.select("doc_id", "text"), benchmark)
    return hits.select(
        "doc_id", F.col(N_WORDS).alias("n_words"), F.col(N_HIT).alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(ITEMS)), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"), F.col(SPANS).alias("hit_spans"), F.col(ITEMS).alias("item_ids"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that the rule does not call contaminated, all columns kept."""
    return with_occurrences(documents, benchmark).where(~is_contaminated()).select(
        *[f"`{c}`" for c in documents.columns])
