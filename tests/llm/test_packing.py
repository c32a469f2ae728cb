"""Optimal buckets against all splits; batches against their budget."""

import collections
import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF
from tidemark.llm import packing
from tidemark.llm.queries import op10_packing


def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts, strict=True))


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 5))
def test_bounds_are_optimal(histogram, k):
    lengths, counts = map(list, zip(*histogram.items(), strict=True))
    bounds = packing.optimal_bounds(np.array(lengths), np.array(counts), k)
    assert len(bounds) <= k and max(bounds) == max(lengths)
    top = max(lengths)
    best = min(padding(lengths, counts, (*c, top)) for r in range(min(k, len(lengths))) for c in itertools.combinations(lengths, r))
    assert padding(lengths, counts, bounds) == best


def check(rows, budget, n_buckets):
    batches = collections.defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.padded_to
        batches[r.bucket, r.batch].append(r)
    assert len({r.bucket for r in rows}) <= n_buckets
    full = collections.Counter()
    for (bucket, _), own in batches.items():
        assert sorted(r.place for r in own) == list(range(len(own)))
        assert len(own) == 1 or len(own) * own[0].padded_to <= budget
        full[bucket] += len(own) < max(1, budget // own[0].padded_to)
    assert all(n <= 1 for n in full.values())  # at most the last batch of a bucket is not full
    for bucket in full:
        numbers = {b for k, b in batches if k == bucket}
        assert numbers == set(range(len(numbers)))


def test_batches_and_repeated_execution(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 40)
    lengths = spark.createDataFrame([(i, 1 + (i * i) % 90) for i in range(1000)] + [(None, 7)] * 5 + [(3, 5000)], "doc_id long, n_tokens long")
    out = packing.pack(lengths, n_buckets=5, budget=400)
    rows = out.collect()
    assert len(rows) == 1006
    check(rows, 400, 5)
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(lengths.repartition(13), n_buckets=5, budget=400).collect()))


def test_bounded_histogram(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_BINS", 10)
    rows = packing.pack(spark.range(1, 1000).selectExpr("id as doc_id", "id as n_tokens"), n_buckets=3, budget=3000).collect()
    check(rows, 3000, 3)


def test_one_very_long_text_leaves_the_bounds_exact(spark, monkeypatch):
    sizes = [3, 5, 8, 9, 14, 15, 22, 37, 1_000_003]
    lengths = [n for i, n in enumerate(sizes) for _ in range(1 + 7 * i % 5)]
    counts = list(collections.Counter(lengths).values())
    best = min(padding(sizes, counts, (*c, sizes[-1])) for c in itertools.combinations(sizes[:-1], 3))
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long")
    for bins in (packing.MAX_BINS, 3):
        monkeypatch.setattr(packing, "MAX_BINS", bins)
        rows = packing.pack(df, n_buckets=4, budget=100).collect()
        check(rows, 100, 4)
        assert {r.padded_to for r in rows} <= set(sizes)
        assert sum(r.padded_to - r.n_tokens for r in rows) == best


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (2, "", 0), (None, "a b", 0)], "doc_id long, text string, BUCKET int")
    assert sorted(r.n_tokens for r in packing.word_lengths(docs).collect()) == [1, 1, 1, 3]
    assert packing.pack(packing.word_lengths(docs)).count() == 4
    assert packing.pack(packing.word_lengths(docs.limit(0))).collect() == []


def test_many_rows_without_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 500)
    monkeypatch.setattr(packing, "COPIES_PER_CHUNK", 300)
    rows = spark.range(5000).selectExpr("CASE WHEN id % 5 = 0 THEN id END AS doc_id", "CAST(7 + id % 2 AS LONG) AS n_tokens")
    found = packing.pack(rows, n_buckets=2, budget=70).collect()
    check(found, 70, 2)
    assert len(found) == 5000 and sum(r.doc_id is None for r in found) == 4000


def test_query(spark):
    rows = op10_packing(spark, SF).collect()
    check(rows, packing.TOKEN_BUDGET, packing.N_BUCKETS)
    lengths, counts = map(list, zip(*collections.Counter(r.n_tokens for r in rows).items(), strict=True))
    even = sorted(lengths)[len(lengths) // 16::max(1, len(lengths) // 16)][:15] + [max(lengths)]
    assert sum(r.padded_to - r.n_tokens for r in rows) <= padding(lengths, counts, even)


def test_query_counts_token_ids(spark):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)

    def ids(text):
        return len(tool.encode(text or "", add_special_tokens=False).ids) + 1

    unspaced = "".join(chr(0x4E00 + i) for i in range(500))
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "Hello world"), (3, unspaced), (3, unspaced)], "doc_id long, text string")
    lengths = [r.n_tokens for r in packing.token_lengths(docs, path).collect()]
    assert lengths == [1, 1, ids("Hello world"), ids(unspaced), ids(unspaced)] and lengths[-1] > 500
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op10_packing(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {d: ids(t) for d, t in texts.items()}
    check(rows, packing.TOKEN_BUDGET, packing.N_BUCKETS)
