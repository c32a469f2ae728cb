"""Similarity components against counting all shared shingles."""

import collections
import random
import re

import numpy as np
import pytest

from tidemark.llm import jaccard
from tidemark.llm.components import connected_components
from tidemark.llm.queries import op8_ngram_jaccard_join
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(docs, k, percent):
    """{doc_id: (size, component)} by an inverted list of all shingles."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists, shared = collections.defaultdict(list), collections.Counter()
    for d, s in sets.items():
        for x in s:
            shared.update((o, d) for o in lists[x])
            lists[x].append(d)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def run(spark, docs, k=3, percent=90, **more):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, k, percent, **more).collect()}


def variants(seed, n, size, edits):
    rng = random.Random(seed)
    base = [f"b{seed}x{i}" for i in range(size)]
    for _ in range(n):
        text = list(base)
        for _ in range(edits):
            text[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        yield " ".join(text)


@pytest.mark.parametrize(("k", "percent", "group"), [(3, 90, 4), (5, 80, 128), (2, 50, 8)])
def test_families_of_near_copies(spark, k, percent, group):
    texts = [*variants(1, 25, 90, 2), *variants(2, 15, 300, 5), *variants(3, 20, 12, 1), *variants(4, 10, 60, 6)]
    texts += ["one", "one two", "ONE  two", "one two three", "", "   ", *["exact copy of some words here"] * 6]
    docs = list(enumerate(texts))
    assert run(spark, docs, k, percent, group_sets=group) == brute(docs, k, percent)


def test_family_mostly_just_below_the_threshold(spark):
    """Members differ from their base by so much that most, but not all, pairs of them fail."""
    docs = list(enumerate([*variants(5, 40, 200, 3), *variants(5, 20, 200, 2), *variants(6, 30, 40, 1)]))
    want = brute(docs, 3, 90)
    assert 5 < len({c for _, c in want.values()}) < len(docs)
    for group in (3, 1024):
        assert run(spark, docs, group_sets=group) == want


def test_shingles_move_only_where_tokens_allow_a_link(spark, monkeypatch):
    """Shingles do not move for sets and pairs that share a token, but fewer than a link needs."""
    moved = []
    for name in ("_open", "_test_pairs"):
        monkeypatch.setattr(jaccard, name, lambda rows, *rest, act=getattr(jaccard, name): moved.append(rows.count()) or act(rows, *rest))
    docs = list(enumerate([*variants(7, 40, 200, 10), *variants(8, 6, 200, 1)]))
    assert run(spark, docs) == brute(docs, 3, 90)
    assert moved[0] < 40 and moved[1] < 100  # 40 sets have a neighbour in their group, 212 pairs share a token


def test_needed_tokens_are_shared_by_every_linked_pair():
    rng = np.random.default_rng(3)
    bands = jaccard.Bands(90)
    for size in (1, 2, 9, 40, 300):
        for _ in range(40):
            whole = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            gone = int(rng.integers(0, size // 10 + 1))
            sets = [whole, np.sort(rng.permutation(whole)[gone:])]
            values, bounds = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
            token, owner = bands.tokens(values, bounds)
            both = len(np.intersect1d(token[owner == 0], token[owner == 1]))
            assert (bands.needed(values, bounds) <= both).all()


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_needed_tokens_follow_the_own_size(percent):
    """Sets of all sizes in a band, each with its own bound; pairs differ in both directions."""
    rng = np.random.default_rng(5)
    bands = jaccard.Bands(percent)
    more = 0
    for size in range(20, 140, 3):
        whole = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        out, into = (int(rng.integers(0, size * (100 - percent) // 100 + 1)) for _ in range(2))
        other = np.unique(np.concatenate((rng.permutation(whole)[out:], rng.integers(0, 2**64, into, dtype=np.uint64))))
        values, bounds = np.concatenate((whole, other)), np.cumsum([0, len(whole), len(other)])
        needed = bands.needed(values, bounds)
        if 100 * len(np.intersect1d(whole, other)) >= percent * len(np.union1d(whole, other)):
            token, owner = bands.tokens(values, bounds)
            assert (needed <= len(np.intersect1d(token[owner == 0], token[owner == 1]))).all()
        own = int(np.searchsorted(bands.edges, len(whole), side="right")) - 1
        filled = [len({(int(v) >> 32) * int(bands.segments[b]) >> 32 for v in whole}) for b in (own, own - 1)]
        more += needed[0] > max(1, *[min(f - int(bands.allowed[b]) for f, b in zip(filled, (own, own - 1), strict=True))])
    assert more > 5 or percent == 50  # more than with one bound for all sizes of a band; half the set may differ at 50


def test_asks_join_only_the_rarer_tokens(spark):
    """A set asks a group with which it shares enough tokens, found by one of its rarer ones, and no other group."""
    held = {1: [10, 11, 12, 13], 2: [10, 11, 12, 20], 3: [10, 20, 21, 22], 4: [10, 11, 30, 31], 5: [40, 41]}
    shared = spark.createDataFrame([(t, s) for s, ts in held.items() for t in ts], "token long, sid long")
    placed = spark.createDataFrame([(s, s, s, s) for s in held], "sid long, gid long, size long, component long")
    for least in (1, 2, 3, 4):
        needed = spark.createDataFrame([(s, least) for s in held], "sid long, needed long")
        got = {(r.sid, r.gid) for r in jaccard._asks(shared, 18, placed, needed).collect()}
        assert got == {(a, b) for a in held for b in held if a < b and len({*held[a]} & {*held[b]}) >= least}


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(3, "a b c d", 1), (3, "a b c d", 1), (1, "A b  c d", 2), (5, None, 3), (None, "a b c d", 4), (None, "x y z", 5), (7, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(map(tuple, jaccard.jaccard_components(df, 3, 90).collect()), key=str)
    assert got == sorted([(3, 2, 1), (3, 2, 1), (1, 2, 1), (5, 0, 5), (None, 2, 1), (None, 1, None), (7, 0, 7)], key=str)
    assert jaccard.jaccard_components(df.limit(0), 3, 90).collect() == []


def test_bands_cover_every_linked_size_pair():
    """Linked sizes are in the same or neighbouring bands, and fewer shingles differ than there are segments."""
    for percent in (50, 80, 90):
        bands = jaccard.Bands(percent, 5000)
        for a in range(1, 1500):
            i = np.searchsorted(bands.edges, a, side="right") - 1
            for b in (a, 100 * a // percent):
                j = np.searchsorted(bands.edges, b, side="right") - 1
                assert i <= j <= i + 1
                assert (100 - percent) * (a + b) // (100 + percent) <= bands.allowed[i] < bands.segments[i]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 100), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 90: 90, 95: 90, 100: 90}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_small_tables_make_few_files(spark, monkeypatch):
    """Files and tasks that write follow the number of rows, not the number of shuffle partitions."""
    from pathlib import Path
    from urllib.parse import urlparse

    from tidemark.llm import components

    most, jobs = 2 * spark.sparkContext.defaultParallelism, []
    for module in (components, jaccard):
        def keep(df, act=module.stored):
            out = act(df)
            jobs.append(len(list(Path(urlparse(out.stored_path).path).glob("part-*"))))
            return out
        monkeypatch.setattr(module, "stored", keep)
    monkeypatch.setattr("pyspark.sql.DataFrame.checkpoint", lambda *a, **b: pytest.fail("a file per partition, even for no rows"))
    changed = {"spark.sql.shuffle.partitions": str(4 * most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    docs = list(enumerate([*variants(7, 30, 120, 4), *variants(8, 30, 120, 1)]))
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        edges = [(i, i + 1) for i in range(400)]
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == dict.fromkeys(range(401), 0)
        assert max(jobs) <= most
        jobs.clear()
        assert run(spark, docs) == brute(docs, 3, 90)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # the token matrix, the members before they are known and the asks have no known number of rows yet
    assert sum(n > most for n in jobs) <= 3


def test_worker_gives_memory_back(monkeypatch):
    """Every step in Python leaves its worker without what it needed."""
    calls = []
    monkeypatch.setattr(jaccard, "release", lambda: calls.append("release"))

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, work, _):
            return list(work(iter([])))

    assert jaccard.document_sets(Rows(), 3) == jaccard.matrix_rows(Rows(), 3, 90) == []
    assert len(calls) == 4


def test_query_equals_brute_force(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op8_ngram_jaccard_join(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([tuple(r) for r in docs], 3, 90)
