"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import runs
from tidemark.llm.queries import op12_periodic_runs

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain_runs(words):
    """Every (start, length, period): for each period the maximal stretches, smallest period of an interval kept."""
    code = {}
    w = np.array([code.setdefault(x, len(code)) for x in words], dtype=np.int64)
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        same = np.concatenate(([0], (w[:-q] == w[q:]).astype(np.int8), [0]))
        turn = np.diff(same)
        for x, y in zip(np.flatnonzero(turn == 1), np.flatnonzero(turn == -1), strict=True):
            if y - x + q >= max(24, 3 * q):
                found.setdefault((int(x), int(y - x + q)), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def by_start(found):
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, rewrite=True):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    places = runs.planted_tail(doc_id, len(words)) if rewrite and doc_id is not None else None
    if places is not None:
        words = [words[i] for i in places]
    found = by_start(plain_runs(words))
    gone = set()
    for s, n, q in found:
        gone.update(range(s + q, s + n))
    left = " ".join(x for i, x in enumerate(words) if i not in gone)
    best = (None,) * 4
    for s, n, q in found:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    listing = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listing, left)]
    return (doc_id, len(found), *best, *sha)


def solve(words):
    code = {}
    codes = np.array([code.setdefault(x, len(code)) for x in words], dtype=np.int32)
    n, one = len(codes), lambda v: np.array([v], dtype=np.int64)
    (found,) = runs.fragments(runs.Pieces(codes, np.array([0, n]), one(0), one(0), one(runs.octaves(n)), one(0), one(n)))
    best = {}
    for q, x, y in found:
        if y - x + q >= max(24, 3 * q):
            best.setdefault((x, y - x + q), q)
    return by_start((s, length, q) for (s, length), q in best.items())


def planted(rng, n, alphabet):
    words = [rng.choice(alphabet) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        p, at = rng.randrange(1, max(2, n // 4)), rng.randrange(n)
        unit = words[at:at + p] or ["x"]
        size = rng.randrange(n)
        words[at:at + size] = [unit[i % len(unit)] for i in range(min(size, n - at))]
    return words


def test_fragments_equal_plain_search():
    rng = random.Random(5)
    for k in range(300):
        words = planted(rng, rng.choice([5, 23, 24, 25, 40, 100, 333, 700]), "ab" if k % 3 == 0 else "abcdefghijklmnop")
        assert solve(words) == by_start(plain_runs(words)), words


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        z = runs.z_function(s)
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k


def collected(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in runs.report(runs.periodic_runs(docs, texts=False, **options)).collect()), key=str)


@pytest.mark.parametrize("tile_words", [8192, 64])
def test_exploded_tiles_equal_plain_search(spark, tile_words):
    rng = random.Random(9)
    rows = [(i, " ".join(planted(rng, rng.choice([10, 60, 200, 900]), "abcdefgh"))) for i in range(40)]
    rows += [(40, "same " * 500), (41, "a b " * 400 + "c " * 300)]
    got = collected(spark, rows, rewrite=runs.planted_tail, tile_words=tile_words)
    assert got == sorted((expected(*r) for r in rows), key=str)


def test_long_texts(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(50)}" for _ in range(30_000)]
    base[9_000:24_000] = [base[9_000 + i % 4_001] for i in range(15_000)]
    base[25_000:29_000] = ["again"] * 4_000
    rows = [(None, " ".join(base)), (None, "one " * 60_000)]
    got = {r.n_words: r for r in runs.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(r) for r in got[30_000].runs] == by_start(plain_runs(base))
    assert [tuple(r) for r in got[60_000].runs] == [(0, 60_000, 1)] and got[60_000].collapsed == "one"


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 24), (None, "a " * 24), (4, "a " * 23), (5, "ä b " * 12), (5, "x y z " * 8)]
    assert collected(spark, rows) == sorted((expected(*r, rewrite=False) for r in rows), key=str)
    assert collected(spark, []) == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op12_periodic_runs(spark, SF).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
