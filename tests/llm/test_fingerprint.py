"""Fingerprints against a plain computation, and the likeness of near and other texts."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np

from tidemark.llm import fingerprint as fp
from tidemark.llm.queries import op11_document_fingerprints

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def window_class(window):
    return sum(round(c * math.log2(c) * fp.STEPS) for c in Counter(window).values())


def plain_features(text, ranks):
    """Different features in order: every neighbourhood votes for its best window."""
    raw = text.encode()
    if len(text) < fp.SHORT or len(raw) < fp.WINDOW + fp.NEIGHBOURS - 1:
        windows = [raw[i:i + fp.SHORT_WINDOW] for i in range(len(raw) - fp.SHORT_WINDOW + 1)]
    else:
        rank = [ranks[window_class(raw[i:i + fp.WINDOW])] for i in range(len(raw) - fp.WINDOW + 1)]
        votes = Counter()
        for lo in range(len(rank) - fp.NEIGHBOURS + 1):
            best = min(range(lo, lo + fp.NEIGHBOURS), key=lambda i: (rank[i], i))
            if rank[best] < fp.UNRANKED:
                votes[best] += 1
        windows = [raw[i:i + fp.WINDOW] for i in sorted(votes) if votes[i] >= fp.POPULAR]
    if raw and not windows:
        return [raw]
    return list(dict.fromkeys(windows))


def plain_print(text, ranks):
    features = plain_features(text, ranks)
    window = fp.WINDOW if len(text) >= fp.SHORT else fp.SHORT_WINDOW
    filters = []
    for at, feature in enumerate(features):
        if at % fp.FEATURES == 0:
            filters.append(set())
        if features == [text.encode()] and len(feature) != window:
            h = int.from_bytes(hashlib.sha256(feature).digest()[:8], "little")
        else:
            h = int(fp._hashed(np.frombuffer(feature, dtype=np.uint8)[None, :])[0])
        filters[-1].update(h >> 11 * k & 2047 for k in range(fp.HASHES))
    return window, len(features), filters


def plain_likeness(a, b):
    if not a[1] or not b[1]:
        return float(a[1] == b[1])
    if a[0] != b[0]:
        return 0.0
    fewer, more = sorted((a[2], b[2]), key=lambda f: (len(f), sum(map(len, f))))
    total = 0.0
    for x in fewer:
        scores = [(len(x & y) - len(x) * len(y) / 2048) / (min(len(x), len(y)) - len(x) * len(y) / 2048) for y in more]
        total += len(x) * min(1.0, max(0.0, *scores))
    return total / sum(map(len, fewer))


def bits(filters):
    return [set(np.flatnonzero(np.unpackbits(f)).tolist()) for f in filters]


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlucmäñ") for _ in range(rng.randrange(1, 11))) for _ in range(n))


def some_texts():
    rng = random.Random(4)
    texts = [prose(rng, rng.choice([1, 3, 12, 20, 60, 400, 1500])) for _ in range(60)]
    return texts + ["", "a", "abcd", "=" * 500, "ab" * 300, "x" * 95, "y" * 96, "é" * 96, prose(rng, 5) + "-" * 400 + prose(rng, 40)]


def corpus(texts):
    counts = Counter(window_class(t.encode()[i:i + fp.WINDOW]) for t in texts for i in range(len(t.encode()) - fp.WINDOW + 1))
    return np.array([counts[c] for c in range(fp.CLASSES)])


def test_prints_equal_plain_computation():
    texts = some_texts()
    ranks = fp.ranks_of(corpus(texts))
    got = fp.fingerprints(texts, ranks)
    want = [plain_print(t, ranks) for t in texts]
    for (w, n, filters), (w2, n2, filters2) in zip(got, want, strict=True):
        assert (w, n, bits(filters)) == (w2, n2, filters2)
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert abs(fp.likeness(got[i], got[j]) - plain_likeness(want[i], want[j])) < 1e-9


def test_blocks_do_not_change_features(monkeypatch):
    text = [prose(random.Random(1), 4000), prose(random.Random(2), 30)]
    ranks = fp.ranks_of(corpus([t[:3000] for t in text]))
    whole = fp.fingerprints(text, ranks)
    data = np.frombuffer("".join(text).encode(), dtype=np.uint8)
    first = np.array([0, len(text[0].encode())])
    counts = fp.histogram(data, first, np.array([first[1], len(data)]))
    monkeypatch.setattr(fp, "BLOCK", 701)
    assert [(a, b, c.tobytes()) for a, b, c in fp.fingerprints(text, ranks)] == [(a, b, c.tobytes()) for a, b, c in whole]
    assert (fp.histogram(data, first, np.array([first[1], len(data)])) == counts).all()
    assert counts.sum() == sum(len(t.encode()) - fp.WINDOW + 1 for t in text)


def test_ranks_come_from_all_texts(spark):
    texts = some_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None)], SCHEMA)
    assert (fp.corpus_ranks(docs) == fp.ranks_of(corpus(texts))).all()


def check(rows, got, ranks):
    """Every document's results, the next one by id."""
    texts = [t or "" for _, t in rows]
    for i, (doc_id, _) in enumerate(rows):
        after = texts[(i + 1) % len(rows)]
        n = len(texts[i]) // 4
        changed = texts[i][:len(texts[i]) - n] + after[:n]
        r = got[doc_id]
        own, other, following = (fp.fingerprints([t], ranks)[0] for t in (texts[i], changed, after))
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == fp.as_text(own) and r.edited_fingerprint == fp.as_text(other)
        assert r.near_edited == fp.likeness(own, other) and r.near_next == fp.likeness(own, following)
        back = fp.from_text(r.fingerprint)
        assert back[:2] == own[:2] and (back[2] == own[2]).all()


def test_odd_rows(spark):
    rows = [(None, "first " * 40), (1, None), (2, ""), (3, "short"), (5, "ñ" * 400), (9, "word " * 30_000), (11, prose(random.Random(8), 90))]
    docs = spark.createDataFrame(rows[::-1], SCHEMA).selectExpr("*", "1 AS piece", "true AS open", "'x' AS fingerprint").repartition(4)
    ranks = fp.corpus_ranks(docs)
    check(rows, {r.doc_id: r for r in fp.report(fp.fingerprint_neighbours(docs)).collect()}, ranks)
    assert fp.fingerprint_neighbours(spark.createDataFrame([], SCHEMA)).collect() == []
    (one,) = fp.fingerprint_neighbours(spark.createDataFrame([(1, "alone " * 50)], SCHEMA)).collect()
    assert one.near_next == 1.0
    same = fp.fingerprint_neighbours(spark.createDataFrame([(1, "copy of it " * 20)] * 5 + [(None, "z")] * 3, SCHEMA)).collect()
    assert len(same) == 8 and {r.near_next for r in same if r.doc_id is None} == {0.0, 1.0}


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in op11_document_fingerprints(spark, SF).collect()}
    assert len(got) == len(rows)
    check(rows, got, fp.corpus_ranks(docs))
    near = np.array([got[d].near_edited for d, _ in rows])
    other = np.array([got[d].near_next for d, _ in rows])
    assert np.median(near) > 0.65 and np.median(other) < 0.05 and (near > 0.4).mean() > 0.95 and (other < 0.3).mean() > 0.95
