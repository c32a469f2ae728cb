"""Merkle manifest against a plain recursive tree."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.queries import op13_merkle_manifest
from tidemark.llm.tables import held_out

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(digests):
    """All levels from the given nodes to the single one left."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i:i + 16]) for i in range(0, len(below), 16)])
    return levels


def walk(levels, i):
    """Siblings of node i at each level, as (left, right)."""
    out = []
    for below in levels[:-1]:
        run = below[i // 16 * 16:i // 16 * 16 + 16]
        out.append((run[:i % 16], run[i % 16 + 1:]))
        i //= 16
    return out


def expected(rows):
    """Per row (in leaf order of each source): the contract's columns, computed plainly."""
    def leaf(r, text):
        return H(*map(coded, (r[0], r[3], r[2], r[4], text)))

    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = own, up([leaf(r, r[1]) for r in own])
    top = up([trees[s][1][-1][0] for s in names])
    root, out = top[-1][0], []
    for k, s in enumerate(names):
        own, levels = trees[s]
        for i, r in enumerate(own):
            path = walk(levels, i) + walk(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = r[1]
            if hit and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for left, right in path:
                folded = H(*left, folded, *right)
            proof = H(*[d for left, right in path for d in left + right])
            out.append((r[0], levels[0][i], levels[-1][0], root, proof, folded, folded == root))
    return out


def compare(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in merkle.manifest(docs, held_out(F.col("doc_id"))).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


@pytest.mark.parametrize("sizes", [[1], [257, 16, 17, 1, 2], [1] * 18, [5000, 1, 40]])
def test_tree_shapes(spark, sizes):
    rows, i = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            rows.append((i * 7 % 100_003, f"Text {i} É", "en", f"s{s}", i))
            i += 1
    compare(spark, rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, "", None, "", 0), (2, "A" * 200_000, "de", None, 3), (None, "Ab", "en", "x", 1),
            (None, "Ab", "en", "x", 1), (None, None, None, None, None), (7, "Ünïcode\n\0x", "fr", "ü", 9), (7, "other", "fr", "ü", 9)]
    rows += [(5, "same Row", "en", "x", 8)] * 40
    compare(spark, rows)


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(docs).collect() == []
    docs = spark.createDataFrame([(3, "Hi", "en", "s", 2)], SCHEMA).withColumns(
        {"pos": F.lit(5), "grp": F.lit("x"), "digest": F.lit("y"), "block": F.lit(1)})
    assert [tuple(r) for r in merkle.manifest(docs).collect()] == expected([(3, "Hi", "en", "s", 2)])


def test_paths_refold_to_the_root(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(400)], SCHEMA)
    for r in merkle.manifest(docs, with_paths=True).collect():
        digest = r.leaf
        for slot, siblings in zip(r.slots, r.siblings, strict=True):
            digest = H(siblings[:slot * 64], digest, siblings[slot * 64:])
        assert digest == r.root and H(*r.siblings) == r.proof_sha256 and r.verified


def test_states_resume(spark):
    children = [H(str(i)) for i in range(11)]
    parent = merkle.Parent(children)
    assert len(parent.before) == 11 and parent.digest == H(*children)
    for slot in range(11):
        changed = [*children[:slot], H("new"), *children[slot + 1:]]
        assert parent.fold(slot, H("new")) == H(*changed)
        assert merkle.Step(slot, parent.siblings(slot).decode()).fold(H("new")) == H(*changed)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = [tuple(r) for r in op13_merkle_manifest(spark, SF).collect()]
    assert sorted(got) == sorted(expected(rows))
