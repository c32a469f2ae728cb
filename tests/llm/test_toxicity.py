"""Nearest-example toxicity: exactness of the search, held-out quality, defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import toxicity
from tidemark.llm.queries import op2_toxicity


def random_model(rng, n_examples, n_terms):
    model = toxicity.Model(terms=np.arange(1, n_terms + 1, dtype=np.uint64), idf=np.ones(n_terms, np.float32), prior=0.1)
    vectors = []
    for _ in range(n_examples):
        term = np.sort(rng.choice(n_terms, size=rng.integers(1, 6), replace=False))
        weight = rng.random(len(term)).astype(np.float32) + np.float32(0.1)
        vectors.append((term, (weight / np.sqrt((weight ** 2).sum())).astype(np.float32)))
    vectors.sort(key=lambda v: v[0][v[1].argmax()])
    model.example = np.array([(i, 1, int(rng.random() < 0.5)) for i in range(n_examples)],
                             dtype=[("doc_id", np.int64), ("copies", np.int64), ("toxic", np.int64)])
    model.entries = (np.repeat(np.arange(n_examples), [len(t) for t, _ in vectors]),
                     np.concatenate([t for t, _ in vectors]), np.concatenate([w for _, w in vectors]))
    return model, vectors


@pytest.mark.parametrize("seed", range(4))
def test_block_max_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    model, vectors = random_model(rng, 300, 40)
    dense = np.zeros((300, 40), np.float32)
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    queries = [v for v in vectors[::3]]
    text = np.repeat(np.arange(len(queries)), [len(t) for t, _ in queries])
    found, index, cosine = model.nearest(text, np.concatenate([t for t, _ in queries]), np.concatenate([w for _, w in queries]), k=7)
    assert found.tolist() == list(range(len(queries)))
    for q, (t, w) in enumerate(queries):
        exact = np.sort(dense[:, t] @ w)[::-1][:7]
        assert np.allclose(np.sort(cosine[q])[::-1], exact, atol=1e-5)
        for i, c in zip(index[q], cosine[q], strict=True):
            assert i < 0 or abs(dense[i, t] @ w - c) < 1e-5


def test_isotonic_is_monotone_and_pools():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0.0, 1.0, 0.0, 0.0, 1.0]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) >= 0).all()
    assert np.interp(0.2, x, y) == pytest.approx(1 / 3) and np.interp(0.95, x, y) == 1


def toy(spark):
    clean = [f"plain words number {i} here {'abcdefgh'[i % 8] * 4} and {i * 7} more" for i in range(120)]
    toxic = [f"text {i} with vile slur{'xyz'[i % 3]} inside number {i * 3}" for i in range(60)]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(clean + toxic)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i >= 120)) for i in range(180)], "doc_id long, toxic int")
    return docs, labels


def test_learns_and_ignores_held_out_labels(spark):
    docs, labels = toy(spark)
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 180
    assert all(r.predicted == int(r.doc_id >= 120) for r in rows)
    assert all(r.evidence and all(0 <= e.cosine <= 1.0001 for e in r.evidence) for r in rows if r.doc_id >= 120)
    wrong = labels.select("doc_id", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, wrong).collect()}
    assert again == {r.doc_id: r.score for r in rows}
    assert any(r.held_out for r in rows) and not all(r.held_out for r in rows)


def test_defined_cases(spark):
    docs, labels = toy(spark)
    odd = spark.createDataFrame([(900, None, 1), (901, "", 1), (None, "vile slurx here", 1), (None, "vile slurx here", 1), (902, "slurx vile " * 9000, 1)], docs.schema)
    rows = toxicity.toxicity(docs.unionByName(odd), labels.union(spark.createDataFrame([(None, 1), (900, None)], labels.schema))).collect()
    by = {(r.doc_id, i): r for i, r in enumerate(rows)}
    assert len(by) == 185 and all(0 <= r.score <= 1 for r in rows)
    assert [r.predicted for r in rows if r.doc_id in (900, 901)] == [0, 0]
    assert [r.predicted for r in rows if r.doc_id is None] == [1, 1]
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 120


def test_query_on_the_small_table(spark):
    rows = op2_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op2_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.9 * sum(r.toxic for r in rows)
    assert sum(r.predicted and not r.toxic for r in rows) <= 0.01 * len(rows)
