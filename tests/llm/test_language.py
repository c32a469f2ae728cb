"""Mixture inference: proportions, defined cases, held-out accuracy."""

import numpy as np
import pytest

from tests.conftest import SF
from tidemark.llm import language
from tidemark.llm.queries import op9_language_id

ALPHABETS = {"aa": "abcde", "bb": "vwxyz", "cc": "äöüßé"}


def sentence(lang, rng, n):
    return " ".join("".join(rng.choice(list(ALPHABETS[lang]), size=rng.integers(3, 8))) for _ in range(n))


def toy(spark, n=90):
    rng = np.random.default_rng(1)
    rows = [(i, sentence(lang, rng, 30), lang) for i in range(n) for lang in [list(ALPHABETS)[i % 3]]]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, SCORE string"), rng


def test_mixture_proportions(spark):
    docs, rng = toy(spark)
    mixed = sentence("aa", rng, 60) + " " + sentence("bb", rng, 30)
    odd = [(900, mixed, None, "x"), (901, sentence("cc", rng, 5).upper(), "aa", "x"), (902, None, "aa", "x"), (903, " 12 .. €", "aa", "x"),
           (904, "", None, "x"), (None, "abcabc", None, "x"), (None, "abcabc", None, "x"), (905, "vwx " * 30000, None, "x")]
    rows = language.identify(docs.union(spark.createDataFrame(odd, docs.schema))).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 98
    assert all(r.lang_pred == list(ALPHABETS)[r.doc_id % 3] for r in rows if r.doc_id is not None and r.doc_id < 90)
    assert by[900].lang_pred == "aa" and by[900].score == pytest.approx(2 / 3, abs=0.05)
    assert [x.lang for x in by[900].languages] == ["aa", "bb"]
    assert by[901].lang_pred == "cc"
    assert [(by[i].lang_pred, by[i].score) for i in (902, 903, 904)] == [("und", 0.0)] * 3
    assert [r.lang_pred for r in rows if r.doc_id is None] == ["aa", "aa"] and by[905].lang_pred == "bb"


def test_nothing_learned_and_empty(spark):
    docs, _ = toy(spark, 6)
    assert {(r.lang_pred, r.score) for r in language.identify(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0)).collect() == []


def test_em_equals_plain_loop():
    rng = np.random.default_rng(3)
    log_word = rng.normal(size=(50, 3)) * 3
    first = np.array([0, 20, 50])
    weight = np.exp(log_word - log_word.max(axis=1, keepdims=True))
    share, likelihood = language._em(weight, first, np.repeat([0, 1], [20, 30]), np.ones((2, 3)))
    for t, (lo, hi) in enumerate([(0, 20), (20, 50)]):
        p = np.ones(3) / 3
        for _ in range(language.ROUNDS):
            z = weight[lo:hi] * p
            p = (z / z.sum(axis=1, keepdims=True)).mean(axis=0)
        assert np.allclose(p, share[t])
        assert likelihood[t] == pytest.approx(np.log((weight[lo:hi] * p).sum(axis=1)).sum())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op9_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id") \
        .where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.93 * len(rows)
    assert len(op9_language_id(spark, SF).collect()) == spark.read.parquet(f"{SF}/documents.parquet").count()
