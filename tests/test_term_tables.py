"""Keyword, category and lexicon tables give what the expressions give, at any length of the tables."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_ASSET_CATEGORIES, DEFAULT_STRESS_KEYWORDS, SEED_LEXICON, Lexicon
from tidemark.operators import term_tables as TT
from tidemark.operators.composite import text_features

WORDS = ["crash", "not", "good", "very", "bear", "market", "Bear", "S&P", "sell-off", "gold!", "no", "the", "bäd", "worst", "rally", "volatility", "spike", "eurusd"]


def rows():
    rng = random.Random(7)
    texts = [None, "", " ", "  bear  market", "bear market", "not very good", "no a b good", "no a b c good", "very very good!!!!!!", "x" * 3000 + "crash",
             " ".join(rng.choice(WORDS) for _ in range(9000)), "😀crash😀 bear market"]
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    return [(i, t, ["index", "commodity", None][i % 3], None if i % 7 == 0 else i / 10) for i, t in enumerate(texts)]


SCHEMA = "row_id long, headline string, asset_type string, change_percent double"


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_tables_equal_expressions(spark, broadcast_rows):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    want = text_features(df, DEFAULT_STRESS_KEYWORDS, DEFAULT_ASSET_CATEGORIES, SEED_LEXICON)
    got = TT.text_features_from_tables(df, TT.keyword_table(spark, DEFAULT_STRESS_KEYWORDS), TT.category_table(spark, DEFAULT_ASSET_CATEGORIES),
                                       TT.lexicon_table(spark, SEED_LEXICON), broadcast_rows=broadcast_rows)
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(want.columns)
    a = {r.row_id: r for r in want.select(names).collect()}
    b = {r.row_id: r for r in got.select(names).collect()}
    assert len(b) == len(a) == got.count()
    for k, r in a.items():
        for n in names:
            assert b[k][n] == (pytest.approx(r[n], abs=1e-9) if isinstance(r[n], float) else r[n]), (k, n)


def test_hundred_thousand_terms(spark):
    texts = [(i, f"ab term{i * 37} cd", None, None) for i in range(400)]
    df = spark.createDataFrame(texts, SCHEMA)
    keywords = spark.range(100_000).select(F.lit("t").alias("tier"), F.concat(F.lit("Term"), "id").alias("term"), F.lit(1).alias("points"))
    got = {r.row_id: r.entry.term for r in TT.term_matches(df, keywords.select(F.struct("term").alias("entry"), "term")).groupBy("row_id")
           .agg(F.struct(F.count(F.lit(1)).alias("term")).alias("entry")).collect()}
    # term<n> contains the terms of all leading digits of n
    assert got == {i: len(str(i * 37)) for i in range(400)}


def test_empty_tables_and_odd_terms(spark):
    df = spark.createDataFrame([(1, "good", "index", None), (2, None, "x", 9.0)], SCHEMA)
    none = TT.text_features_from_tables(df, TT.keyword_table(spark, {}), TT.category_table(spark, {}), TT.lexicon_table(spark, Lexicon({}, negations=())))
    assert [(r.keyword_stress_score, r.vader_compound) for r in none.orderBy("row_id").collect()] == [(0.0, 0.0), (4.5, 0.0)]
    odd = spark.createDataFrame([("a", "", 1), ("a", None, 5), ("a", "good", 2), ("a", "good", 2), ("b", "good", 3)], "tier string, term string, points int")
    out = TT.text_features_from_tables(df, odd, TT.category_table(spark, {"c": ["oo"]}), TT.lexicon_table(spark, SEED_LEXICON))
    assert [(r.keyword_stress_score, r.mentions_c) for r in out.orderBy("row_id").collect()] == [(6.0, 1), (4.5, 0)]
