"""Gold at size: texts move once, keys are made once, row-order features leave the wide rows where they are."""

from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.operators.clean import clean_articles
from tidemark.operators.ordering import blocked_window, global_index
from tidemark.plans import registry  # noqa: F401  (first: the query modules import one another through it)
from tidemark.plans import pipeline as P
from tidemark.plans import queries_models as M
from tidemark.plans import queries_silver as S


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_blocked_window_reads_its_rows_once(spark):
    df = spark.range(1, 50).select(F.col("id").alias("idx"))
    out = blocked_window(df, "idx", lambda w: [F.lead("idx", 1).over(w).alias("n")], preceding=2, following=1, block=7)
    assert plan(out).count("Range (") == 1
    assert sorted((r.idx, r.n) for r in out.collect()) == [(i, i + 1 if i < 49 else None) for i in range(1, 50)]


def test_article_order_does_not_read_the_texts_again(spark):
    assert "documents.parquet" not in plan(S.article_order(spark, SF))


def test_dedup_comes_before_the_derived_columns(spark):
    df = spark.createDataFrame([(2, "Some headline  here", "2024-01-01T00:00:00", 1.5, "x"), (1, "Some headline here", "2024-01-01T00:00:00", 2.0, "x")],
                               "row_id long, headline string, timestamp string, price double, asset_type string")
    silver = clean_articles(df, kind="market")
    row = silver.collect()
    assert len(row) == 1 and (row[0].row_id, row[0].snippet, row[0].asset_tags, row[0].market_tags) == (1, "Some headline here [Price: $2.00]", ["Some"], ["x"])
    below = plan(silver).split("Aggregate", 1)[1]
    assert "Price" not in below  # the second copy of the text is made after the shuffle
    assert [tuple(r) for r in clean_articles(df, kind="market", columns=["row_id"]).collect()] == [(1,)]


def test_model_queries_store_gold_without_texts(spark):
    g = M._gold(spark, SF)
    assert not {"headline", "snippet"} & set(g.columns)
    whole = P.gold_features(spark, SF)
    assert {"headline", "snippet"} <= set(whole.columns) and whole.count() == g.count()
    both = whole.select("row_id", "target_stress_next", "sentiment_volatility_7d").join(
        g.select("row_id", F.col("target_stress_next").alias("t"), F.col("sentiment_volatility_7d").alias("v")), "row_id")
    assert both.where("abs(target_stress_next - t) > 1e-12 or abs(sentiment_volatility_7d - v) > 1e-12").count() == 0
    assert global_index(g.select("row_id", "timestamp"), ["timestamp", "row_id"]).count() == g.count()
