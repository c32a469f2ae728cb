"""Train-all statuses, labels by position, overlays, histograms and column roles on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.models.classifier import regime_labels
from tidemark.models.training import train_all
from tidemark.operators import risk as R
from tidemark.operators import views as V


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 10])
@pytest.mark.parametrize("score", [None, "null"])
def test_labels_by_position(spark, n, score):
    df = spark.range(n).select(F.col("id").alias("row_id"), F.timestamp_seconds(-F.col("id")).alias("timestamp"))
    if score:
        df = df.withColumn("weighted_stress_score", F.lit(None).cast("double"))
    got = [r.regime_label for r in regime_labels(df).orderBy("timestamp").collect()]
    want = ["medium"] * n
    if n >= 3:
        want[:n // 3] = ["low"] * (n // 3)
        want[-n // 3:] = ["high"] * len(want[-n // 3:])
    assert got == want


def test_train_all_reports_and_skips(spark):
    gold = spark.createDataFrame([(i, float(i), None) for i in range(6)], "row_id long, x double, old_prediction double")

    def lazily_failing(g):
        return g.withColumn("a_prediction", F.raise_error(F.lit("no such luck")).cast("double"))

    out, status = train_all(gold, {
        "one": lambda g: g.withColumn("one_prediction", F.col("x") * 2),
        "two": lambda g: g.where("row_id < 3").withColumn("one_prediction", F.col("x")),
        "none": lambda g: g.withColumn("other", F.lit(1)),
        "eager": lambda g: g.select("missing"),
        "lazy": lazily_failing,
    })
    assert [(r.model, r.status, r.predictions) for r in status.collect()] == [
        ("one", "success", 6), ("two", "success", 3), ("none", "no_predictions", 0), ("eager", "failed", 0), ("lazy", "failed", 0)]
    assert "no such luck" in status.where("model = 'lazy'").first().error
    rows = {r.row_id: r for r in out.collect()}
    assert len(rows) == 6 and rows[1].one_prediction == 2.0 and rows[1].two_one_prediction == 1.0 and rows[5].two_one_prediction is None
    assert out.columns == ["row_id", "x", "old_prediction", "one_prediction", "two_one_prediction"]


def test_overlay_and_histograms(spark):
    df = spark.createDataFrame([(0.0, 1, None), (1.0, 1, None), (4.0, 1, None), (None, 1, None)], "x double, same int, nothing double")
    o = R.normal_overlay(df, "x", 5).orderBy("point").collect()
    m, s = 5 / 3, math.sqrt(((5 / 3) ** 2 + (2 / 3) ** 2 + (7 / 3) ** 2) / 2)
    assert [r.x for r in o] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert all(r.density == pytest.approx(math.exp(-((r.x - m) / s) ** 2 / 2) / (s * math.sqrt(2 * math.pi))) for r in o)
    assert {r.density for r in R.normal_overlay(df, "same", 3).collect()} == {None} and R.normal_overlay(df, "nothing").count() == 0
    h = sorted(tuple(r) for r in R.feature_histograms(df, ["x", "same", "nothing"], 4).collect())
    assert h == [("same", 0, 4, 1.0), ("x", 0, 1, 0.0), ("x", 1, 1, 1.0), ("x", 3, 1, 3.0)]


def test_column_roles(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3, None)], "id long, Name string, Close_Price double, Volume int, update_time timestamp")
    assert V.columns_named(df, "price", "close", "value") == ["Close_Price"]
    got = [tuple(r) for r in V.column_profile(df).collect()]
    assert got == [(1, "id", "numeric", "", 1), (2, "Name", "categorical", "", 1), (3, "Close_Price", "numeric", "price", 1),
                   (4, "Volume", "numeric", "volume", 1), (5, "update_time", "other", "date", 0)]
