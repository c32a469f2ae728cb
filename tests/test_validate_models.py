"""Validation (F3), dedup, models (properties) and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.clean import dedup_keep_first
from tidemark.operators.validate import validate, violation_counts

T0 = "2024-01-01T00:00:00"
ROWS = [
    (1, None, T0, 10.0), (2, "", T0, 10.0), (3, "Short one", T0, -1.0),
    (4, "Markets fall  sharply...!? today", T0, 10.0), (5, "x" * 1001, T0, None),
    (6, "A perfectly valid headline", None, 10.0), (7, "A perfectly valid headline", "not a date", 10.0),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "row_id long, headline string, timestamp string, price double")


def test_market_and_news_validation(spark):
    df = frame(spark)
    mv, mi = validate(df, kind="market")
    assert sorted(r["row_id"] for r in mv.collect()) == [3, 4, 5]
    nv, ni = validate(df, kind="news")
    assert sorted(r["row_id"] for r in nv.collect()) == [4]
    assert mv.count() + mi.count() == df.count() and nv.count() + ni.count() == df.count()
    c = violation_counts(df, kind="market").first()
    assert c["short_headline"] == 2 and c["invalid_price"] == 2 and c["invalid_date"] == 2


def test_dedup_keeps_lowest_row_id(spark):
    df = spark.createDataFrame([(5, "a", 1), (2, "a", 1), (9, "b", 1), (3, "a", 2)], "row_id long, h string, t int")
    got = sorted(r["row_id"] for r in dedup_keep_first(df, ["h", "t"]).collect())
    assert got == [2, 3, 9]
    assert sorted(r["row_id"] for r in dedup_keep_first(dedup_keep_first(df, ["h", "t"]), ["h", "t"]).collect()) == got


def _gold_like(spark, n=400):
    import random

    rnd = random.Random(7)
    rows = []
    for i in range(n):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), a, b, 2 * a - b + rnd.gauss(0, 0.1)))
    return spark.createDataFrame(rows, "row_id long, timestamp timestamp, f1 double, f2 double, "
                                       "weighted_stress_score double")


def test_ridge_matches_closed_form(spark):
    import numpy as np

    from tidemark.models.regression import fit_ridge

    g = _gold_like(spark)
    fit = fit_ridge(g, ["f1", "f2"], alpha=1.0, use_split=False)
    pdf = g.toPandas()
    X = pdf[["f1", "f2"]].to_numpy()
    y = pdf["weighted_stress_score"].to_numpy()
    Xc, yc = X - X.mean(axis=0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(2), Xc.T @ yc)
    assert np.allclose(fit.model.coefficients.toArray(), w, atol=1e-6)


def test_classifier_probabilities_sum_to_one(spark):
    from tidemark.models.classifier import fit_classifier, predict_regimes

    g = _gold_like(spark)
    p = predict_regimes(g, fit_classifier(g, ["f1", "f2"], trees=10))
    s = p.select((F.col("prob_low") + F.col("prob_medium") + F.col("prob_high")).alias("s"))
    assert s.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_isolation_forest_rate(spark):
    from tidemark.models.iforest import fit_isolation_forest

    g = _gold_like(spark, 600)
    m = fit_isolation_forest(g, ["f1", "f2"], trees=30, contamination=0.1)
    out = m.transform(g)
    rate = out.agg(F.avg("is_anomaly")).first()[0]
    assert out.count() == 600 and 0.07 <= rate <= 0.13
    assert out.where(F.size("top_anomaly_features") != 2).count() == 0


def test_entry_runs_and_plan_has_no_single_partition_row_window(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    from tidemark.plans.pipeline import gold_features
    from tests.conftest import SF

    plan = gold_features(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the row-grain windows (7-row volatility, next-row target) run per block, never over one partition;
    # the only SinglePartition exchanges left carry one-row aggregates, per-partition counts or the daily grain
    row_windows = [ln for ln in plan.splitlines() if "Window [" in ln and "sentiment_polarity" in ln]
    assert row_windows and all("_blk" in ln for ln in row_windows)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_filters_are_pushed_to_the_scan(spark):
    from tidemark.sources.tables import read_table
    from tests.conftest import SF

    o = read_table(spark, SF, "orders", ["o_orderdate", "o_totalprice"]).where(
        F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    plan = o._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan \
        or "ReadSchema: struct<o_orderdate:timestamp_ntz,o_totalprice:double>" in plan


def test_neural_regressor_learns(spark):
    from tidemark.models.neural import fit_neural

    g = _gold_like(spark, 300)
    m = fit_neural(g, ["f1", "f2"], epochs=60, lr=0.01, dropout=0.0)
    first, last = m.history[0][1], min(h[1] for h in m.history)
    assert last < first * 0.5
    out = m.transform(g)
    assert out.count() == 300 and out.where(F.col("neural_network_prediction").isNull()).count() == 0


def test_lagged_regression_uses_every_numeric_column(spark):
    import statistics

    from tidemark.plans.queries_models import _all_lagged

    for n, lags, window in ((40, 7, 3), (13, 3, 3), (7, 1, 2)):
        a, b = [float(i * i % 11) for i in range(n)], [i * 3 % 7 for i in range(n)]
        a[n // 2] = None
        rows = [(100 + i, f"2024-01-01 00:{i:02d}:00", a[i], b[i], "x", 1.0, 2.0) for i in range(n)]
        df = spark.createDataFrame(rows, "row_id long, timestamp string, a double, b int, s string, "
                                         "weighted_stress_score double, target_stress_next double")
        got = {r.row_id: r.asDict() for r in _all_lagged(df, 7).collect()}
        expected = {}
        for i in range(lags, n):
            row = {"row_id": 100 + i}
            for c, v in (("a", a), ("b", b)):
                frame = [x for x in v[max(0, i - window):i] if x is not None]
                row |= {f"{c}_current": v[i]} | {f"{c}_lag_{k}": v[i - k] for k in range(1, lags + 1)}
                row |= {f"{c}_roll_mean": round(statistics.mean(frame), 6) if frame else None,
                        f"{c}_roll_std": round(statistics.stdev(frame), 6) if len(frame) > 1 else 0.0}
            if None not in row.values():
                expected[100 + i] = row
        assert got.keys() == expected.keys() and expected
        for i, row in expected.items():
            assert got[i].keys() == row.keys()
            assert all(abs(got[i][c] - v) < 2e-6 for c, v in row.items())
