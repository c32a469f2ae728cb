"""Ordering helpers (blocked window = global window, partition invariance) and risk analytics (F8)."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import risk as R
from tidemark.operators.ordering import blocked_window, carried_lag, global_index
from tidemark.sources.views import events


@pytest.mark.parametrize("parts,block", [(1, 7), (4, 100), (16, 1013)])
def test_blocked_window_equals_global(spark, parts, block):
    from tests.conftest import SF

    ev = events(spark, SF).select(F.col("event_id").alias("row_id"), F.col("ts").alias("timestamp"), "value")
    idx = global_index(ev, ["timestamp", "row_id"], "idx", rows_per_bucket=-(-1000 // parts))

    def build(w):
        return [F.lead("value", 1).over(w).alias("nxt"),
                F.stddev_samp("value").over(w.rowsBetween(-6, 0)).alias("sd7")]

    got = blocked_window(idx, "idx", build, preceding=6, following=1, block=block)
    w = Window.orderBy("timestamp", "row_id")
    want = ev.select("row_id", F.row_number().over(w).alias("idx_w"), F.lead("value", 1).over(w).alias("nxt_w"),
                     F.stddev_samp("value").over(w.rowsBetween(-6, 0)).alias("sd7_w"))
    j = got.join(want, "row_id")
    bad = j.where((F.col("idx") != F.col("idx_w")) | ~F.col("nxt").eqNullSafe(F.col("nxt_w"))
                  | (F.abs(F.coalesce(F.col("sd7"), F.lit(0.0)) - F.coalesce(F.col("sd7_w"), F.lit(0.0))) > 1e-9))
    assert j.count() == ev.count() and bad.count() == 0


@pytest.mark.parametrize("block_size", [3, 64, 1 << 16])
def test_carried_lag_equals_lag(spark, block_size):
    from tests.conftest import SF

    ev = events(spark, SF)
    got = carried_lag(ev, "value", ["event_type"], "event_id", "p", block_size=block_size)
    want = ev.select("event_id", F.lag("value").over(Window.partitionBy("event_type").orderBy("event_id")).alias("q"))
    j = got.join(want, "event_id")
    assert j.where(~F.col("p").eqNullSafe(F.col("q"))).count() == 0 and j.count() == ev.count()


def series(spark, prices, name="x"):
    import datetime as dt

    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), name, float(p)) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "timestamp date, instrument string, price double")


def test_crash_and_recover(spark):
    s = series(spark, [100, 120, 60, 90])
    rets = [r["ret"] for r in R.returns(s).orderBy("timestamp").collect()]
    assert rets[0] is None and abs(rets[1] - 0.2) < 1e-12 and abs(rets[2] + 0.5) < 1e-12 and abs(rets[3] - 0.5) < 1e-12
    dd = [r["drawdown"] for r in R.drawdown(R.returns(s)).orderBy("timestamp").collect()]
    assert [round(x, 12) for x in dd] == [0.0, -0.5, -0.25]
    m = R.risk_metrics(s).first()
    assert abs(m["max_drawdown"] + 0.5) < 1e-12


def test_constant_series_sharpe_zero(spark):
    m = R.risk_metrics(series(spark, [5, 5, 5, 5, 5])).first()
    assert m["sharpe_ratio"] == 0.0 and m["annual_volatility"] == 0.0


def test_zero_price_gives_null_return(spark):
    rets = [r["ret"] for r in R.returns(series(spark, [0, 10, 11])).orderBy("timestamp").collect()]
    assert rets[1] is None


def test_sample_skew_kurtosis(spark):
    import pandas as pd

    prices = [100, 103, 99, 108, 104, 111, 107, 100, 115, 112]
    m = R.risk_metrics(series(spark, prices)).first()
    r = pd.Series(prices, dtype=float).pct_change().dropna()
    assert abs(m["skewness"] - r.skew()) < 1e-9 and abs(m["kurtosis"] - r.kurt()) < 1e-9
    assert abs(m["var_95"] - r.quantile(0.05)) < 1e-12


def test_rolling_window_needs_full_frame(spark):
    for n, expect in ((20, 0), (21, 1), (22, 2)):
        rr = R.rolling_risk(R.returns(series(spark, [100 + (i % 3) for i in range(n)])))
        assert rr.where(F.col("volatility").isNotNull()).count() == expect


def test_normal_quantile(spark):
    df = spark.createDataFrame([(0.01,), (0.5,), (0.975,)], "p double")
    got = [r["z"] for r in df.select(R.normal_quantile(F.col("p")).alias("z")).collect()]
    assert abs(got[0] + 2.3263478740) < 1e-6 and abs(got[1]) < 1e-9 and abs(got[2] - 1.959963985) < 1e-6
    assert not any(math.isnan(x) for x in got)


@pytest.mark.parametrize("partitions", [4, 8, 64])
def test_global_index_on_many_wide_rows(spark, partitions):
    """400,000 wide rows, hot and null timestamps: equal to one global row_number, also when joined."""
    n = 400_000
    rows = spark.range(n).repartition(partitions).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 1000 == 1, None)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("timestamp"),
        F.repeat(F.lit("payload "), 20).alias("payload"))
    idx = global_index(rows, ["timestamp", "row_id"], rows_per_bucket=5000)
    want = rows.select("row_id", F.row_number().over(Window.orderBy("timestamp", "row_id")).alias("w"))
    got = idx.join(want, "row_id").agg(
        F.count_if(F.col("idx") != F.col("w")).alias("bad"), F.count_distinct("idx").alias("n"), F.max("idx").alias("top")).first()
    assert (got["bad"], got["n"], got["top"]) == (0, n, n)


def test_exact_quantiles(spark):
    from tidemark.operators.quantiles import exact_quantiles

    df = spark.range(5001).select(F.col("id").alias("row_id"), (F.pmod(F.xxhash64("id"), F.lit(97)) / 7.0).alias("a"),
                                  F.when(F.col("id") % 2 == 0, -F.col("id")).alias("b"), F.lit(None).cast("double").alias("c"))
    got = exact_quantiles(df, ["a", "b", "c"], [0.0, 0.1, 0.33, 0.5, 1.0])
    for c in ("a", "b"):
        want = df.agg(F.percentile(c, F.array(*[F.lit(p) for p in (0.0, 0.1, 0.33, 0.5, 1.0)]))).first()[0]
        assert got[c] == pytest.approx(want, abs=1e-12)
    assert got["c"] == [None] * 5


@pytest.mark.parametrize("n", [10, 256, 10**5, 10**9, 10**12])
def test_forest_hash_bound_expects_enough_rows_at_any_size(n):
    from tidemark.models.iforest import hash_bound

    expected = n * (hash_bound(256, n) + 2**63 + 1) / 2**64
    assert expected >= min(n, 400) * 0.999 and (n < 500 or expected <= 460)
