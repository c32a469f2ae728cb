"""Time-lagged regression (W9, ML5, J4, AGG23).

Lags and rolling statistics run over the global (timestamp, row_id) order through the blocked window, never over
one partition.  Rows without a full set of lags get the mean prediction, so scoring keeps the number of rows.
Fitting returns a status instead of raising.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.features import numeric_features
from tidemark.models.regression import FittedRegression, fit_linear
from tidemark.operators.ordering import blocked_window, global_index

MIN_ROWS = 10
#: Columns that hold results of models, by name.
PREDICTION_MARKS = ("prediction", "regime", "anomaly", "similarity", "forecast", "prob_")


def prediction_columns(columns: Sequence[str]) -> list[str]:
    """PRJ13: the columns that hold results of models."""
    return [c for c in columns if any(mark in c for mark in PREDICTION_MARKS)]


def lag_columns(df: DataFrame) -> list[str]:
    """Numeric columns to lag: no results of models, no identifiers, not the next row's target (D7)."""
    results = set(prediction_columns(df.columns))
    return [c for c in numeric_features(df) if c not in results]


def variance_ranking(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG23: (feature, variance, rank), the largest variance first (ties: by name, nulls last), from one aggregate."""
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance")) for i, c in enumerate(columns)])
    ordered = F.array_sort(pairs, lambda a, b: F.when(
        (a["variance"] > b["variance"]) | (a["variance"].isNotNull() & b["variance"].isNull()), -1).when(
        (a["variance"] < b["variance"]) | (a["variance"].isNull() & b["variance"].isNotNull()), 1).when(
        a["feature"] < b["feature"], -1).otherwise(1))
    return row.select(F.posexplode(ordered).alias("at", "r")).select("r.feature", "r.variance", (F.col("at") + 1).alias("rank"))


def lag_sizes(n: int, lag_window: int) -> tuple[int, int]:
    """(lags, rolling window) for n rows."""
    return max(1, min(lag_window, n // 4)), max(2, min(3, n // 3))


def lagged_features(df: DataFrame, columns: Sequence[str], lags: int, window: int, extra: Sequence[str] = ()) -> DataFrame:
    """W9: per row ``<c>_current``, ``<c>_lag_1`` to ``<c>_lag_<lags>``, and mean and standard deviation (0 for a single
    value) of the ``window`` rows before it (D7); rows with a gap are left out.  ``extra`` columns are kept as they are."""
    index = global_index(df.select("row_id", "timestamp", *dict.fromkeys([*columns, *extra])), ["timestamp", "row_id"], "_idx")

    def build(w):
        before = w.rowsBetween(-window, -1)
        out = []
        for c in columns:
            out += [F.lag(c, k).over(w).alias(f"{c}_lag_{k}") for k in range(1, lags + 1)]
            out += [F.avg(c).over(before).alias(f"{c}_roll_mean"),
                    F.when(F.count(c).over(before) == 1, 0.0).otherwise(F.stddev_samp(c).over(before)).alias(f"{c}_roll_std")]
        return out

    rows = blocked_window(index, "_idx", build, preceding=max(lags, window))
    names = [f"{c}_{s}" for c in columns for s in (*[f"lag_{k}" for k in range(1, lags + 1)], "roll_mean", "roll_std")]
    full = rows.na.drop(subset=[*columns, *names])
    return full.select("row_id", *[F.col(c).alias(f"{c}_current") for c in columns], *names, *extra)


@dataclass
class LaggedModel:
    """``status`` is success or skipped (with a ``reason``); a skipped model predicts nothing."""

    status: str
    reason: str | None = None
    rows: int = 0
    columns: list[str] = field(default_factory=list)
    target: str = "weighted_stress_score"
    lags: int = 0
    window: int = 0
    features: list[str] = field(default_factory=list)
    stats: dict = field(default_factory=dict)
    fit: FittedRegression | None = None

    def status_table(self, spark) -> DataFrame:
        return spark.createDataFrame([(self.status, self.reason, self.rows, len(self.features), self.lags, self.window)],
                                     "status string, reason string, samples long, features int, lags int, window int")


def _scaled(rows: DataFrame, features: Sequence[str], stats: dict) -> DataFrame:
    """Features less their mean, by their population deviation (0 where that is 0)."""
    cols = [((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]) if stats[c][1] > 0 else F.lit(0.0)).alias(c) for c in features]
    return rows.select(*[c for c in rows.columns if c not in set(features)], *cols)


def _design(df: DataFrame, model: LaggedModel) -> DataFrame:
    """Lagged rows; the target counts by its lags only, never by its current value."""
    both = [*model.columns, model.target]
    rows = lagged_features(df, both, model.lags, model.window)
    return rows.withColumnRenamed(f"{model.target}_current", model.target)


def fit_lagged(df: DataFrame, target: str = "weighted_stress_score", lag_window: int = 3, min_rows: int = MIN_ROWS) -> LaggedModel:
    """OLS of the target on the scaled lagged features of all numeric columns and of the target itself."""
    n = df.count()
    if n < min_rows:
        return LaggedModel("skipped", "insufficient_data", n)
    if target not in df.columns:
        return LaggedModel("skipped", "no_target_column", n)
    lags, window = lag_sizes(n, lag_window)
    model = LaggedModel("success", None, n, [c for c in lag_columns(df) if c != target], target, lags, window)
    rows = _design(df, model)
    model.features = [c for c in rows.columns if c not in ("row_id", target)]
    moments = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}{i}") for i, c in enumerate(model.features)
                                                       for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    model.rows = moments["n"]
    if model.rows < min_rows:
        return LaggedModel("skipped", "insufficient_lagged_data", model.rows)
    model.stats = {c: (moments[f"m{i}"], moments[f"s{i}"]) for i, c in enumerate(model.features)}
    model.fit = fit_linear(_scaled(rows, model.features, model.stats), model.features, target, use_split=False)
    return model


def predict_lagged(df: DataFrame, model: LaggedModel, out: str = "time_lagged_prediction") -> DataFrame:
    """All rows with the prediction, and ``<out>_filled`` where it is the mean prediction (J4).  A skipped model leaves
    the rows without prediction."""
    if model.fit is None:
        return df.withColumns({out: F.lit(None).cast("double"), f"{out}_filled": F.lit(True)})
    rows = _scaled(_design(df, model), model.features, model.stats)
    scored = model.fit.transform(rows).select("row_id", F.col(f"{model.fit.name}_prediction").alias(out))
    mean = scored.agg(F.avg(out).alias("_mean"))
    joined = df.join(scored, "row_id", "left").crossJoin(F.broadcast(mean))  # one row
    return joined.withColumn(f"{out}_filled", F.col(out).isNull()).withColumn(out, F.coalesce(out, "_mean")).drop("_mean")
