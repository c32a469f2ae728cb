"""Regression models on MLlib (ML1-ML5, TOP1, NUM7, AGG8, XAI1, XAI4).

Each fit returns a small result object with the fitted MLlib model, the coefficient table (a driver-
sized DataFrame: one row per feature) and a ``transform`` that appends ``<name>_prediction`` and the
residual to the rows (J1: no join on timestamps, the prediction is a column of the same rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.features import assemble, fill_zero, hash_split


@dataclass
class FittedRegression:
    name: str
    features: list[str]
    model: LinearRegressionModel
    target: str
    expansion: PolynomialExpansion | None = None

    def _vectors(self, df: DataFrame) -> DataFrame:
        x = assemble(fill_zero(df, self.features), self.features, "_x")
        if self.expansion is not None:
            x = self.expansion.transform(x).drop("_x").withColumnRenamed("_px", "_x")
        return x

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``<name>_prediction`` and ``<name>_residual`` (NUM7)."""
        p = self.model.setFeaturesCol("_x").setPredictionCol(f"{self.name}_prediction").transform(self._vectors(df))
        p = p.drop("_x")
        if self.target in df.columns:
            p = p.withColumn(f"{self.name}_residual", F.col(self.target) - F.col(f"{self.name}_prediction"))
        return p

    def coefficients(self, spark) -> DataFrame:
        """TOP1 input: feature, coefficient, |coefficient| (ordered by magnitude)."""
        names = self.term_names()
        rows = [(n, float(c), abs(float(c))) for n, c in zip(names, self.model.coefficients.toArray())]
        rows.append(("(intercept)", float(self.model.intercept), abs(float(self.model.intercept))))
        df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
        return df.orderBy(F.col("abs_coefficient").desc(), "feature")

    def term_names(self) -> list[str]:
        if self.expansion is None:
            return list(self.features)
        return polynomial_terms(self.features, self.expansion.getDegree())


def polynomial_terms(features: Sequence[str], degree: int) -> list[str]:
    """Names of the PolynomialExpansion outputs, in MLlib's order (ML4b)."""
    terms: list[tuple[int, ...]] = []

    def expand(n: int, d: int) -> list[tuple[int, ...]]:
        # MLlib enumerates monomials recursively over the last feature first
        if n == 0:
            return [()]
        out = []
        for k in range(d + 1):
            for rest in expand(n - 1, d - k):
                out.append(rest + (k,))
        return out

    for e in expand(len(features), degree):
        if sum(e) == 0:
            continue
        terms.append(e)
    # order: MLlib's expansion iterates degrees of the last variable slowest; sort to match it
    terms.sort(key=lambda e: tuple(reversed(e)))
    names = []
    for e in terms:
        parts = []
        for f, k in zip(features, e):
            if k == 1:
                parts.append(f)
            elif k > 1:
                parts.append(f"{f}^{k}")
        names.append(" ".join(parts))
    return names


def _fit(df: DataFrame, name: str, features: Sequence[str], target: str, reg: float, l1: float,
         standardization: bool, use_split: bool, expansion: PolynomialExpansion | None = None,
         solver: str = "auto") -> FittedRegression:
    feats = list(features)
    tmp = FittedRegression(name, feats, None, target, expansion)  # type: ignore[arg-type]
    x = tmp._vectors(df).withColumn("_y", F.coalesce(F.col(target).cast("double"), F.lit(0.0)))
    if use_split:
        x = hash_split(x).where(F.col("is_train"))
    lr = LinearRegression(featuresCol="_x", labelCol="_y", regParam=reg, elasticNetParam=l1,
                          standardization=standardization, solver=solver, maxIter=200, tol=1e-9)
    tmp.model = lr.fit(x)
    return tmp


def fit_linear(df: DataFrame, features: Sequence[str], target: str = "weighted_stress_score",
               use_split: bool = True) -> FittedRegression:
    """ML1: ordinary least squares (normal equations)."""
    return _fit(df, "linear_regression", features, target, 0.0, 0.0, False, use_split, solver="normal")


def fit_ridge(df: DataFrame, features: Sequence[str], target: str = "weighted_stress_score", alpha: float = 1.0,
              use_split: bool = True) -> FittedRegression:
    """ML2: L2 penalty ``alpha * ||w||^2`` on the sum of squares.  MLlib's objective is
    ``1/(2n) SSE + regParam/2 ||w||^2`` on a label scaled by its population std, hence
    ``regParam = alpha * std_pop(y) / n`` (n = training rows)."""
    y = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    base = hash_split(df).where(F.col("is_train")) if use_split else df
    n, sd = base.agg(F.count(F.lit(1)), F.stddev_pop(y)).first()
    reg = alpha * (sd or 0.0) / max(n, 1)
    return _fit(df, "ridge_regression", features, target, reg, 0.0, False, use_split, solver="normal")


def fit_lasso(df: DataFrame, features: Sequence[str], target: str = "weighted_stress_score", alpha: float = 0.01,
              use_split: bool = True) -> FittedRegression:
    """ML3: L1 penalty (coordinate-descent objective ``1/(2n) SSE + alpha ||w||_1``)."""
    return _fit(df, "lasso_regression", features, target, alpha, 1.0, False, use_split)


def fit_polynomial(df: DataFrame, features: Sequence[str], target: str = "weighted_stress_score",
                   degree: int = 2, max_features: int | None = None, use_split: bool = True) -> FittedRegression:
    """ML4: the features expanded to ``degree`` (no bias term), then OLS.  ``max_features`` (default: all)
    keeps those most correlated with the target (AGG11)."""
    from tidemark.operators.correlation import target_correlations

    feats = list(features)
    if max_features is not None and len(feats) > max_features:
        top = target_correlations(fill_zero(df, feats + [target]), feats, target, max_features).collect()
        feats = [r["feature"] for r in top]  # at most max_features names
    exp = PolynomialExpansion(degree=degree, inputCol="_x", outputCol="_px")
    return _fit(df, "polynomial_regression", feats, target, 0.0, 0.0, False, use_split, expansion=exp,
                solver="normal")


def evaluate(pred: DataFrame, target: str, prediction_cols: Sequence[str]) -> DataFrame:
    """AGG8: MSE, MAE, R^2 per prediction column over pairwise-complete rows (D24): one aggregate for all
    models.  The total sum of squares is n times the population variance, which does not cancel."""
    aggs = []
    for i, c in enumerate(prediction_cols):
        ok = F.col(target).isNotNull() & F.col(c).isNotNull()
        y, p = F.when(ok, F.col(target)), F.when(ok, F.col(c))
        aggs += [F.avg(F.pow(y - p, 2)).alias(f"mse{i}"), F.avg(F.abs(y - p)).alias(f"mae{i}"),
                 F.var_pop(y).alias(f"var{i}"), F.count(y).cast("long").alias(f"n{i}")]
    rows = [F.struct(F.lit(c.replace("_prediction", "")).alias("model"), F.col(f"mse{i}").alias("mse"),
                     F.col(f"mae{i}").alias("mae"), (F.lit(1.0) - F.try_divide(f"mse{i}", f"var{i}")).alias("r2"),
                     F.col(f"n{i}").alias("n")) for i, c in enumerate(prediction_cols)]
    return pred.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def linear_attributions(df: DataFrame, fit: FittedRegression, top: int = 10) -> DataFrame:
    """XAI1 + XAI4: phi_j = coef_j * (x_j - mean_j); mean |phi| per feature, top ``top`` with share %."""
    feats = fit.features
    coefs = fit.model.coefficients.toArray()
    x = fill_zero(df, feats)
    means = x.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)])
    x = x.crossJoin(F.broadcast(means))  # one row
    agg = x.agg(*[F.avg(F.abs(F.lit(float(coefs[i])) * (F.col(c) - F.col(f"m{i}")))).alias(f"a{i}")
                  for i, c in enumerate(feats)])
    stack = ", ".join(f"'{c}', a{i}" for i, c in enumerate(feats))
    long = agg.selectExpr(f"stack({len(feats)}, {stack}) as (feature, mean_abs_attribution)")
    top_rows = long.orderBy(F.col("mean_abs_attribution").desc(), "feature").limit(top)
    from pyspark.sql import Window

    tot = F.sum("mean_abs_attribution").over(Window.partitionBy())  # at most `top` rows
    return top_rows.withColumn("share_pct", F.try_divide(F.col("mean_abs_attribution") * 100, tot))
