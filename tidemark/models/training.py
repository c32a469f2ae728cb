"""Train-all (ML0e): every model is fitted and applied on one written gold table; a model that fails is reported and skipped.

``train_all`` takes named trainers (gold rows -> rows with ``row_id`` and new columns).  The columns kept of each are picked by
name (PRJ13), written to the shared checkpoint folder, which is where a lazily planned failure shows, and joined to all
rows by ``row_id``; a clashing column is named ``<model>_<column>``.  Rows without a prediction have NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tidemark.models import classifier as CL
from tidemark.models import iforest as IF
from tidemark.models import lagged as LG
from tidemark.models import neural as NN
from tidemark.models import regression as RG
from tidemark.models.features import numeric_features
from tidemark.session import stored

Trainer = Callable[[DataFrame], DataFrame]
STATUS = "model string, status string, predictions long, error string"


def default_trainers(target: str = "weighted_stress_score") -> dict[str, Trainer]:
    """The models of the library with their usual settings."""
    def forest(g: DataFrame) -> DataFrame:
        return IF.fit_isolation_forest(g, numeric_features(g)).transform(g)

    def boosted(g: DataFrame) -> DataFrame:
        rows = stored(CL.regime_split(g))
        return CL.predict_regimes(rows, CL.fit_classifier(rows, numeric_features(g)))

    return {
        "linear_regression": lambda g: RG.fit_linear(g, numeric_features(g), target).transform(g),
        "ridge_regression": lambda g: RG.fit_ridge(g, numeric_features(g), target).transform(g),
        "lasso_regression": lambda g: RG.fit_lasso(g, numeric_features(g), target).transform(g),
        "polynomial_regression": lambda g: RG.fit_polynomial(g, numeric_features(g), target).transform(g),
        "time_lagged_regression": lambda g: LG.predict_lagged(g, LG.fit_lagged(g, target)),
        "isolation_forest": forest,
        "neural_network": lambda g: NN.fit_neural(g, numeric_features(g), target).transform(g),
        "regime_classifier": boosted,
    }


def train_all(gold: DataFrame, trainers: Mapping[str, Trainer]) -> tuple[DataFrame, DataFrame]:
    """(gold rows with all predictions, status table (model, status, predictions, error)); status is success, no_predictions or
    failed.  ``gold`` should be a written table: every model reads it."""
    own, out, statuses = set(gold.columns), gold, []
    for name, trainer in trainers.items():
        try:
            made = trainer(gold)
            picked = LG.prediction_columns([c for c in made.columns if c not in own])
            if not picked:
                statuses.append((name, "no_predictions", 0, None))
                continue
            rows = stored(made.select("row_id", *picked))
            statuses.append((name, "success", rows.count(), None))
        except Exception as failure:  # one model's failure must not stop the others; it is reported in the table
            statuses.append((name, "failed", 0, f"{type(failure).__name__}: {str(failure).splitlines()[0] if str(failure) else ''}"))
            continue
        for c in picked:
            if c in out.columns:
                rows = rows.withColumnRenamed(c, f"{name}_{c}")
        out = out.join(rows, "row_id", "left")
    return out, gold.sparkSession.createDataFrame(statuses, STATUS)
