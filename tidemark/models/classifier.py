"""Risk-regime classifier (ML7, ML7b, ML0b, AGG25).

Labels come from the 33 % / 67 % quantiles of the stress score (low below, high above, medium between).  The
model is the softmax boosting of ``boosting.py`` (or an MLlib forest), fitted on a stratified split;
``prob_<class>`` is the probability of that class (D6: classes are indexed low=0, medium=1, high=2, never
alphabetically).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.boosting import BoostedModel, fit_boosted
from tidemark.models.features import assemble, fill_zero, stratified_split
from tidemark.operators.ordering import global_index
from tidemark.operators.quantiles import exact_quantiles

CLASSES = ("low", "medium", "high")


def regime_labels(df: DataFrame, score: str = "weighted_stress_score", q_low: float = 0.33,
                  q_high: float = 0.67) -> DataFrame:
    """ML7b: ``label`` (0/1/2) and ``regime_label`` from the score quantiles (exact, over the row index).  Without a score
    column, or without any value in it, by position in (timestamp, row_id) order: the first third (rounded down) is low, the last
    third (rounded up) high; fewer than 3 rows are all medium."""
    lo, hi = exact_quantiles(df, [score], (q_low, q_high))[score] if score in df.columns else (None, None)
    if lo is None:
        n = df.count()
        keys = ["timestamp", "row_id"]
        idx = F.lit(1)
        if n >= 3:
            df = df.join(global_index(df.select(*keys), keys, "_idx").select("row_id", "_idx"), "row_id")
            idx = F.when(F.col("_idx") > n - (n + 2) // 3, 2).when(F.col("_idx") <= n // 3, 0).otherwise(1)
    else:
        s = F.col(score)
        idx = F.when(s < F.lit(lo), 0).when(s > F.lit(hi), 2).otherwise(1)
    return df.withColumn("label", idx.cast("double")).withColumn(
        "regime_label", F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.col("label").cast("int") + 1)).drop("_idx")


#: Fewer rows than this are all used for training.
MIN_SPLIT_ROWS = 10


def regime_split(df: DataFrame, score: str = "weighted_stress_score") -> DataFrame:
    """Labelled rows with ``is_train`` (ML0b); under MIN_SPLIT_ROWS rows all are training rows."""
    x = regime_labels(df, score)
    if x.limit(MIN_SPLIT_ROWS).count() < MIN_SPLIT_ROWS:
        return x.withColumn("is_train", F.lit(True))
    return stratified_split(x, "label")


def fit_classifier(df: DataFrame, features: Sequence[str], kind: str = "boosted", trees: int = 100,
                   depth: int = 6, seed: int = 42, use_split: bool = True):
    """Fits on the training split; returns (model or None for a single-class input, features, that class).

    ``df`` may bring ``label`` and ``is_train`` (from ``regime_split``)."""
    x = df if "label" in df.columns else regime_split(df) if use_split else regime_labels(df)
    if use_split and "is_train" in x.columns:
        x = x.where("is_train")
    classes = [r[0] for r in x.select("label").distinct().collect()]  # at most 3 values
    if len(classes) < 2:
        return None, list(features), (classes[0] if classes else 1.0)
    if kind == "boosted":
        return fit_boosted(x, features, "label", len(CLASSES), trees, depth), list(features), None
    x = assemble(fill_zero(x, features), features, "_x")
    return RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed).fit(x), list(features), None


def predict_regimes(df: DataFrame, fitted, prefix: str = "") -> DataFrame:
    """Adds ``risk_regime`` (the likeliest class, the lower of equals) and ``prob_low/medium/high`` (sum 1).  Rows are
    scored by ``row_id``, which must be unique."""
    model, features, constant = fitted
    names = [f"prob_{c}" for c in CLASSES]
    if model is None:
        c = int(constant)
        return df.withColumn(f"{prefix}risk_regime", F.lit(CLASSES[c])).select(
            "*", *[F.lit(1.0 if i == c else 0.0).alias(name) for i, name in enumerate(names)])
    if isinstance(model, BoostedModel):
        p = df.join(model.probabilities(df, names), "row_id")
    else:
        p = model.transform(assemble(fill_zero(df, features), features, "_x"))
        p = p.withColumn("_p", vector_to_array("probability"))
        p = p.select("*", *[F.coalesce(F.get(F.col("_p"), i), F.lit(0.0)).alias(name) for i, name in enumerate(names)])
    best = F.array_position(F.array(*names), F.greatest(*names))
    p = p.withColumn(f"{prefix}risk_regime", F.element_at(F.array(*[F.lit(c) for c in CLASSES]), best.cast("int")))
    return p.drop("_x", "_p", "rawPrediction", "probability", "prediction")


def classification_report(pred: DataFrame, truth: str = "regime_label", predicted: str = "risk_regime") -> DataFrame:
    """AGG25 (multiclass): per class precision, recall, F1, support, plus overall accuracy."""
    counts = pred.agg(
        F.avg((F.col(truth) == F.col(predicted)).cast("double")).alias("accuracy"),
        *[F.count_if(cond).alias(f"{name}_{c}") for c in CLASSES for name, cond in (
            ("tp", (F.col(truth) == c) & (F.col(predicted) == c)), ("fp", (F.col(truth) != c) & (F.col(predicted) == c)),
            ("fn", (F.col(truth) == c) & (F.col(predicted) != c)), ("support", F.col(truth) == c))])
    rows = []
    for c in CLASSES:
        tp, fp, fn = (F.col(f"{k}_{c}") for k in ("tp", "fp", "fn"))
        prec, rec = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
        rows.append(F.struct(F.lit(c).alias("class"), prec.alias("precision"), rec.alias("recall"),
                             F.try_divide(2 * prec * rec, prec + rec).alias("f1"),
                             F.col(f"support_{c}").cast("long").alias("support"), F.col("accuracy")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def binary_report(pred: DataFrame, truth: str, predicted: str) -> DataFrame:
    """AGG25 (binary): precision, recall, F1 of a 0/1 prediction."""
    tp = F.count_if((F.col(truth) == 1) & (F.col(predicted) == 1))
    fp = F.count_if((F.col(truth) == 0) & (F.col(predicted) == 1))
    fn = F.count_if((F.col(truth) == 1) & (F.col(predicted) == 0))
    prec, rec = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return pred.agg(prec.alias("precision"), rec.alias("recall"), F.try_divide(2 * prec * rec, prec + rec).alias("f1"),
                    F.count_if(F.col(predicted) == 1).cast("long").alias("flagged"),
                    F.count(F.lit(1)).cast("long").alias("rows"))
