"""Layer snapshots (SRC1, SRC2, SNK1-SNK3).

A layer (bronze / silver / gold / predictions) is one folder with a Parquet dataset per ``run_id``.  A run is
written first and published after: the manifest ``_published/<layer>`` gets one small file with the run id and
its rows once all of its files are there, and readers take only published runs, so none ever sees half a run.
The number of rows is observed while they are written; an empty run is not published.  Nothing here deletes
data (D19): unreadable or tiny files are skipped by the reader, never removed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_run_id(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_snapshot(df: DataFrame, root: str, layer: str, run_id: str | None = None) -> str | None:
    """SNK1: write one run of ``root/layer`` and publish it; an empty frame publishes nothing and returns None.  Returns
    the run id.  The plan runs once.  What an attempt left behind that was never published is written anew; a published
    run is never changed."""
    rid = run_id or new_run_id()
    runs = published_runs(df.sparkSession, root, layer)
    if runs is not None and not runs.where(F.col("run_id") == rid).isEmpty():
        raise ValueError(f"run {rid} of {layer} is published already")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root}/{layer}/run_id={rid}")
    if not seen.get["rows"]:
        return None
    df.sparkSession.createDataFrame([(seen.get["rows"],)], "rows long").coalesce(1) \
        .write.parquet(f"{root}/_published/{layer}/run_id={rid}")
    return rid


def published_runs(spark: SparkSession, root: str, layer: str) -> DataFrame | None:
    """(run_id, rows) of the published runs, or None if there are none; any other error is raised."""
    try:
        return spark.read.schema("rows long, run_id string").parquet(f"{root}/_published/{layer}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _layer(spark: SparkSession, root: str, layer: str) -> DataFrame | None:
    """The layer's published runs, or None."""
    runs = published_runs(spark, root, layer)
    if runs is None:
        return None
    ids = [r["run_id"] for r in runs.select("run_id").collect()]  # one per run
    return spark.read.option("basePath", f"{root}/{layer}").parquet(*[f"{root}/{layer}/run_id={i}" for i in ids])


def latest_run_id(spark: SparkSession, root: str, layer: str) -> str | None:
    """The newest published run of a layer (reads only the manifest)."""
    runs = published_runs(spark, root, layer)
    return runs.agg(F.max("run_id")).first()[0] if runs is not None else None


def read_latest_snapshot(spark: SparkSession, root: str, layer: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC1: the newest run of a layer; raises when the layer has none."""
    rid = latest_run_id(spark, root, layer)
    if rid is None:
        raise FileNotFoundError(f"no {layer} snapshots under {root}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", f"{root}/{layer}").parquet(f"{root}/{layer}/run_id={rid}")


def read_best_gold(spark: SparkSession, root: str, run_id: str | None = None, min_file_bytes: int = 100) -> DataFrame:
    """SRC2: this run's predictions, else the latest predictions, else the latest features; files
    under ``min_file_bytes`` are ignored (``_metadata.file_size``), never deleted."""
    for layer, rid in (("predictions", run_id), ("predictions", None), ("gold", None)):
        df = _layer(spark, root, layer)
        if df is None:
            continue
        df = df.where(F.col("_metadata.file_size") >= min_file_bytes)
        rid = rid or latest_run_id(spark, root, layer)
        if rid is None:
            continue
        pick = df.where(F.col("run_id") == F.lit(rid))
        if not pick.isEmpty():
            return pick
    raise FileNotFoundError(f"no predictions or features under {root}")


def _flatten_for_text(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def export_csv(df: DataFrame, path: str) -> None:
    """SNK2: CSV with a header (nested columns as JSON text)."""
    _flatten_for_text(df).write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """SNK3: JSON records, one per line."""
    df.write.mode("overwrite").json(path)
