"""Bronze runs -> silver runs as a file stream.

``foreachBatch`` may run a batch again after its write (a driver lost before the batch was recorded), so a batch never appends: it
overwrites its own ``batch_id`` folder, and a replay replaces what the first try wrote.  A file stream may spread one run over
several batches; ``read_silver`` therefore removes duplicates over the batches of a run as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.clean import clean_articles, dedup_keep_first
from tidemark.operators.validate import validate


SILVER_KEYS = ("run_id", "headline", "timestamp")


def write_batch(batch: DataFrame, batch_id: int, silver_dir: str, kind: str = "market") -> None:
    """Validate, clean and de-duplicate one batch of bronze rows and put it in place of its ``batch_id`` folder."""
    valid, _ = validate(batch, kind=kind)
    silver = clean_articles(valid, kind=kind, dedup_keys=SILVER_KEYS)
    silver.write.mode("overwrite").partitionBy("run_id").parquet(f"{silver_dir.rstrip('/')}/batch_id={batch_id}")


def read_silver(spark: SparkSession, silver_dir: str) -> DataFrame:
    """All silver rows, the first of equal ones in a run (by row_id, then batch)."""
    rows = spark.read.parquet(silver_dir)
    rows = rows.withColumn("_first", F.struct("row_id", "batch_id"))
    return dedup_keep_first(rows, SILVER_KEYS, "_first").drop("_first", "batch_id")


def incremental_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, checkpoint: str,
                       schema: T.StructType, kind: str = "market", once: bool = True) -> StreamingQuery:
    """Each micro-batch of bronze rows (``run_id`` partitions) goes through ``write_batch``; ``read_silver`` reads the layer.
    ``once`` processes what is there and stops (``availableNow``)."""
    stream = spark.readStream.schema(schema).parquet(bronze_dir)

    writer = stream.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, silver_dir, kind))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
