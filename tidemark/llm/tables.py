"""Small table helpers of the subpackage."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if a count shows at most this many rows of a few longs.
BROADCAST_ROWS = 500_000
#: Rows of a few longs that make one file of a stored table.
FILE_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; where it is unset (tests on one
    machine) a folder in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads come from files that every executor shares."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder as Parquet and read back: like ``cut``, in much less space."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def few_files(df: DataFrame, rows: int, each: int = FILE_ROWS) -> DataFrame:
    """``df``, of at most ``rows`` rows, in no more partitions than ``each`` rows a partition need, but one per core.

    A task that writes costs the same however few rows it has; where a local disk is written, it even starts processes."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables written by ``stored`` that no later step reads."""
    for df in tables:
        remove(df.sparkSession, df.stored_path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id):
    """True where crc32 of the id as text, modulo 5, is 0: rows that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffles of plans that are done: it does so once the driver has collected them as garbage."""
    gc.collect()
    spark._jvm.System.gc()
