"""Corpus preparation pipeline: each stage works on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of ``documents``.

Rows without doc_id are judged like all others.  Of a group of near duplicates exactly one row stays: the one
with the smallest id, a row without id only if none of the group has one; of rows that repeat this id, one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, packing, quality, toxicity
from tidemark.llm.tables import BROADCAST_ROWS, discard, few_files, shared_folder, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents predicted toxic go; the model learns from the labels of the kept table."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the base rules or the divergence rules reject go."""
    return quality.drop_low_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on five-word shingles, similarity 0.8 or more: one document of each group stays."""
    key = f"row_{uuid.uuid4().hex}"  # a row is known by its number, written once: ids may be null or repeat
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()))
    groups = jaccard.jaccard_components(rows.select(F.col(key).alias("doc_id"), "text"), k=5, percent=80)
    n_rows = rows.count()
    groups = stored(few_files(groups.select(F.col("doc_id").alias(key), "component_id"), n_rows))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("first")
    kept = groups.join(rows.select(key, "doc_id"), key).groupBy("component_id").agg(first).select(f"first.{key}")
    gone = stored(few_files(groups.select(key).join(kept, key, "left_anti"), n_rows))
    discard(groups)
    few = gone.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(gone) if few else gone, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that the contamination rule rejects go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: bucket, padded length and batch of every document left, by its token ids."""
    import public_tokenizers

    return packing.pack(packing.token_lengths(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages learn a model and join by similarity, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
