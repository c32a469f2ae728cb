"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (chat, decontaminate, fingerprint, html_text, jaccard, language, merkle, oracle, packing, quality, runs,
                          token_files, toxicity, urls)
from tidemark.llm.tables import held_out, table

Builder = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents against every window of every benchmark item."""
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("hit_spans", "item_ids")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text, learned from the labelled training rows."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("evidence")


def op3_chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls and results that all conversation turns stand for, linked, ordered, validated, serialised."""
    return chat.link_conversations(table(spark, sf_dir, "conversations"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and link-graph verdict of every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and divergence verdicts of every whole text."""
    return quality.quality(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written as range-coded block files and read back."""
    import public_tokenizers

    return token_files.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity of 0.9 or more, all documents."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the training rows."""
    return language.identify(table(spark, sf_dir, "documents")).drop("languages")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets and batches of all documents by their token ids."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_lengths(table(spark, sf_dir, "documents"), path))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and the likeness to both neighbours."""
    return fingerprint.report(fingerprint.fingerprint_neighbours(table(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole document, after the tails of every tenth were made periodic."""
    return runs.report(runs.periodic_runs(table(spark, sf_dir, "documents"), runs.planted_tail, texts=False))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and refolded root of every document; every fifth text is tampered with."""
    return merkle.manifest(table(spark, sf_dir, "documents"), held_out(F.col("doc_id")))


QUERIES: dict[str, Builder] = {fn.__name__: fn for fn in (
    op1_decontamination, op2_toxicity, op3_chat_tool_calls, op4_url_filters, op5_quality_rules, op6_token_files,
    op7_html_extraction, op8_ngram_jaccard_join, op9_language_id, op10_packing,
    op11_document_fingerprints, op12_periodic_runs, op13_merkle_manifest)}

ORACLE: dict[str, str] = {
    "op1_decontamination": oracle.DECONTAMINATION,
    "op5_quality_rules": oracle.QUALITY,
    "op8_ngram_jaccard_join": oracle.JACCARD,
    "op13_merkle_manifest": oracle.MERKLE,
}
