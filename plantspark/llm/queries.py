"""The queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantspark.llm import compression, filter_audit, importance, language_id, line_dedup, lm_scoring, mixing, packing, pieces, simhash, suffix_dedup, token_files, vector_tree
from plantspark.llm.common import read_table
from plantspark.session import new_folder


def op1_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and all pages; a row has either a doc_id or a page_id."""
    none = F.lit(None).cast("long")
    docs = language_id.document_records(read_table(spark, sf_dir, "documents")).withColumn("page_id", none)
    pages = language_id.page_records(read_table(spark, sf_dir, "pages")).withColumn("doc_id", none)
    out = language_id.identify(docs.unionByName(pages))
    return out.select("doc_id", "page_id", "declared", "host", "language", "posterior", "grams", "kept")


def op2_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer, end_id=1, with_ids=False)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeated_windows(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op4_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = new_folder(spark, "token-files")
    return token_files.token_file_digests(read_table(spark, sf_dir, "documents"), folder, tokenizer, end_id=2)


def op5_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tree.search(read_table(spark, sf_dir, "embeddings"))


def op6_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_bands(read_table(spark, sf_dir, "documents"), labels=read_table(spark, sf_dir, "labels"))


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    n, left = F.octet_length("raw").cast("long"), F.octet_length("kept").cast("long")
    return out.select(
        "doc_id", n.alias("n_bytes"), (n - left).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op9_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op10_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.ppm_scores(read_table(spark, sf_dir, "documents"))


def op11_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.coded(read_table(spark, sf_dir, "documents"), model, with_values=False)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_evidence, op2_bounded_packing, op3_line_dedup, op4_wavelet_files, op5_kmeans_tree, op6_compression_bands,
        op7_suffix_arrays, op8_simhash_bk_trees, op9_cube_mixing, op10_ppm_scores, op11_piece_agenda, op12_importance_resampling,
        op13_filter_audit,
    )
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": line_dedup.ORACLE_SQL,
    "op12_importance_resampling": importance.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
