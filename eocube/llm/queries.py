"""The operators applied to the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eocube.llm import (
    clustering,
    decontamination,
    fingerprints,
    lexical_search,
    licenses,
    line_dedup,
    near_duplicates,
    packing,
    quality,
    sentence_pieces,
    suffix_dedup,
    token_counts,
    token_files,
)
from eocube.llm.tables import documents, table
from eocube.sources.store import workspace

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("spans")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "llm-token-files")
    path = public_tokenizers.path(BYTE_BPE)
    return token_files.read_documents(token_files.write_token_files(documents(spark, sf_dir), folder, path, end_id=2))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(documents(spark, sf_dir), licenses.notices(spark))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.benchmark_passages(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir)).drop("keep_map")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(documents(spark, sf_dir))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.piece_digests(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_token_files, op3_quality_rules, op4_near_duplicates, op5_token_counts,
        op6_fingerprints, op7_license_scan, op8_decontamination, op9_best_fit_packing, op10_line_dedup,
        op11_centroid_clusters, op12_ranked_search, op13_sentence_pieces,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op10_line_dedup": line_dedup.LINE_DEDUP_SQL,
    "op11_centroid_clusters": clustering.CLUSTER_SQL,
    "op12_ranked_search": lexical_search.SEARCH_SQL,
}
