"""From documents to packed training sequences: five stages, each an operator of ``eocube.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the ``docs`` of the next one. All but the last return the columns
of ``documents``. Null texts count as empty, an empty table passes through all stages, and
columns of any other name are carried along unread. Of repeated rows of one ``doc_id`` one is left
by the near-duplicate stage; rows without ``doc_id`` all stay. Texts of any length go through whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eocube.llm import decontamination, line_dedup, near_duplicates, packing, quality
from eocube.llm.tables import table, written

TOKENIZER = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.3 or more; trained on the labels of this corpus."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of 20 characters and more that three documents share."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, that with the smallest id."""
    return near_duplicates.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.best_fit_packing(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The classifier is trained and the packing searched for: tests/llm holds both against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
