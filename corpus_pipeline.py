"""Training-data pipeline over `documents`.

STAGES, in order: quality rules (failing documents go), toxicity (toxic documents go),
line dedup (recurring lines go, the first document keeps them), SimHash near-dedup (the
smallest doc_id of each component stays) and packing (one row per packed piece). Each
stage works on all rows its predecessor kept, written as Parquet and read again.

A stage handles nulls, empty and very long texts, repeated rows, empty tables and further
columns as its operator's docstring says; all but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from molarflow.llm import lines, packing, quality, simhash, toxicity
from molarflow.llm.common import stored, table

#: The tokenizer that packing uses.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: SQL can express neither the learned classifier nor the tokenizer; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_recurring(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored in the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
