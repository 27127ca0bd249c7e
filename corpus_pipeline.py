"""A training corpus from ``documents``: language ID, quality rules, near
duplicates, benchmark decontamination, packing.

Each stage reads what the stage before wrote. All but the last return rows of
``documents`` as they came, less those that the stage rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiflow.llm import decontaminate, jaccard_join, langid, packing, quality_rules
from lexiflow.llm.catalog import tokenizer_path
from lexiflow.llm.common import read_table
from lexiflow.session import write_table

#: Near duplicates: five-word shingles, similarity 0.8 or more.
NEAR_DUPLICATES = jaccard_join.JoinConfig(shingle=5, percent=80)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents whose language is identified with a posterior of at
    least one half stay; texts without letters go."""
    return langid.identify_documents(docs).where("accepted").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that pass the base rule and the certified rules stay."""
    return quality_rules.keep_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of linked documents the one with the smallest id stays."""
    return jaccard_join.first_of_each(docs, cfg=NEAR_DUPLICATES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: pieces of the remaining documents in windows of 4096 tokens, with their ids."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("pack", pack)]

#: Trigram models, random groups and token ids are not SQL; tests/llm compares
#: each stage with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
