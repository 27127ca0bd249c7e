"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontaminate, jaccard_join, langid, log_frequency_lm, merkle, packing, prefix_bpe, quality_rules, sharding,
               token_count, url_reputation, warc)
from .common import read_table
from .oracle import SQL

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        LLM_QUERIES[name] = fn
        return fn
    return deco


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_evidence_fusion")
def op1(spark, sf_dir):
    return langid.identify_pages(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


@query("op2_risk_controlled_rules")
def op2(spark, sf_dir):
    out = quality_rules.judge_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_rules")


@query("op3_log_frequency_bloom")
def op3(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return log_frequency_lm.score_documents(read_table(spark, sf_dir, "documents"), held_out)


@query("op4_hypergeometric_shards")
def op4(spark, sf_dir):
    out = sharding.shard_documents(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op5_revisit_resolution")
def op5(spark, sf_dir):
    return warc.deduplicate_pages(read_table(spark, sf_dir, "pages"))[0]


@query("op6_differencing_pack")
def op6(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op7_rank_merge_tokens")
def op7(spark, sf_dir):
    return token_count.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op10_simhash_windows")
def op10(spark, sf_dir):
    out = decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "start", "n_words", "similarity")


@query("op8_metric_space_join")
def op8(spark, sf_dir):
    return jaccard_join.join_documents(read_table(spark, sf_dir, "documents"))


RULES = (
    url_reputation.Rule("allow", "org", "/"),
    url_reputation.Rule("block", "example.org", "/es/"),
    url_reputation.Rule("block", "example.org", "/en/1"),
    url_reputation.Rule("allow", "com", "/fr/"),
    url_reputation.Rule("block", "com", "/de/"),
)


@query("op9_host_reputation")
def op9(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels")
    # an item's labels carry its number; a page is bad when it is toxic or of low quality
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    out = url_reputation.filter_urls(
        read_table(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op11_prefix_bpe")
def op11(spark, sf_dir):
    return prefix_bpe.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op12_slot_pivot_manifest")
def op12(spark, sf_dir):
    return merkle.verify_documents(read_table(spark, sf_dir, "documents"))


@query("op13_incidence_alignment")
def op13(spark, sf_dir):
    return alignment.align_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                     tokenizer_path("piece_bpe_32k.model"))


LLM_ORACLE = {k: v for k, v in SQL.items() if k in LLM_QUERIES}
