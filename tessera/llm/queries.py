"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    align,
    chat,
    decontaminate,
    fingerprint,
    katz,
    merkle,
    mix,
    neardup,
    pii,
    spans,
    sql,
    topk,
    toxicity,
    urls,
)
from tessera.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark, sf_dir):
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_chat_prefix_target(spark, sf_dir):
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digest(c.unionByName(extra))


def op3_mix_sources(spark, sf_dir):
    return mix.mix_sources(table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op6_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_katz_scores(spark, sf_dir):
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op8_pii_sanitise(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op9_span_dedup(spark, sf_dir):
    return spans.dedup_spans(table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark, sf_dir):
    v = topk.scaled_vectors(table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(v, v.filter("vec_id % 20 = 0"))


def op11_multiset_hash(spark, sf_dir):
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest_proofs(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark, sf_dir):
    return align.align_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_chat_prefix_target,
        op3_mix_sources,
        op4_minhash_near_dedup,
        op5_url_filter,
        op6_toxicity,
        op7_katz_scores,
        op8_pii_sanitise,
        op9_span_dedup,
        op10_exact_top_k,
        op11_multiset_hash,
        op12_merkle_manifest,
        op13_tokenizer_alignment,
    )
}

ORACLE: dict[str, str] = {
    "op1_decontaminate": sql.OP1,
    "op2_chat_prefix_target": sql.OP2,
    "op3_mix_sources": sql.OP3,
    "op4_minhash_near_dedup": sql.OP4,
    "op5_url_filter": sql.OP5,
    "op10_exact_top_k": sql.OP10,
    "op12_merkle_manifest": sql.OP12,
}
