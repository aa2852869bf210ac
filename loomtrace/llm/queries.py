"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.llm import bpe, toxicity
from loomtrace.llm.common import table
from loomtrace.llm.lines import dedup_lines
from loomtrace.llm.mixing import mix_sources
from loomtrace.llm.quality import judge
from loomtrace.llm.secrets import blobs_of, scan_commits
from loomtrace.llm.simhash import near_groups
from loomtrace.llm.substrings import dedup_substrings
from loomtrace.llm.tokencounts import token_counts
from loomtrace.llm.topk import quantised, top_k

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
UNIGRAM_PIECES = "piece_bpe_32k.model"


def held_out(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string")) % 5 == 0


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    out = toxicity.score(docs, model)
    hit = F.col("_lt_score") >= 0.5
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("_lt_score").alias("score"), hit.cast("int").alias("predicted"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("id % 20 = 0"), vectors, k=20)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BPE_RANKS)
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_lt_lines").alias("n_lines"), F.col("_lt_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # a history of two commits; what the first holds, the second finds in the ledger
    late = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 1, F.lit(False))
    findings, _ = scan_commits([docs.where(~late), docs.where(late)])
    rows = docs.select("doc_id", blobs_of(docs).alias("blob")).join(findings, "blob", "left")
    spans = F.coalesce("spans", F.array().cast(findings.schema["spans"].dataType))
    shown = lambda which: F.array_join(F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter(spans, lambda s: s["rank"] < 3)
    count = lambda k: F.size(F.filter(spans, lambda s: s["rank"] == k)).cast("long")
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(shown(base), 256).alias("base_sha256"), shown(spans).alias("spans"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_groups(table(spark, sf_dir, "documents"), shingle=3, most=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex(F.element_at("fps", 1)), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "_lt_m.*", F.col("_lt_base_failed").alias("base_failed"), F.col("_lt_kept").alias("kept"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(UNIGRAM_PIECES))
    return out.select("doc_id", "n_words", F.col("total").alias("n_tokens"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_exact_topk, op3_byte_bpe, op4_line_dedup, op5_secret_scan, op6_simhash, op7_quality_rules, op8_substring_dedup, op9_mix_sources, op10_token_counts,
)}
