"""The named queries of this subpackage: thin readers over the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from swipelens.llm import (
    bpe, chat, divergence, extract, hnsw, host_rules, kdshards, mixing, secret_scan, simhash, spelling, warc, wavelet,
)
from swipelens.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", *extract.RESULTS)


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, TOKENIZER).select("doc_id", *bpe.RESULTS)


def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = host_rules.quality_rules(docs, keep_text=False)
    return judged.select("doc_id", *host_rules.METRICS, "base_failed", "kept")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.report(secret_scan.scan(docs)).select("doc_id", *secret_scan.RESULTS)


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wavelet.shard_report(docs, TOKENIZER)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_report(table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", *mixing.RESULTS)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshards.shard_report(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_hnsw": op2_hnsw,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_host_quality": op5_host_quality,
    "op6_secret_scan": op6_secret_scan,
    "op7_token_shards": op7_token_shards,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_chat_format": op10_chat_format,
    "op11_divergence": op11_divergence,
    "op12_kd_shards": op12_kd_shards,
    "op13_spelling": op13_spelling,
}
