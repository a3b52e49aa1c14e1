"""The stages that turn raw documents into encoded training text, one operator each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens.llm import bpe, host_rules, mixing, secret_scan, simhash
from swipelens.llm.common import table
from swipelens.session import new_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail by their own text or by their host."""
    return host_rules.quality_rules(docs).where("kept").select(COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of SimHash near-duplicates, that with the smallest id."""
    return simhash.deduplicate(docs).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mask; the documents stay."""
    clean = secret_scan.redact(secret_scan.scan(docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin the sources to their budgets in whole documents; one taken twice comes twice."""
    mixed = mixing.expand(mixing.mix(docs, keep_text=True))
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the SHA-256 of the text they decode to."""
    return bpe.transcode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", dedup),
    ("secret scans", secrets),
    ("mixing sources", mix),
    ("bpe encoding", encode),
]

#: The fingerprints have no counterpart in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in turn; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
