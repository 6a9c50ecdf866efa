"""Corpus preparation: toxic texts out, near-duplicates out, benchmark passages out, secrets
masked, the rest encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastelens.llm import bpe, decontamination, secret_scan, simhash, toxicity
from tastelens.llm.batches import fold, free, quoted
from tastelens.llm.queries import NEAR_BITS, NEAR_WORDS, TOXIC, VOCABULARY, table
from tastelens.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on their own texts, does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    out = free("toxicity", docs.columns)
    scored = toxicity.score(docs, model, keep=docs.columns, out=out)
    return scored.filter(F.col(out) < TOXIC).select(*map(quoted, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, that with the smallest id; rows without an id come last."""
    return simhash.first_rows(docs, NEAR_WORDS, NEAR_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    out = free("leaks", docs.columns)
    items = table(spark, sf_dir, "benchmark")
    found = decontamination.with_leaks(docs, items, keep=docs.columns, out=out)
    return found.filter(F.size(out) == 0).select(*map(quoted, docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    out = free("secrets", docs.columns)
    found = secret_scan.with_secrets(docs, out=out)
    text = secret_scan.masked(F.col("text"), F.col(out)).alias("text")
    return found.select(*(text if c == "text" else quoted(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of the text they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    whole = bpe.encode_and_decode(docs, path)
    return whole.select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scans", mask_secrets),
    ("bpe", encode),
]

# The first, second and last stage have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
