"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm import bpe, filter_audit, fingerprints, licenses, line_dedup, mixing, quality, repeats, secrets, simhash, token_store, toxicity, whitening
from tenure.llm.common import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"), runs=True)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        token_store.write_tokens(table(spark, sf_dir, "documents"), path, f.read(), end_id=2)
    read = token_store.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).select("doc_id", "fingerprint", "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, min_chars=20, min_docs=3, n_lines_col="n_lines", n_dropped_col="n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.per_document(mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3.0))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=toxicity.usable_label())
    found = toxicity.scored(docs, model, keep=["doc_id"])
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = filter_audit.text_failures(table(spark, sf_dir, "documents"))
    lost = filter_audit.with_losses(docs, table(spark, sf_dir, "labels"), good_lost="quality", toxic_lost="toxic")
    return filter_audit.audit(lost, filters="ABCDE", part_col="lang", losses=("good_lost", "toxic_lost"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), most=8)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_byte_bpe, op3_token_store, op4_simhash, op5_line_dedup,
        op6_fingerprints, op7_secrets, op8_mixing, op9_toxicity, op10_quality,
        op11_filter_audit, op12_repeats, op13_whitening,
    )
}
