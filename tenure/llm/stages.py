"""The stages of ``corpus_pipeline.py``: (spark, docs, sf_dir) to a DataFrame.

Each works on all rows of ``docs`` and, but for the last, returns the columns
that ``docs`` has. Defined cases are those of the operator that a stage calls.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm import bpe, line_dedup, mixing, simhash, toxicity


def _with_n_chars(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, counts the text's code points again."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more as toxic go; the labels teach as in the query."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), least=0.7)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup; documents whose lines all went stay with an empty text."""
    return _with_n_chars(line_dedup.dedup_lines(docs, min_chars=20, min_docs=3))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays (the least id)."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to the query's weights: a document occurs as often as the mix takes it."""
    return mixing.mixed_rows(docs, weights=(1, 2, 3), most=3.0)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, decoded again and summed up; columns as in ``bpe.tokens``."""
    return bpe.tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
