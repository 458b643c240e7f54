"""A corpus pipeline: toxic documents out, shared lines out, near-duplicates out,
sources mixed to target weights, the rest encoded.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenure.llm import stages
from tenure.llm.common import written

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.drop_shared_lines),
    ("near_dedup", stages.drop_near_duplicates),
    ("mixing", stages.mix_sources),
    ("byte_bpe", stages.encode_texts),
]

#: No SQL form: fingerprints, learned scores and random rounding; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
