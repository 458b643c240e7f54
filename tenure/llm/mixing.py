"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, its
source's target over its size. The whole part is sure; the fractions are
rounded in pairs: mass moves at random from one document to the other until one
of the two is integral. Groups leave one residual each, and the residuals are
combined by the same rule up a reduction tree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenure.llm.common import written

#: Rows that one group of the reduction tree has on average at most.
FAN_IN = 2_000
_EPS = 1e-9


def numbered(df: DataFrame, order, name: str) -> DataFrame:
    """``df`` with the row's number from 0 in the given order, without one task for all.

    Range partitions are numbered each for itself; their sizes (one number per
    partition) are summed up on the driver.
    """
    parted = written(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_part"], r["count"]) for r in parted.groupBy("_part").count().collect())
    first, total = [], 0
    for part, n in sizes:
        first.append((part, total))
        total += n
    starts = df.sparkSession.createDataFrame(first or [(0, 0)], "_part int, _first long")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return parted.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn(name, F.col("_first") + F.col("_own")).drop("_part", "_own", "_first")


def targets(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources by code point, null last, weigh ``weights`` in turn and share all
    sizes; a target stops at ``most`` times its source's size and the excess is
    shared again by weight. The level at which shares and stops add up is found
    by sums over the source table; only those sums come to the driver.
    """
    own = numbered(sources, F.col("source").asc_nulls_last(), "_rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    own = written(own.withColumn("weight", w).withColumn("stop", F.col("source_size") * float(most)), "sources")
    total = float(own.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        free = F.col("stop") > level * F.col("weight") if stopped >= 0 else F.lit(True)
        r = own.agg(
            F.coalesce(F.sum(F.when(~free, F.col("stop"))), F.lit(0.0)).alias("stops"),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)).alias("weights"),
            F.count(F.when(~free, 1)).alias("n"),
        ).first()
        if r["n"] == stopped or not r["weights"]:
            break
        stopped, level = r["n"], (total - r["stops"]) / r["weights"]
    share = F.col("weight") * level if r["weights"] else F.col("stop")
    return own.select("source", "source_size", "n_texts", F.least("stop", share).alias("target"))


def pivot(p: np.ndarray, seed: int, last: bool) -> tuple[np.ndarray, int, float]:
    """Round fractions in their order: (0/1 per row, the row left over or -1, its fraction).

    The sum is kept: two fractions a and b become a + b and 0, or 1 and a + b - 1,
    with the probabilities that keep each one's expectation. ``last``: the row
    left over is rounded by its own probability.
    """
    out, draw = np.zeros(len(p), np.int64), np.random.default_rng(seed).random(len(p) + 1)
    i, a = -1, 0.0
    for j, b in enumerate(p.tolist()):
        if not _EPS < b < 1 - _EPS:
            out[j] = b >= 0.5
            continue
        if i < 0:
            i, a = j, b
            continue
        s = a + b
        if s < 1:
            if draw[j] * s < b:
                i = j
            a = s
        else:
            if draw[j] * (2 - s) < 1 - b:
                out[i], i = 1, j
            else:
                out[j] = 1
            a = s - 1
        if a <= _EPS or a >= 1 - _EPS:
            out[i], i, a = a > 0.5, -1, 0.0
    if i >= 0 and last:
        out[i], i = draw[-1] < a, -1
    return out, i, a


def _rounds(rows: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level of the tree over (source, bucket): ``rows`` with ``copy`` (0, 1 or null) and the fraction left."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mass", "doc_key", "th"], kind="stable", ignore_index=True)
        s = xxhash.xxh64_intdigest(f"{key[0] is None} {key[0]} {key[1]} {level}".encode(), seed & 0xFFFFFFFF)
        out, left, a = pivot(pdf["p"].to_numpy(float), s, last)
        pdf["copy"] = out
        pdf["copy"] = pdf["copy"].astype("Int64")
        if left >= 0:
            pdf.loc[left, "copy"], pdf.loc[left, "p"] = pd.NA, a
        return pdf[["source", "doc_key", "th", "mass", "p", "bucket", "copy"]]

    kind = rows.schema["source"].dataType.simpleString()
    return rows.groupBy("source", "bucket").applyInPandas(run, f"source {kind}, doc_key string, th long, mass double, p double, bucket long, copy long")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    seed: int = 11,
) -> DataFrame:
    """One row per distinct (source, id, text): ``source, doc_id, th, size, times,
    source_size, target, copies``.

    ``size`` counts the words of a text (null: 0), ``times`` how often the row
    occurs, ``copies`` how many copies of each of these rows the mix takes (whole
    numbers up to ``most``, rounded up). The copies' sizes add up to about the
    source's target; a rerun gives the same rows.

    Defined cases: a null source is a source of its own (weighed last); null and
    repeated ids are told apart by their text, repeated rows share one decision;
    a source without words has target 0 and no copies; an empty table gives an
    empty table; other columns are ignored.

    Scale: texts are read once for (size, hash) and never shuffled. A source is
    dealt to groups of about ``FAN_IN`` rows by hash, whatever its share of all
    rows, each rounded in order of size; one residual per group goes up.
    """
    own = docs.select(docs[f"`{source_col}`"].alias("source"), docs[f"`{id_col}`"].alias("doc_id"), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("t"))
    own = own.select("source", "doc_id", F.xxhash64("t").alias("th"), F.regexp_count("t", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"))
    own = written(own.groupBy("source", "doc_id", "th").agg(F.first("size").alias("size"), F.count("*").alias("times")), "sizes")
    sources = own.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("n_texts"))
    sources = written(targets(sources, weights, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    rows = own.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.*", "source_size", "target", "n_texts", ratio.alias("r"))
    rows = rows.withColumn("whole", F.floor(F.col("r") + _EPS)).withColumn("doc_key", F.col("doc_id").cast("string"))
    rows = rows.withColumn("p", F.greatest(F.col("r") - F.col("whole"), F.lit(0.0))).withColumn("mass", (F.col("size") * F.col("times")).cast("double"))
    groups = F.ceil(F.col("n_texts") / FAN_IN)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_key", "th"), groups))
    largest = sources.agg(F.max("n_texts")).first()[0] or 0
    n, level = math.ceil(largest / FAN_IN), 0
    leaf = rows.select("source", "doc_key", "th", "mass", "p", "bucket")
    rounded = written(_rounds(leaf, level, n <= 1, seed), "rounded_0")
    decided = rounded.filter("copy is not null")
    while n > 1:
        level, n = level + 1, math.ceil(n / FAN_IN)
        left = rounded.filter("copy is null").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
        rounded = written(_rounds(left.drop("copy"), level, n <= 1, seed), f"rounded_{level}")
        decided = decided.union(rounded.filter("copy is not null"))
    d = decided.select(F.col("source").alias("x_source"), F.col("doc_key").alias("x_key"), F.col("th").alias("x_th"), "copy")
    same = F.col("source").eqNullSafe(F.col("x_source")) & F.col("doc_key").eqNullSafe(F.col("x_key")) & (F.col("th") == F.col("x_th"))
    return rows.join(d, same).select(
        "source", "doc_id", "th", "size", "times", "source_size", "target", (F.col("whole") + F.col("copy")).cast("long").alias("copies")
    )


def per_document(mixed: DataFrame) -> DataFrame:
    """One row per document row of ``mix``'s table: ``doc_id, size, source_size, target, taken``."""
    rows = mixed.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: rows without a copy are gone, others occur once per copy."""
    taken = mix(docs, id_col, text_col, source_col, **options).filter("copies > 0")
    taken = taken.select(F.col("source").alias("x_source"), F.col("doc_id").alias("x_id"), F.col("th").alias("x_th"), "copies")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{source_col}`"].alias("r_source"),
        docs[f"`{id_col}`"].alias("r_id"), F.xxhash64(F.coalesce(docs[f"`{text_col}`"], F.lit(""))).alias("r_th"),
    )
    same = F.col("r_source").eqNullSafe(F.col("x_source")) & F.col("r_id").eqNullSafe(F.col("x_id")) & (F.col("r_th") == F.col("x_th"))
    return rows.join(taken, same).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
