"""Line dedup: drop lines that many documents share.

Lines are exploded, normalised and hashed; distinct documents are counted per
hash; lines over the threshold go from every document but the last one, and
the texts are put together again by line position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import SPACES, ascii_lower, fresh, let, written


def line_key(line: Column) -> Column:
    """Spaces stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    n_lines_col: str | None = None,
    n_dropped_col: str | None = None,
) -> DataFrame:
    """``docs`` with the shared lines dropped from the text column.

    A key (``line_key``) of at least ``min_chars`` code points that occurs in at
    least ``min_docs`` distinct documents (distinct ids) loses all its lines
    except in the largest id that holds it. The other lines stay, joined by
    ``\\n``. ``n_lines_col`` / ``n_dropped_col`` name optional count columns; a
    column of that name is replaced.

    Defined cases: a null or empty text is one empty line and comes back as
    the empty text; a row with a null id holds no line (it is not counted) but
    loses shared lines like any other; rows with the same id are one document,
    and repeated rows come back each with the same result; an empty table gives
    an empty table; all other columns are carried through untouched.

    Scale: only 16-byte hashes with id and position are shuffled for the count
    (partial sums per map task, so a line in a third of all documents costs one
    row per task), and hot hashes in the join back are split by AQE because
    the other side has one row per hash. Texts are shuffled once.
    """
    row, rid, text, th = fresh(docs, "_row", "_id", "_text", "_th")
    base = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(row),
        docs[f"`{id_col}`"].alias(rid),
        F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias(text),
    ).withColumn(th, F.xxhash64(text))
    lines = base.select(rid, th, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keys = lines.select(rid, th, "pos", line_key(F.col("line")).alias("key"))
    keys = keys.filter(F.length("key") >= min_chars).select(
        F.col(rid).alias("id"), F.col(th).alias("th"), "pos",
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"),
    )
    keys = written(keys, "line_keys")
    shared = (
        keys.groupBy("h1", "h2")
        .agg(F.countDistinct("id").alias("n"), F.max("id").alias("keep"))
        .filter(F.col("n") >= min_docs)
        .select("h1", "h2", "keep")
    )
    # a table of its own: next to a plain exchange AQE can split a hot line's rows in the join
    shared = written(shared, "shared_lines")
    drops = (
        keys.join(shared, ["h1", "h2"])
        .filter(F.col("id").isNull() | (F.col("id") != F.col("keep")))
        .groupBy("id", "th")
        .agg(F.collect_set("pos").alias("drops"))
        .select(F.col("id").alias("d_id"), F.col("th").alias("d_th"), "drops")
    )
    joined = base.join(drops, F.col(rid).eqNullSafe(F.col("d_id")) & (F.col(th) == F.col("d_th")), "left")
    joined = joined.withColumn("_lines", F.split(text, "\n"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = let(
        F.col("_lines"),
        lambda ls: F.array_join(F.transform(F.array_except(every, F.col("drops")), lambda i: F.get(ls, i)), "\n"),
    )
    new_text = F.when(F.col("drops").isNull(), F.col(text)).otherwise(kept)
    out = [(new_text if c == text_col else F.col(row)[c]).alias(c) for c in docs.columns if c not in (n_lines_col, n_dropped_col)]
    if n_lines_col:
        out.append(F.size("_lines").cast("long").alias(n_lines_col))
    if n_dropped_col:
        out.append(F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias(n_dropped_col))
    return joined.select(*out)
