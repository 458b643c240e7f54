"""Quality rules: per-text rules and cross-document line frequency.

DataFrame functions only. The per-text features are array expressions on the
row; the line frequency is one grouped count on (host, line hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import SPACES, ascii_lower, let, words, written

SYMBOLS = "#*$%&|<>"


def repeated_words(ws: Column, window: int) -> Column:
    """Words covered by a ``window``-word window that the text holds twice or more.

    Windows are compared by the hash of their word hashes. Only texts with a
    repeat sort (hash, position) pairs; the cover is summed over neighbouring
    positions, so the work is n log n for any text.
    """

    def cover(pos: Column) -> Column:
        gaps = F.transform(pos, lambda p, i: F.when(i == 0, F.lit(window)).otherwise(F.least(p - F.get(pos, i - 1), F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def heavy(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda s: let(
                F.sort_array(
                    F.transform(
                        F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])),
                        lambda x: x["i"],
                    )
                ),
                cover,
            ),
        )

    word_hashes = F.transform(ws, lambda w: F.xxhash64(w))
    hashes = let(
        word_hashes,
        lambda wh: F.transform(
            F.sequence(F.lit(0), F.size(wh) - window),
            lambda i: F.xxhash64(*[F.get(wh, i + j) for j in range(window)]),
        ),
    )
    return F.when(F.size(ws) < window + 1, F.lit(0)).otherwise(
        let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(heavy(hs)))
    )


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(
        F.filter(F.split(text, "\n"), lambda ln: F.btrim(ln, F.lit(SPACES)) != ""),
        lambda ls: F.size(ls) - F.size(F.array_distinct(ls)),
    )


def hashed_lines(text: Column) -> Column:
    """Per line with a word: hashes ``h1, h2`` of the normalised line (spaces stripped, A-Z
    lower-cased), its words ``nw``, and whether it is the text's ``first`` of that hash, as an array."""

    def hashed(key: Column) -> Column:
        nw = F.regexp_count(key, F.lit(r"[\x20\x09-\x0D]+")) + 1
        return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"), nw.alias("nw"))

    def marked(lines: Column) -> Column:
        def mark(x: Column, i: Column) -> Column:
            last = F.get(lines, i - 1)
            first = (i == 0) | (last["h1"] != x["h1"]) | (last["h2"] != x["h2"])
            return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["nw"].alias("nw"), first.alias("first"))

        return F.transform(lines, mark)

    keys = F.filter(F.transform(F.split(text, "\n"), lambda ln: ascii_lower(F.btrim(ln, F.lit(SPACES)))), lambda k: k != "")
    return let(F.sort_array(F.transform(keys, hashed)), marked)


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    window: int = 8,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    max_line_docs: int = 20,
    min_kept_percent: int = 30,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, removed_words, base_failed, kept``.

    Base rules: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` % of the words in repeated windows, fails. Line
    frequency: lines (spaces stripped, A-Z lower-cased, hashed) that more than
    ``max_line_docs`` documents of one host hold are removed; a document is depleted,
    and not kept, if under ``min_kept_percent`` % of its words remain. Each row is a
    document, exact copies of a text too, and counts once for a line it repeats.

    Defined cases: a null text has no words; a null host is a host of its own;
    null and repeated ids get a row per input row; lines without a word are
    never counted; an empty table gives an empty table; other columns are
    ignored.

    Scale: texts are read once and never shuffled; their features and hashed lines are
    written to the shared folder. The line count moves one (host, hash) partial sum
    per map task and key, so a line found in a third of all documents is no hot
    key; what is joined with it, and with a text's removed words, is a table of its own, so
    AQE can split a hot line or text.
    """
    base = docs.select(
        docs[f"`{id_col}`"].alias("doc_id"),
        F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"),
        docs[f"`{host_col}`"].cast("string").alias("host"),
    )
    texts = written(base.withColumn("ws", words(F.col("text"))).select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("th"),
        F.size("ws").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("ws"), window).cast("long").alias("n_repeat_words"),
        hashed_lines(F.col("text")).alias("lines"),
    ), "quality", compression="zstd")
    lines = texts.select("host", "th", F.inline("lines"))
    counted = lines.groupBy("host", "h1", "h2").agg(F.sum(F.col("first").cast("long")).alias("docs"))
    frequent = written(counted.filter(F.col("docs") > max_line_docs).select("host", "h1", "h2"), "frequent_lines")
    copies = texts.groupBy("host", "th").agg(F.count("*").alias("copies"))
    hosts = F.col("l.host").eqNullSafe(F.col("f.host"))
    # copies of one text give the same rows, so their sum is divided by how many there are
    removed = (
        lines.alias("l")
        .join(frequent.alias("f"), hosts & (F.col("l.h1") == F.col("f.h1")) & (F.col("l.h2") == F.col("f.h2")))
        .groupBy(F.col("l.host").alias("host"), F.col("l.th").alias("th"))
        .agg(F.sum("l.nw").alias("all_removed"))
        .alias("r")
        .join(copies.alias("c"), F.col("r.host").eqNullSafe(F.col("c.host")) & (F.col("r.th") == F.col("c.th")))
        .select(F.col("r.host").alias("r_host"), F.col("r.th").alias("r_th"), (F.col("all_removed") / F.col("copies")).cast("long").alias("removed"))
    )
    removed = written(removed, "removed_words")
    out = texts.join(removed, F.col("host").eqNullSafe(F.col("r_host")) & (F.col("th") == F.col("r_th")), "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    gone = F.coalesce("removed", F.lit(0)).cast("long")
    depleted = 100 * (F.col("n_words") - gone) < min_kept_percent * F.col("n_words")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        gone.alias("removed_words"), failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
    )
