"""Fixtures and brute-force pieces shared by the tests of the text operators."""

import re

import duckdb
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns with names that the operators use themselves.
CLASH = ["th", "fp", "key", "pos", "ids", "host", "h1", "row", "line", "_text", "_id", "n", "component_id", "size", "feature"]


def edge_rows():
    """(doc_id, text): nulls, empty and blank texts, ties, repeated rows, repeated ids, one long text."""
    shared = "A line that several documents hold, word for word."
    return [
        (1, "one two three four five six seven\n" + shared),
        (2, "  " + shared.upper() + "\t\nanother line of the second text here"),
        (3, shared + "\n\nthird text ends\x0b here with spaces  \n" + shared),
        (3, shared + "\n\nthird text ends\x0b here with spaces  \n" + shared),
        (4, None),
        (5, ""),
        (6, " \t\n"),
        (None, "no id: " + shared),
        (None, shared),
        (7, "Émile ÇA va? 'tis 12 o'clock x\x1cy\r\n" + shared),
        (8, "tiny"),
        (8, "tiny two"),
        (9, ("the quick brown fox jumps over the lazy dog near bank %d\n" * 1) % 1 + "spam and eggs for all my good friends today " * 400),
        (10, "the quick brown fox jumps over the lazy dog near bank 1"),
        (11, "one two three four five six seven\n" + shared),
    ]


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("s"), F.col("doc_id") % 2)))
    df = df.withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))
    for c in CLASH if clash else []:
        df = df.withColumn(c, F.lit("clash"))
    return df


def documents(sf=SF):
    return duckdb.sql(f"select doc_id, text, source from '{sf}/documents.parquet' order by doc_id").fetchall()


def same(got, want):
    """Equal as bags of rows."""
    k = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=k) == sorted(map(tuple, want), key=k)
