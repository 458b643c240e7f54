"""Pasted delimited text as a relation — SURVEY A2-A7.

The reference takes one pasted string per run (rows separated by ``,``,
fields by ``|``). Here the input is a DataFrame of pastes (``paste_id``,
``text``), so any number of runs are parsed in parallel; each paste is
processed whole (no prefix or row cap). ``paste_frame`` wraps a single
string for interactive use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.oracle import char_only_strip, col, empty_to_null


def paste_frame(spark: SparkSession, text: str, paste_id: int = 0) -> DataFrame:
    """One pasted string as a one-row DataFrame."""
    return spark.createDataFrame([(paste_id, text)], "paste_id long, text string")


def split_rows(df: DataFrame, text_col: str = "text", sep: str = ",", keep_tab: bool = False,
               clean: bool = True, row_col: str = "value", pos_col: str = "row_pos") -> DataFrame:
    """Rows of each paste; empty tokens collapse like ``regexp_substr(x, '[^,]+', 1, n)`` (A2).

    ``clean`` applies the paste cleaner (B1 or, with ``keep_tab``, B2) to the
    whole text first. ``row_pos`` is 0-based over the surviving rows.
    """
    text = char_only_strip(text_col, keep_tab) if clean else F.col(text_col)
    toks = F.filter(F.split(text, _regex_quote(sep)), lambda t: t != F.lit(""))
    others = [c for c in df.columns if c != text_col]
    return df.select(*others, F.posexplode(toks).alias(pos_col, row_col))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def field_collapsed(c, n: int, sep: str = "|") -> Column:
    """n-th (1-based) non-empty field: empty fields vanish and later fields shift (A5)."""
    pattern = "[^" + _regex_quote(sep) + "]+"
    return F.get(F.regexp_extract_all(col(c), F.lit(pattern), 0), n - 1)


def field_kept(c, n: int, sep: str = "|") -> Column:
    """n-th (0-based) field keeping empties; '' and missing fields are NULL (A4)."""
    return empty_to_null(F.get(F.split(col(c), _regex_quote(sep)), n))


def clean_token(c: Column, keep_tab: bool = False) -> Column:
    """Apostrophes out, then the paste cleaner (B3 + B1/B2)."""
    return char_only_strip(F.replace(c, F.lit("'"), F.lit("")), keep_tab)


def header_rows(rows: DataFrame, pos_col: str = "row_pos", key: str = "paste_id") -> tuple[DataFrame, DataFrame]:
    """Split parsed rows into the header row (first row of each paste) and the data rows (A3)."""
    return rows.filter(F.col(pos_col) == 0), rows.filter(F.col(pos_col) > 0)
