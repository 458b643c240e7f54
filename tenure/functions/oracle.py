"""Column helpers with Oracle/PeopleSoft value semantics.

Three rules drive everything here:
  * the empty string is NULL, and concatenation treats NULL as empty;
  * PeopleSoft stores "no value" as a single space ``' '``;
  * ``decode`` compares NULL with NULL as equal, ``=`` does not.
All helpers are plain Column expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def empty_to_null(c: ColumnOrName) -> Column:
    """Oracle treats '' as NULL."""
    c = col(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def cat(*cols: ColumnOrName) -> Column:
    """Oracle ``||``: NULL pieces count as empty, an empty result is NULL."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]
    return empty_to_null(F.concat(*parts))


def nvl(c: ColumnOrName, default: Any) -> Column:
    return F.coalesce(col(c), lit_or_col(default))


def decode(c: ColumnOrName, mapping: Mapping[Any, Any] | Iterable[tuple[Any, Any]], default: Any = None) -> Column:
    """Null-safe switch: ``decode(x, k1, v1, ..., default)``."""
    c = col(c)
    items = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    expr = None
    for k, v in items:
        cond = c.eqNullSafe(lit_or_col(k))
        expr = F.when(cond, lit_or_col(v)) if expr is None else expr.when(cond, lit_or_col(v))
    if expr is None:
        return lit_or_col(default)
    return expr.otherwise(lit_or_col(default)) if default is not None else expr


def is_blank(c: ColumnOrName) -> Column:
    """PeopleSoft blank: exactly one space. NULL is neither blank nor non-blank."""
    return col(c) == F.lit(" ")


def trim_null(c: ColumnOrName) -> Column:
    """``trim`` with Oracle's result rule: all-space text becomes NULL."""
    return empty_to_null(F.trim(col(c)))


# The characters each variant of the paste cleaner deletes.
STRIP_CHARS_V1 = "\t\r\n;\""   # TAB, CR, LF, semicolon, double quote
STRIP_CHARS_V2 = "\r\n;\""     # the same without TAB


def char_only_strip(c: ColumnOrName, keep_tab: bool = False) -> Column:
    """Delete control characters, ``;`` and ``"`` then trim (B1; B2 with ``keep_tab``)."""
    chars = STRIP_CHARS_V2 if keep_tab else STRIP_CHARS_V1
    return trim_null(F.translate(col(c), chars, ""))


def strip_apostrophes(c: ColumnOrName) -> Column:
    """B3."""
    return empty_to_null(F.replace(col(c), F.lit("'"), F.lit("")))


def digits_only(c: ColumnOrName) -> Column:
    """Phone normaliser: keep the digits; nothing left -> NULL."""
    return empty_to_null(F.regexp_replace(col(c), r"[^0-9]", ""))


def strip_prefix(c: ColumnOrName, pattern: str = r"^Message: ") -> Column:
    """B6."""
    return F.regexp_replace(col(c), pattern, "")


def trailing_id(c: ColumnOrName, width: int = 6) -> Column:
    """Last ``width`` characters when they are all digits, else NULL."""
    return empty_to_null(F.regexp_extract(col(c), r"([0-9]{%d})\z" % width, 1))


def all_digits(c: ColumnOrName) -> Column:
    """B8."""
    return col(c).rlike(r"^[0-9]+$")


def to_number_or_zero(c: ColumnOrName, dtype: str = "decimal(38,10)") -> Column:
    """Safe numeric conversion, 0 when not a number."""
    return F.coalesce(col(c).try_cast(dtype), F.lit(0).cast(dtype))


def to_number(c: ColumnOrName, dtype: str = "decimal(38,10)", on_error: str = "fail") -> Column:
    """Numeric conversion (B10): a text that is no number fails the query, or gives
    NULL with ``on_error='null'``."""
    c = col(c)
    n = F.trim(c).try_cast(dtype)
    if on_error == "null":
        return n
    bad = F.raise_error(F.concat(F.lit("invalid number: "), c)).cast(dtype)
    return F.when(c.isNotNull(), F.coalesce(n, bad))


def to_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """``to_date(text, fmt)`` (B11): a Spark date pattern, by default ISO; NULL where the text is no such date."""
    return F.try_to_date(col(c)) if fmt is None else F.try_to_date(col(c), fmt)


def date_text(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """``to_char(date, fmt)``."""
    return F.date_format(col(c), fmt)


def num_text(c: ColumnOrName) -> Column:
    """Oracle number-to-text: no trailing zeros, no leading zero (``2.50``->``2.5``, ``0.5``->``.5``)."""
    s = F.regexp_replace(col(c).cast("string"), r"\.0*$|(\.[0-9]*[1-9])0+$", "$1")
    return F.regexp_replace(s, r"^(-?)0\.", "$1.")


def fm_2dp(c: ColumnOrName) -> Column:
    """``to_char(x, 'FM9999999.90')``: two decimals (half-up), no leading zero."""
    s = col(c).cast("decimal(38,2)").cast("string")  # half-up rounding to 2 places
    return F.regexp_replace(s, r"^(-?)0\.", "$1.")


def oracle_trunc_pad(c: ColumnOrName, width: int, left: bool = False, pad: str = " ") -> Column:
    """``rpad``/``lpad`` with truncation; NULL stays NULL."""
    return F.lpad(col(c), width, pad) if left else F.rpad(col(c), width, pad)


def asc(c: ColumnOrName) -> Column:
    """Oracle ascending order: NULLS LAST."""
    return col(c).asc_nulls_last()


def desc(c: ColumnOrName) -> Column:
    """Oracle descending order: NULLS FIRST."""
    return col(c).desc_nulls_first()


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def any_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)
