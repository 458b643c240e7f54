"""Field-level comparison and load-string building — SURVEY B30-B37, A14.

A "field spec" is a list of ``Field(label, new, cur, ...)``; the helpers turn
it into one Column expression (no UDF):

* ``field_diff``: `` label:new(cur)`` for every field whose values differ
  (NULL equals NULL), concatenated, trimmed, NULL when nothing differs.
* ``fields_equal``: 0 when every field is equal with plain ``=`` (any NULL
  makes the pair differ), else 1.
* ``changed_only``: the new value where it differs from the current one,
  else empty — the slots of a change-only load string.
* ``load_string``: pipe-joined slots where NULL is an empty slot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.oracle import all_of, col, empty_to_null


@dataclass
class Field:
    label: str
    new: object
    cur: object
    lead: str = " "           # text before the label (the first field has none)
    new_lpad: int | None = None  # lpad the new value to this width
    rpad_total: int | None = None  # pad the whole "label:new(cur)" piece to this width
    rpad_value: int | None = None  # pad "new(cur)" to this width
    cut: bool = False              # also cut what is wider (the fixed-width layout)
    fmt: Callable[[Column], Column] | None = None  # text form of a value; values are compared as they are


def _padded(c: Column, width: int, cut: bool, left: bool = False) -> Column:
    to = F.lit(width) if cut else F.greatest(F.length(c), F.lit(width))
    return F.lpad(c, to, F.lit(" ")) if left else F.rpad(c, to, F.lit(" "))


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _piece(f: Field) -> Column:
    text = f.fmt or (lambda c: c.cast("string"))
    new, cur = text(col(f.new)), text(col(f.cur))
    if f.new_lpad:
        new = _padded(new, f.new_lpad, f.cut, left=True)
    body = F.concat(_text(new), F.lit("("), _text(cur), F.lit(")"))
    if f.rpad_value:
        body = _padded(body, f.rpad_value, f.cut)
    piece = F.concat(F.lit(f"{f.lead}{f.label}:"), body)
    differs = ~col(f.new).eqNullSafe(col(f.cur))
    piece = F.when(differs, piece)
    if f.rpad_total:
        piece = _padded(piece, f.rpad_total, f.cut)
    return piece


def field_diff(fields: Sequence[Field]) -> Column:
    """Differences as one string, NULL when none."""
    text = F.concat(*[F.coalesce(_piece(f), F.lit("")) for f in fields])
    return empty_to_null(F.trim(text))


def fields_equal(pairs: Sequence[tuple[object, object]]) -> Column:
    """0 when all pairs are equal with ``=`` (NULL never equal), else 1."""
    cond = all_of([col(a) == col(b) for a, b in pairs])
    return F.when(cond, 0).otherwise(1)


def changed_only(new, cur) -> Column:
    """``decode(new, cur, NULL, new)``: the new value only when it differs."""
    return F.when(~col(new).eqNullSafe(col(cur)), col(new))


def load_string(*slots, sep: str = "|") -> Column:
    """Delimited load line; NULL slots stay as empty slots.

    Numbers should be passed through ``num_text`` and dates through
    ``date_text`` by the caller when the Oracle text form matters.
    """
    parts = [_text(col(s).cast("string")) if not isinstance(s, str) else F.lit(s) for s in slots]
    line = F.concat(*[x for i, p in enumerate(parts) for x in ((F.lit(sep), p) if i else (p,))])
    return line if len(parts) > 1 else empty_to_null(line)


def next_effseq(cur_effdt, new_effdt, cur_effseq, offset=None) -> Column:
    """Same-day change -> current effseq + 1 (or + offset); else 0 (or offset - 1)."""
    same = col(cur_effdt).eqNullSafe(col(new_effdt))
    if offset is None:
        return F.when(same, col(cur_effseq) + 1).otherwise(F.lit(0))
    return F.when(same, col(cur_effseq) + col(offset)).otherwise(col(offset) - 1)


def plural_audit(count, head, maximum, position) -> Column:
    """Capacity message for planned moves into a slot."""
    total = col(count) + col(head)
    return (
        F.when(col(position).isNull(), F.lit(None).cast("string"))
        .when(total > col(maximum), F.concat(
            F.lit("!! Increase ("), col(position), F.lit(") capacity before proceeding "),
            total.cast("string"), F.lit(" / "), col(maximum).cast("string")))
        .otherwise(F.concat(
            F.lit("Ok "), col(count).cast("string"), F.lit(" record"),
            F.when(col(count) > 1, "s").otherwise(""), F.lit(", new counts: "),
            total.cast("string"), F.lit(" / "), col(maximum).cast("string")))
    )
