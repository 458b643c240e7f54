"""Effective-dated (as-of) operators — SURVEY 2.D.

An effective-dated table holds the history of a key: one row per change,
stamped with ``effdt`` (and ``effseq`` for several changes on one day). The
row "in force" at a date is the one with the greatest ``effdt <= date`` and,
within that day, the greatest ``effseq``.

Plan shapes (all single-pass, no correlated re-scans):

* ``asof_rows``: filter ``effdt <= asof`` (pushed to the parquet scan), then
  ``rank() over (partition by keys order by effdt desc, effseq desc) = 1``.
  Catalyst plans the rank filter as a WindowGroupLimit: a partial top-rank
  pass runs before the shuffle, so only the winning rows of each map
  partition travel, and a key holding a third of the rows is cut down on the
  map side. One shuffle on the key.
* ``asof_join`` (as-of date taken from the driving row, any number of dates at
  once): both sides are reduced to one row per key and day, a running maximum
  carries the last history day forward, and equi-joins on (key, day) fetch the rows.
  It never forms the (driving row x history row) pairs a range join would, and
  no task holds all rows of a key.
* ``versions`` / ``counts_over_time``: history as intervals, and how many of
  them hold from which day on (a running sum of starts and ends), for head
  counts at any number of dates.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.oracle import col


def _as_column(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, _dt.datetime)):
        return F.lit(v)
    return F.lit(v).cast("date") if isinstance(v, str) else F.lit(v)


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def asof_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    effdt: str = "effdt",
    asof=None,
    effseq: str | None = None,
    ties: str = "keep",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Rows in force at ``asof`` per key (D1, D2, D5; D6 when ``asof`` is None).

    ``ties='keep'`` keeps every row sharing the winning (effdt, effseq), like the
    correlated ``max`` subqueries; ``ties='any'`` returns exactly one row per key
    (``tiebreak`` columns make the choice deterministic).
    """
    keys = _keys(keys)
    if asof is not None:
        df = df.filter(F.col(effdt) <= _as_column(asof))
    order = [F.col(effdt).desc()] + ([F.col(effseq).desc()] if effseq else [])
    if ties == "any":
        w = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc() for c in tiebreak])
        fn = F.row_number()
    else:
        w = Window.partitionBy(*keys).orderBy(*order)
        fn = F.rank()
    # rank()/row_number() == 1 is planned as a partial WindowGroupLimit before
    # the shuffle, so a hot key is cut down on the map side.
    return df.withColumn("__rk", fn.over(w)).filter(F.col("__rk") == 1).drop("__rk")


def latest_rows(df: DataFrame, keys, effdt: str = "effdt", effseq: str | None = None) -> DataFrame:
    """Latest row per key with no upper date bound (future rows count) — D6."""
    return asof_rows(df, keys, effdt, None, effseq)


def active_asof(
    df: DataFrame,
    keys,
    effdt: str = "effdt",
    asof=None,
    effseq: str | None = None,
    status_col: str = "hr_status",
    active: str | Sequence[str] = "A",
) -> DataFrame:
    """Pick the row in force first, then keep it only when active.

    The order matters: a terminated latest row hides older active rows.
    """
    picked = asof_rows(df, keys, effdt, asof, effseq)
    act = [active] if isinstance(active, str) else list(active)
    return picked.filter(F.col(status_col).isin(act))


def next_effective(df: DataFrame, keys, effdt: str = "effdt", asof=None, name: str = "next_effdt") -> DataFrame:
    """Earliest effective date strictly after ``asof`` per key."""
    keys = _keys(keys)
    return (
        df.filter(F.col(effdt) > _as_column(asof))
        .groupBy(*keys)
        .agg(F.min(effdt).alias(name))
    )


def latest_date(df: DataFrame, keys, effdt: str = "effdt", asof=None, name: str = "latest_effdt") -> DataFrame:
    """Greatest effective date ``<= asof`` per key (one row per key)."""
    keys = _keys(keys)
    if asof is not None:
        df = df.filter(F.col(effdt) <= _as_column(asof))
    return df.groupBy(*keys).agg(F.max(effdt).alias(name))


def newer_record_audit(
    picked: DataFrame,
    history: DataFrame,
    keys,
    effdt: str = "effdt",
    run_date=None,
    now=None,
    picked_effdt: str | None = None,
    name: str = "audit_newer",
    message: str = "WARNING: NEWER JOB RECORD FOUND: ",
) -> DataFrame:
    """Flag picked rows older than the latest row as of ``now``.

    The warning is raised only when the run date lies in the past
    (``run_date < now``) and a newer row exists as of ``now``.
    """
    keys = _keys(keys)
    picked_effdt = picked_effdt or effdt
    newest = latest_date(history, keys, effdt, now, "__newest")
    out = picked.join(newest, on=keys, how="left")
    cond = (_as_column(run_date) < _as_column(now)) & (F.col(picked_effdt) < F.col("__newest"))
    msg = F.when(cond, F.concat(F.lit(message), F.date_format("__newest", "yyyy-MM-dd")))
    return out.withColumn(name, msg).drop("__newest")


def same_day_warning(effdt: Column | str, cur_effdt: Column | str, extra: Column | None = None,
                     message: str = "!Warning! Record already exists on ") -> Column:
    """Warning when a change is dated on the same day as the current row."""
    cond = col(effdt) == col(cur_effdt)
    if extra is not None:
        cond = cond & extra
    return F.when(cond, F.concat(F.lit(message), F.date_format(col(cur_effdt), "yyyy-MM-dd")))


def asof_dates(points: DataFrame, history: DataFrame, on: Sequence[str], date: str, effdt: str,
               history_on: Sequence[str] | None = None) -> DataFrame:
    """``__k0.., __d, __m``: per distinct (key, day) of ``points`` the last day of ``history`` up to it.

    Points and history are first reduced to one row per key and day (map-side
    partial aggregates), so however many rows a key has, its timeline has one row per
    calendar day at most; the running maximum over it carries the day forward.
    """
    names = [f"__k{i}" for i in range(len(on))]
    p = points.select(*[F.col(c).alias(n) for c, n in zip(on, names)], F.col(date).cast("date").alias("__d"), F.lit(True).alias("__p"))
    h = history.select(*[F.col(c).alias(n) for c, n in zip(history_on or on, names)], F.col(effdt).cast("date").alias("__d"),
                       F.lit(False).alias("__p"))
    days = p.unionByName(h).dropna(subset=[*names, "__d"]).groupBy(*names, "__d").agg(
        F.bool_or("__p").alias("__p"), F.bool_or(~F.col("__p")).alias("__h"))
    w = Window.partitionBy(*names).orderBy("__d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = days.withColumn("__m", F.max(F.when(F.col("__h"), F.col("__d"))).over(w))
    return days.filter(F.col("__p") & F.col("__m").isNotNull()).select(*names, "__d", "__m")


def day_rows(df: DataFrame, keys, effdt: str = "effdt", effseq: str | None = None, ties: str = "keep") -> DataFrame:
    """The rows that hold at the end of each day of a key: those of the day's greatest ``effseq``.

    ``ties='any'``: one of them, the greatest by its columns.
    """
    keys = _keys(keys)
    if ties == "any":
        rest = [c for c in df.columns if c not in [*keys, effdt]]
        best = F.max(F.struct(*([effseq] if effseq else []), *[c for c in rest if c != effseq]))
        return df.groupBy(*keys, effdt).agg(best.alias("__b")).select(*[F.col("__b")[c].alias(c) if c in rest else F.col(c) for c in df.columns])
    return asof_rows(df, [*keys, effdt], effseq) if effseq else df


def versions(df: DataFrame, keys, effdt: str = "effdt", effseq: str | None = None, valid_to: str = "valid_to") -> DataFrame:
    """History as intervals: each day's rows hold from ``effdt`` up to, not on, ``valid_to`` (NULL: still)."""
    keys = _keys(keys)
    days = day_rows(df.dropna(subset=[*keys, effdt]), keys, effdt, effseq)
    # in descending order the days before a row's are the later ones; rows of one day share the frame
    later = Window.partitionBy(*keys).orderBy(F.unix_date(effdt).desc()).rangeBetween(Window.unboundedPreceding, -1)
    return days.withColumn(valid_to, F.min(effdt).over(later))


def counts_over_time(intervals: DataFrame, key: str, effdt: str = "effdt", valid_to: str = "valid_to",
                     name: str = "head_count") -> DataFrame:
    """``key, effdt, <name>``: how many intervals of a key hold, from each day on which that changes.

    Starts and ends are summed per key and day before the shuffle, so a key with a
    third of the rows is one row per day.
    """
    ends = F.array(F.struct(F.col(effdt).alias("day"), F.lit(1).alias("n")), F.struct(F.col(valid_to).alias("day"), F.lit(-1).alias("n")))
    e = intervals.filter(F.col(key).isNotNull()).select(key, F.inline(ends)).filter(F.col("day").isNotNull())
    e = e.groupBy(key, "day").agg(F.sum("n").alias("n")).filter(F.col("n") != 0)
    w = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return e.select(key, F.col("day").alias(effdt), F.sum("n").over(w).alias(name))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_date: str,
    right_effdt: str = "effdt",
    right_effseq: str | None = None,
    right_cols: Sequence[str] | None = None,
    prefix: str = "",
    ties: str = "any",
    how: str = "left",
    right_on: str | Sequence[str] | None = None,
) -> DataFrame:
    """For each left row, the right row in force at the left row's own date (D3).

    Left outer by default: left rows with no right row at or before their date get
    NULLs; a NULL key or date matches nothing. ``right_cols`` are carried over
    (renamed with ``prefix``); the matched right ``effdt``/``effseq`` are returned as
    ``{prefix}{right_effdt}`` etc. ``ties='keep'`` returns every right row of the
    winning day and ``effseq``, ``'any'`` the greatest of them.

    Scale: the dates are matched on one row per key and day (``asof_dates``), then the
    rows follow by equi-joins on (key, day), which spread a hot key over its days and
    which AQE splits further; the work is linear in the rows, whatever the number of
    dates, and no task holds a key's history.
    """
    keys, rkeys = _keys(on), _keys(right_on or on)
    names = [f"__k{i}" for i in range(len(keys))]
    carry = list(dict.fromkeys([*(right_cols or []), right_effdt, *([right_effseq] if right_effseq else [])]))
    days = asof_dates(left, right, keys, left_date, right_effdt, rkeys)
    r = right.dropna(subset=[*rkeys, right_effdt])
    r = r.select(*[F.col(k).alias(n) for k, n in zip(rkeys, names)], F.col(right_effdt).cast("date").alias("__m"),
                 *[F.col(c).alias(f"__r_{c}") for c in carry])
    r = day_rows(r, names, "__m", f"__r_{right_effseq}" if right_effseq else None, ties)
    found = days.join(r, [*names, "__m"])
    met = [left[k] == found[n] for k, n in zip(keys, names)] + [left[left_date].cast("date") == found["__d"]]
    out = left.join(found, met, how)
    return out.select(*[left[c] for c in left.columns], *[F.col(f"__r_{c}").alias(prefix + c) for c in carry])


def left_asof(left: DataFrame, history: DataFrame, on: str, key: str, instance: Sequence[str], qualifies: Column,
              cols: dict[str, str], effdt: str = "effdt", effseq: str | None = None, asof=None,
              strict_outer: bool = False) -> DataFrame:
    """Left join to the qualifying rows in force of a partner, with the reference's row loss.

    ``left[on]`` names a partner (``history[key]``), whose records are told apart by
    ``instance``. A left row without any qualifying partner row, of any date, stays
    with NULLs; one whose partner has qualifying rows in force appears once per such
    row; one whose partner has qualifying rows but none in force is lost, unless
    ``strict_outer`` keeps it with NULLs. ``cols``: history column to output name.

    One pass over the history: per record its row in force and whether any row
    qualifies (partial aggregates), then per partner an array of its few records.
    """
    keys = [key, *[c for c in instance if c != key]]
    order = F.struct(effdt, *([effseq] if effseq else []))
    dated = F.lit(True) if asof is None else F.col(effdt) <= _as_column(asof)
    row = F.struct(F.coalesce(qualifies, F.lit(False)).alias("__ok"), *[F.col(c).alias(n) for c, n in cols.items()])
    records = history.groupBy(*keys).agg(F.max_by(row, F.when(dated, order)).alias("row"), F.bool_or(qualifies).alias("any"))
    partners = records.groupBy(F.col(key).alias("__k")).agg(
        F.filter(F.collect_list("row"), lambda r: r["__ok"]).alias("__rows"), F.bool_or("any").alias("__any"))
    out = left.join(partners, left[on] == partners["__k"], "left")
    if not strict_outer:
        out = out.filter(~F.coalesce("__any", F.lit(False)) | (F.size("__rows") > 0))
    out = out.select(*[left[c] for c in left.columns], F.explode_outer("__rows").alias("__r"))
    return out.select(*left.columns, *[F.col("__r")[n].alias(n) for n in cols.values()])
