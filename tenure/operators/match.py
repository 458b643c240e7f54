"""Correlated lookups re-expressed as joins + windows — SURVEY 2.E.

* ``headcount``: incumbents per slot, one partial-aggregated shuffle.
* ``best_match``: the "lateral top-1" (best existing row with all fields
  equal) as one multi-key left join to the top one or two candidates per
  field combination.
* ``pick_one``: best row per key with an optional "prefer flagged rows" rule.
* ``resolve_unique``: a value only when exactly one qualifying row exists.
* ``expand_rows``: conditional row generation (lateral union all).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.oracle import col


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def headcount(active_jobs: DataFrame, position_col: str = "position_nbr", name: str = "head_count",
              count_col: str | None = None) -> DataFrame:
    """Incumbents per position from an already as-of'd, active job frame."""
    agg = F.count(count_col) if count_col else F.count(F.lit(1))
    return active_jobs.groupBy(position_col).agg(agg.alias(name))


def with_headcount(df: DataFrame, counts: DataFrame, on: str, count_name: str = "head_count",
                   df_key: str | None = None) -> DataFrame:
    """Left join a head-count frame, 0 when the slot has no incumbent."""
    if df_key and df_key != on:
        counts = counts.withColumnRenamed(on, df_key)
        on = df_key
    return df.join(counts, on=on, how="left").withColumn(count_name, F.coalesce(F.col(count_name), F.lit(0)))


def best_match(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    order_by: Sequence["Sort"],
    left_id: Sequence[str],
    right_cols: Sequence[str],
    eligible: Column | None = None,
    exclude: tuple[str, str] | None = None,
    prefer: tuple[str, str] | None = None,
    left_gate: Column | None = None,
) -> DataFrame:
    """Left join each driving row to its single best right row.

    ``on``: (left column, right column) equality pairs; NULL never matches.
    ``order_by``: ``Sort`` keys on right columns, ending with a unique key.
    ``left_id`` names what tells driving rows apart; equal ones get equal matches.
    ``eligible``: predicate on right columns (e.g. the manager-capacity rule).
    ``exclude``: (left, right): candidates equal to the left value do not count
    (the driving row's own slot). ``prefer``: (left, right): the candidate equal
    to the left value wins, eligible or not (an occupied own slot stays a match);
    the right column must be unique. ``left_gate``: only rows that satisfy it
    look a match up.

    The candidates' order does not depend on the driving row, so the first one
    of a combination of equality fields wins (the second, if the first can be
    excluded). These are kept as a short array per combination; one left join on
    the combination and an expression do the rest.
    """
    keep = 2 if exclude else 1
    rk = [b for _, b in on]
    cols = list(dict.fromkeys([*right_cols, *([exclude[1]] if exclude else [])]))
    cand = right.dropna(subset=rk)
    best = cand if eligible is None else cand.filter(eligible)
    best = best.withColumn("__rn", F.row_number().over(Window.partitionBy(*rk).orderBy(*[o.column() for o in order_by])))
    best = best.filter(F.col("__rn") <= keep).groupBy(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(rk)]).agg(
        F.array_sort(F.collect_list(F.struct("__rn", *cols))).alias("__best"))
    gate = F.lit(True) if left_gate is None else F.coalesce(left_gate, F.lit(False))
    out = left.withColumn("__gate", gate)
    met = [(out[a] == best[f"__c{i}"]) for i, (a, _) in enumerate(on)]
    out = out.join(best, on=[out["__gate"], *met], how="left").drop(*[f"__c{i}" for i in range(len(on))])
    found = F.col("__best")
    if exclude:
        found = F.filter(found, lambda x: F.col(exclude[0]) != x[exclude[1]])
    found = F.get(found, 0)
    picked = {c: found[c] for c in right_cols}
    if prefer:
        own = cand.select(F.col(prefer[1]).alias("__own"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(rk)],
                          F.struct(*[F.col(c) for c in right_cols]).alias("__slot"))
        met = [out[a] == own[f"__c{i}"] for i, (a, _) in enumerate(on)]
        out = out.join(own, on=[out["__gate"], out[prefer[0]] == own["__own"], *met], how="left")
        picked = {c: F.when(F.col("__slot").isNotNull(), F.col("__slot")[c]).otherwise(v) for c, v in picked.items()}
    return out.select(*left.columns, *[v.alias(c) for c, v in picked.items()])


class Sort:
    """A sort key on a right-side column: ``Sort("head_count", desc=True)``."""

    def __init__(self, name: str, desc: bool = False, nulls_first: bool | None = None):
        self.name, self.desc = name, desc
        # Oracle default: NULLS LAST ascending, NULLS FIRST descending
        self.nulls_first = desc if nulls_first is None else nulls_first

    def column(self, prefix: str = "") -> Column:
        c = F.col(prefix + self.name)
        if self.desc:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def pick_one(df: DataFrame, keys, order_by: Sequence[Column], prefer: Column | None = None) -> DataFrame:
    """Best row per key.

    With ``prefer``: if any row of the key satisfies it, only such rows
    compete; otherwise all rows do (``flag = P or not exists(P)``), so it is the
    first sort key. ``row_number() = 1`` becomes a partial WindowGroupLimit
    before the shuffle.
    """
    keys = _keys(keys)
    first = [] if prefer is None else [F.coalesce(prefer, F.lit(False)).desc()]
    w = Window.partitionBy(*keys).orderBy(*first, *order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def resolve_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    value: str,
    name: str,
    distinct: bool = False,
) -> DataFrame:
    """Attach ``value`` from ``right`` only when exactly one right row matches.

    ``distinct=True`` counts distinct values instead of rows (E16: exactly one
    distinct emplid for a name). The count is a grouped aggregate on the
    right's key — partial-aggregated, so a hot key costs one row per map task.
    """
    agg = (F.count_distinct(value) if distinct else F.count(F.lit(1)))
    uniq = (
        right.groupBy(*[F.col(b).alias(f"__u{i}") for i, (_, b) in enumerate(on)])
        .agg(agg.alias("__n"), F.min(value).alias(name))
        .filter(F.col("__n") == 1)
        .drop("__n")
    )
    cond = [F.col(a) == F.col(f"__u{i}") for i, (a, _) in enumerate(on)]
    return left.join(uniq, on=cond, how="left").drop(*[f"__u{i}" for i in range(len(on))])


def expand_rows(df: DataFrame, variants: Sequence[tuple[Column, Column]], pos_name: str = "row_val",
                total_name: str | None = "row_total", total_keep: Sequence[Column] | None = None,
                value_name: str = "variant") -> DataFrame:
    """Generate 1..n rows per input row.

    ``variants``: (keep predicate, value) pairs in output order; rows whose
    predicate is false are skipped and the survivors are numbered 1.. in order.
    ``total_keep`` optionally gives the predicates used for the total (they may
    differ from the keep predicates, as in the reference's NULL handling).
    """
    arr = F.filter(
        F.array(*[F.struct(k.alias("keep"), v.alias("value")) for k, v in variants]),
        lambda x: F.coalesce(x["keep"], F.lit(False)),
    )
    out = df.select("*", F.posexplode(arr).alias("__pos", "__v"))
    out = out.withColumn(pos_name, (F.col("__pos") + 1).cast("int")).withColumn(value_name, F.col("__v")["value"])
    if total_name:
        preds = total_keep if total_keep is not None else [k for k, _ in variants]
        total = sum(F.when(F.coalesce(p, F.lit(False)), 1).otherwise(0) for p in preds)
        out = out.withColumn(total_name, total.cast("int"))
    return out.drop("__pos", "__v")
