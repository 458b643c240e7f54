"""Mail merge re-aimed to Spark.

CSV recipients -> per-column transformers -> business e-mail lookup ->
per-recipient rendering and validation (individual mode), or one BCC
message per batch of recipients (BCC mode). Rendering is a static chain of
``regexp_replace`` calls over the record's columns, so the whole job is one
narrow projection plus one join for the lookup; BCC groups are bounded by
``batch_size``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.lookups import business_email

Transformer = Callable[[Column], Column]

TRANSFORMERS: dict[str, Transformer] = {
    "capitalize": T.capitalize,
    "currency": T.currency,
    "currency_with_symbol": lambda c: T.currency(c, "$"),
}


def apply_transforms(df: DataFrame, spec: dict[str, Transformer | str]) -> DataFrame:
    """Per-column transformers (B43); a NULL result keeps the raw value."""
    cols = {}
    for c, fn in spec.items():
        f = TRANSFORMERS[fn] if isinstance(fn, str) else fn
        cols[c] = F.coalesce(f(F.col(c)), F.col(c))
    return df.withColumns(cols)


def render_fields(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[tuple[str, Column]]:
    return [(c, F.col(c)) for c in df.columns if c not in exclude]


def individual(records: DataFrame, emails: DataFrame, id_col: str, subject: Column, body: Column,
               field_cols: list[str]) -> DataFrame:
    """One rendered message per recipient with its status (J7 individual mode)."""
    r = business_email(records, id_col, emails)
    fields = [(c, F.col(c)) for c in field_cols + ["email"]]
    subj = T.render(subject, fields)
    html = T.render(body, fields)
    left = F.array_union(T.unreplaced(subj), T.unreplaced(html))
    status = (F.when(F.col("email") == "", "no email")
              .when(~T.valid_email("email"), "invalid email")
              .when(F.size(left) > 0, "sent with unreplaced")
              .otherwise("sent"))
    return r.select(id_col, F.col("email").alias("to"), subj.alias("subject"), html.alias("body"),
                    F.array_sort(left).alias("unreplaced"), status.alias("status"))


def summary(messages: DataFrame) -> DataFrame:
    """Run summary counts by status (F8)."""
    return messages.groupBy("status").agg(F.count(F.lit(1)).alias("messages"))


def bcc(records: DataFrame, emails: DataFrame, id_col: str, subject: Column, body: Column,
        field_cols: list[str], batch_size: int = 500, parts: int = 64) -> DataFrame:
    """BCC messages of at most ``batch_size`` recipients, rendered from each one's first record.

    Records are dealt to ``parts`` by a hash of the id, numbered in each part in
    order of the id, and cut into batches, so no group holds more than a batch.
    Any address with ``@`` counts as a recipient; they stand in record order.
    """
    r = business_email(records, id_col, emails)
    part = (F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 6), 16, 10).cast("long") % parts)
    r = r.withColumn("part", F.coalesce(part, F.lit(0)))
    order = Window.partitionBy("part").orderBy(F.col(id_col).asc_nulls_last(), *[F.col(c) for c in field_cols], "email")
    r = r.withColumn("__n", F.row_number().over(order)).withColumn("batch", F.floor((F.col("__n") - 1) / batch_size))
    fields = [(c, F.col(c)) for c in field_cols]
    first = F.min_by(F.struct(T.render(subject, fields).alias("s"), T.render(body, fields).alias("b")), "__n")
    valid = F.when(F.col("email").contains("@"), F.struct("__n", F.trim("email").alias("to")))
    return r.groupBy("part", "batch").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(valid)), lambda x: x["to"]), ";").alias("bcc"),
        F.count(valid).alias("recipients"),
        first["s"].alias("subject"), first["b"].alias("body"),
    )
