"""Keyed lookups — SURVEY A13.

``business_email``: e-mail of type BUSN per employee id, '' when absent.
Where several rows exist the greatest address wins (deterministic stand-in
for the reference's "last row returned wins"). A grouped aggregate plus a
left join — never an ``IN (...)`` list spliced into SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def business_email(records: DataFrame, id_col: str, emails: DataFrame, addr_type: str = "BUSN",
                   out_col: str = "email") -> DataFrame:
    e = (emails.filter(F.col("e_addr_type") == addr_type)
         .groupBy(F.col("emplid").alias("__id"))
         .agg(F.max("email_addr").alias("__email")))
    out = records.join(e, records[id_col] == e["__id"], "left")
    return out.withColumn(out_col, F.coalesce(F.col("__email"), F.lit(""))).drop("__id", "__email")
