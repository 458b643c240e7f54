"""Refund split: pasted refund rows -> active paysheet lines + former employees.

Plan: parse pastes (narrow) -> pick one employment record per person
(``pick_one``: primary job, else any; one shuffle on emplid, partial
top-1 before it) -> inner join for the active paysheet file, left-anti join
for the former-employee list. The pick is computed once and shared by both
outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.oracle import col, to_number
from ..operators.match import pick_one
from ..session import cut_lineage
from ..sources.paste import clean_token, field_collapsed, split_rows

REFUND_FIELDS = ["emplid", "co", "ded_cd", "ded_classification", "paysheet_one_time_code", "amount"]


def parse_refunds(pastes: DataFrame, text_col: str = "text", amount_type: str = "decimal(38,10)") -> DataFrame:
    """Six collapsed-pipe fields per pasted row."""
    rows = split_rows(pastes, text_col, ",", keep_tab=True)
    v = F.col("value")

    def fld(n):
        # trim(replace(field, apostrophe)); '' is NULL
        t = F.trim(F.replace(field_collapsed(v, n), F.lit("'"), F.lit("")))
        return F.when(t != "", t)

    out = rows.select(
        *[c for c in rows.columns if c != "value"],
        *[fld(i + 1).alias(name) for i, name in enumerate(REFUND_FIELDS[:-1])],
        to_number(fld(6), amount_type).alias("amount"),
    )
    return out


def employee_pick(employees: DataFrame) -> DataFrame:
    """One record per person: primary (``P``) jobs only when one exists."""
    return pick_one(
        employees,
        "emplid",
        [col("reg_temp").asc_nulls_last(), col("std_hours").desc_nulls_first(), col("empl_rcd").asc_nulls_last()],
        prefer=F.col("job_indicator") == "P",
    ).select("emplid", "empl_rcd", "company", "paygroup")


def active_paysheet(refunds: DataFrame, pick: DataFrame) -> DataFrame:
    """Paysheet file rows for refunds of current employees (E13 + A17)."""
    j = refunds.filter(F.col("emplid").isNotNull()).join(pick, "emplid", "inner")
    null = F.lit(None).cast("string")
    # Paysheet layout constants.
    return j.select(
        *[c for c in ("paste_id", "row_pos") if c in refunds.columns],
        F.lit("OT").alias("paysheet_update_source"),
        null.alias("creation_date"),
        F.col("company"),
        F.col("paygroup").alias("pay_group"),
        F.lit("N").alias("off_cycle"),
        F.col("emplid"),
        F.col("empl_rcd"),
        null.alias("sequence_nbr"),
        F.lit("D").alias("paysheet_transaction_type"),
        F.lit("A").alias("transaction_status"),
        F.col("paysheet_one_time_code").alias("paysheet_code_addition_or_refund"),
        F.lit("00").alias("plan_type"),
        null.alias("benefit_plan"),
        F.col("ded_cd").alias("deduction_cd"),
        F.col("ded_classification").alias("before_after_tax"),
        F.lit("A").alias("ded_calc_routine"),
        F.col("amount"),
        F.lit("N").alias("annual_check"),
        F.lit("B").alias("sales_tax_type"),
    )


def termed_list(refunds: DataFrame, pick: DataFrame) -> DataFrame:
    """Refunds with no current employee, code and amount present."""
    j = refunds.join(pick.select("emplid"), "emplid", "left_anti")
    j = j.filter(F.col("ded_cd").isNotNull() & F.col("amount").isNotNull())
    return j.select(
        *[c for c in ("paste_id", "row_pos") if c in refunds.columns],
        "emplid",
        F.col("ded_cd").alias("deduction_cd"),
        F.col("paysheet_one_time_code").alias("paysheet_code_addition_or_refund"),
        "amount",
        F.col("ded_classification").alias("before_after_tax"),
    )


def refund_split(pastes: DataFrame, employees: DataFrame) -> dict[str, DataFrame]:
    """Both outputs of one run, from one parse and one pick, written once."""
    refunds = cut_lineage(parse_refunds(pastes))
    pick = cut_lineage(employee_pick(employees))
    return {"active": active_paysheet(refunds, pick), "termed": termed_list(refunds, pick)}


def report_order(active: bool) -> list[Column]:
    """Of the active file (by person and record) and of the leavers' list (by person); a paste's rows in their order (H1)."""
    return [col("emplid").asc_nulls_last(), *([col("empl_rcd").asc_nulls_last()] if active else []), col("paste_id").asc(), col("row_pos").asc()]
