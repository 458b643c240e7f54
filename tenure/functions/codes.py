"""HR code mappings as Column expressions — SURVEY B21-B29, J2a, J2b.

Every mapping is a ``CASE``/``isin``/``create_map`` expression; nothing
leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .oracle import col, decode

# Manager-level codes that mark a manager slot.
MANAGER_CODES = ["1", "2", "3", "6", "A", "B", "C"]

# Manager rank by code (a lower rank is a more senior level); other codes rank 9.
MANAGER_RANK = {"1": 2, "2": 0, "3": 1, "6": 3, "7": 5, "9": 6, "A": 1, "B": 2, "C": 3, "D": 4}

# Union codes whose members belong to company 001 (others 101).
COMPANY_001_UNIONS = ["73", "399"]

# Employee status codes meaning "on leave".
LEAVE_STATUSES = ["L", "P"]


def hours_category(hours, null_as: str = "F") -> Column:
    """Full/part/casual code from standard hours: <20 C, <36 P, else F.

    ``null_as='F'`` is B21 (NULL hours fall to ``F``); ``null_as='P'`` is the
    B22 variant written ``>=36 F, <20 C, else P``.
    """
    h = col(hours)
    if null_as == "P":
        return F.when(h >= 36, "F").when(h < 20, "C").otherwise("P")
    return F.when(h < 20, "C").when(h < 36, "P").otherwise("F")


def category_change(new_hours, cur_category, documented: bool = False) -> Column:
    """FT/PT/casual transition code or NULL when the category holds.

    Default reproduces the reference's code path: ``hours < 36 and cur = 'P'``
    is tested without a lower bound, so P -> casual never yields ``PTC``.
    ``documented=True`` follows the documented table instead.
    """
    h, c = col(new_hours), col(cur_category)
    if documented:
        same = ((h < 20) & (c == "C")) | ((h >= 20) & (h < 36) & (c == "P")) | ((h >= 36) & (c == "F"))
    else:
        same = ((h < 20) & (c == "C")) | ((h < 36) & (c == "P")) | ((h >= 36) & (c == "F"))
    return (
        F.when(same, F.lit(None).cast("string"))
        .when(h < 20, decode(c, {"F": "FTC"}, "PTC"))
        .when(h < 36, decode(c, {"F": "FTP"}, "CPT"))
        .otherwise(decode(c, {"P": "PTF"}, "CFT"))
    )


def is_manager(code) -> Column:
    """1 for a manager-level code, else 0 (B24; NULL -> 0 like ``decode``)."""
    return F.when(col(code).isin(MANAGER_CODES), 1).otherwise(0)


def manager_rank(code) -> Column:
    """Seniority rank of a manager-level code, 9 when unknown."""
    m = F.create_map(*[x for k, v in MANAGER_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[col(code)], F.lit(9))


def company_from_union(union_cd) -> Column:
    """B26."""
    return F.when(col(union_cd).isin(COMPANY_001_UNIONS), "001").otherwise("101")


def company_adjust(company, new_hours) -> Column:
    """Company 001 becomes 101 when the new hours fall under 20."""
    h = col(new_hours)
    return F.when(h.isNull() | (h >= 20), col(company)).otherwise(decode(col(company), {"001": "101"}, col(company)))


def snap_rate(new_rate, cur_rate, tolerance: float = 0.01) -> Column:
    """Keep the current rate when the new one is within ``tolerance``."""
    return F.when(F.abs(col(new_rate) - col(cur_rate)) < tolerance, col(cur_rate)).otherwise(col(new_rate))


def on_leave(empl_status) -> Column:
    """B29."""
    return F.when(col(empl_status).isin(LEAVE_STATUSES), 1).otherwise(0)


def casual_union_mismatch(new_category, union_cd) -> Column:
    """1 when a casual category meets a 001-company union."""
    return F.when(col(new_category).isin("F", "P"), 0).otherwise(
        F.when(col(union_cd).isin(COMPANY_001_UNIONS), 1).otherwise(0))


def action_reason(row_val, fpc_change, cur: dict, new: dict) -> Column:
    """Transfer action reason, first matching rule wins.

    ``cur``/``new`` map: deptid, jobcode, shift, std_hours, mgr_rank,
    sal_admin_plan, grade, hourly_rt to columns.
    """
    c = {k: col(v) for k, v in cur.items()}
    n = {k: col(v) for k, v in new.items()}
    rv = col(row_val)
    same_dj = (c["deptid"] == n["deptid"]) & (c["jobcode"] == n["jobcode"])
    same_plan = c["sal_admin_plan"] == n["sal_admin_plan"]
    return (
        F.when(rv == 2, col(fpc_change))
        .when(rv == 3, "TRE")
        .when(rv > 3, "N/A NOT PROGRAMMED FOR ADDITIONAL ROWS BEYOND row_val = 3")
        .when(same_dj & (c["shift"] != n["shift"]), "SFT")
        .when(same_dj & (c["std_hours"] != n["std_hours"]), "HRS")
        .when(c["mgr_rank"] > n["mgr_rank"], "PRO")
        .when(c["mgr_rank"] < n["mgr_rank"], "DEM")
        .when(same_plan & (c["grade"] < n["grade"]), "PRO")
        .when(same_plan & (c["grade"] > n["grade"]), "DEM")
        .when((c["jobcode"] != n["jobcode"]) & (c["hourly_rt"] < n["hourly_rt"]), "PRO")
        .when((c["deptid"] != n["deptid"]) | (c["jobcode"] != n["jobcode"]), "LTM")
        .otherwise("???")
    )


# Request comments handled as simple transfers.
SIMPLE_COMMENTS = ["Transfer", "FTE/Shift Changes"]


def complexity(id_req_count, hire_comments, union_mismatch, rcd_count, reports_to) -> tuple[Column, Column]:
    """Complexity flag and its reason — the two use different priority orders."""
    not_simple = F.when(col(hire_comments).isin(SIMPLE_COMMENTS), 0).otherwise(1) == 1
    flag = F.when(
        (col(id_req_count) > 1) | not_simple | (col(union_mismatch) == 1) | (col(rcd_count) > 1)
        | col(reports_to).isNull(), "Complex").otherwise("Simple")
    reason = (
        F.when(col(reports_to).isNull(), "Reports_to issue")
        .when(col(id_req_count) > 1, "Multiple Different Emplids")
        .when(col(rcd_count) > 1, "Multiple active empl_rcds")
        .when(col(union_mismatch) == 1, "Casual Union Mismatch")
        .when(not_simple, "Non Tfr/FTE/Shift Change")
    )
    return flag, reason
