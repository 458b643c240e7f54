"""The query catalog: one Spark plan per operator / workflow.

Every entry takes ``(spark, sf_dir)``, reads the driver tables (through the
derived fixtures) and returns a DataFrame whose column names match the
DuckDB oracle in ``oracles.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import effdt as D
from ..operators import match as M
from ..sources import fixtures as FX
from . import bulk_paf as BP

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed as-of dates used by the catalog (inside the fixture's 1995-2001 range).
ASOF = "1998-06-30"
NOW = "2000-12-31"

JOB_KEYS = ["emplid", "empl_rcd"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def active_jobs(spark, sf, asof=ASOF) -> DataFrame:
    return D.active_asof(FX.job(spark, sf), JOB_KEYS, "effdt", asof, "effseq")


@query
def asof_latest_job(spark, sf):
    """D1+D2: job row in force at ASOF per employment instance."""
    j = D.asof_rows(FX.job(spark, sf), JOB_KEYS, "effdt", ASOF, "effseq")
    return j.select("emplid", "empl_rcd", "effdt", "effseq", "hr_status", "position_nbr", "deptid")


@query
def asof_active_job(spark, sf):
    """Pick the row in force, then keep it only if active."""
    return active_jobs(spark, sf).select("emplid", "empl_rcd", "effdt", "effseq", "position_nbr")


@query
def latest_unbounded(spark, sf):
    """Latest position version without a date bound."""
    p = D.latest_rows(FX.position_data(spark, sf), "position_nbr", "effdt")
    return p.select("position_nbr", "effdt", "eff_status", "deptid")


@query
def position_headcount(spark, sf):
    """E6+F1: active slots as of ASOF with their active incumbent count (0 if none)."""
    pos = D.active_asof(FX.position_data(spark, sf), "position_nbr", "effdt", ASOF, status_col="eff_status")
    counts = M.headcount(active_jobs(spark, sf))
    out = M.with_headcount(pos, counts, "position_nbr")
    return out.select("position_nbr", "max_head_count", "head_count",
                      (F.col("head_count") > F.col("max_head_count")).alias("over_capacity"))


@query
def future_and_newer_audit(spark, sf):
    """D8+D9+D10: next future change, newer-record warning and same-day flag."""
    job = FX.job(spark, sf)
    cur = D.asof_rows(job, JOB_KEYS, "effdt", ASOF, "effseq").select(*JOB_KEYS, "effdt", "effseq")
    nxt = D.next_effective(job, JOB_KEYS, "effdt", ASOF, "next_effdt")
    out = cur.join(nxt, JOB_KEYS, "left")
    out = D.newer_record_audit(out, job, JOB_KEYS, "effdt", run_date=ASOF, now=NOW)
    run = F.lit(ASOF).cast("date")
    return out.select(
        *JOB_KEYS, F.col("effdt").alias("cur_effdt"), "effseq", "next_effdt", "audit_newer",
        D.same_day_warning(F.date_add(run, 0), "effdt").alias("audit_effdt_exists"),
    )


# ---------------------------------------------------------------- J5 refunds
from . import refunds as R  # noqa: E402


def _refund_parts(spark, sf):
    return R.parse_refunds(FX.refund_pastes(spark, sf)), R.employee_pick(FX.employees(spark, sf))


@query
def refunds_active(spark, sf):
    """J5 active paysheet file."""
    refunds, pick = _refund_parts(spark, sf)
    return R.active_paysheet(refunds, pick)


@query
def refunds_termed(spark, sf):
    """J5 former-employee refund list."""
    refunds, pick = _refund_parts(spark, sf)
    return R.termed_list(refunds, pick)


@query
def primary_job_pick(spark, sf):
    """E11+E12: one employment record per person, primary first."""
    return R.employee_pick(FX.employees(spark, sf))


# ------------------------------------------------------- D/E operator queries
from ..functions import codes as C  # noqa: E402
from ..functions import oracle as O  # noqa: E402
from ..operators import diff as X  # noqa: E402
from ..operators.match import Sort  # noqa: E402

START = "1999-01-01"   # transfer start date (the fixture's :STARTING_DATE)
OFFICER_EXCLUDED = ["9", "7", "D"]


@query
def manager_by_position(spark, sf):
    """D7+E4: each incumbent's managers: whoever's record is the latest dated one of the
    reports_to slot up to the incumbent's own date, in any status, ties kept."""
    cur = active_jobs(spark, sf).select("emplid", "empl_rcd", "reports_to", "effdt")
    return NS.slot_holders(cur, FX.job(spark, sf)).select("emplid", "empl_rcd", "reports_to", "mgr_emplid", "mgr_empl_rcd")


def _managed(spark, sf, strict_outer):
    cands = FX.candidates(spark, sf).filter(F.col("load_status") == "N").select("req_num", "manager_id")
    ok = (F.col("hr_status") == "A") & ~F.col("officer_cd").isin(OFFICER_EXCLUDED)
    out = D.left_asof(cands, FX.job(spark, sf), "manager_id", "emplid", JOB_KEYS, ok,
                      {"empl_rcd": "mgr_empl_rcd", "position_nbr": "mgr_position_nbr"}, "effdt", "effseq", NOW, strict_outer)
    return out.withColumn("mgr_position_nbr", F.coalesce("mgr_position_nbr", F.lit("XXXXXXXX")))


@query
def left_asof_drop_quirk(spark, sf):
    """Candidates left-joined to their manager's active rows, keeping only rows in force.

    Reproduces the reference: a candidate whose manager has active rows but
    none in force disappears.
    """
    return _managed(spark, sf, strict_outer=False)


@query
def left_asof_strict(spark, sf):
    """D11, strict: as above, but no candidate disappears."""
    return _managed(spark, sf, strict_outer=True)


@query
def asof_per_row(spark, sf):
    """D3: the manager's records (every employment) in force at each candidate's own hire date."""
    cands = FX.candidates(spark, sf).select("req_num", "hire_dt", "manager_id")
    cands = cands.withColumn("mgr_empl_rcd", F.explode(F.array(F.lit(0), F.lit(1))))
    return D.asof_join(cands, FX.job(spark, sf), ["manager_id", "mgr_empl_rcd"], "hire_dt", "effdt", "effseq",
                       right_cols=["position_nbr", "hr_status"], prefix="mgr_", right_on=JOB_KEYS)


POS_FIELDS = ["business_unit", "deptid", "location", "jobcode", "company", "std_hours",
              "reports_to", "union_cd", "shift", "reg_temp", "flsa_status"]


def _positions_with_counts(spark, sf, asof):
    pos = D.active_asof(FX.position_data(spark, sf), "position_nbr", "effdt", asof, status_col="eff_status")
    counts = M.headcount(active_jobs(spark, sf, asof))
    return M.with_headcount(pos, counts, "position_nbr")


@query
def best_position_match(spark, sf):
    """E7+E8+H2: best other active slot whose 11 fields equal the incumbent's own values."""
    cur = active_jobs(spark, sf).select("emplid", "empl_rcd", F.col("position_nbr").alias("cur_pos"),
                                        *POS_FIELDS)
    pos = _positions_with_counts(spark, sf, ASOF)
    eligible = F.col("manager_level").isNotNull() & ((C.is_manager("manager_level") == 0) | (F.col("head_count") == 0))
    out = M.best_match(
        cur, pos, on=[(f, f) for f in POS_FIELDS],
        order_by=[Sort("head_count", desc=True), Sort("max_head_count", desc=True), Sort("position_nbr")],
        left_id=JOB_KEYS, right_cols=["position_nbr", "head_count", "max_head_count"],
        eligible=eligible, exclude=("cur_pos", "position_nbr"),
    )
    return out.select("emplid", "empl_rcd", "cur_pos", F.col("position_nbr").alias("tfr_pos"),
                      F.col("head_count").alias("tfr_pos_head_count"),
                      F.col("max_head_count").alias("tfr_pos_max_head_count"))


def _hire_requests(spark, sf):
    h = FX.hires(spark, sf).filter((F.col("hire_comments") != " ") & (F.col("start_date") == F.lit(START).cast("date")))
    return h


def _unique_managers(spark, sf, hires):
    inforce = D.active_asof(FX.job(spark, sf), JOB_KEYS, "effdt", START, "effseq")
    guard = (F.col("mgr_id") != " ") & (F.length("mgr_id") == 6) & O.all_digits("mgr_id")
    h = hires.withColumn("__mgr_key", F.when(guard, F.col("mgr_id")))
    h = M.resolve_unique(h, inforce.filter(C.is_manager("officer_cd") == 1),
                         [("__mgr_key", "emplid")], "position_nbr", "edw_reports_to")
    h = M.resolve_unique(h, inforce, [("__mgr_key", "emplid")], "position_nbr", "edw_anyvalue_reports_to")
    return h.drop("__mgr_key")


@query
def unique_manager_resolve(spark, sf):
    """The hiring manager's slot only when exactly one qualifying in-force row exists."""
    h = _unique_managers(spark, sf, _hire_requests(spark, sf).select("req_num", "mgr_id"))
    return h.select("req_num", "mgr_id", "edw_reports_to", "edw_anyvalue_reports_to")


def _resolve_names(spark, sf, hires):
    nm = D.asof_rows(FX.names(spark, sf).filter(F.col("name_type") == "PRI"),
                     ["emplid", "name_type"], "effdt", NOW)
    act = D.active_asof(FX.job(spark, sf), JOB_KEYS, "effdt", START, "effseq").filter(F.col("per_org") == "EMP")
    people = nm.join(act.select("emplid").distinct(), "emplid", "left_semi")
    return M.resolve_unique(hires, people, [("name", "name_display")], "emplid", "resolved_emplid", distinct=True)


@query
def unique_name_resolve(spark, sf):
    """E16+G6: blank-emplid requests resolved by exact current name, only when one person matches."""
    h = _hire_requests(spark, sf).filter(F.col("emplid") == " ").select("req_num", "name")
    return _resolve_names(spark, sf, h).select("req_num", "name", "resolved_emplid")


def _job_vs_position(spark, sf):
    cur = active_jobs(spark, sf)
    pos = D.asof_rows(FX.position_data(spark, sf), "position_nbr", "effdt", ASOF)
    p = pos.select("position_nbr", *[F.col(c).alias("p_" + c) for c in POS_FIELDS + ["update_incumbents", "include_title", "full_part_time"]])
    return cur.join(p, "position_nbr", "inner")


@query
def field_diff(spark, sf):
    """B32+B33+B18+B30: override diff string and exact-equality flag, job vs its slot."""
    j = _job_vs_position(spark, sf)
    pairs = [(F.col(c), F.col("p_" + c)) for c in POS_FIELDS]
    return j.select("emplid", "empl_rcd", F.col("position_nbr").alias("cur_pos"),
                    X.fields_equal(pairs).alias("override_diff_check"),
                    X.field_diff(BP.override_fields("", "p_")).alias("override_remaining_values_diff"))


@query
def changed_fields_load(spark, sf):
    """B35+A14+B36: change-only position update line (job values proposed over the slot's)."""
    j = _job_vs_position(spark, sf)
    run = F.lit(ASOF).cast("date")
    slots = [F.col("position_nbr"), O.date_text(run), F.lit("A"), F.lit("REORG")]
    for c in ["business_unit", "deptid", "jobcode"]:
        slots.append(X.changed_only(c, "p_" + c))
    slots.append(F.lit(None).cast("string"))
    slots.append(O.decode("p_update_incumbents", {"Y": F.lit(None).cast("string")}, "Y"))
    for c in ["reports_to", "location", "company"]:
        slots.append(X.changed_only(c, "p_" + c))
    slots.append(O.num_text(X.changed_only("std_hours", "p_std_hours")))
    for c in ["union_cd", "shift", "reg_temp"]:
        slots.append(X.changed_only(c, "p_" + c))
    slots.append(X.changed_only(C.hours_category("std_hours"), "p_full_part_time"))
    slots.append(X.changed_only("flsa_status", "p_flsa_status"))
    slots.append(O.decode("p_include_title", {"Y": F.lit(None).cast("string")}, "Y"))
    return j.select("emplid", "empl_rcd", X.load_string(*slots).alias("position_update_load"),
                    X.next_effseq("effdt", run, "effseq").cast("int").alias("next_effseq"))


def _identified(spark, sf) -> DataFrame:
    """Requests with the person's id, given or found by an unambiguous name."""
    h = _hire_requests(spark, sf)
    given = h.filter(F.col("emplid") != " ").withColumn("emplid", F.trim("emplid"))
    found = _resolve_names(spark, sf, h.filter(F.col("emplid") == " ")).filter(F.col("resolved_emplid").isNotNull())
    return given.unionByName(found.withColumn("emplid", F.col("resolved_emplid")).drop("resolved_emplid"))


def _hires_with_job(spark, sf):
    h = _identified(spark, sf)
    act = D.active_asof(FX.job(spark, sf), JOB_KEYS, "effdt", START, "effseq").filter(F.col("per_org") == "EMP")
    a = act.select("emplid", "empl_rcd", *[F.col(c).alias("cur_" + c) for c in
                   ["effdt", "effseq", "deptid", "jobcode", "std_hours", "shift", "reg_temp", "full_part_time",
                    "company", "union_cd", "hourly_rt", "position_nbr", "officer_cd"]])
    h = h.select("req_num", "emplid", "name", "hire_comments", "mgr_id",
                 *[F.col(c).alias("edw_" + c) for c in ["deptid", "jobcode", "std_hours", "shift", "reg_temp", "hourly_rt"]])
    return h.join(a, "emplid", "inner")


@query
def row_expansion(spark, sf):
    """E18+I2: primary row, + FT/PT category change row, + reg/temp change row."""
    j = _hires_with_job(spark, sf)
    fpc = C.category_change("edw_std_hours", "cur_full_part_time")
    variants = [
        (F.lit(True), F.struct(F.lit(1).alias("row_val"), F.lit("Primary Row").alias("row_def"))),
        (fpc.isNotNull(), F.struct(F.lit(2).alias("row_val"), F.lit("FPC cat change").alias("row_def"))),
        (F.col("edw_reg_temp") != F.col("cur_reg_temp"),
         F.struct(F.lit(3).alias("row_val"), F.lit("reg_temp change").alias("row_def"))),
    ]
    total_keep = [F.lit(True), fpc.isNotNull(), ~F.col("edw_reg_temp").eqNullSafe(F.col("cur_reg_temp"))]
    out = M.expand_rows(j, variants, pos_name="row_rn", total_name="row_total", total_keep=total_keep)
    return out.select("req_num", "emplid", "empl_rcd", F.col("variant.row_val").alias("row_val"),
                      F.col("variant.row_def").alias("row_def"), "row_rn", "row_total")


@query
def fpc_change(spark, sf):
    """Hour categories (both NULL rules), transition code, company and rate rules."""
    j = _hires_with_job(spark, sf)
    jc = D.asof_rows(FX.jobcode_tbl(spark, sf).filter(F.col("setid") == "SHARE"), ["setid", "jobcode"], "effdt", NOW)
    e = jc.select(F.col("jobcode").alias("edw_jobcode"), F.col("union_cd").alias("edw_jc_union_cd"))
    j = j.join(e, "edw_jobcode", "inner")
    gen = C.hours_category("edw_std_hours")
    return j.select(
        "req_num", "emplid", "empl_rcd",
        gen.alias("edw_generated_fpc"),
        C.hours_category("edw_std_hours", null_as="P").alias("fpc_null_as_p"),
        C.category_change("edw_std_hours", "cur_full_part_time").alias("generated_fpc_analysis"),
        C.category_change("edw_std_hours", "cur_full_part_time", documented=True).alias("documented_fpc_analysis"),
        C.casual_union_mismatch(gen, "edw_jc_union_cd").alias("fpc_union_mismatch"),
        C.company_from_union("edw_jc_union_cd").alias("edw_jc_company"),
        C.company_adjust("cur_company", "edw_std_hours").alias("company_adjusted"),
        C.snap_rate("edw_hourly_rt", "cur_hourly_rt").alias("corrected_hourly_rt"),
        C.is_manager("cur_officer_cd").alias("cur_is_mgr"),
        C.manager_rank("cur_officer_cd").alias("cur_mgr_rank"),
    )


# ------------------------------------------------------------ scalar helpers
@query
def clean_phone(spark, sf):
    """B4+B8+B9: digits-only phone, all-digits predicate, safe numeric sort key."""
    c = FX.candidates(spark, sf)
    return c.select("req_num", O.digits_only("home_phone").alias("home_phone"),
                    O.all_digits("req_num").alias("req_is_number"),
                    O.to_number_or_zero("req_num", "decimal(20,0)").alias("num_order"))


@query
def trailing_id(spark, sf):
    """B6+B7+B13+B12: message prefix strip, trailing 6-digit id, 2-decimal rate text."""
    c = FX.candidates(spark, sf)
    return c.select("req_num", O.strip_prefix("message_descr").alias("message_descr"),
                    O.trailing_id("message_descr").alias("lm_emplid"),
                    O.fm_2dp("hourly_rt").alias("hourly_pay"),
                    O.date_text("hire_dt").alias("hire_dt"))


@query
def action_reason(spark, sf):
    """Transfer action reason per expanded row (rules in priority order)."""
    j = _hires_with_job(spark, sf)
    jc = D.asof_rows(FX.jobcode_tbl(spark, sf).filter(F.col("setid") == "SHARE"), ["setid", "jobcode"], "effdt", NOW)
    jc = jc.select("jobcode", C.manager_rank("manager_level").alias("rank"), "sal_admin_plan", "grade")
    cur = jc.select(F.col("jobcode").alias("cur_jobcode"), *[F.col(c).alias("cur_jc_" + c) for c in ["rank", "sal_admin_plan", "grade"]])
    new = jc.select(F.col("jobcode").alias("edw_jobcode"), *[F.col(c).alias("edw_jc_" + c) for c in ["rank", "sal_admin_plan", "grade"]])
    j = j.join(cur, "cur_jobcode", "inner").join(new, "edw_jobcode", "inner")
    fpc = C.category_change("edw_std_hours", "cur_full_part_time")
    j = j.withColumn("fpc", fpc)
    variants = [(F.lit(True), F.lit(1)), (F.col("fpc").isNotNull(), F.lit(2)),
                (F.col("edw_reg_temp") != F.col("cur_reg_temp"), F.lit(3))]
    j = M.expand_rows(j, variants, pos_name="row_rn", total_name=None, value_name="row_val")
    rate = C.snap_rate("edw_hourly_rt", "cur_hourly_rt")
    keys = ["deptid", "jobcode", "shift", "std_hours"]
    cur_m = {k: "cur_" + k for k in keys} | {"mgr_rank": "cur_jc_rank", "sal_admin_plan": "cur_jc_sal_admin_plan",
                                             "grade": "cur_jc_grade", "hourly_rt": "cur_hourly_rt"}
    new_m = {k: "edw_" + k for k in keys} | {"mgr_rank": "edw_jc_rank", "sal_admin_plan": "edw_jc_sal_admin_plan",
                                             "grade": "edw_jc_grade", "hourly_rt": rate}
    return j.select("req_num", "emplid", "empl_rcd", "row_val",
                    C.action_reason("row_val", "fpc", cur_m, new_m).alias("acn_rsn"))


@query
def complexity_flag(spark, sf):
    """J2b + G6: complexity flag and reason (different priority orders)."""
    h = _unique_managers(spark, sf, _identified(spark, sf))
    j = _hires_with_job(spark, sf).select("req_num", "emplid", "empl_rcd", "cur_full_part_time", "edw_std_hours",
                                          "edw_jobcode")
    j = j.join(h.select("req_num", "edw_reports_to", "hire_comments", "name"), "req_num", "inner")
    # count(distinct) over a window becomes a grouped count joined back
    j = j.join(j.groupBy("req_num", "name").agg(F.countDistinct("emplid").alias("id_req_count")), ["req_num", "name"])
    j = j.join(j.groupBy("req_num", "name", "emplid").agg(F.countDistinct("empl_rcd").alias("id_empl_rcd_count")),
               ["req_num", "name", "emplid"])
    jc = D.asof_rows(FX.jobcode_tbl(spark, sf).filter(F.col("setid") == "SHARE"), ["setid", "jobcode"], "effdt", NOW)
    j = j.join(jc.select(F.col("jobcode").alias("edw_jobcode"), F.col("union_cd").alias("edw_jc_union_cd")), "edw_jobcode")
    mism = C.casual_union_mismatch(C.hours_category("edw_std_hours"), "edw_jc_union_cd")
    flag, reason = C.complexity("id_req_count", "hire_comments", mism, "id_empl_rcd_count", "edw_reports_to")
    return j.select("req_num", "emplid", "empl_rcd", F.col("id_req_count").cast("long").alias("id_req_count"),
                    flag.alias("complex_check"), reason.alias("complex_def"))


# -------------------------------------------------------------- J2 transfers
from . import transfers as TR  # noqa: E402


def _transfer_slots(spark, sf, req) -> DataFrame:
    """The slots, and a fitting vacant one for every third request, so that moves occur."""
    jc = D.asof_rows(FX.jobcode_tbl(spark, sf).filter(F.col("setid") == "SHARE"), ["setid", "jobcode"], "effdt", NOW)
    req = req.join(jc.select(F.col("jobcode").alias("edw_jobcode"), "union_cd"), "edw_jobcode")
    k = F.col("req_num").cast("long")
    made = req.filter(k % 3 == 0).select(
        F.concat(F.lit("T"), F.lpad("req_num", 7, "0")).alias("position_nbr"), F.lit("1998-01-01").cast("date").alias("effdt"),
        F.lit("A").alias("eff_status"), F.col("edw_bus_unit").alias("business_unit"), F.col("edw_deptid").alias("deptid"),
        F.col("edw_jobcode").alias("jobcode"), C.company_from_union("union_cd").alias("company"),
        F.col("edw_std_hours").alias("std_hours"), F.col("edw_reports_to").alias("reports_to"), "union_cd",
        F.col("edw_shift").alias("shift"), F.col("edw_reg_temp").alias("reg_temp"), F.col("edw_flsa_status").alias("flsa_status"),
        (k % 4 + 1).cast("int").alias("max_head_count"),
        F.substring(F.lit(FX.LEVEL_CYCLE), (k % 10).cast("int") + 1, 1).alias("manager_level"))
    return FX.position_data(spark, sf).select(*made.columns).unionByName(made)


@query
def transfers(spark, sf):
    """The transfer list over both branches, with load strings, status and retention."""
    job = FX.job(spark, sf)
    in_force = TR.jobs_in_force(job, START)
    req = TR.resolved(FX.hires(spark, sf), in_force, FX.names(spark, sf), FX.dept_tbl(spark, sf), START, NOW)
    return TR.listed(req, in_force, job, FX.jobcode_tbl(spark, sf), _transfer_slots(spark, sf, req),
                     FX.person_assignment(spark, sf), START, NOW)


@query
def transfer_status(spark, sf):
    """J2b+J2c: rows, slots found and people per status and complexity."""
    t = transfers(spark, sf)
    return t.groupBy(F.coalesce("status", F.lit("")).alias("status"), "complex_check").agg(
        F.count(F.lit(1)).alias("n"), F.count("tfr_pos").alias("n_slots"), F.countDistinct("emplid").alias("people"))


@query
def dual_employment(spark, sf):
    """J2d+E19: second-employment load strings."""
    t = transfers(spark, sf).filter(F.col("dual_emp_exceltoci").isNotNull())
    return t.select("req_num", "emplid", "empl_rcd", "tfr_pos", "dual_emp_exceltoci")


# ------------------------------------------------------------- J6 name search
from . import name_search as NS  # noqa: E402


@query
def name_similarity(spark, sf):
    """E10+A6+G11-G14: best historical-name match per person (Jaro-Winkler > 90)."""
    return NS.search(FX.names_searched(spark, sf), FX.names_hist(spark, sf), scorer="jaro_winkler")


@query
def name_levenshtein(spark, sf):
    """E10 with the edit-distance scorer (the README's description of the search)."""
    return NS.search(FX.names_searched(spark, sf), FX.names_hist(spark, sf), scorer="levenshtein", threshold=80)


@query
def name_search_profile(spark, sf):
    """Best match per person enriched with the current job record (D1) and slot."""
    best = NS.search(FX.names_searched(spark, sf), FX.names_hist(spark, sf), scorer="jaro_winkler")
    return NS.profile(best, FX.job(spark, sf), FX.position_data(spark, sf), NOW)


@query
def name_search_full_profile(spark, sf, by=None):
    """J6+E22+D7: best match per person with current name, records in force, manager, location, contacts."""
    named = FX.names(spark, sf).filter((F.col("name_type") == "PRI") & (F.col("effdt") <= F.lit(NOW).cast("date"))).select("emplid").distinct()
    best = NS.search(FX.names_searched(spark, sf), FX.names_hist(spark, sf).join(named, "emplid", "left_semi"), scorer="jaro_winkler")
    return NS.full_profile(best, FX.names(spark, sf), FX.job(spark, sf), FX.location_tbl(spark, sf), FX.dept_tbl(spark, sf),
                           FX.jobcode_tbl(spark, sf), FX.addresses(spark, sf), FX.phones(spark, sf), FX.emails(spark, sf),
                           FX.pers_nid(spark, sf), FX.user_ids(spark, sf), NOW, by)


# ------------------------------------------------------------- J7 mail merge
from ..functions import text as T  # noqa: E402
from ..session import checkpoint_dir  # noqa: E402
from ..sources.csv import read_csv_records, tidy_records  # noqa: E402
from . import mail_merge as MM  # noqa: E402

MAIL_FIELDS = ["employee_id", "full_name", "refund_amount", "segment"]
MAIL_TRANSFORMS = {"full_name": "capitalize", "refund_amount": "currency_with_symbol"}


def _recipients(spark, sf):
    return tidy_records(FX.recipients_raw(spark, sf), normalise=True)


@query
def csv_normalise(spark, sf):
    """A9+B39+B49: header normalisation, trimmed values, all-blank rows dropped."""
    return _recipients(spark, sf)


@query
def csv_folder(spark, sf):
    """A9+A10+A12: a folder of CSV files in three encodings, headers in two orders, values with line ends and
    characters that only show late in a file which no byte order mark tells."""
    rows = FX.remarks(spark, sf)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tenure-csv/{uuid.uuid4().hex}"
    for part, encoding in enumerate(("UTF-8", "UTF-16", "ISO-8859-1")):
        mine = rows.filter(F.col("id").cast("long") % 3 == part)
        names = mine.columns if part else mine.columns[::-1]
        mine.select(*names).write.option("header", True).option("encoding", encoding).option("escape", '"').option("quoteAll", True).csv(f"{folder}/{part}")
    return read_csv_records(spark, folder, glob="*.csv")


@query
def capitalize_field(spark, sf):
    """B40+B43: name capitalisation transformer."""
    r = _recipients(spark, sf)
    return r.select("employee_id", T.capitalize("full_name").alias("full_name"))


@query
def currency_field(spark, sf):
    """B41+B42: money text with and without the symbol."""
    r = _recipients(spark, sf)
    return r.select("employee_id", T.currency("refund_amount").alias("amount"),
                    T.currency("refund_amount", "$").alias("amount_with_symbol"))


@query
def placeholders(spark, sf):
    """B46+I3: distinct placeholders per letter, first-seen order."""
    t = FX.letters(spark, sf)
    return t.select("template_id", T.placeholders(F.concat_ws(" ", "subject", "html_body")).alias("placeholders"))


def _rendered(spark, sf):
    r = MM.apply_transforms(_recipients(spark, sf), MAIL_TRANSFORMS)
    t = FX.letters(spark, sf).withColumnRenamed("template_id", "employee_id")
    j = r.join(t, "employee_id", "inner")
    fields = [(c, F.col(c)) for c in MAIL_FIELDS]
    return j.select("employee_id", T.render("subject", fields).alias("subject"),
                    T.render("html_body", fields).alias("body"))


@query
def render_template(spark, sf):
    """B47+B44: each recipient's letter rendered with its own (transformed) values."""
    return _rendered(spark, sf)


@query
def unreplaced(spark, sf):
    """Placeholders left after rendering."""
    r = _rendered(spark, sf)
    return r.select("employee_id", F.array_union(T.unreplaced("subject"), T.unreplaced("body")).alias("left_over")) \
        .select("employee_id", F.array_sort("left_over").alias("unreplaced"))


@query
def placeholder_mapping(spark, sf):
    """Placeholder -> recipient column by normalised name ('email' skipped)."""
    t = FX.letters(spark, sf).select(
        "template_id", F.posexplode(T.placeholders(F.concat_ws(" ", "subject", "html_body"))).alias("pos", "placeholder"))
    t = t.withColumn("normalized", T.normalise_col("placeholder")).filter(F.col("normalized") != "email")
    cols = F.array(*[F.lit(c) for c in MAIL_FIELDS])
    return t.select("template_id", F.col("pos").cast("int").alias("pos"), "placeholder", "normalized",
                    F.when(F.array_contains(cols, F.col("normalized")), F.col("normalized")).alias("matched_column"))


@query
def unused_columns(spark, sf):
    """B50+B51: recipient columns that a letter doesn't use (the id column is found by its name)."""
    t = FX.letters(spark, sf)
    names = T.unused_columns(F.concat_ws(" ", "subject", "html_body"), MAIL_FIELDS, T.default_id_column(MAIL_FIELDS))
    return t.select("template_id", F.array_join(names, ",").alias("unused"))


def _individual(spark, sf):
    r = MM.apply_transforms(_recipients(spark, sf), MAIL_TRANSFORMS)
    t = FX.letters(spark, sf).withColumnRenamed("template_id", "employee_id")
    j = r.join(t, "employee_id", "inner")
    return MM.individual(j, FX.emails(spark, sf), "employee_id", F.col("subject"), F.col("html_body"), MAIL_FIELDS)


@query
def mail_merge_individual(spark, sf):
    """J7 individual mode: recipient, e-mail lookup (A13), render, validate."""
    return _individual(spark, sf)


@query
def mail_summary(spark, sf):
    """F8: run summary by status."""
    return MM.summary(_individual(spark, sf))


@query
def mail_merge_bcc(spark, sf):
    """J7 BCC mode: one message per batch of 50 recipients, rendered from its first record."""
    r = MM.apply_transforms(_recipients(spark, sf), MAIL_TRANSFORMS)
    subject = F.lit("Refund notice for {{segment}}")
    body = F.lit("<p>Hello {{full_name}}, your refund of {{refund_amount}} is ready.</p>")
    return MM.bcc(r, FX.emails(spark, sf), "employee_id", subject, body, MAIL_FIELDS, batch_size=50)


# -------------------------------------------------------- J3/J4 hire staging
from . import hire_staging as HS  # noqa: E402

STAGE_START = "1998-01-01"
STAGE_DAYS = 30
CLINICAL_ASOF = "2000-06-30"
CLINICAL_FAMILIES = ["B1", "B2", "B6"]


def _stage_inputs(spark, sf):
    return (FX.candidates(spark, sf), FX.job(spark, sf), FX.pers_nid(spark, sf), FX.dept_tbl(spark, sf),
            FX.jobcode_tbl(spark, sf))


def _stage_slots(spark, sf, c):
    """The slots, and a fitting one of its own for every third staged hire, so that matches occur."""
    digits = F.regexp_replace("req_num", "[^0-9]", "")
    made = c.filter(digits.cast("long") % 3 != 1).select(
        F.concat(F.lit("H"), F.lpad(digits, 9, "0"), F.substring("mgr_position_nbr", -2, 2)).alias("position_nbr"),
        F.lit("1990-01-01").cast("date").alias("effdt"), F.lit("A").alias("eff_status"), "business_unit", "deptid",
        F.lit("0001").alias("location"), "jobcode", F.lit("001").alias("company"), "std_hours", F.col("mgr_position_nbr").alias("reports_to"),
        F.lit("73").alias("union_cd"), "shift", "reg_temp", C.hours_category("std_hours", null_as="P").alias("full_part_time"),
        F.lit(7).alias("max_head_count"), F.when(F.col("location") == "RMOTE", "Y").otherwise("N").alias("avail_telework_pos")).distinct()
    return FX.position_data(spark, sf).select(*made.columns).unionByName(made)


def _staged(spark, sf):
    return HS.base(*_stage_inputs(spark, sf), NOW, start=STAGE_START, days=STAGE_DAYS)


@query
def hire_window_report(spark, sf):
    """J3+C2+B9+B13+G10+B38+E2+E9+F6+F7: hire staging for the window [start, start + days]."""
    c = _staged(spark, sf)
    return HS.hire_staging(c, FX.job(spark, sf), FX.pers_nid(spark, sf), FX.person(spark, sf), FX.names(spark, sf),
                           FX.phones(spark, sf), FX.emails(spark, sf), _stage_slots(spark, sf, c),
                           M.headcount(active_jobs(spark, sf, NOW), count_col="emplid"), NOW)


@query
def first_match_string(spark, sf):
    """E9+D5+H3: the first fitting slot of each staged hire as descriptive text."""
    c = _staged(spark, sf)
    out = HS.first_slot(c, _stage_slots(spark, sf, c), M.headcount(active_jobs(spark, sf, NOW), count_col="emplid"))
    return out.select("req_num", "mgr_position_nbr", "post_chg_pos_use")


@query
def combined_history_listagg(spark, sf):
    """E17+F3+F4+E20: per-person ordered roll-up of in-force records with rehire flag."""
    h = HS.person_history(FX.job(spark, sf), FX.pers_nid(spark, sf), FX.person(spark, sf), FX.names(spark, sf), NOW)
    return h.select("emplid", HS.history_text("records", F.get("ids", 0)).alias("history"), "rehire",
                    F.get("ids", 0).alias("person_nid"))


@query
def clinical_report(spark, sf):
    """J4+B14+E9: clinical families, hire date within +-100 days, days until hire, first fitting slot."""
    c = HS.base(*_stage_inputs(spark, sf), CLINICAL_ASOF, families=CLINICAL_FAMILIES, window_days=100)
    return HS.clinical_report(c, _stage_slots(spark, sf, c), M.headcount(active_jobs(spark, sf, CLINICAL_ASOF), count_col="emplid"),
                              FX.phones(spark, sf), FX.emails(spark, sf), CLINICAL_ASOF)


# --------------------------------------------------------------- J1 bulk PAF


@query
def paste_fields_keep_empty(spark, sf):
    """A3+A4+B1+B3: header row (effdt, reason) and empty-keeping request fields."""
    return BP.parse_requests(FX.bulk_lines(spark, sf))


@query
def bulk_paf(spark, sf):
    """Bulk position change — status, load strings, capacity and override audits."""
    return BP.bulk_paf(FX.bulk_lines(spark, sf), FX.job(spark, sf), FX.position_data(spark, sf),
                       FX.dept_tbl(spark, sf), NOW)


@query
def bulk_paf_dates(spark, sf):
    """J1+D3: 200 pastes, each as of its own date, and one without a date, in one plan."""
    return BP.bulk_paf(FX.bulk_lines_by_date(spark, sf), FX.job(spark, sf), FX.position_data(spark, sf),
                       FX.dept_tbl(spark, sf), NOW)


def _bulk_valued(spark, sf):
    days = BP.job_days(FX.job(spark, sf))
    heads = BP.head_counts(days)
    return heads, BP.valued(BP.requests(FX.bulk_lines(spark, sf)), days, FX.position_data(spark, sf), FX.dept_tbl(spark, sf), heads, NOW)


@query
def retention_rank(spark, sf):
    """Which incumbents of a slot keep it, by the most frequent future values."""
    t = BP.ranked(_bulk_valued(spark, sf)[1])
    return t.select("paste_id", "cur_pos", "emplid", "empl_rcd", F.col("tfr_retain_one").cast("int").alias("tfr_retain_one"),
                    "cur_incumbent_count", "missing_head_count", "total_pos_remaining_value_diffs")


@query
def capacity_audit(spark, sf):
    """G5+B37+E7: planned moves into each slot against its capacity.

    A fitting vacant slot for every third request is added, so that moves occur.
    """
    heads, valued = _bulk_valued(spark, sf)
    k = F.col("line_no")
    made = valued.filter(k % 3 == 0).select(
        F.concat(F.lit("B"), F.lpad(k.cast("string"), 7, "0")).alias("position_nbr"), F.lit("1990-01-01").cast("date").alias("effdt"),
        F.lit("A").alias("eff_status"), *[F.col(c + "_new").alias(c) for c in POS_FIELDS if c != "std_hours"],
        F.col("std_hours_new").cast("decimal(6,2)").alias("std_hours"), (k % 4 + 1).cast("int").alias("max_head_count"),
        F.lit("9").alias("manager_level"))
    slots = FX.position_data(spark, sf).unionByName(made, allowMissingColumns=True)
    t = BP.finished(BP.matched(BP.ranked(valued), slots, heads)).filter(F.col("tfr_pos").isNotNull())
    return t.select("paste_id", "tfr_pos", "status", F.col("audit_tfr_move_plus_cur_over_max").alias("audit"),
                    "job_update_position_nbr_exceltoci")


# ------------------------------------------------- H1 reports in their order
from ..sources.sinks import numbered  # noqa: E402


@query
def bulk_paf_lines(spark, sf):
    """J1+H1+A14: the bulk change report in its order, with line numbers."""
    out = ["paste_id", "line_no", "row_pos", "status", "cur_pos", "job_update_override_position_exceltoci"]
    order_only = ["total_pos_remaining_value_diffs", "emplid", "empl_rcd"]
    t = numbered(bulk_paf(spark, sf), BP.report_order(), "report_line", keep=[*out, *order_only])
    return t.select("report_line", *out)


@query
def transfer_lines(spark, sf):
    """J2+G9+H1+A14: the transfer list in its order, with line numbers."""
    t = numbered(TR.with_unclassified(transfers(spark, sf)), TR.report_order())
    return t.select("line_no", "unclassified", "req_num", "emplid", "empl_rcd", "row_rn", "complex_check", "status", "transfers_exceltoci")


@query
def hire_window_lines(spark, sf):
    """J3+H1: hire staging in its order, a line per request (contacts that multiply rows fall together)."""
    t = hire_window_report(spark, sf).select("req", "hire_dt", "num_order", "position_ci").distinct()
    return numbered(t, [*HS.report_order("req"), O.asc("position_ci")])


@query
def clinical_lines(spark, sf):
    """J4+H1: the clinical report in its order, a line per request."""
    t = clinical_report(spark, sf).select("req_num", "hire_dt", "num_order", "mgr_position_nbr").distinct()
    return numbered(t, [*HS.report_order("req_num"), O.asc("mgr_position_nbr")])


@query
def refund_lines(spark, sf):
    """J5+A16+H1: both refund lists of one run, each in its order."""
    both = R.refund_split(FX.refund_pastes(spark, sf), FX.employees(spark, sf))
    cols = ["paste_id", "row_pos", "emplid", "deduction_cd", "amount"]
    parts = [numbered(t, R.report_order(k == "active")).select(F.lit(k).alias("list"), "line_no", *cols) for k, t in both.items()]
    return parts[0].unionByName(parts[1])


@query
def name_search_lines(spark, sf):
    """J6+H1: the profile report in its order, with line numbers."""
    out = ["name_searched", "max_historical_proximity", "current_proximity", "emplid", "empl_rcd", "phone_cell"]
    order_only = ["manager_id", "phone_home", "email_busn", "email_home", "national_id"]
    t = name_search_full_profile(spark, sf, by=NS.record_order())
    t = numbered(t, NS.report_order(), keep=[*out, *order_only], show=out, ranged=True)
    return t.select("line_no", *out)
