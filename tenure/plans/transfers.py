"""Transfers: hiring requests of current employees to transfer actions.

Plan: one as-of job frame at the start date, written once and shared by the
managers, the current values, the head counts and the primary jobs
(``jobs_in_force``) -> requests with the manager's slot by unique match and the
person by id or, for blank ids, by a name only one person has, written once
(``resolved``) -> job-code lookups, field differences, written once (``compared``)
-> what a request or person has in all (people, records, a finished record) as
one chain of partial aggregates, joined back once -> row expansion -> best slot (own slot
first) -> action reason, complexity, status, load strings -> row and group
retention, a filter by then. No window holds a whole request list, and nothing
is computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import oracle as O
from ..operators import diff as X
from ..operators import effdt as D
from ..operators import match as M
from ..session import cut_lineage

JOB_KEYS = ["emplid", "empl_rcd"]
# requested value -> name after the lookups
REQUEST = ["deptid", "jobcode", "std_hours", "shift", "reg_temp", "flsa_status", "hourly_rt"]
CURRENT = ["deptid", "jobcode", "std_hours", "full_part_time", "shift", "reports_to", "company", "union_cd",
           "flsa_status", "reg_temp", "hourly_rt", "business_unit", "job_indicator", "officer_cd"]
# requested column -> slot column: all must be equal for a slot to fit
SLOT_FIELDS = [("edw_bus_unit", "business_unit"), ("edw_deptid", "deptid"), ("edw_jobcode", "jobcode"),
               ("edw_jc_company", "company"), ("edw_std_hours", "std_hours"), ("edw_reports_to", "reports_to"),
               ("edw_jc_union_cd", "union_cd"), ("edw_shift", "shift"), ("edw_reg_temp", "reg_temp"),
               ("edw_flsa_status", "flsa_status")]


def requests(hires: DataFrame, in_force: DataFrame, dept: DataFrame, start, now) -> DataFrame:
    """Requests of the start date with business unit and the hiring manager's slot."""
    h = hires.filter((F.col("hire_comments") != " ") & (F.col("start_date") == F.lit(start).cast("date")))
    h = h.select("req_num", "name", "start_date", F.trim("hire_comments").alias("hire_comments"),
                 O.trim_null("emplid").alias("orig_emp"), (F.col("emplid") == " ").alias("by_name"),
                 F.col("mgr_id").alias("edw_mgr_id"), F.col("mgr_name").alias("edw_mgr_name"),
                 F.col("prof_experience_dt").alias("edw_prof_exp_dt"),
                 *[F.col(c).alias("edw_" + c) for c in REQUEST])
    h = h.filter(F.col("by_name").isNotNull())
    # a scalar lookup over all setids; where several rows are in force the least business unit is taken
    d = D.asof_rows(dept, ["setid", "deptid"], "effdt", now)
    d = d.groupBy(F.col("deptid").alias("edw_deptid")).agg(F.min("business_unit").alias("edw_bus_unit"))
    h = h.join(d, "edw_deptid", "left")
    # cheap guards first: only six-digit ids are looked up
    key = F.when((F.length("edw_mgr_id") == 6) & O.all_digits("edw_mgr_id"), F.col("edw_mgr_id"))
    h = h.withColumn("__mgr", key)
    h = M.resolve_unique(h, in_force.filter(C.is_manager("officer_cd") == 1), [("__mgr", "emplid")], "position_nbr",
                         "edw_reports_to")
    h = M.resolve_unique(h, in_force, [("__mgr", "emplid")], "position_nbr", "edw_anyvalue_reports_to")
    return h.drop("__mgr")


def identified(req: DataFrame, employed: DataFrame, names: DataFrame, now) -> DataFrame:
    """Requests with ``emplid``: the given one, or for blank ids the only employed person
    whose current primary name is the request's (I1, E16)."""
    by_id = req.filter(~F.col("by_name")).withColumn("emplid", F.col("orig_emp"))
    current = D.asof_rows(names.filter(F.col("name_type") == "PRI"), ["emplid", "name_type"], "effdt", now)
    people = current.join(employed.select("emplid").distinct(), "emplid", "left_semi")
    by_name = M.resolve_unique(req.filter("by_name"), people, [("name", "name_display")], "emplid", "emplid", distinct=True)
    return by_id.unionByName(by_name.filter(F.col("emplid").isNotNull()))


def jobs_in_force(job: DataFrame, start) -> DataFrame:
    """Active job records as of the start date, written once."""
    return cut_lineage(D.active_asof(job, JOB_KEYS, "effdt", start, "effseq"))


def resolved(hires: DataFrame, in_force: DataFrame, names: DataFrame, dept: DataFrame, start, now) -> DataFrame:
    """Requests with business unit, manager's slot and person, both branches; written once."""
    employed = in_force.filter(F.col("per_org") == "EMP")
    return cut_lineage(identified(requests(hires, in_force, dept, start, now), employed, names, now))


def with_jobs(req: DataFrame, in_force: DataFrame, job: DataFrame, start) -> DataFrame:
    """One row per request and active employment record of its person."""
    cur = in_force.filter(F.col("per_org") == "EMP").select(
        *JOB_KEYS, F.col("effdt").alias("cur_job_effdt"), "effseq", F.col("position_nbr").alias("cur_pos"),
        C.on_leave("empl_status").alias("cur_job_on_leave"), *[F.col(c).alias("cur_job_" + c) for c in CURRENT])
    asked = job.join(req.select("emplid").distinct(), "emplid", "left_semi")
    nxt = D.next_effective(asked, JOB_KEYS, "effdt", start, "future_job_effdt")
    a = req.join(cur, "emplid", "inner").join(nxt, JOB_KEYS, "left")
    return a.withColumn("edw_generated_fpc", C.hours_category("edw_std_hours")) \
        .withColumn("generated_fpc_analysis", C.category_change("edw_std_hours", "cur_job_full_part_time")) \
        .withColumn("corrected_hourly_rt", C.snap_rate("edw_hourly_rt", "cur_job_hourly_rt"))


def with_jobcodes(a: DataFrame, jobcode: DataFrame, now) -> DataFrame:
    """Both job codes' values as of now."""
    jc = D.asof_rows(jobcode.filter(F.col("setid") == "SHARE"), ["setid", "jobcode"], "effdt", now)

    def side(p: str) -> DataFrame:
        return jc.select(F.col("jobcode").alias(p + "jobcode"), C.manager_rank("manager_level").alias(p + "jc_mgr_rank"),
                         C.is_manager("manager_level").alias(p + "jc_is_mgr"), F.col("sal_admin_plan").alias(p + "jc_sal_admin_plan"),
                         F.col("grade").alias(p + "jc_grade"), F.col("union_cd").alias(p + "jc_union_cd"),
                         F.col("manager_level").alias(p + "jc_officer_cd"))

    a = a.join(side("cur_job_"), "cur_job_jobcode", "inner").join(side("edw_"), "edw_jobcode", "inner")
    a = a.withColumn("edw_jc_company", C.company_from_union("edw_jc_union_cd"))
    return a.withColumn("fpc_union_mismatch", C.casual_union_mismatch("edw_generated_fpc", "edw_jc_union_cd"))


def with_group_facts(a: DataFrame) -> DataFrame:
    """``id_req_count``, ``id_empl_rcd_count`` (G6) and ``has_done`` (C8) of each request and person.

    One aggregate over the rows gives (request, name, person) groups; the coarser
    groups are aggregates of these, so a request with a third of the rows is summed
    before each shuffle, and the rows meet their facts in one join.
    """
    r, n, e = F.col("req_num").alias("__r"), F.col("name").alias("__n"), F.col("emplid").alias("__e")
    person = a.groupBy(r, n, e).agg(F.countDistinct("empl_rcd").alias("id_empl_rcd_count"),
                                    F.max(F.col("remaining_value_diff").isNull()).alias("__done"))
    people = person.groupBy("__r", "__n").agg(F.count(F.lit(1)).alias("id_req_count"))
    done = person.groupBy("__r", "__e").agg(F.max("__done").alias("has_done"))
    p, q, d = person.alias("p"), people.alias("q"), done.alias("d")
    facts = p.join(q, F.col("p.__r").eqNullSafe(F.col("q.__r")) & F.col("p.__n").eqNullSafe(F.col("q.__n"))) \
        .join(d, F.col("p.__r").eqNullSafe(F.col("d.__r")) & (F.col("p.__e") == F.col("d.__e"))) \
        .select("p.__r", "p.__n", "p.__e", "id_req_count", "id_empl_rcd_count", "has_done")
    met = F.col("req_num").eqNullSafe(F.col("__r")) & F.col("name").eqNullSafe(F.col("__n")) & (F.col("emplid") == F.col("__e"))
    return a.join(facts, met).drop("__r", "__n", "__e")


def compared(req: DataFrame, in_force: DataFrame, job: DataFrame, jobcode: DataFrame, assignment: DataFrame, start, now) -> DataFrame:
    """Requests with their records, job codes and the differences that are left; written once."""
    a = with_jobcodes(with_jobs(req, in_force, job, start), jobcode, now)
    prof = assignment.select(*JOB_KEYS, F.col("prof_experience_dt").alias("cur_prof_exp_dt"))
    return cut_lineage(a.join(prof, JOB_KEYS, "left").withColumn("remaining_value_diff", differences()))


def differences() -> Column:
    """The ten-field difference text, NULL when the transfer is done."""
    # Labels and their order.
    return X.field_diff([
        X.Field("bu", "edw_bus_unit", "cur_job_business_unit", lead="", new_lpad=5, rpad_total=15),
        X.Field("dept", "edw_deptid", "cur_job_deptid"),
        X.Field("jobcode", "edw_jobcode", "cur_job_jobcode"),
        X.Field("co", "edw_jc_company", "cur_job_company"),
        X.Field("std_hours", "edw_std_hours", "cur_job_std_hours", rpad_value=8, fmt=O.num_text),
        X.Field("reports_to", "edw_reports_to", "cur_job_reports_to"),
        X.Field("union_cd", "edw_jc_union_cd", "cur_job_union_cd"),
        X.Field("shift", "edw_shift", "cur_job_shift"),
        X.Field("reg_temp", "edw_reg_temp", "cur_job_reg_temp"),
        X.Field("flsa_status", "edw_flsa_status", "cur_job_flsa_status"),
    ])


def expanded(a: DataFrame) -> DataFrame:
    """Primary row, and rows for a category and a regular/temporary change."""
    fpc = F.col("generated_fpc_analysis")
    row = lambda n, text: F.struct(F.lit(n).alias("row_val"), F.lit(text).alias("row_def"))
    changed = F.col("edw_reg_temp") != F.col("cur_job_reg_temp")
    out = M.expand_rows(
        a, [(F.lit(True), row(1, "Primary Row")), (fpc.isNotNull(), row(2, "FPC cat change")), (changed, row(3, "reg_temp change"))],
        pos_name="row_rn", total_name="row_total",
        total_keep=[F.lit(True), fpc.isNotNull(), ~F.col("edw_reg_temp").eqNullSafe(F.col("cur_job_reg_temp"))])
    return out.select(*[c for c in out.columns if c != "variant"], F.col("variant.row_val").alias("row_val"),
                      F.col("variant.row_def").alias("row_def"))


def with_slot(a: DataFrame, positions: DataFrame, in_force: DataFrame, start) -> DataFrame:
    """The best slot that fits the request, the own slot first."""
    slots = D.active_asof(positions, "position_nbr", "effdt", start, status_col="eff_status")
    slots = M.with_headcount(slots, M.headcount(in_force, count_col="emplid"), "position_nbr")
    slots = slots.withColumnsRenamed({"position_nbr": "tfr_pos", "manager_level": "tfr_pos_mgr_level"})
    return M.best_match(
        a, slots, SLOT_FIELDS,
        order_by=[M.Sort("head_count", desc=True), M.Sort("max_head_count", desc=True), M.Sort("tfr_pos")],
        left_id=["req_num", *JOB_KEYS, "row_val"], right_cols=["tfr_pos", "tfr_pos_mgr_level"],
        eligible=(C.is_manager("tfr_pos_mgr_level") == 0) | (F.col("head_count") == 0),
        prefer=("cur_pos", "tfr_pos"),
        left_gate=F.col("remaining_value_diff").isNotNull() & (F.col("row_val") == 1))


def with_dual_employment(a: DataFrame, in_force: DataFrame, assignment: DataFrame) -> DataFrame:
    """Load string for a second employment, or why there is none (E19, J2d)."""
    primary = in_force.filter((F.col("job_indicator") == "P") & (F.col("per_org") == "EMP")).groupBy("emplid").agg(
        F.count(F.lit(1)).alias("__primaries"), F.min("empl_rcd").alias("__rcd"))
    last = assignment.groupBy("emplid").agg(F.max("empl_rcd").alias("__last"))
    org = assignment.select("emplid", F.col("empl_rcd").alias("__rcd"), F.struct(
        "per_org", "org_instance_ern", "benefit_rcd_nbr", "cmpny_seniority_dt", "service_dt", "seniority_pay_dt").alias("__org"))
    one = primary.join(org, ["emplid", "__rcd"], "left").join(last, "emplid", "left")
    a = a.join(one, "emplid", "left")
    o = lambda c: F.col("__org")[c].cast("string")
    t = lambda c: F.col(c).cast("string")
    k = F.lit
    # Slot order and constants of the load layout.
    text = X.load_string(
        F.col("emplid"), F.when(F.col("__org").isNotNull(), F.col("__last") + 1).cast("string"), o("per_org"),
        o("org_instance_ern"), o("benefit_rcd_nbr"), k("Y"), o("cmpny_seniority_dt"), k("Y"), o("service_dt"), k("Y"),
        o("seniority_pay_dt"), t("edw_prof_exp_dt"), t("start_date"), k("0"), F.col("tfr_pos"), k("ADL"), k("ADL"),
        F.col("edw_jc_officer_cd"), k("S"), k("BA"), k("Y"), k("Y"), k("0"), k("NAHRLY"), O.num_text("edw_hourly_rt"),
        k("H"), k("USD"))
    dual = (F.when(F.col("__primaries").isNull(), "No Active Primary EMP")
            .when(F.col("__primaries") > 1, "Multiple Primary EMP records").otherwise(text))
    gate = F.col("tfr_pos").isNotNull() & (F.col("hire_comments") == "Dual Employment")
    return a.withColumn("dual_emp_exceltoci", F.when(gate, dual)).drop("__primaries", "__rcd", "__last", "__org")


def reason(a_row_val="row_val") -> Column:
    keys = ["deptid", "jobcode", "shift", "std_hours"]
    cur = {k: "cur_job_" + k for k in keys} | {"mgr_rank": "cur_job_jc_mgr_rank", "sal_admin_plan": "cur_job_jc_sal_admin_plan",
                                               "grade": "cur_job_jc_grade", "hourly_rt": "cur_job_hourly_rt"}
    new = {k: "edw_" + k for k in keys} | {"mgr_rank": "edw_jc_mgr_rank", "sal_admin_plan": "edw_jc_sal_admin_plan",
                                           "grade": "edw_jc_grade", "hourly_rt": "corrected_hourly_rt"}
    return C.action_reason(a_row_val, "generated_fpc_analysis", cur, new)


def transfers(hires: DataFrame, job: DataFrame, names: DataFrame, jobcode: DataFrame, positions: DataFrame,
              dept: DataFrame, assignment: DataFrame, start, now) -> DataFrame:
    """The transfer list for requests that start on ``start``; ``now`` dates the reference tables."""
    in_force = jobs_in_force(job, start)
    return listed(resolved(hires, in_force, names, dept, start, now), in_force, job, jobcode, positions, assignment, start, now)


def listed(req: DataFrame, in_force: DataFrame, job: DataFrame, jobcode: DataFrame, positions: DataFrame,
           assignment: DataFrame, start, now) -> DataFrame:
    """The transfer list of ``resolved`` requests."""
    a = with_group_facts(compared(req, in_force, job, jobcode, assignment, start, now))
    # Open rows and one row per completed record; C8: a completed record hides the person's open ones
    open_ = F.col("remaining_value_diff").isNotNull()
    a = expanded(a).filter((open_ | (F.col("row_val") == 1)) & (~F.col("has_done") | ~open_))
    a = with_slot(a, positions, in_force, start)
    a = with_dual_employment(a, in_force, assignment)
    diff, row = F.col("remaining_value_diff"), F.col("row_val")
    flag, why = C.complexity("id_req_count", "hire_comments", "fpc_union_mismatch", "id_empl_rcd_count", "edw_reports_to")
    a = a.withColumn("acn_rsn", reason()).withColumn("complex_check", flag).withColumn("complex_def", why)

    day = O.date_text("start_date")
    no_manager = F.col("edw_reports_to").isNull()
    blocked = (F.when(F.col("edw_anyvalue_reports_to").isNotNull() & no_manager, "Reports_to is not a manager.")
               .when(no_manager, "Hiring manager no longer active."))
    # Slot order and constants of the load layouts, status texts.
    create = F.when((row == 1) & diff.isNotNull() & F.col("tfr_pos").isNull(), F.coalesce(blocked, X.load_string(
        "00000000", day, "A", "NEW", F.col("edw_bus_unit"), F.col("edw_deptid"), F.col("edw_jobcode"),
        F.when(F.col("edw_jc_is_mgr") == 1, "1").otherwise("99"), "Y", F.col("edw_reports_to"), F.col("edw_jc_company"),
        O.num_text("edw_std_hours"), F.col("edw_jc_union_cd"), F.col("edw_shift"), F.col("edw_reg_temp"),
        F.col("edw_generated_fpc"), F.col("edw_flsa_status"), "Y")))
    status = (F.when(diff.isNull(), "-----Completed-----").when(no_manager, blocked)
              .when(F.col("cur_job_on_leave") == 1, "--!! On Leave !!---")
              .when(F.col("fpc_union_mismatch") == 1, "!Union and Casual!!")
              .when(F.col("cur_job_company") != F.col("edw_jc_company"), "!!Company  Number!!")
              .when(F.col("cur_job_effdt") == F.col("start_date"), F.concat(F.lit("Existing "), day)))
    seq = X.next_effseq("cur_job_effdt", "start_date", "effseq", "row_rn")
    move = F.when(~(F.col("tfr_pos").isNull() & (row == 1)), X.load_string(
        O.cat(F.when(F.col("complex_check") == "Complex", "!!!"), F.col("emplid")), F.col("empl_rcd").cast("string"), day,
        seq.cast("string"), F.col("tfr_pos"), "POS", F.col("acn_rsn"), "Y", "Y", "0", "NAHRLY",
        O.num_text("corrected_hourly_rt"), "H", "USD"))
    prof_dt = F.when(F.col("edw_prof_exp_dt").eqNullSafe(F.col("cur_prof_exp_dt")), "Match").otherwise(X.load_string(
        F.col("emplid"), F.col("empl_rcd").cast("string"), O.date_text("edw_prof_exp_dt")))
    newer = F.when(F.col("future_job_effdt").isNotNull(), F.concat(F.lit("!!NEWER EFFDT FOUND: "), O.date_text("future_job_effdt")))

    return a.select(
        "acn_rsn", "hire_comments", "req_num", "orig_emp", "name", "emplid", "empl_rcd", "effseq", "cur_job_effdt",
        "start_date", "complex_check", "complex_def", status.alias("status"), newer.alias("audit_newer"), "cur_pos",
        "cur_job_officer_cd", "tfr_pos", "tfr_pos_mgr_level", move.alias("transfers_exceltoci"),
        prof_dt.alias("prof_dt_exceltoci"), F.coalesce(diff, F.lit("-------Completed-------")).alias("remaining_value_diff"),
        "edw_mgr_id", "edw_mgr_name", "dual_emp_exceltoci", create.alias("position_create_complete_exceltoci"),
        "edw_prof_exp_dt", "edw_deptid", "edw_jobcode", "edw_std_hours", "edw_shift", "cur_job_job_indicator", "row_val",
        "row_def", "row_rn")


def with_unclassified(t: DataFrame) -> DataFrame:
    """``t`` with ``unclassified``: how many rows of the person have no action reason."""
    odd = t.groupBy(F.col("emplid").alias("__e")).agg(F.sum(F.when(F.col("acn_rsn") == "???", 1).otherwise(0)).alias("unclassified"))
    return t.join(odd, F.col("emplid") == F.col("__e")).drop("__e")


def report_order() -> list[Column]:
    """Of ``with_unclassified``: open rows first, complex ones last, people with an unclassified row after others (H1)."""
    done = F.when(F.col("remaining_value_diff") == "-------Completed-------", 1).otherwise(0)
    return [done.asc(), O.desc("complex_check"), O.asc("unclassified"), *[O.asc(c) for c in (
        "emplid", "req_num", "empl_rcd", "effseq", "row_rn", "remaining_value_diff", "transfers_exceltoci")]]
