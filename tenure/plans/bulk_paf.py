"""Bulk position change.

Plan: parse the request lines (narrow; the header row of each paste is a
one-row-per-paste frame joined by ``paste_id``, which AQE broadcasts from
its runtime size), written once (``requests``) -> the job history's rows at
the end of each day, written once (``job_days``) -> each request's job and slot in force at its paste's own
date through ``asof_join``, whatever the number of dates (``valued``) ->
override pick / proposed values / diffs (column expressions) -> per-slot
counts as grouped aggregates joined back (``ranked``) -> best existing slot:
slot versions as intervals, met with the distinct (date, new values) that are
looked for, their head counts from one running sum per slot, then
``best_match`` (``matched``) -> load strings, audits and the status
(``finished``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import oracle as O
from ..operators import diff as X
from ..operators import effdt as D
from ..operators import match as M
from ..session import cut_lineage, written
from ..sources.paste import clean_token, field_kept, split_rows

JOB_KEYS = ["emplid", "empl_rcd"]
FIELDS = ["business_unit", "deptid", "location", "jobcode", "company", "std_hours", "reports_to",
          "union_cd", "shift", "reg_temp", "flsa_status"]
REQ_FIELDS = ["emplid", "empl_rcd", "raw_deptid_new", "raw_location_new", "raw_jobcode_new",
              "raw_std_hours_new", "raw_shift_new", "raw_mgr_position_new"]


def override_fields(new: str, cur: str) -> list[X.Field]:
    """The eleven fields of the override comparison, by column prefix."""
    # Labels in output order.
    labels = [("business_unit", "bu"), ("deptid", "dept"), ("location", "location"), ("jobcode", "jobcode"),
              ("company", "co"), ("std_hours", "std_hours"), ("reports_to", "reports_to"), ("union_cd", "union_cd"),
              ("shift", "shift"), ("reg_temp", "reg_temp"), ("flsa_status", "flsa_status")]
    layout = {"business_unit": {"lead": "", "new_lpad": 5, "rpad_total": 15}, "std_hours": {"rpad_value": 8, "fmt": O.num_text}}
    return [X.Field(label, new + c, cur + c, **layout.get(c, {})) for c, label in labels]


NO_DATE = "!!Paste without a readable header date. Request not processed."


def parse_requests(lines: DataFrame, date_format: str | None = None) -> DataFrame:
    """Requests with their paste's header date and reason.

    A header date that is missing or can't be read (by ``date_format``, else as an ISO
    date) is NULL.
    """
    rows = split_rows(lines, "text", ",", keep_tab=False)
    v = F.col("value")
    is_header = (F.col("line_no") == 0) & (F.col("row_pos") == 0)
    hdr = rows.filter(is_header).select(
        "paste_id",
        O.to_date(clean_token(field_kept(v, 0)), date_format).alias("effdt"),
        clean_token(field_kept(v, 1)).alias("action_reason"))
    req = rows.filter(~is_header)
    cols = [clean_token(field_kept(v, i)).alias(n) for i, n in enumerate(REQ_FIELDS)]
    req = req.select("paste_id", "line_no", "row_pos", *cols)
    req = req.withColumn("empl_rcd", F.col("empl_rcd").cast("int")) \
        .withColumn("raw_std_hours_new", O.to_number("raw_std_hours_new"))
    return req.join(hdr, "paste_id", "inner")


def requests(lines: DataFrame, date_format: str | None = None) -> DataFrame:
    """``parse_requests``, written once.

    The lines are dealt first: short ones come in a file or two, which a task or two would parse.
    """
    return cut_lineage(parse_requests(lines.repartition(*lines.columns), date_format))


def job_days(job: DataFrame) -> DataFrame:
    """The job records that hold at the end of a day, with what a bulk change reads of them; written once."""
    own = [*JOB_KEYS, "effdt", "effseq", "hr_status", "position_nbr", "position_override", *FIELDS]
    return written(D.day_rows(job.select(*own).dropna(subset=[*JOB_KEYS, "effdt"]), JOB_KEYS, "effdt", "effseq"))


def head_counts(days: DataFrame) -> DataFrame:
    """``position_nbr, effdt, head_count``: active incumbents of each slot over time, from ``job_days``."""
    held = D.versions(days, JOB_KEYS, "effdt").filter(F.col("hr_status") == "A")
    return cut_lineage(D.counts_over_time(held, "position_nbr"))


def with_head_count(df: DataFrame, heads: DataFrame, slot: str, date: str, name: str) -> DataFrame:
    """``df`` with the head count of its slot at its own date (0: none)."""
    out = D.asof_join(df, heads, slot, date, "effdt", right_cols=["head_count"], prefix="__h_", right_on="position_nbr")
    return out.withColumn(name, F.coalesce("__h_head_count", F.lit(0))).drop("__h_head_count", "__h_effdt")


def bulk_paf(lines: DataFrame, job: DataFrame, positions: DataFrame, dept: DataFrame, now, date_format: str | None = None) -> DataFrame:
    """Bulk position change, each paste as of the date in its header, all dates in one plan.

    Requests of a paste without a readable date come back with ``NO_DATE`` as status.
    """
    req = requests(lines, date_format)
    days = job_days(job)
    heads = head_counts(days)
    done = finished(matched(ranked(valued(req, days, positions, dept, heads, now)), positions, heads))
    undated = req.filter(F.col("effdt").isNull()).select(
        "paste_id", "line_no", "row_pos", "emplid", "empl_rcd", F.col("action_reason").alias("acn_rsn"), F.lit(NO_DATE).alias("status"))
    return done.unionByName(undated, allowMissingColumns=True)


def valued(req: DataFrame, days: DataFrame, positions: DataFrame, dept: DataFrame, heads: DataFrame, now) -> DataFrame:
    """Requests with current and proposed values, differences, audits and counts per slot; written once.

    ``days`` are ``job_days``: a day's rows are picked already.
    """
    own = ["position_nbr", "position_override", "hr_status", *FIELDS, "effseq"]
    a = D.asof_join(req, days, JOB_KEYS, "effdt", "effdt", right_cols=own, prefix="b_", ties="keep", how="inner")
    a = a.filter(F.col("b_hr_status") == "A").drop("b_hr_status").withColumnsRenamed(
        {"b_position_nbr": "cur_pos", "b_position_override": "cur_job_pos_override", "b_effdt": "cur_job_effdt", "b_effseq": "cur_job_effseq"})
    # every step below reads this more than once, and joins to the job history stand behind it
    a = cut_lineage(a)
    # slot and head count at a date, once per slot and date rather than per request
    extra = ["full_part_time", "include_title", "max_head_count", "update_incumbents", "manager_level"]
    slots = D.asof_join(a.select("cur_pos", "effdt").distinct(), positions, "cur_pos", "effdt", "effdt", right_cols=[*FIELDS, *extra],
                        prefix="p_", ties="keep", how="inner", right_on="position_nbr").drop("p_effdt")
    a = a.join(with_head_count(slots, heads, "cur_pos", "effdt", "cur_pos_head_count"), ["cur_pos", "effdt"])
    a = D.newer_record_audit(a, days, JOB_KEYS, run_date=F.col("effdt"), now=now, picked_effdt="cur_job_effdt")

    ov = F.col("cur_job_pos_override")
    cur = {c: O.decode(ov, {"Y": F.col("b_" + c)}, F.col("p_" + c)) for c in FIELDS}
    for c in FIELDS:
        a = a.withColumn(f"cur_{c}_proper", cur[c])
    # dept -> business unit, only when a new dept was requested (E5, as of now)
    d = D.asof_rows(dept.filter(F.col("setid") == "SHARE"), ["setid", "deptid"], "effdt", now, ties="any",
                    tiebreak=["business_unit"])
    d = d.select(F.col("deptid").alias("__dept"), F.col("business_unit").alias("__bu"))
    a = a.join(d, F.col("raw_deptid_new") == F.col("__dept"), "left")
    new = {
        "deptid": F.coalesce("raw_deptid_new", "cur_deptid_proper"),
        "location": F.coalesce("raw_location_new", "cur_location_proper"),
        "jobcode": F.coalesce("raw_jobcode_new", "cur_jobcode_proper"),
        "shift": F.coalesce("raw_shift_new", "cur_shift_proper"),
        "business_unit": F.coalesce(F.when(F.col("raw_deptid_new").isNotNull(), F.col("__bu")), F.col("cur_business_unit_proper")),
        "std_hours": F.coalesce("raw_std_hours_new", "cur_std_hours_proper"),
        "reports_to": F.coalesce("raw_mgr_position_new", "cur_reports_to_proper"),
        "company": C.company_adjust("cur_company_proper", "raw_std_hours_new"),
        "union_cd": F.col("cur_union_cd_proper"), "reg_temp": F.col("cur_reg_temp_proper"),
        "flsa_status": F.col("cur_flsa_status_proper"),
    }
    for c, e in new.items():
        a = a.withColumn(f"{c}_new", e)
    a = a.drop("__dept", "__bu")
    a = a.withColumn("fpc_new", C.hours_category("std_hours_new"))
    a = a.withColumn("cur_pos_mgr_bool", C.is_manager("p_manager_level"))
    # G1: incumbents of the slot inside this request (grouped count joined back)
    g1 = a.groupBy("paste_id", "cur_pos").agg(F.count(F.lit(1)).alias("cur_incumbent_count"))
    a = a.join(g1, ["paste_id", "cur_pos"])
    a = a.withColumn("override_diff_check", X.fields_equal([("b_" + c, "p_" + c) for c in FIELDS]))
    a = a.withColumn("override_remaining_values_diff", X.field_diff(override_fields("b_", "p_")))

    def nt(c):
        return O.num_text(F.col(c))
    diff_fields = [
        X.Field("bu", F.col("business_unit_new"), F.col("cur_business_unit_proper"), lead="", new_lpad=5, rpad_total=15),
        X.Field("dept", F.col("deptid_new"), F.col("cur_deptid_proper")),
        X.Field("location", F.col("location_new"), F.col("cur_location_proper")),
        X.Field("jobcode", F.col("jobcode_new"), F.col("cur_jobcode_proper")),
        X.Field("company", F.col("company_new"), F.col("cur_company_proper")),
        X.Field("std_hours", "std_hours_new", "cur_std_hours_proper", rpad_value=8, fmt=O.num_text),
        X.Field("reports_to", F.col("reports_to_new"), F.col("cur_reports_to_proper")),
        X.Field("shift", F.col("shift_new"), F.col("cur_shift_proper")),
    ]
    a = a.withColumn("remaining_value_diff", X.field_diff(diff_fields))
    key_cols = ["deptid_new", "location_new", "jobcode_new", "shift_new", "reg_temp_new", "union_cd_new",
                "business_unit_new", "company_new"]
    a = a.withColumn("future_key", O.cat(*[x for i, c in enumerate(key_cols + ["std_hours_new", "reports_to_new", "flsa_status_new"])
                                          for x in ((F.lit("|"),) if i else ()) + ((nt(c) if c == "std_hours_new" else F.col(c)),)]))
    a = a.withColumn("missing_head_count", F.col("cur_pos_head_count") - F.col("cur_incumbent_count"))
    # feeds three grouped counts and the match
    return cut_lineage(a)


def ranked(a: DataFrame) -> DataFrame:
    """With the counts of equal future values per slot and who of them keeps it."""
    g2 = a.groupBy("paste_id", "cur_pos", "future_key").agg(F.count(F.lit(1)).alias("cur_incumbent_fut_matching"))
    g3 = a.groupBy("paste_id", "cur_pos").agg(
        F.sum(F.when(F.col("remaining_value_diff").isNull(), 0).otherwise(1)).alias("total_pos_remaining_value_diffs"))
    # G4 on the reduced (slot, future key) frame
    g4 = g2.withColumn("tfr_retain_one", F.dense_rank().over(
        Window.partitionBy("paste_id", "cur_pos").orderBy(F.col("cur_incumbent_fut_matching").desc(),
                                                          F.col("future_key").asc_nulls_last())))
    a = a.join(g4, ["paste_id", "cur_pos", "future_key"], "left").join(g3, ["paste_id", "cur_pos"])
    return a.withColumn("missing_head_count_fut_matching", F.col("cur_pos_head_count") - F.col("cur_incumbent_fut_matching"))


def matched(a: DataFrame, positions: DataFrame, heads: DataFrame) -> DataFrame:
    """With the best existing slot for the proposed values at the request's date (E7, E8, C5) and its planned moves."""
    gate = F.col("remaining_value_diff").isNotNull() & (
        (F.col("missing_head_count") > 0) | ((F.col("missing_head_count") == 0) & (F.col("tfr_retain_one") > 1)))
    # what is looked for, once per date and combination of values, met with the slots' intervals
    want = a.filter(gate).select(F.col("effdt").alias("at"), *[F.col(c + "_new").alias("__w_" + c) for c in FIELDS]).distinct()
    slots = D.versions(positions, "position_nbr", "effdt").filter((F.col("eff_status") == "A") & F.col("manager_level").isNotNull())
    met = [slots[c] == want["__w_" + c] for c in FIELDS]
    met += [slots["effdt"] <= want["at"], slots["valid_to"].isNull() | (want["at"] < slots["valid_to"])]
    cand = want.join(slots, met).select("at", "position_nbr", "max_head_count", "manager_level", *[slots[c] for c in FIELDS])
    cand = with_head_count(cand, heads, "position_nbr", "at", "head_count")
    a = M.best_match(
        a, cand, on=[("effdt", "at"), *[(c + "_new", c) for c in FIELDS]],
        order_by=[M.Sort("head_count", desc=True), M.Sort("max_head_count", desc=True), M.Sort("position_nbr")],
        left_id=["paste_id", "line_no", "row_pos"], right_cols=["position_nbr", "head_count", "max_head_count"],
        # a slot without a manager level is no candidate here
        eligible=(C.is_manager("manager_level") == 0) | (F.col("head_count") == 0),
        exclude=("cur_pos", "position_nbr"), left_gate=gate,
    ).withColumnsRenamed({"position_nbr": "tfr_pos", "head_count": "tfr_pos_head_count", "max_head_count": "tfr_pos_max_head_count"})
    a = cut_lineage(a)
    moves = a.filter(F.col("tfr_pos").isNotNull()).groupBy("paste_id", "tfr_pos").agg(F.count(F.lit(1)).alias("tfr_moves"))
    return a.join(moves, ["paste_id", "tfr_pos"], "left")


def finished(a: DataFrame) -> DataFrame:
    """Load strings, audits and status of matched requests."""
    diff = F.col("remaining_value_diff")
    mhf = F.col("missing_head_count_fut_matching")
    mh = F.col("missing_head_count")
    retain = F.col("tfr_retain_one")
    tfr = F.col("tfr_pos")
    eff = O.date_text("effdt")
    nt = O.num_text
    seq = X.next_effseq("cur_job_effdt", "effdt", "cur_job_effseq")
    chg = X.changed_only
    upd = F.when(diff.isNotNull() & (mhf == 0), X.load_string(
        F.col("cur_pos"), eff, F.lit("A"), F.col("action_reason"),
        chg("business_unit_new", "cur_business_unit_proper"), chg("deptid_new", "p_deptid"),
        chg("jobcode_new", "p_jobcode"), F.lit(None).cast("string"),
        O.decode("p_update_incumbents", {"Y": F.lit(None).cast("string")}, "Y"),
        chg("reports_to_new", "p_reports_to"), chg("location_new", "p_location"), chg("company_new", "p_company"),
        nt(chg("std_hours_new", "p_std_hours")), chg("union_cd_new", "p_union_cd"), chg("shift_new", "p_shift"),
        chg("reg_temp_new", "p_reg_temp"), chg("fpc_new", "p_full_part_time"), chg("flsa_status_new", "p_flsa_status"),
        O.decode("p_include_title", {"Y": F.lit(None).cast("string")}, "Y")))
    create = F.when(diff.isNotNull() & tfr.isNull() & ((mh != 0) | ((mh == 0) & (retain != 1))), X.load_string(
        F.lit("00000000"), eff, F.lit("A"), F.lit("NEW"), F.col("business_unit_new"), F.col("deptid_new"),
        F.col("jobcode_new"), F.when(F.col("cur_pos_mgr_bool") == 1, "1").otherwise("99"), F.lit("Y"),
        F.col("reports_to_new"), F.col("location_new"), F.col("company_new"), nt(F.col("std_hours_new")),
        F.col("union_cd_new"), F.col("shift_new"), F.col("reg_temp_new"), F.col("fpc_new"), F.col("flsa_status_new"),
        F.lit("Y")))
    move = F.when(diff.isNotNull() & tfr.isNotNull() & (mhf != 0), X.load_string(
        F.col("emplid"), F.col("empl_rcd").cast("string"), eff, seq.cast("string"), tfr, F.lit("POS"),
        F.col("action_reason")))
    ov = F.col("cur_job_pos_override")
    odc = F.col("override_diff_check")
    reverse = (
        F.when((ov == "N") & ((diff.isNull() & (odc == 0)) | diff.isNotNull()), F.lit(None).cast("string"))
        .when((ov == "N") & diff.isNull() & (odc == 1), O.cat(
            F.lit("!!Override reversal UNSAFE. Leave Unresolved. Position Override is N but there are remaining differences: "),
            "override_remaining_values_diff"))
        .when((ov == "Y") & diff.isNotNull(), F.lit("Override reversal pending. Must complete position moves."))
        .when((ov == "Y") & diff.isNull() & (odc == 1), O.cat(
            F.lit("!!Override reversal UNSAFE. Leave Unresolved. Remaining differences: "), "override_remaining_values_diff"))
        .otherwise(X.load_string(F.col("emplid"), F.col("empl_rcd").cast("string"), eff, seq.cast("string"),
                                 F.lit("N"), F.lit("POS"), F.lit("UPD"))))
    capacity = F.when(diff.isNotNull() & (mh == 0) & (retain == 1) & (mhf != 0), F.lit("Pending pos update after transfers.")) \
        .otherwise(X.plural_audit("tfr_moves", "tfr_pos_head_count", "tfr_pos_max_head_count", "tfr_pos"))
    status = (
        F.when(F.col("total_pos_remaining_value_diffs") == 0, "-----Completed-----")
        .when(diff.isNotNull() & (mhf == 0), "1.  POSITION_UPDATE Position_update_complete_exceltoci")
        .when(diff.isNotNull() & tfr.isNull() & ((mh > 0) | ((mh == 0) & (retain > 1))),
              "2.  POSITION_CREATE Position_create_complete_exceltoci")
        .when(diff.isNotNull() & tfr.isNotNull(), "3.  JOB_POS_TRANSFER Job_update_position_nbr_exceltoci")
        .when(diff.isNotNull() & (mh == 0) & (retain == 1) & (mhf > 0), "3.1 !Pending pos update after transfers.!")
        .when(diff.isNull() & (ov == "Y") & (odc == 0), "4.  JOB_REVERSE_OVERRIDE Job_update_override_position_exceltoci")
    )
    full_move = F.when(F.col("total_pos_remaining_value_diffs") != 0, F.when(mhf == 0, "Yes").otherwise("No"))
    return a.select(
        "paste_id", "line_no", "row_pos", "emplid", "empl_rcd", "cur_job_effdt", "cur_job_effseq", F.col("effdt").alias("new_effdt"),
        F.col("action_reason").alias("acn_rsn"), status.alias("status"), full_move.alias("full_incumbent_move"),
        "cur_company_proper", "override_remaining_values_diff", "cur_pos", "tfr_pos", upd.alias("position_update_complete_exceltoci"), "remaining_value_diff",
        create.alias("position_create_complete_exceltoci"), capacity.alias("audit_tfr_move_plus_cur_over_max"),
        move.alias("job_update_position_nbr_exceltoci"), "cur_job_pos_override",
        reverse.alias("job_update_override_position_exceltoci"),
        D.same_day_warning("effdt", "cur_job_effdt", diff.isNotNull()).alias("audit_effdt_exists"),
        "missing_head_count", F.col("tfr_retain_one").cast("int").alias("tfr_retain_one"),
        "cur_pos_head_count", "cur_incumbent_count", "total_pos_remaining_value_diffs", "audit_newer",
        *[c + "_new" for c in ("business_unit", "deptid", "location", "jobcode", "company", "reports_to", "shift", "fpc",
                                "union_cd", "reg_temp", "flsa_status")],
        nt("std_hours_new").alias("std_hours_new"),
    )


def report_order() -> list[Column]:
    """Open slots first; of the completed, rows with an override step first (H1)."""
    done = F.col("total_pos_remaining_value_diffs") == 0
    step = F.col("job_update_override_position_exceltoci")
    return [F.coalesce(done, F.lit(False)).cast("int").asc(), F.when(done, step.isNull().cast("int")).asc_nulls_last(),
            F.when(done, step).asc_nulls_last(), O.asc("status"), O.asc("cur_pos"), O.asc("emplid"), O.asc("empl_rcd"),
            O.asc("paste_id"), O.asc("line_no"), O.asc("row_pos")]
