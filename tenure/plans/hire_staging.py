"""Hire staging and the clinical-hire report.

Plan: filter the candidate window (C2, pushed to the scan) -> narrow
cleaning (B4, B6, B7, B9) -> left join national ids (E21) -> manager slot
via the D11 left-as-of rule -> department and job-family lookups as-of
(E5, one small as-of frame each) -> the two history roll-ups (E17/F3/F4/E20)
computed once per person (group by emplid, ordered ``listagg``) and joined
-> combination rules (B38, F6, F7) -> report columns (G10, A14, B13).
A person's roll-up is built once no matter how many candidates point to
that person.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import oracle as O
from ..operators import diff as X
from ..operators import effdt as D
from ..session import cut_lineage

JOB_KEYS = ["emplid", "empl_rcd"]
OFFICER_EXCLUDED = ["9", "7", "D"]
HISTORY_SEP = "   "
HISTORY_WIDTH = 85


def valid_nids(nid: DataFrame) -> DataFrame:
    """US primary national ids that are all digits."""
    return nid.filter((F.col("country") == "USA") & (F.col("national_id_type") == "PR")
                      & O.all_digits("national_id"))


def person_history(job: DataFrame, nid: DataFrame, person: DataFrame, names: DataFrame, asof,
                   people: DataFrame | None = None) -> DataFrame:
    """Per person: in-force records in report order, rehire flags, own national ids.

    ``people`` (one column ``emplid``) limits the work to these before anything is
    rolled up. A person's records are few, so they stay together as an array.
    """
    if people is not None:
        job, nid, person, names = (x.join(people, "emplid", "left_semi") for x in (job, nid, person, names))
    cur = D.asof_rows(job, JOB_KEYS, "effdt", asof, "effseq")
    name = D.asof_rows(names.filter(F.col("name_type") == "PRI"), ["emplid", "name_type"], "effdt", asof, ties="any",
                       tiebreak=["last_name", "first_name"])
    cur = cur.join(person.select("emplid", "birthdate"), "emplid").join(name.select("emplid", "last_name", "first_name"), "emplid")
    head = _joined("hr_status", "per_org", "emplid", F.col("empl_rcd").cast("string"), O.date_text("effdt"))
    tail = _joined(O.date_text("birthdate"), "deptid", "jobcode", "last_name", "first_name")
    # nulls first: a record without an end stands before ended ones
    order = ["per_org", "hr_status", (-F.unix_date("termination_dt")).alias("ended"), "job_indicator", "empl_rcd"]
    rows = cur.groupBy("emplid").agg(
        F.array_sort(F.collect_list(F.struct(*order, head.alias("head"), tail.alias("tail"), "elig_rehire"))).alias("records"))
    ids = nid.filter((F.col("country") == "USA") & (F.col("national_id_type") == "PR")
                     & F.col("national_id").isNotNull() & (F.col("national_id") != "XXXXXXXXX")) \
        .groupBy("emplid").agg(F.array_sort(F.collect_set("national_id")).alias("ids"))
    return rows.join(ids, "emplid", "left").select(
        "emplid", "records", "ids",
        F.when(F.exists("records", lambda r: r["elig_rehire"] == "N"), "N").alias("rehire"),
        F.get("records", 0)["elig_rehire"].alias("first_rehire"))


def _joined(*cols) -> F.Column:
    """Slash-joined slots; NULL leaves its slot empty."""
    return F.concat(*[x for i, c in enumerate(cols) for x in ((F.lit("/"),) if i else ()) + (F.coalesce(O.col(c), F.lit("")),)])


def history_text(records, national_id, cut: bool = False) -> F.Column:
    """The roll-up as text; lines are padded to the layout's width (and cut to it with ``cut``)."""
    nid = F.coalesce(O.col(national_id), F.lit("no_ssn_in_system"))

    def line(r: F.Column) -> F.Column:
        whole = F.concat(r["head"], F.lit("/"), nid, F.lit("/"), r["tail"])
        return F.rpad(whole, F.lit(HISTORY_WIDTH) if cut else F.greatest(F.length(whole), F.lit(HISTORY_WIDTH)), F.lit(" "))

    return F.array_join(F.transform(records, line), HISTORY_SEP)


def _combine(lm: F.Column, ssn: F.Column) -> F.Column:
    """one string if the other is NULL or equal; else the EMP roll-up first."""
    return (F.when(lm.isNull(), ssn).when(ssn.isNull(), lm).when(lm == ssn, lm)
            .when(F.substring(lm, 3, 1) == "E", F.concat(lm, F.lit("-"), ssn))
            .otherwise(F.concat(ssn, F.lit("-"), lm)))


def base(candidates: DataFrame, job: DataFrame, nid: DataFrame, dept: DataFrame, jobcode: DataFrame,
         asof, start=None, days: int = 0, families: list[str] | None = None, window_days: int | None = None) -> DataFrame:
    c = candidates.filter(F.col("load_status") == "N")
    asof_d = F.lit(asof).cast("date")
    if start is not None:
        s = F.lit(start).cast("date")
        c = c.filter(F.col("hire_dt").between(s, F.date_add(s, int(days or 0))))
    if window_days is not None:
        c = c.filter(F.col("hire_dt").between(F.date_sub(asof_d, window_days), F.date_add(asof_d, window_days)))
    jc = D.asof_rows(jobcode.filter(F.col("setid") == "SHARE"), ["setid", "jobcode"], "effdt", asof)
    jc = jc.select("jobcode", "job_family")
    if families is not None:
        c = c.join(jc.filter(F.col("job_family").isin(families)), "jobcode", "inner")
    else:
        c = c.join(jc, "jobcode", "left")
    c = c.select("*", O.strip_prefix("message_descr").alias("message"), O.trailing_id("message_descr").alias("lm_emplid"),
                 O.digits_only("home_phone").alias("phone"), O.to_number_or_zero("req_num", "decimal(20,0)").alias("num_order"))
    ids = valid_nids(nid).select(F.col("national_id"), F.col("emplid").alias("ssn_matching_emplid"))
    c = c.join(ids, "national_id", "left")
    # manager slot: the D11 rule (active, officer code allowed, in force)
    ok = (F.col("hr_status") == "A") & ~F.col("officer_cd").isin(OFFICER_EXCLUDED)
    c = D.left_asof(c, job, "manager_id", "emplid", JOB_KEYS, ok, {"position_nbr": "mgr_position_nbr"}, "effdt", "effseq", asof)
    c = c.withColumn("mgr_position_nbr", F.coalesce("mgr_position_nbr", F.lit("XXXXXXXX")))
    d = D.asof_rows(dept.filter(F.col("setid") == "SHARE"), ["setid", "deptid"], "effdt", asof)
    # the candidates are few beside the tables, and every part of a report starts from them
    return cut_lineage(c.join(d.select("deptid", "business_unit"), "deptid", "left"))


def with_contacts(c: DataFrame, phones: DataFrame, emails: DataFrame) -> DataFrame:
    """Cell phone and home e-mail of the person with the candidate's national id; several give several rows."""
    cell = phones.filter(F.col("phone_type") == "CELL").select(F.col("emplid").alias("__e"), O.digits_only("phone").alias("current_ps_cell"))
    c = c.join(cell, c["ssn_matching_emplid"] == cell["__e"], "left").drop("__e")
    home = emails.filter(F.col("e_addr_type") == "HOME").select(F.col("emplid").alias("__e"), F.col("email_addr").alias("current_ps_hm_email"))
    return c.join(home, c["ssn_matching_emplid"] == home["__e"], "left").drop("__e")


def with_history(c: DataFrame, job: DataFrame, nid: DataFrame, person: DataFrame, names: DataFrame, asof) -> DataFrame:
    people = c.select(F.col("lm_emplid").alias("emplid")).union(c.select("ssn_matching_emplid")).distinct()
    h = person_history(job, nid, person, names, asof, people.filter("emplid is not null"))
    lm = h.select(F.col("emplid").alias("lm_emplid"), *[F.col(x).alias("lm_" + x) for x in ("records", "rehire", "first_rehire", "ids")])
    ss = h.select(F.col("emplid").alias("ssn_matching_emplid"), F.col("records").alias("ssn_records"), F.col("rehire").alias("ssn_rehire"))
    c = c.join(lm, "lm_emplid", "left").join(ss, "ssn_matching_emplid", "left")
    # A mismatch only if none of the person's ids is the candidate's
    mine = F.coalesce(F.array_contains("lm_ids", F.col("national_id")), F.lit(False))
    mismatch = F.col("lm_records").isNotNull() & F.col("lm_ids").isNotNull() & ~mine
    lm_text = F.when(mismatch, F.concat(F.lit("SSN MISMATCH! "), F.get("lm_ids", 0), F.lit(" <> "), F.coalesce("national_id", F.lit("")))) \
        .otherwise(history_text("lm_records", F.when(mine, F.col("national_id"))))
    lm_rehire = F.when(mismatch, F.when(F.col("lm_first_rehire") == "N", "N")).otherwise(F.col("lm_rehire"))
    same = F.coalesce(F.col("ssn_matching_emplid") == F.col("lm_emplid"), F.lit(False))
    ssn_text = F.when(~same, history_text("ssn_records", "national_id"))
    ssn_rehire = F.when(~same, F.col("ssn_rehire"))
    lm_id, ssn_id = F.col("lm_emplid"), F.col("ssn_matching_emplid")
    c = c.withColumn("__lm", lm_text).withColumn("__ssn", ssn_text)
    return c.select(
        *[x for x in c.columns if not x.startswith("__")],
        F.when(lm_id.isNull(), ssn_id).when(ssn_id.isNull(), lm_id).when(lm_id == ssn_id, lm_id)
        .otherwise(F.concat(lm_id, F.lit("-"), ssn_id)).alias("emplid_lm_ssn"),
        F.when((lm_rehire == "N") | (ssn_rehire == "N"), "N").alias("rehire_eligibility"),
        _combine(F.col("__lm"), F.col("__ssn")).alias("lm_ssn_combined_records"),
    )


# candidate column -> slot column: all must be equal for a slot to be shown
SLOT_FIELDS = [("deptid", "deptid"), ("jobcode", "jobcode"), ("mgr_position_nbr", "reports_to"), ("std_hours", "std_hours"),
               ("slot_shift", "shift"), ("reg_temp", "reg_temp"), ("fpc", "full_part_time"), ("telework", "avail_telework_pos")]


def first_slot(c: DataFrame, positions: DataFrame, counts: DataFrame, key: str = "req_num") -> DataFrame:
    """``c`` with ``post_chg_pos_use``: the first slot (by number) that fits the hire, in force
    on the hire date, as descriptive text (E9, D5, H3). ``counts``: head count per slot.

    A version holds from its date to the next one, so the candidate's own date picks the
    version inside the equi-join. Slots are reduced to the first per combination and interval and
    candidates to their combinations and days before they meet.
    """
    life = Window.partitionBy("position_nbr").orderBy("effdt")
    p = positions.withColumn("until", F.lead("effdt").over(life)).filter(F.col("eff_status") == "A")
    p = p.join(counts, "position_nbr", "left")
    pad = lambda x, n: F.lpad(F.coalesce(x, F.lit("")), F.greatest(F.length(F.coalesce(x, F.lit(""))), F.lit(n)), F.lit(" "))
    t = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    # Slot order and constants of the text.
    text = F.concat(
        t("position_nbr"), F.lit("|cur/in-"), pad(F.coalesce("head_count", F.lit(0)).cast("string"), 3), F.lit("|"), O.date_text("effdt"),
        F.lit("|"), t("eff_status"), F.lit("| | |UPD|"), pad(t("business_unit"), 6), F.lit("|"), t("deptid"), F.lit("|"), t("jobcode"),
        F.lit("|Y|HEAD?|"), pad(t("max_head_count"), 3), F.lit("|Y|"), t("reports_to"), F.lit("|"), pad(t("location"), 11),
        F.lit("|Maildrop?|"), t("company"), F.lit("|"), pad(O.num_text("std_hours"), 4), F.lit("|"), pad(t("union_cd"), 2), F.lit("|"),
        t("shift"), F.lit("|"), t("reg_temp"), F.lit("|"), t("full_part_time"), F.lit("| | |Y|"), t("avail_telework_pos"),
        F.lit("--Available telework|Y"))
    p = p.select("position_nbr", "effdt", "until", text.alias("post_chg_pos_use"), *[F.col(b).alias(f"__s{i}") for i, (_, b) in enumerate(SLOT_FIELDS)])
    own = c.filter(F.col("mgr_position_nbr") != "XXXXXXXX").withColumn("fpc", C.hours_category("std_hours", null_as="P"))
    own = own.withColumn("slot_shift", O.decode("shift", {"N": "1"}, F.col("shift")))
    own = own.withColumn("telework", O.decode("location", {"RMOTE": "Y"}, "N")).select(key, "hire_dt", *[a for a, _ in SLOT_FIELDS]).distinct()
    # slots of equal fields and days differ by number only: the first of them stands for all, so the pairs
    # of a combination grow with its days, not with its hires times its slots
    alike = [f"__s{i}" for i in range(len(SLOT_FIELDS))]
    p = p.dropna(subset=alike).groupBy(*alike, "effdt", "until").agg(F.min(F.struct("position_nbr", "post_chg_pos_use")).alias("__slot"))
    asked = [*[a for a, _ in SLOT_FIELDS], "hire_dt"]
    days = own.select(*asked).distinct()
    met = [days[a] == p[f"__s{i}"] for i, (a, _) in enumerate(SLOT_FIELDS)]
    met += [p["effdt"] <= days["hire_dt"], p["until"].isNull() | (days["hire_dt"] < p["until"])]
    fit = days.join(p, met).groupBy(*asked).agg(F.min("__slot").alias("__slot"))
    best = own.join(fit, asked).groupBy(F.col(key).alias("__k"), F.col("mgr_position_nbr").alias("__m")).agg(F.min("__slot").alias("__slot"))
    best = best.select("__k", "__m", "__slot.post_chg_pos_use")
    return c.join(best, (c[key] == best["__k"]) & (c["mgr_position_nbr"] == best["__m"]), "left").drop("__k", "__m")


def hire_staging(c: DataFrame, job, nid, person, names, phones, emails, positions, counts, asof) -> DataFrame:
    """J3 over the candidates of ``base``: people found, history, contacts, first fitting slot, load string."""
    c = first_slot(with_history(with_contacts(c, phones, emails), job, nid, person, names, asof), positions, counts)
    fpc = C.hours_category("std_hours", null_as="P")
    hours = F.when(F.col("std_hours") == 0, F.lit(1.2).cast("decimal(6,2)")).otherwise(F.col("std_hours"))
    # Slot order and constants of the load layout.
    position_ci = X.load_string(
        "00000000", O.date_text("hire_dt"), "A", " ", " ", "UPD", F.col("business_unit"), F.col("deptid"), F.col("jobcode"),
        "Y", "99", "Y", F.col("mgr_position_nbr"), " ", " ", "CMPY - Def101", O.num_text(hours), " ", F.col("shift"),
        O.decode("reg_temp", {"R": "R"}, "T"), fpc, " ", " ", "Y", "N", "Y")
    counted = c.groupBy(F.col("req_num").alias("__q")).agg(F.count(F.lit(1)).alias("req_count"))
    c = c.join(counted, F.col("req_num").eqNullSafe(F.col("__q")))
    return c.select(
        F.lit(None).cast("string").alias("notes"), F.col("load_status").alias("load"), F.col("req_num").alias("req"), "emplid_lm_ssn",
        "rehire_eligibility", "lm_ssn_combined_records", "last_name", "first_name", "middle_name", O.date_text("birthdate").alias("birthdate"),
        F.col("national_id").alias("ssn"), "address1", "address2", "city", F.col("state_number").alias("state"), "postal",
        F.col("phone").alias("home_phone"), O.digits_only("work_phone").alias("work_phone"), O.digits_only("mobile_phone").alias("mobile"),
        "current_ps_cell", F.col("email_addr").alias("email"), "current_ps_hm_email", "post_chg_pos_use", F.col("flsa_status").alias("flsa"),
        O.fm_2dp("hourly_rt").alias("hourly_pay"), "std_hours", F.col("datein_prefix").alias("prof_date"),
        F.col("hire_comments").alias("hire_type"), F.col("manager_id").alias("mgrid"), "deptid", "job_family", "jobcode",
        F.col("descr100").alias("jc100"), F.col("scheduled").alias("schedule"), F.col("reg_temp").alias("regtemp"),
        F.col("full_part_time").alias("fullpartc"), "shift", F.col("alter_emplid").alias("npi"), "req_count",
        O.date_text("hire_dt").alias("hire_dt"), position_ci.alias("position_ci"), "num_order",
    )


def report_order(request: str) -> list[Column]:
    """By hire date, numeric request order, request (H1); rows of one request by their other values."""
    return [O.asc("hire_dt"), O.asc("num_order"), O.asc(request)]


def clinical_report(c: DataFrame, positions, counts, phones, emails, asof) -> DataFrame:
    """J4 over the candidates of ``base`` (clinical job families, a +-100 day hire window)."""
    c = first_slot(with_contacts(c, phones, emails), positions, counts)
    return c.select(
        F.lit(None).cast("string").alias("notes"), O.date_text("hire_dt").alias("hire_dt"),
        O.date_text(F.lit(asof).cast("date")).alias("current_dt"), F.datediff("hire_dt", F.lit(asof).cast("date")).alias("days_until_hire"),
        "req_num", "lm_emplid", F.col("hire_comments").alias("hire_type"), "last_name", "first_name", "middle_name",
        O.date_text("birthdate").alias("birthdate"), F.col("national_id").alias("ssn"), "post_chg_pos_use", "job_family", "jobcode",
        "mgr_position_nbr", "ssn_matching_emplid", "num_order",
    )
