"""HR-shaped inputs derived from the driver's TPC-H-like tables.

The reference ships no data, so the catalog derives effective-dated HR tables
from the driver tables with deterministic column arithmetic. Every fixture
reads its whole source table (its size grows with the scale factor); none is
a fixed literal. The same derivations exist as DuckDB SQL in
``fixtures_sql.py`` for the oracle checks.

All derivations are narrow projections (no shuffle) except ``job``'s
``effseq`` (a window over a person's changes on one day) and
``names_searched`` (a distinct over the name domain).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: scan one driver table (parquet; column pruning and filters push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c, n) -> F.Column:
    return F.lpad(c.cast("string"), n, "0")


def _hours(k) -> F.Column:
    return F.when(k == 0, 40).when(k == 1, 24).otherwise(12).cast("decimal(6,2)")


# Fixed value: manager-level codes cycled by key (first character of the
# cycle for key % 10 == 0).
LEVEL_CYCLE = "1236ABC79D"


def job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ps_job``: one row per order = one change of a person's job record."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rcd = (k % 2).cast("int")
    day = F.col("o_orderdate").cast("date")
    seq_w = Window.partitionBy("o_custkey", rcd, day).orderBy(k)
    return o.select(
        _pad(F.col("o_custkey"), 6).alias("emplid"),
        rcd.alias("empl_rcd"),
        day.alias("effdt"),
        (F.row_number().over(seq_w) - 1).cast("int").alias("effseq"),
        F.when(F.col("o_orderstatus") == "F", "I").otherwise("A").alias("hr_status"),
        F.when(k % 9 == 0, "POI").otherwise("EMP").alias("per_org"),
        _pad(k % 200, 8).alias("position_nbr"),
        F.when(k % 6 == 0, "Y").otherwise("N").alias("position_override"),
        F.concat(F.lit("BU"), (k % 2).cast("string")).alias("business_unit"),
        _pad(k % 4, 4).alias("deptid"),
        _pad(k % 3, 4).alias("location"),
        _pad(k % 5, 4).alias("jobcode"),
        F.when(k % 4 == 0, "101").otherwise("001").alias("company"),
        _hours(k % 3).alias("std_hours"),
        _pad(k % 10, 8).alias("reports_to"),
        F.when(k % 6 == 0, "73").otherwise("NON").alias("union_cd"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.substring("o_orderpriority", 1, 1)).alias("shift"),
        F.when(k % 7 == 0, "T").otherwise("R").alias("reg_temp"),
        F.when(k % 3 == 0, "F").when(k % 3 == 1, "P").otherwise("C").alias("full_part_time"),
        F.when(k % 2 == 0, "N").otherwise("E").alias("flsa_status"),
        F.when(k % 2 == 0, "P").otherwise("S").alias("job_indicator"),
        F.when(k % 19 == 0, "L").when(k % 23 == 0, "P").otherwise("A").alias("empl_status"),
        F.substring(F.lit(LEVEL_CYCLE), (k % 10).cast("int") + 1, 1).alias("officer_cd"),
        F.when(k % 17 == 0, "N").otherwise("Y").alias("elig_rehire"),
        F.when(F.col("o_orderstatus") == "F", day).alias("termination_dt"),
        F.date_sub(day, (k % 400).cast("int")).alias("hire_dt"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("hourly_rt"),
    )


def position_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ps_position_data``: every part is a slot with two effective-dated versions."""
    p = table(spark, sf_dir, "part")

    def version(ver: int, effdt: str) -> DataFrame:
        k = F.col("p_partkey")
        return p.select(
            _pad(k, 8).alias("position_nbr"),
            F.lit(effdt).cast("date").alias("effdt"),
            (F.when(k % 11 == 0, "I").otherwise("A") if ver else F.lit("A")).alias("eff_status"),
            F.concat(F.lit("BU"), (k % 2).cast("string")).alias("business_unit"),
            # version 1 moves half the slots to departments 0004-0007
            _pad((k + 4) % 8 if ver else k % 4, 4).alias("deptid"),
            _pad(k % 3, 4).alias("location"),
            _pad(k % 5, 4).alias("jobcode"),
            F.when(k % 4 == 0, "101").otherwise("001").alias("company"),
            _hours(k % 3).alias("std_hours"),
            _pad(k % 10, 8).alias("reports_to"),
            F.when(k % 6 == 0, "73").otherwise("NON").alias("union_cd"),
            (k % 2 + 1).cast("string").alias("shift"),
            F.when(k % 7 == 0, "T").otherwise("R").alias("reg_temp"),
            F.when(k % 3 == 0, "F").when(k % 3 == 1, "P").otherwise("C").alias("full_part_time"),
            F.when(k % 2 == 0, "N").otherwise("E").alias("flsa_status"),
            F.when(k % 3 == 0, "N").otherwise("Y").alias("include_title"),
            F.when(F.col("p_size") % 5 == 0, 1).otherwise(99).cast("int").alias("max_head_count"),
            F.when(k % 4 == 1, "N").otherwise("Y").alias("update_incumbents"),
            F.when(k % 5 == 0, "Y").otherwise("N").alias("avail_telework_pos"),
            F.when(k % 21 != 0, F.substring(F.lit(LEVEL_CYCLE), (k % 10).cast("int") + 1, 1)).alias("manager_level"),
        )

    return version(0, "1994-01-01").unionByName(version(1, "1998-01-01"))


def hires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfer requests; every 8th has a blank emplid."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.cast("string").alias("req_num"),
        F.when(k % 8 == 0, " ").otherwise(_pad(k, 6)).alias("emplid"),
        F.col("c_name").alias("name"),
        F.when(k % 4 == 0, "Transfer").when(k % 4 == 1, "FTE/Shift Changes")
        .when(k % 4 == 2, "Dual Employment").otherwise(" ").alias("hire_comments"),
        _pad((k + 1) % 150, 6).alias("mgr_id"),
        _pad(k % 4, 4).alias("deptid"),
        _pad(k % 5, 4).alias("jobcode"),
        _hours(k % 3).alias("std_hours"),
        (F.col("c_nationkey") % 2 + 1).cast("string").alias("shift"),
        F.when(k % 7 == 0, "T").otherwise("R").alias("reg_temp"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("hourly_rt"),
        F.lit("1999-01-01").cast("date").alias("start_date"),
        F.concat(F.lit("Manager "), ((k + 1) % 150).cast("string")).alias("mgr_name"),
        F.when(k % 9 == 0, F.lit(None)).when(k % 2 == 0, "N").otherwise("E").alias("flsa_status"),
        F.when(k % 6 != 0, F.date_add(F.lit("1985-01-01").cast("date"), (k % 900).cast("int"))).alias("prof_experience_dt"),
    )


def person_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisational instance of each employment record (dates of seniority and service)."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").withColumn("empl_rcd", F.explode(F.array(F.lit(0), F.lit(1))))
    c = c.filter((k % 14 != 0) | (F.col("empl_rcd") == 0))
    day = lambda y, n: F.date_add(F.lit(f"{y}-01-01").cast("date"), (k % n).cast("int"))
    return c.select(
        _pad(k, 6).alias("emplid"), F.col("empl_rcd").cast("int").alias("empl_rcd"),
        F.lit("EMP").alias("per_org"), F.col("empl_rcd").cast("int").alias("org_instance_ern"),
        (k % 3).cast("int").alias("benefit_rcd_nbr"),
        F.when(k % 4 != 0, day(1985, 900)).alias("prof_experience_dt"),
        day(1986, 700).alias("cmpny_seniority_dt"), day(1987, 500).alias("service_dt"),
        F.when(k % 5 != 0, day(1988, 300)).alias("seniority_pay_dt"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ps_employees``: current records; customers with a negative balance have left."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    k = F.col("c_custkey")
    c = c.withColumn("empl_rcd", F.explode(F.array(F.lit(0), F.lit(1))))
    r = F.col("empl_rcd")
    return c.select(
        _pad(k, 6).alias("emplid"),
        r.cast("int").alias("empl_rcd"),
        F.when(F.col("c_nationkey") % 2 == 0, "001").otherwise("101").alias("company"),
        F.concat(F.lit("PG"), (F.col("c_nationkey") % 3).cast("string")).alias("paygroup"),
        F.when((k % 5 != 0) & (r == 0), "P").otherwise("S").alias("job_indicator"),
        F.when((k + r) % 4 == 0, "T").otherwise("R").alias("reg_temp"),
        (F.lit(12) * (1 + (k + r) % 3)).cast("decimal(6,2)").alias("std_hours"),
    )


def refund_pastes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pasted refund text, one paste per customer.

    Each paste holds one or two comma-separated rows of six pipe-separated
    fields; some rows have an empty middle field, stray quotes, apostrophes
    and empty rows (``,,``).
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    amount = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    row1 = F.concat(
        F.lit("'"), _pad(k, 6), F.lit("|001|"),
        F.when(k % 19 == 0, F.lit("")).otherwise(F.lit("PARK;")),
        F.lit('|"A"|REF|'), amount,
    )
    row2 = F.concat(F.lit(",,"), _pad(k + 1, 6), F.lit("|101|PARK|B|REF|"), F.lit("5.25"))
    text = F.when(k % 5 == 0, F.concat(row1, row2)).otherwise(row1)
    return c.select(k.alias("paste_id"), text.alias("text"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hire-staging candidates, one per order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    return o.select(
        F.when(k % 3 == 0, F.concat(F.lit("R"), k.cast("string"))).otherwise(k.cast("string")).alias("req_num"),
        F.when(k % 25 == 0, "Y").otherwise("N").alias("load_status"),
        F.col("o_orderdate").cast("date").alias("hire_dt"),
        _pad(cust, 6).alias("manager_id"),
        _pad(k % 4, 4).alias("deptid"),
        _pad(k % 5, 4).alias("jobcode"),
        _hours(k % 3).alias("std_hours"),
        F.when(k % 16 == 3, _pad(cust + 900000000, 9)).otherwise(_pad(cust * 7, 9)).alias("national_id"),
        F.when(k % 11 != 0, (k % 3 + 1).cast("string")).alias("shift"),
        F.when(k % 7 == 0, "T").when(k % 7 != 1, "R").alias("reg_temp"),
        F.when(k % 5 == 0, "RMOTE").otherwise(_pad(k % 3, 4)).alias("location"),
        F.concat(F.lit("("), _pad(cust % 1000, 3), F.lit(") 555-"), _pad(k % 10000, 4)).alias("home_phone"),
        F.when(k % 4 == 0, F.concat(F.lit("Message: matches "), _pad(cust, 6)))
        .otherwise(F.lit("Message: none")).alias("message_descr"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("hourly_rt"),
        F.concat(F.lit("Last"), (cust % 90).cast("string")).alias("last_name"),
        F.concat(F.lit("First"), (k % 70).cast("string")).alias("first_name"),
        F.when(k % 3 == 0, F.lit("M")).alias("middle_name"),
        F.when(k % 15 != 0, F.date_add(F.lit("1960-01-01").cast("date"), (k % 9000).cast("int"))).alias("birthdate"),
        F.concat((k % 99).cast("string"), F.lit(" Elm St")).alias("address1"),
        F.when(k % 4 == 0, F.lit("Apt 2")).alias("address2"),
        F.concat(F.lit("City"), (k % 25).cast("string")).alias("city"),
        F.concat(F.lit("S"), (k % 50).cast("string")).alias("state_number"), _pad(k % 1000, 5).alias("postal"),
        F.concat(F.lit("555-"), _pad(k % 7919, 4), F.lit(" x")).alias("work_phone"),
        F.when(k % 6 != 0, F.concat(F.lit("+1 "), _pad(k % 6007, 7))).alias("mobile_phone"),
        F.concat(F.lit("c"), k.cast("string"), F.lit("@example.net")).alias("email_addr"),
        F.concat(F.lit("Role "), (k % 12).cast("string")).alias("descr100"),
        F.when(k % 2 == 0, "N").otherwise("E").alias("flsa_status"),
        F.when(k % 5 == 1, "Days").otherwise("Nights").alias("scheduled"),
        F.when(k % 3 == 0, "F").when(k % 3 == 1, "P").otherwise("C").alias("full_part_time"),
        F.when(k % 10 == 0, _pad(k, 10)).alias("alter_emplid"),
        F.when(k % 4 == 0, "New Hire").otherwise("Rehire").alias("hire_comments"),
        F.when(k % 9 != 0, F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")).alias("datein_prefix"),
    )


def names_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name history: every part is a name record; two parts per person."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        _pad(F.floor(k / 2), 6).alias("emplid"),
        F.when(k % 2 == 0, "PRI").otherwise("LEG").alias("name_type"),
        F.when(k % 2 == 0, 1).otherwise(2).cast("int").alias("order_by_seq"),
        F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type")).alias("name"),
    )


def names_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name list with typos (every ``e`` becomes ``i``), distinct over all parts."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.replace(F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")), F.lit("e"), F.lit("i")).alias("name_searched")
    ).distinct()


def jobcode_tbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ps_jobcode_tbl``: each supplier is one effective-dated version of a job code."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.when(k % 7 == 6, "OTHER").otherwise("SHARE").alias("setid"),
        _pad(k % 5, 4).alias("jobcode"),
        F.date_add(F.lit("1990-01-01").cast("date"), (F.floor(k / 5) * 30).cast("int")).alias("effdt"),
        F.substring(F.lit(LEVEL_CYCLE), (k % 10).cast("int") + 1, 1).alias("manager_level"),
        F.concat(F.lit("P"), (k % 2).cast("string")).alias("sal_admin_plan"),
        _pad(k % 9, 3).alias("grade"),
        F.when(k % 3 == 0, "73").when(k % 3 == 1, "399").otherwise("NON").alias("union_cd"),
        F.concat(F.lit("B"), (k % 8).cast("string")).alias("job_family"),
        F.concat(F.lit("Job "), k.cast("string")).alias("descr"), F.concat(F.lit("Job number "), k.cast("string")).alias("descr50"),
    )


def dept_tbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departments: each supplier is one effective-dated version of a department."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.when(k % 7 == 6, "OTHER").otherwise("SHARE").alias("setid"),
        _pad(k % 4, 4).alias("deptid"),
        F.date_add(F.lit("1990-01-01").cast("date"), (F.floor(k / 4) * 45).cast("int")).alias("effdt"),
        F.concat(F.lit("BU"), (F.floor(k / 4) % 2).cast("string")).alias("business_unit"),
        F.concat(F.lit("Department "), k.cast("string")).alias("descr"),
    )


def pers_nid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ps_pers_nid``: one national id per customer, a second one for every twelfth."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    own = _pad(k * 7 + F.when(k % 10 == 9, 1).otherwise(0), 9)
    ids = F.filter(F.array(own, F.when(k % 12 == 0, _pad(k + 900000000, 9))), lambda x: x.isNotNull())
    return c.select(
        _pad(k, 6).alias("emplid"),
        F.lit("USA").alias("country"),
        F.lit("PR").alias("national_id_type"),
        F.explode(ids).alias("national_id"),
    )


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One person per customer with a birth date (every 17th has none on file)."""
    k = F.col("c_custkey")
    born = F.when(k % 17 != 0, F.date_add(F.lit("1950-01-01").cast("date"), (k % 9000).cast("int")))
    return table(spark, sf_dir, "customer").select(_pad(k, 6).alias("emplid"), born.alias("birthdate"))


# Words of made-up payroll names, like those searched for.
PS_WORDS = ["hot", "old", "blue", "large", "cold", "small"]
PS_NOUNS = ["ring large", "bolt economy", "ring small", "plate standard", "plate economy"]


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ps_names``: primary display names; every 10th customer's name is shared by the next person."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    own = F.struct(_pad(k, 6).alias("emplid"), F.lit("1990-01-01").cast("date").alias("effdt"))
    twin = F.when(k % 10 == 3, F.struct(_pad(k + 1, 6).alias("emplid"), F.lit("1996-01-01").cast("date").alias("effdt")))
    rows = c.select("c_custkey", "c_name", "c_nationkey", F.explode(F.array(own, twin)).alias("r")).filter(F.col("r").isNotNull())
    return rows.select(
        F.col("r.emplid").alias("emplid"),
        F.lit("PRI").alias("name_type"),
        F.col("r.effdt").alias("effdt"),
        F.col("c_name").alias("name_display"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("Q")).alias("middle_name"),
        F.concat(F.element_at(F.array(*[F.lit(x) for x in PS_WORDS]), (k % len(PS_WORDS) + 1).cast("int")), F.lit(" "),
                 F.element_at(F.array(*[F.lit(x) for x in PS_NOUNS]), (F.floor(k / 3) % len(PS_NOUNS) + 1).cast("int"))).alias("name_psformat"),
    )


def phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone numbers by type: HOME for two thirds of the customers, CELL for half of them, a second CELL for some."""
    k = F.col("c_custkey")
    number = F.concat(F.lit("555"), _pad(k, 7))
    one = lambda kind, mark: F.struct(F.lit(kind).alias("phone_type"), F.concat(number, F.lit(mark)).alias("phone"))
    kinds = F.array(F.when(k % 3 != 0, one("HOME", "H")), F.when(k % 2 == 0, one("CELL", "C")), F.when(k % 20 == 0, one("CELL", "C2")))
    return table(spark, sf_dir, "customer").select(_pad(k, 6).alias("emplid"), F.inline(F.filter(kinds, lambda x: x.isNotNull())))


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOME addresses of three quarters of the customers."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter(k % 4 != 0).select(
        _pad(k, 6).alias("emplid"), F.lit("HOME").alias("address_type"), F.concat((k % 99).cast("string"), F.lit(" Main St")).alias("address1"),
        F.concat(F.lit("City"), F.col("c_nationkey").cast("string")).alias("city"), _pad(k % 1000, 5).alias("postal"),
        F.when(k % 8 == 1, F.lit("Unit 7")).alias("address2"), F.concat(F.lit("County"), (k % 30).cast("string")).alias("county"),
        F.concat(F.lit("S"), (k % 50).cast("string")).alias("state"))


def user_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User ids of four fifths of the customers."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter(k % 5 != 0).select(_pad(k, 6).alias("emplid"), F.concat(F.lit("U"), k.cast("string")).alias("oprid"))


def location_tbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations: each supplier is one effective-dated version."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(k % 7 == 6, "OTHER").otherwise("SHARE").alias("setid"), _pad(k % 3, 4).alias("location"),
        F.date_add(F.lit("1990-01-01").cast("date"), (F.floor(k / 3) * 20).cast("int")).alias("effdt"),
        F.col("s_name").alias("descr"), F.concat(F.lit("B"), (k % 11).cast("string")).alias("building"),
        F.concat(F.lit("AC"), (k % 13).cast("string")).alias("descr_ac"), F.concat(F.lit("G"), (k % 17).cast("string")).alias("geo_code"))


RECIPIENT_COLUMNS = ["emplid", "full_name", "refund_amount", "segment"]


def recipients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recipient sheet as it arrives from a CSV: raw headers, padded values, blank rows."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    blank = k % 29 == 0
    amount = F.when(k % 13 == 0, F.lit("n/a")).when(k % 31 == 0, "1.2.3").when(k % 37 == 0, "5-").when(
        k % 17 == 0, "$12345678901234567890123456789012.345").when(k % 19 == 0, "9" * 60).when(k % 23 == 0, "555-1234").otherwise(
        F.concat(F.lit("$"), F.col("c_acctbal").cast("decimal(12,2)").cast("string")))
    vals = [
        _pad(k, 6),
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(",  "), F.replace("c_name", F.lit("#"), F.lit("-")), F.lit("!")),
        amount,
        F.col("c_mktsegment"),
    ]
    heads = ["Employee ID", " Full-Name ", "Refund Amount ($)", "Segment"]
    return c.select(*[F.when(blank, F.lit("  ")).otherwise(v).alias(h) for v, h in zip(vals, heads)])


def remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A remark per customer: some with line ends, quotes and commas, some with letters beyond ASCII."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    text = F.when(k % 7 == 0, F.lit('first line\nsecond, "quoted"')).when(k % 5 == 0, F.lit("  Zoë, Müller  ")).otherwise(F.col("c_mktsegment"))
    return c.select(k.cast("string").alias("id"), F.col("c_name").alias("name"), text.alias("remark"))


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ps_email_addresses``: one address per customer; every 5th is HOME, every 23rd malformed."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    addr = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org"))
    return c.select(
        _pad(k, 6).alias("emplid"),
        F.when(k % 5 == 0, "HOME").otherwise("BUSN").alias("e_addr_type"),
        F.when(k % 23 == 0, F.lit("not-an-email")).otherwise(addr).alias("email_addr"),
    )


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One letter template per customer (subject + HTML body with ``{{field}}`` tokens)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    extra = F.when(k % 3 == 0, F.lit(" {{segment}}")).otherwise(F.lit(" {{missing_field}}"))
    body = F.concat(F.lit("<p>Dear {{ <b>full_name</b> }},</p><p>Your refund of {{refund_amount}} is ready ("),
                    F.col("c_mktsegment"), extra, F.lit("). Ref {{employee_id}} {{employee_id}}</p>"))
    return c.select(_pad(k, 6).alias("template_id"), F.lit("Refund for {{full_name}}").alias("subject"),
                    body.alias("html_body"))


# Header line of each paste: date|reason.
BULK_HEADERS = ["1998-06-30|REORG", "1996-06-30|REALIGN"]


def _bulk_requests(spark: SparkSession, sf_dir: str, paste) -> DataFrame:
    """One request line per customer in the paste numbered ``paste``.

    Request fields: emplid|empl_rcd|deptid|location|jobcode|std_hours|shift|mgr_position;
    an empty field keeps the current value.
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    fields = [
        F.concat(F.lit("'"), _pad(k, 6)),
        (k % 2).cast("string"),
        F.when(k % 3 == 0, _pad((k + 1) % 4, 4)).otherwise(F.lit("")),
        F.lit(""),
        F.when(k % 5 == 0, _pad((k + 2) % 5, 4)).otherwise(F.lit("")),
        F.when(k % 4 == 0, F.lit("12")).otherwise(F.lit("")),
        F.when(k % 7 == 0, F.lit("2")).otherwise(F.lit("")),
        F.lit(""),
    ]
    return c.select(paste(k).cast("long").alias("paste_id"), (k + 1).alias("line_no"), F.concat_ws("|", *fields).alias("text"))


def bulk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bulk position-change requests: header line 0 (effdt|reason), one request line per customer."""
    header = spark.range(len(BULK_HEADERS)).select(
        F.col("id").alias("paste_id"), F.lit(0).cast("long").alias("line_no"),
        F.element_at(F.array(*[F.lit(h) for h in BULK_HEADERS]), (F.col("id") + 1).cast("int")).alias("text"))
    return header.unionByName(_bulk_requests(spark, sf_dir, lambda k: F.when(k % 5 == 0, 1).otherwise(0)))


def bulk_lines_by_date(spark: SparkSession, sf_dir: str, dates: int = 200) -> DataFrame:
    """As ``bulk_lines``, with one paste for each of ``dates`` days and one whose date is missing."""
    i = F.col("id")
    day = F.date_add(F.lit("1995-01-15").cast("date"), (i * 11).cast("int")).cast("string")
    header = spark.range(dates + 1).select(
        i.alias("paste_id"), F.lit(0).cast("long").alias("line_no"),
        F.concat(F.when(i < dates, day).otherwise(""), F.lit("|REORG"), i.cast("string")).alias("text"))
    return header.unionByName(_bulk_requests(spark, sf_dir, lambda k: k % (dates + 1)))
