"""Bulk position change: how often its inputs are read."""

from tenure.operators import effdt as D
from tenure.plans import bulk_paf as BP
from tenure.plans import catalog

from .conftest import SF001


def test_valued_requests_read_the_job_history_once(spark, monkeypatch):
    """The last frame written reads jobs for the newer-record audit alone (in the rows and in their counts)."""
    frames, cut = [], BP.cut_lineage
    monkeypatch.setattr(BP, "cut_lineage", lambda df: frames.append(df) or cut(df))
    catalog._bulk_valued(spark, SF001)
    plan = frames[-1]._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [o_orderkey#") <= 2


def test_history_and_lines_are_read_once_for_all_steps(spark, monkeypatch):
    """Of all frames written for valued requests one reads the job history, and one parses the lines (header, requests)."""
    plans = []
    for name in ("cut_lineage", "written"):
        step = getattr(BP, name, None)
        monkeypatch.setattr(BP, name, lambda df, step=step: plans.append(df._jdf.queryExecution().analyzed().toString()) or step(df), raising=False)
    catalog._bulk_valued(spark, SF001)
    assert sum(p.count("Relation [o_orderkey#") for p in plans) == 1
    assert sorted(p.count("Relation [c_custkey#") for p in plans)[:-1] == [0] * (len(plans) - 1)


def test_job_days_hold_what_the_history_holds(spark):
    """Days with several records, ties, missing keys and dates: intervals and head counts are those of the whole history."""
    rest = [c for c in BP.FIELDS if c != "std_hours"]
    keys = [("a", 0), ("a", 1), ("b", 0), (None, 0), ("c", None)]
    rows = [(*k, d and f"2020-01-0{d}", s, "AI"[(i + s) % 2], f"P{i % 3}", "N", i, *[str(i)] * len(rest))
            for i, (k, d, s) in enumerate((k, d, s) for k in keys for d in (1, 2, 4, None) for s in (0, 1, 1))]
    names = [*BP.JOB_KEYS, "effdt", "effseq", "hr_status", "position_nbr", "position_override", "std_hours", *rest]
    job = spark.createDataFrame(rows, "emplid string, empl_rcd int, effdt string, effseq int, hr_status string, position_nbr string, "
                                "position_override string, std_hours int, " + ", ".join(f"{c} string" for c in rest))
    job = job.withColumn("effdt", job.effdt.cast("date"))
    days = BP.job_days(job)
    assert days.count() == 3 * 3 * 2
    whole = D.versions(job, BP.JOB_KEYS, "effdt", "effseq")
    as_rows = lambda df, cols: sorted(map(str, df.select(*cols).collect()))
    assert as_rows(D.versions(days, BP.JOB_KEYS, "effdt"), [*names, "valid_to"]) == as_rows(whole, [*names, "valid_to"])
    want = D.counts_over_time(whole.filter("hr_status = 'A'"), "position_nbr")
    assert as_rows(BP.head_counts(days), want.columns) == as_rows(want, want.columns)


def test_requests_are_dealt_before_they_are_parsed(spark):
    """Lines of one partition end in several."""
    lines = spark.range(1, 20_001).coalesce(1).selectExpr("id % 2 as paste_id", "id as line_no", "concat('00', id, '|0|||||') as text")
    heads = spark.createDataFrame([(0, 0, "1998-06-30|A"), (1, 0, "1998-07-01|B")], "paste_id long, line_no long, text string")
    lines = lines.unionByName(heads).coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = BP.requests(lines)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found.rdd.getNumPartitions() > 1
    assert found.count() == 20_000
    assert sorted(map(str, found.collect())) == sorted(map(str, BP.parse_requests(lines).collect()))
