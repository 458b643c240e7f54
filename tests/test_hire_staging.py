"""Hire staging: the first fitting slot of a hire."""

import datetime as dt
import random
from decimal import Decimal

from tenure.plans import hire_staging as HS

CANDIDATE = ("req_num string, hire_dt date, deptid string, jobcode string, mgr_position_nbr string, std_hours decimal(6,2), "
             "shift string, reg_temp string, location string")
SLOT = ("position_nbr string, effdt date, eff_status string, business_unit string, deptid string, location string, jobcode string, "
        "company string, std_hours decimal(6,2), reports_to string, union_cd string, shift string, reg_temp string, "
        "full_part_time string, max_head_count int, avail_telework_pos string")
DAY = dt.date(2000, 1, 1)


def hire(req, day=DAY, dept="0001", mgr="00000001", shift="1"):
    return req, day, dept, "0002", mgr, Decimal(40), shift, "R", "0000"


def slot(nbr, day=dt.date(1999, 1, 1), status="A", dept="0001", mgr="00000001", shift="1"):
    return nbr, day, status, "BU1", dept, "0001", "0002", "001", Decimal(40), mgr, "73", shift, "R", "F", 7, "N"


def first_slot(spark, hires, slots):
    counts = spark.createDataFrame([("S2", 5)], "position_nbr string, head_count long")
    return HS.first_slot(spark.createDataFrame(hires, CANDIDATE), spark.createDataFrame(slots, SLOT), counts)


def rows_out(plan):
    """The most rows that one step of an executed plan gave out."""
    metric, children = plan.metrics().get("numOutputRows"), plan.children()
    return max([metric.get().value() if metric.isDefined() else 0, *[rows_out(children.apply(i)) for i in range(children.size())]])


def test_first_slot_does_not_pair_hires_with_slots(spark):
    n = 400
    days = [DAY + dt.timedelta(days=i % 3) for i in range(n)]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = first_slot(spark, [hire(str(i), d) for i, d in enumerate(days)], [slot(f"S{i:04d}") for i in range(n)])
        texts = [r.post_chg_pos_use for r in out.collect()]
        most = rows_out(out._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(texts) == n and {t.split("|")[0] for t in texts} == {"S0000"}
    assert most <= 3 * n


def test_first_slot_matches_brute_force(spark):
    rnd = random.Random(4)
    pick = rnd.choice
    hires = [hire(pick(["1", "2", "3", "4", None]) if i % 4 == 0 else f"r{i}", DAY + dt.timedelta(days=rnd.randrange(8)), pick(["0001", "0002", None]),
                  pick(["00000001", "00000002", "XXXXXXXX", None]), pick(["1", "N", None])) for i in range(120)]
    versions = {(f"S{rnd.randrange(12)}", DAY + dt.timedelta(days=rnd.randrange(-4, 8))) for _ in range(50)}
    slots = [slot(*v, pick("AAI"), pick(["0001", "0002", None]), pick(["00000001", "00000002"]), pick(["1", "1", None])) for v in sorted(versions)]

    def fits(h, s):
        later = [x[1] for x in slots if x[0] == s[0] and x[1] > s[1]]
        shift = "1" if h[6] == "N" else h[6]
        fields = [(h[2], s[4]), (h[4], s[9]), (shift, s[11])]
        return s[2] == "A" and s[1] <= h[1] and all(h[1] < x for x in later) and all(a is not None and a == b for a, b in fields)

    def best(h):
        group = [x for x in hires if h[0] is not None and x[0] == h[0] and x[4] == h[4] and h[4] != "XXXXXXXX"]
        found = [s[0] for x in group for s in slots if fits(x, s)]
        return min(found) if found else None

    got = sorted(str((r.req_num, r.hire_dt, r.deptid, r.mgr_position_nbr, r.shift, r.post_chg_pos_use and r.post_chg_pos_use.split("|")[0]))
                 for r in first_slot(spark, hires, slots).collect())
    assert got == sorted(str((h[0], h[1], h[2], h[4], h[6], best(h))) for h in hires)
    assert sum(best(h) is not None for h in hires) > 10
