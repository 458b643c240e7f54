"""As-of joins for many dates at once, and head counts over time."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tenure.operators import effdt as D

DAY0 = dt.date(2020, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def tables(spark, seed, keys=6, rows=120, days=40):
    rnd = random.Random(seed)
    hot = lambda: 0 if rnd.random() < 0.4 else rnd.randrange(keys)
    hist = [(f"k{hot()}", day(rnd.randrange(days)), rnd.randrange(2), i) for i in range(rows)] + [(None, day(1), 0, -1), ("k1", None, 0, -2)]
    left = [(i, f"k{hot()}", day(rnd.randrange(-5, days + 5))) for i in range(rows)] + [(-1, None, day(3)), (-2, "k0", None), (-3, "none", day(3))]
    return (left, spark.createDataFrame(left, "id int, k string, at date"), hist, spark.createDataFrame(hist, "k string, effdt date, seq int, v int"))


def in_force(hist, k, at):
    own = [r for r in hist if r[0] == k and r[1] is not None and at is not None and r[1] <= at and k is not None]
    best = max(((r[1], r[2]) for r in own), default=None)
    return [r for r in own if (r[1], r[2]) == best]


def test_asof_join_against_every_pair(spark):
    for seed in range(3):
        left, ldf, hist, hdf = tables(spark, seed)
        got = D.asof_join(ldf, hdf, "k", "at", "effdt", "seq", right_cols=["v"], prefix="m_", ties="keep").collect()
        want = sorted((i, v) for i, k, at in left for v in ([r[3] for r in in_force(hist, k, at)] or [None]))
        key = lambda x: (x[0], x[1] is None, x[1] or 0)
        assert sorted(((r.id, r.m_v) for r in got), key=key) == sorted(want, key=key)
        one = D.asof_join(ldf, hdf, "k", "at", "effdt", "seq", right_cols=["v"], prefix="m_").collect()
        assert sorted(r.id for r in one) == sorted(r[0] for r in left)
        assert all(r.m_v == max([x[3] for x in in_force(hist, r.k, r["at"])], default=None) for r in one)
        inner = D.asof_join(ldf, hdf, "k", "at", "effdt", "seq", right_cols=["v"], how="inner")
        assert inner.count() == sum(bool(in_force(hist, k, at)) for _, k, at in left)


def test_a_hot_key_has_one_timeline_row_per_day(spark):
    """One key with two thirds of 60,000 rows on 90 days: no group of the window is over 90 rows."""
    n = F.col("id")
    rows = spark.range(60_000).select(F.when(n % 3 != 0, 0).otherwise(n).alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.floor(n / 7) % 90).cast("int")).alias("day"))
    got = D.asof_dates(rows, rows, ["k"], "day", "day")
    assert got.groupBy("__k0").count().agg(F.max("count")).first()[0] == 90
    assert got.filter("__d <> __m").count() == 0
    out = D.asof_join(rows, rows.distinct().withColumn("v", F.lit(1)), "k", "day", "day", right_cols=["v"], prefix="m_")
    assert out.filter("m_v = 1").count() == 60_000


def test_versions_and_counts(spark):
    for seed in range(3):
        _, _, hist, hdf = tables(spark, seed, keys=4, rows=60, days=30)
        v = D.versions(hdf, "k", "effdt", "seq")
        got = v.collect()
        for r in got:
            later = [x[1] for x in hist if x[0] == r.k and x[1] is not None and x[1] > r.effdt]
            assert r.valid_to == min(later, default=None)
        c = D.counts_over_time(v.withColumn("g", F.col("v") % 3), "g")
        at = {(r.g, r.effdt): r.head_count for r in c.collect()}
        for g in range(3):
            for n in range(30):
                want = sum(r.v % 3 == g and r.effdt <= day(n) and (r.valid_to is None or day(n) < r.valid_to) for r in got)
                have = max(((d, x) for (k, d), x in at.items() if k == g and d <= day(n)), default=(None, 0))[1]
                assert have == want


def test_empty_sides(spark):
    _, ldf, _, hdf = tables(spark, 0)
    assert D.asof_join(ldf.limit(0), hdf, "k", "at", "effdt", "seq", right_cols=["v"]).count() == 0
    assert D.asof_join(ldf, hdf.limit(0), "k", "at", "effdt", "seq", right_cols=["v"], prefix="m_").filter("m_v is not null").count() == 0
    assert D.versions(hdf.limit(0), "k", "effdt", "seq").count() == 0
