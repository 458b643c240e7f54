"""Operator unit tests on small hand-made frames (NULL, blank, tie and same-day cases)."""

import datetime as dt

from pyspark.sql import functions as F

from tenure.functions import codes as C
from tenure.functions import oracle as O
from tenure.operators import diff as X
from tenure.operators import effdt as D
from tenure.operators import match as M
from tenure.sources import paste as P

d = dt.date


def _job(spark):
    rows = [
        ("1", 0, d(2020, 1, 1), 0, "A", "P1"),
        ("1", 0, d(2020, 1, 1), 1, "A", "P2"),   # same day, higher effseq wins
        ("1", 0, d(2021, 1, 1), 0, "A", "P3"),   # future row
        ("2", 0, d(2019, 1, 1), 0, "A", "P1"),
        ("2", 0, d(2020, 6, 1), 0, "I", "P1"),   # terminated latest hides older active
        ("3", 0, d(2022, 1, 1), 0, "A", "P9"),   # only future rows
        ("4", 0, d(2020, 2, 1), 0, "A", "P1"),
        ("4", 0, d(2020, 2, 1), 0, "A", "P4"),   # tie kept
    ]
    return spark.createDataFrame(rows, "emplid string, empl_rcd int, effdt date, effseq int, hr_status string, position_nbr string")


def test_asof_rows_effseq_and_ties(spark):
    got = D.asof_rows(_job(spark), ["emplid", "empl_rcd"], "effdt", "2020-12-31", "effseq")
    res = sorted((r.emplid, r.position_nbr) for r in got.collect())
    assert res == [("1", "P2"), ("2", "P1"), ("4", "P1"), ("4", "P4")]
    one = D.asof_rows(_job(spark), ["emplid", "empl_rcd"], "effdt", "2020-12-31", "effseq", ties="any",
                      tiebreak=["position_nbr"])
    assert sorted((r.emplid, r.position_nbr) for r in one.collect()) == [("1", "P2"), ("2", "P1"), ("4", "P1")]


def test_active_asof_filters_after_pick(spark):
    got = D.active_asof(_job(spark), ["emplid", "empl_rcd"], "effdt", "2020-12-31", "effseq")
    assert sorted(r.emplid for r in got.collect()) == ["1", "4", "4"]


def test_latest_and_next(spark):
    lat = D.latest_rows(_job(spark), ["emplid", "empl_rcd"], "effdt", "effseq")
    assert sorted((r.emplid, r.position_nbr) for r in lat.collect())[:2] == [("1", "P3"), ("2", "P1")]
    nxt = D.next_effective(_job(spark), ["emplid", "empl_rcd"], "effdt", "2020-12-31")
    assert sorted((r.emplid, r.next_effdt) for r in nxt.collect()) == [("1", d(2021, 1, 1)), ("3", d(2022, 1, 1))]


def test_asof_join_per_row_date(spark):
    left = spark.createDataFrame([("1", d(2020, 1, 1)), ("1", d(2019, 1, 1)), ("2", d(2020, 7, 1)), ("9", d(2020, 1, 1))],
                                 "emplid string, at date")
    got = D.asof_join(left, _job(spark), "emplid", "at", "effdt", "effseq", right_cols=["position_nbr"], prefix="m_")
    res = sorted((r.emplid, str(r.at), r.m_position_nbr, r.m_effseq) for r in got.collect())
    assert res == [("1", "2019-01-01", None, None), ("1", "2020-01-01", "P2", 1),
                   ("2", "2020-07-01", "P1", 0), ("9", "2020-01-01", None, None)]


def test_oracle_string_rules(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(None, "a", " x\t;\"y\n ", Decimal("2.50"), Decimal("0.50"))],
                               "n string, a string, s string, x decimal(6,2), y decimal(6,2)")
    r = df.select(O.cat("n", "a").alias("c"), O.cat("n").alias("e"), O.char_only_strip("s").alias("s1"),
                  O.char_only_strip("s", keep_tab=True).alias("s2"), O.num_text("x").alias("x"),
                  O.num_text("y").alias("y"), O.decode("n", {None: "was null"}, "other").alias("d")).first()
    assert r.c == "a" and r.e is None and r.s1 == "xy" and r.s2 == "x\ty"
    assert r.x == "2.5" and r.y == ".5" and r.d == "was null"


def test_hours_and_category_codes(spark):
    df = spark.createDataFrame([(19.0, "P"), (20.0, "C"), (36.0, "P"), (None, "F"), (10.0, "F")], "h double, cur string")
    r = df.select(C.hours_category("h").alias("a"), C.hours_category("h", "P").alias("b"),
                  C.category_change("h", "cur").alias("c")).collect()
    assert [x.a for x in r] == ["C", "P", "F", "F", "C"]
    assert [x.b for x in r] == ["C", "P", "F", "P", "C"]
    # P -> casual never yields PTC in the reference's code path
    assert [x.c for x in r] == [None, "CPT", "PTF", "CFT", "FTC"]  # NULL hours fall to the else branch


def test_field_diff_null_safe(spark):
    df = spark.createDataFrame([("a", "a", None, None, "1", "2")], "n1 string, c1 string, n2 string, c2 string, n3 string, c3 string")
    f = [X.Field("one", "n1", "c1", lead=""), X.Field("two", "n2", "c2"), X.Field("three", "n3", "c3")]
    r = df.select(X.field_diff(f).alias("d"), X.fields_equal([("n1", "c1"), ("n2", "c2")]).alias("e")).first()
    assert r.d == "three:1(2)" and r.e == 1


def test_paste_split_rules(spark):
    df = P.paste_frame(spark, "'1|001||A|REF|5.25,,2|101|X|B|C|1\r\n")
    rows = P.split_rows(df, "text", ",", keep_tab=True)
    got = rows.select("row_pos", P.field_collapsed("value", 3).alias("f3"), P.field_kept("value", 2).alias("k2")).collect()
    assert [(r.row_pos, r.f3, r.k2) for r in got] == [(0, "A", None), (1, "X", "X")]


def test_best_match_excludes_own_and_prefers(spark):
    left = spark.createDataFrame([("e1", "d1", "P1"), ("e2", "d2", "P5")], "id string, dept string, cur string")
    right = spark.createDataFrame([("P1", "d1", 5), ("P2", "d1", 3), ("P3", "d1", 3), ("P5", "d2", 0)],
                                  "pos string, dept string, hc int")
    S = M.Sort
    got = M.best_match(left, right, [("dept", "dept")], [S("hc", desc=True), S("pos")], ["id"], ["pos"],
                       exclude=("cur", "pos"))
    assert sorted((r.id, r.pos) for r in got.collect()) == [("e1", "P2"), ("e2", None)]
    pref = M.best_match(left, right, [("dept", "dept")], [S("hc"), S("pos")], ["id"], ["pos"], prefer=("cur", "pos"))
    assert sorted((r.id, r.pos) for r in pref.collect()) == [("e1", "P1"), ("e2", "P5")]


def test_resolve_unique_and_expand(spark):
    left = spark.createDataFrame([("n1",), ("n2",), ("n3",)], "name string")
    right = spark.createDataFrame([("n1", "a"), ("n2", "b"), ("n2", "c"), ("n2", "c")], "nm string, id string")
    got = M.resolve_unique(left, right, [("name", "nm")], "id", "res", distinct=True)
    assert sorted((r.name, r.res) for r in got.collect()) == [("n1", "a"), ("n2", None), ("n3", None)]
    df = spark.createDataFrame([(1, True, None)], "k int, a boolean, b boolean")
    out = M.expand_rows(df, [(F.lit(True), F.lit("p")), (F.col("a"), F.lit("a")), (F.col("b"), F.lit("b"))])
    assert [(r.row_val, r.variant, r.row_total) for r in out.collect()] == [(1, "p", 2), (2, "a", 2)]


def test_streaming_runs_batch_plan(spark, tmp_path):
    from tenure.plans.refunds import parse_refunds
    from tenure.streaming import run_per_batch

    src = tmp_path / "in"
    src.mkdir()
    spark.createDataFrame([(1, "'000001|001|PARK|A|REF|5.25")], "paste_id long, text string") \
        .write.mode("overwrite").parquet(str(src / "p1"))
    stream = spark.readStream.schema("paste_id long, text string").parquet(str(src / "p1"))
    seen = []
    q = run_per_batch(spark, stream, parse_refunds, lambda df, e: seen.extend(df.collect()),
                      str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert [r.emplid for r in seen] == ["000001"] and str(seen[0].amount).startswith("5.25")


def test_csv_source_roundtrip(spark, tmp_path):
    from tenure.sources.csv import read_csv_records

    p = tmp_path / "r.csv"
    p.write_text("﻿Employee ID, Full-Name ,Amount ($)\n 000001 , john doe ,\"$3,218\"\n , , \n")
    df = read_csv_records(spark, str(p), normalise=True)
    rows = df.collect()
    assert df.columns == ["employee_id", "full_name", "amount"]
    assert [(r.employee_id, r.full_name, r.amount) for r in rows] == [("000001", "john doe", "$3,218")]


def test_text_transformers_examples(spark):
    from tenure.functions import text as T

    df = spark.createDataFrame([("john doe", "$3,218", "500", "  ")], "a string, b string, c string, d string")
    r = df.select(T.capitalize("a").alias("a"), T.currency("b").alias("b"), T.currency("c").alias("c"),
                  T.currency("d", "$").alias("d"), T.capitalize("d").alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == ("John Doe", "3218.00", "500.00", "$0.00", "  ")


def test_best_match_own_slot_even_if_not_eligible(spark):
    left = spark.createDataFrame([("e1", "d1", "P1"), ("e2", "d1", "P9"), ("e3", None, "P1")], "id string, dept string, cur string")
    right = spark.createDataFrame([("P1", "d1", 5), ("P2", "d1", 0), ("P3", "d1", 0), ("P9", "d2", 0)], "pos string, dept string, hc int")
    got = M.best_match(left, right, [("dept", "dept")], [M.Sort("hc", desc=True), M.Sort("pos")], ["id"], ["pos"],
                       eligible=F.col("hc") == 0, prefer=("cur", "pos"))
    assert sorted((r.id, r.pos) for r in got.collect()) == [("e1", "P1"), ("e2", "P2"), ("e3", None)]
    gated = M.best_match(left, right, [("dept", "dept")], [M.Sort("pos")], ["id"], ["pos"], left_gate=F.col("id") == "e2")
    assert sorted((r.id, r.pos) for r in gated.collect()) == [("e1", None), ("e2", "P1"), ("e3", None)]


def test_asof_join_null_keys_and_dates(spark):
    left = spark.createDataFrame([(None, d(2020, 1, 1)), ("1", None), ("1", d(2020, 1, 1))], "k string, at date")
    right = spark.createDataFrame([(None, d(2019, 1, 1), "x"), ("1", None, "y"), ("1", d(2019, 5, 1), "z")], "k string, effdt date, v string")
    got = D.asof_join(left, right, "k", "at", "effdt", right_cols=["v"], prefix="m_")
    assert sorted((str(r.k), str(r["at"]), r.m_v) for r in got.collect()) == [
        ("1", "2020-01-01", "z"), ("1", "None", None), ("None", "2020-01-01", None)]


def test_strict_numbers(spark):
    import pytest

    df = spark.createDataFrame([("12.5",), (None,), (" 4000000 ",)], "x string")
    assert [str(r.n) for r in df.select(O.to_number("x").alias("n")).collect()] == ["12.5000000000", "None", "4000000.0000000000"]
    bad = spark.createDataFrame([("12,5",)], "x string")
    with pytest.raises(Exception, match="invalid number: 12,5"):
        bad.select(O.to_number("x").alias("n")).collect()
    assert bad.select(O.to_number("x", on_error="null").alias("n")).first().n is None


def test_money_texts(spark):
    from tenure.functions import text as T

    rows = [("1.2.3", "0.00"), ("5-", "0.00"), ("-", "0.00"), ("555-1234", "0.00"), ("-7.005", "-7.01"), ("$.5", "0.50"), (None, "0.00"),
            ("9" * 32, "9" * 32 + ".00"), ("9" * 60, "9" * 60), ("1" * 45 + ".5", "1" * 45 + ".5")]
    df = spark.createDataFrame(rows, "x string, want string")
    assert [(r.x, r.m) for r in df.select("x", T.currency("x").alias("m")).collect()] == rows
    capped = df.select(T.currency("x", limit="999999999.99", max_chars=50).alias("m")).collect()
    assert capped[7].m == "999999999.99" and capped[4].m == "-7.01"


def test_csv_folder_encodings_and_headers(spark, tmp_path):
    import pytest

    from tenure.sources.csv import read_csv_records

    (tmp_path / "a.csv").write_bytes("id,name\n1,\tJosé \n , \n".encode("utf-8-sig"))
    (tmp_path / "b.csv").write_bytes("name,id\nbob,2\n".encode("utf-16"))
    (tmp_path / "c.csv").write_bytes("id,name\n3,Müller €\n".encode("cp1252"))
    got = read_csv_records(spark, str(tmp_path), glob="*.csv", with_file=True)
    assert sorted((r.id, r.name, r.source_file[-5:]) for r in got.collect()) == [("1", "José", "a.csv"), ("2", "bob", "b.csv"), ("3", "Müller €", "c.csv")]
    (tmp_path / "bad.txt").write_text("id,id,\n1,2,3\n")
    with pytest.raises(ValueError, match="duplicate header: id; empty header"):
        read_csv_records(spark, str(tmp_path / "bad.txt"))


def test_csv_encoding_by_the_whole_file(spark, tmp_path):
    """The only byte that is no UTF-8 stands at the very end; a record holds a line end; a header is longer than 64 KB."""
    from tenure.sources.csv import read_csv_records

    (tmp_path / "late.csv").write_bytes(b"id,name\n" + b"1,plain\n" * 20_000 + b'2,"two\nlines"\n3,caf\xe9 \x80\n')
    got = {r.id: r.name for r in read_csv_records(spark, str(tmp_path / "late.csv")).collect()}
    assert got == {"1": "plain", "2": "two\nlines", "3": "café €"}
    names = [f"column number {i:060d}" for i in range(900)]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join(map(str, range(900))) + "\n")
    wide = read_csv_records(spark, str(tmp_path / "wide.csv"))
    assert wide.columns == names and wide.first()[899] == "899"
    (tmp_path / "empty.csv").write_bytes(b"")
    assert read_csv_records(spark, str(tmp_path / "late.csv"), with_file=True).count() == 20_002


def test_transfer_own_manager_slot_and_name_branch(spark):
    """A manager whose own, occupied slot fits keeps it; a blank id is found by an unambiguous name."""
    from decimal import Decimal

    from tenure.plans import transfers as TR

    day = d(1999, 1, 1)
    job = spark.createDataFrame(
        [(e, 0, d(1998, 1, 1), 0, "A", "EMP", p, "BU1", "D1", "J1", "001", Decimal(40), "M0", "73", "1", "R", "F", "N", "P", "A", lvl, Decimal("10.00"))
         for e, p, lvl in (("000001", "P1", "1"), ("000002", "P2", "9"), ("000009", "M0", "1"))],
        "emplid string, empl_rcd int, effdt date, effseq int, hr_status string, per_org string, position_nbr string, business_unit string, deptid string,"
        "jobcode string, company string, std_hours decimal(6,2), reports_to string, union_cd string, shift string, reg_temp string, full_part_time string,"
        "flsa_status string, job_indicator string, empl_status string, officer_cd string, hourly_rt decimal(12,2)")
    hires = spark.createDataFrame(
        [("1", "000001", "Ann", "Transfer", "000009", "D2", "J1", Decimal(40), "1", "R", Decimal("12.00"), day, "Max", "N", None),
         ("2", " ", "Bob", "Dual Employment", "000009", "D2", "J1", Decimal(40), "1", "R", Decimal("10.00"), day, "Max", "N", None)],
        "req_num string, emplid string, name string, hire_comments string, mgr_id string, deptid string, jobcode string, std_hours decimal(6,2),"
        "shift string, reg_temp string, hourly_rt decimal(12,2), start_date date, mgr_name string, flsa_status string, prof_experience_dt date")
    names = spark.createDataFrame([("000001", "PRI", day, "Ann"), ("000002", "PRI", d(1990, 1, 1), "Bob")], "emplid string, name_type string, effdt date, name_display string")
    old = d(1990, 1, 1)
    jc = spark.createDataFrame([("SHARE", "J1", old, "1", "P0", "001", "73", "B1")], "setid string, jobcode string, effdt date, manager_level string, sal_admin_plan string, grade string, union_cd string, job_family string")
    dept = spark.createDataFrame([("SHARE", "D2", old, "BU1")], "setid string, deptid string, effdt date, business_unit string")
    slot = lambda p, lvl, n: (p, old, "A", "BU1", "D2", "J1", "001", Decimal(40), "M0", "73", "1", "R", "N", n, lvl)
    positions = spark.createDataFrame([slot("P1", "1", 1), slot("P2", "1", 1), slot("V1", "9", 99), slot("V2", "1", 99)],
        "position_nbr string, effdt date, eff_status string, business_unit string, deptid string, jobcode string, company string, std_hours decimal(6,2),"
        "reports_to string, union_cd string, shift string, reg_temp string, flsa_status string, max_head_count int, manager_level string")
    own = spark.createDataFrame([("000002", 0, "EMP", 0, 1, None, old, old, None)], "emplid string, empl_rcd int, per_org string, org_instance_ern int, benefit_rcd_nbr int,"
        "prof_experience_dt date, cmpny_seniority_dt date, service_dt date, seniority_pay_dt date")
    got = {r.req_num: r for r in TR.transfers(hires, job, names, jc, positions, dept, own, "1999-01-01", "2000-01-01").collect()}
    assert got["1"].tfr_pos == "P1" and got["2"].tfr_pos == "P2"
    assert got["1"].remaining_value_diff == "dept:D2(D1)" and got["1"].acn_rsn == "LTM" and got["1"].complex_check == "Simple"
    assert got["1"].transfers_exceltoci == "000001|0|1999-01-01|0|P1|POS|LTM|Y|Y|0|NAHRLY|12|H|USD"
    assert got["2"].emplid == "000002" and got["2"].orig_emp is None
    assert got["2"].dual_emp_exceltoci == ("000002|1|EMP|0|1|Y|1990-01-01|Y|1990-01-01|Y|||1999-01-01|0|P2|ADL|ADL|1|S|BA|Y|Y|0|NAHRLY|10|H|USD")


def test_id_and_unused_columns(spark):
    from tenure.functions import text as T

    assert T.default_id_column(["Name", "Emp-Number", "EMPLID"]) == "Emp-Number"
    assert T.default_id_column(["Name", "Mail"]) == "Name" and T.default_id_column([]) is None
    df = spark.createDataFrame([("Dear {{Full Name}} {{ <b>x</b> }}",), ("",)], "t string")
    got = df.select(T.unused_columns("t", ["id", "full_name", "x", "y"], "id").alias("u")).collect()
    assert [list(r.u) for r in got] == [["y"], ["full_name", "x", "y"]]


def test_trailing_id_is_at_the_very_end(spark):
    df = spark.createDataFrame([("Message: 123456",), ("x 123456\n",), ("12345",), ("1234567",)], "m string")
    assert [r.i for r in df.select(O.trailing_id("m").alias("i")).collect()] == ["123456", None, None, "234567"]
