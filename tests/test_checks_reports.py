import pytest
from pyspark.sql import functions as F

from monthclose.operators import reports
from monthclose.operators.checks import (
    Checks, TableCheck, check_value, diff_name, diff_totals, duplicate_keys, grouped_counts, largest_first,
    show_sums, table_checks,
)
from monthclose.operators.compare import (
    full_join_null_safe, month_change, reconcile, rows_where_key_in, totals_where_key_in,
)
from monthclose.operators.reports import export_sheets, next_version, sheet_query, sheet_set, with_total
from monthclose.operators.stages import measure, read_stages


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v double")


# -- comparison --------------------------------------------------------------------------------


def test_reconcile(spark, rows):
    a = kv(spark, ("x", 10.0), ("y", 5.0), (None, 7.0), ("only_a", 3.0), ("null", None))
    b = kv(spark, ("x", 11.0), ("y", 7.5), (None, 1.0), ("only_b", 4.0), ("null", 9.0))
    assert rows(reconcile(a, b, ["k"], "v")) == [
        (None, 7.0, 1.0, 6.0), ("null", 0.0, 9.0, -9.0), ("only_a", 3.0, 0.0, 3.0),
        ("only_b", 0.0, 4.0, -4.0), ("y", 5.0, 7.5, -2.5),
    ]
    # The threshold is strict: x differs by exactly 1.
    assert "x" in {r[0] for r in rows(reconcile(a, b, ["k"], "v", threshold=0.99))}


def test_reconcile_adds_up_repeated_keys(spark, rows):
    a = kv(spark, *[("hot", 1.0)] * 1000, ("x", 1.0))
    b = kv(spark, *[("hot", 1.0)] * 700)
    assert rows(reconcile(a, b, ["k"], "v")) == [("hot", 1000.0, 700.0, 300.0)]


def test_largest_first(spark):
    diffs = reconcile(kv(spark, ("a", 5.0), ("b", 3.0)), kv(spark, ("c", 9.0), ("b", 8.0)), ["k"], "v")
    assert [r["k"] for r in largest_first(diffs, ["k"]).collect()] == ["c", "a", "b"]
    assert tuple(diff_totals(diffs).head()) == (3, 8.0, 17.0, -9.0)


def test_month_change_null_keys_do_not_match(spark, rows):
    a, b = kv(spark, ("x", 10.0), (None, 1.0)), kv(spark, ("x", 4.0), (None, 2.0), ("z", 3.0))
    assert rows(month_change(a, b, "k", "v")) == [
        (None, 0.0, 2.0, -2.0), (None, 1.0, 0.0, 1.0), ("x", 10.0, 4.0, 6.0), ("z", 0.0, 3.0, -3.0),
    ]
    assert rows(month_change(a, b, "k", "v", how="left")) == [
        (None, 1.0, None, 1.0), ("x", 10.0, 4.0, 6.0),
    ]


def test_full_join_null_safe(spark, rows):
    a = kv(spark, ("x", 1.0), (None, 2.0))
    b = kv(spark, (None, 3.0), ("y", 4.0)).withColumnRenamed("v", "w")
    assert rows(full_join_null_safe(a, b, ["k"], ["v"], ["w"])) == [
        (None, 2.0, 3.0), ("x", 1.0, None), ("y", None, 4.0),
    ]


def test_semi_joins(spark, rows):
    data = kv(spark, ("x", 1.0), ("x", 2.0), ("y", 3.0), (None, 4.0))
    allowed = spark.createDataFrame([("x",), ("x",), (None,)], "a string")
    assert rows(rows_where_key_in(data, "k", allowed)) == [("x", 1.0), ("x", 2.0)]
    sums = {"n": F.count(F.lit(1)), "s": F.sum("v")}
    assert tuple(totals_where_key_in(data, "k", allowed, sums).head()) == (2, 3.0)


# -- checks ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "value, expect, status",
    [(0, "zero", "OK"), (1, "zero", "NG"), (1, "nonzero", "OK"), (0, "nonzero", "NG"),
     (5, 5, "OK"), (5, 4, "NG"), (None, "zero", "NG"), (None, "nonzero", "NG")],
)
def test_check_value(spark, value, expect, status):
    df = spark.createDataFrame([(value,)], "n bigint")
    assert tuple(check_value(df, "x", expect).head()) == ("x", str(expect), value, status)


def test_check_value_without_rows_is_zero(spark):
    assert check_value(spark.createDataFrame([], "n bigint"), "x").head()["status"] == "OK"


def test_show_sums(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, b double")
    assert [tuple(r) for r in show_sums(df, "l").collect()] == [("l", "a", "1"), ("l", "b", "NULL")]


def test_grouped_counts_and_duplicates(spark, rows):
    df = kv(spark, ("a", 1.0), ("a", 2.0), (None, 3.0))
    assert rows(grouped_counts(df, ["k"])) == [("None", 1), ("a", 2), ("total", 3)]
    assert rows(grouped_counts(df)) == [("total", 3)]
    assert rows(grouped_counts(df.where("false"), ["k"])) == [("total", 0)]
    assert rows(duplicate_keys(df, ["k"])) == [("a", 2)]


def test_checks_on_a_store(spark, store, tmp_path):
    store.replace("t", kv(spark, ("a", 1.0), ("b", 9.0)))
    checks = Checks(store, str(tmp_path / "out"), {"SDM": "202601"})
    assert checks.require("t") and not checks.require("t", "u")
    assert checks.check("empty", "SELECT COUNT(*) FROM t WHERE v < 0")
    assert checks.check("gone", "SELECT COUNT(*) FROM u") is False
    assert checks.check("column", "SELECT COUNT(u) FROM t") is False
    with pytest.raises(Exception):
        checks.check("bad sql", "SELEC 1")
    assert checks.check_sum("sum", "SELECT SUM(v) AS v FROM t") == {"v": "10.0"}
    assert checks.row_count("t", where="k = 'a'") == 1
    assert checks.row_count("t", group_by="k") == 2
    assert checks.row_count("u") == 0
    same = "SELECT k, v FROM t"
    assert checks.check_diff("same", same, same, ["k"], "v")
    assert checks.check_diff("gone", same, "SELECT k, v FROM u", ["k"], "v")
    assert not checks.check_diff("a / b", same, "SELECT k, v + 2 AS v FROM t", ["k"], "v")
    parts = list((tmp_path / "out" / "diff_a___b.csv").glob("part-*.csv"))
    text = b"".join(p.read_bytes() for p in parts)
    assert text.startswith("﻿k,val_a,val_b,diff\n".encode()) and b"a,1.0,3.0,-2.0" in text
    statuses = [tuple(r)[3] for r in checks.summary().collect()]
    assert statuses.count("NG") == 1 and statuses.count("SKIP") == 5
    assert diff_name("x" * 80) == "diff_" + "x" * 80


# -- reports -----------------------------------------------------------------------------------


def test_sheet_query():
    params = {"SDM": "202601"}
    assert sheet_query("t", "s_{yyyymm}", "202601", params) == ("SELECT * FROM t", "s_202601")
    config = {"columns": ["a", "b"], "where": "m = '${SDM}'", "order_by": "a DESC", "limit": 5}
    assert sheet_query("t", config, "202601", params) == (
        "SELECT a, b FROM t WHERE m = '202601' ORDER BY a DESC LIMIT 5", "t",
    )
    config = {"sheet": "x", "sql": "SELECT 1 FROM t_{yyyymm}", "where": "ignored"}
    assert sheet_query("t", config, "202601", params) == ("SELECT 1 FROM t_202601", "x")


def test_sheet_set():
    got = sheet_set({"a_{yyyymm}": ["x", "y"], "out_b": "named"}, ["out_b", "out_c", "z"], "202601", {})
    assert got == [("a_202601", "x"), ("a_202601", "y"), ("out_b", "named"), ("out_c", "c")]


@pytest.mark.parametrize(
    "names, version",
    [([], "v0.01"), (["j_202601_v0.01"], "v0.02"), (["j_202601_v0.99.xlsx"], "v0.100"),
     (["j_202601_v1.0", "j_202601_v0.07"], "v1.01"), (["j_202601_v1.00", "j_202601_v1.04"], "v1.05"),
     (["j_202601_v2", "j_202601_v1.50"], "v2.01"), (["j_202602_v5.01", "jj_202601_v7.1"], "v0.01"),
     (["j_202601_vx"], "v0.01"), (["j_202601_v10.9", "j_202601_v9.99"], "v10.10")],
)
def test_next_version(spark, names, version):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    row = next_version(df, "j_202601").head()
    assert (row["version"], row["next"]) == (version, f"j_202601_{version}")


def test_export(spark, store, tmp_path):
    store.replace("t", kv(spark, ("a", 1.0), ("b", 9.0)))
    store.replace("out_sum", kv(spark, ("s", 10.0)))
    sheets = {
        "t": ["all", {"sheet": "none", "where": "v < 0"}, {"sheet": "broken", "where": "nope = 1"}],
        "free": {"sheet": "n" * 40, "sql": "SELECT COUNT(*) AS n FROM t"},
    }
    path, summary = export_sheets(store, "job", sheets, str(tmp_path / "out"))
    assert path.endswith("job_202601_v0.01")
    got = [tuple(r)[:4] for r in summary.orderBy(F.col("no").asc_nulls_last()).collect()]
    assert got == [(1, "t", "all", 2), (2, "free", "n" * 40, 1), (3, "out_sum", "sum", 1),
                   (None, "합계", None, 4)]
    assert not (tmp_path / "out" / "job_202601_v0.01" / "none").exists()
    again, _ = export_sheets(store, "job", {"t": "all"}, str(tmp_path / "out"), format="csv")
    assert again.endswith("job_202601_v0.02")


def test_labels_and_sheets_that_share_a_name_are_all_kept(spark, store, tmp_path, rows):
    store.replace("t", kv(spark, ("a", 1.0), ("b", 9.0)))
    checks = Checks(store, str(tmp_path / "out"))
    for n, label in enumerate(["a b", "a/b", "a_b", "A b", "a b_rows", "a b"], 2):
        checks.check_diff(label, "SELECT k, v FROM t", f"SELECT k, v + {n} AS v FROM t", ["k"], "v")
    found = {p.name: {abs(r["diff"]) for r in spark.read.parquet(str(p)).collect()} for p in (tmp_path / "out").glob("*_rows")}
    assert sorted(found.values(), key=str) == [{2.0}, {3.0}, {4.0}, {5.0}, {6.0}, {7.0}]
    sheets = {"t": [{"sheet": s, "where": f"v < {n}"} for s, n in (("a/b", 5), ("a_b", 10), ("A_B", 5), ("요약", 10), ("a_b", 10))]}
    path, summary = export_sheets(store, "job", sheets, str(tmp_path / "sheets"))
    total = summary.where("no IS NULL").head()["rows"]
    folders = [p for p in (tmp_path / "sheets/job_202601_v0.01").iterdir() if p.name != "요약"]
    assert total == 8 and sum(spark.read.parquet(str(p)).count() for p in folders) == 8 and len(folders) == 5


def test_checks_of_one_table_are_one_scan(spark, store, tmp_path):
    store.replace("t", kv(spark, ("a", 1.0), ("b", 9.0), ("b", None)))
    wanted = [TableCheck("none", "k = 'x'"), TableCheck("some", "k = 'b'", expect="nonzero"), TableCheck("two", "k = 'b'", expect=2),
              TableCheck("sum", value="sum(v)", expect=10.0), TableCheck("shown", "k = 'x'", "sum(v)", None),
              TableCheck("empty", "k = 'x'", "sum(v)"), TableCheck("month", "k = '${SDM}'")]
    found = table_checks(store.table("t"), wanted)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("Aggregate") == 1
    assert [tuple(r)[1:] for r in found.collect()] == [
        ("zero", "0", "OK"), ("nonzero", "2", "OK"), ("2", "2", "OK"), ("10.0", "10.0", "OK"), ("shown", None, "OK"),
        ("zero", None, "NG"), ("zero", "0", "OK")]
    checks = Checks(store, str(tmp_path / "out"), {"SDM": "b"})
    assert not checks.check_table("t", wanted)
    assert [r[3] for r in checks.results] == ["OK"] * 5 + ["NG", "NG"]
    assert not checks.check_table("t", [TableCheck("bad", "nope = 1"), TableCheck("good", expect=3)])
    assert [r[2:] for r in checks.results[-2:]] == [("no column", "SKIP"), ("3", "OK")]
    assert not checks.check_table("u", [TableCheck("gone")]) and checks.results[-1][2:] == ("no table", "SKIP")
    assert checks.check_table("t", []) and table_checks(store.table("t"), []).count() == 0


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_sheets_of_one_table_are_one_scan(spark, store, tmp_path, monkeypatch, format):
    store.replace("t", kv(spark, ("a", 1.0), ("b", 9.0), ("b", 3.0), (None, 4.0)))
    singly = []
    write = reports._write_counted
    monkeypatch.setattr(reports, "_write_counted", lambda df, path, f: singly.append(path.rsplit("/", 1)[-1]) or write(df, path, f))
    sheets = {"t": ["all", {"sheet": "b/${SDM}", "where": "k = 'b' OR v > 100"}, {"sheet": "none", "where": "v < 0"},
                    {"sheet": "keys", "columns": ["k"], "where": "v > 1"}, {"sheet": "again", "columns": ["k"]},
                    {"sheet": "top", "order_by": "v DESC", "limit": 1}, {"sheet": "bad", "where": "nope = 1"}]}
    path, summary = export_sheets(store, "job", sheets, str(tmp_path / "o"), {"SDM": "x"}, format=format)
    assert singly == ["top"]  # and the bad one is skipped
    assert [(r.sheet, r.rows) for r in summary.where("no > 0").orderBy("no").collect()] == [
        ("all", 4), ("b/x", 2), ("keys", 3), ("again", 4), ("top", 1)]
    read = spark.read.option("header", True).format(format)
    found = {p.name: read.load(str(p)) for p in sorted((tmp_path / "o/job_202601_v0.01").iterdir())}
    counts = {n: df.count() for n, df in found.items()}
    assert sorted(counts) == ["again", "all", "b_x", "keys", "top", "요약"]
    assert (counts["all"], counts["b_x"], counts["top"]) == (4, 2, 1)
    if format == "parquet":  # a row of one empty field is a blank line in CSV
        assert (counts["again"], counts["keys"], counts["요약"]) == (4, 3, 6)
    assert found["all"].columns == ["k", "v"] and found["keys"].columns == ["k"]


def test_with_total_of_nothing(spark):
    empty = spark.createDataFrame([], "no int, `table` string, sheet string, rows bigint")
    assert [tuple(r) for r in with_total(empty).collect()] == [(None, "합계", None, 0)]


def test_read_stages(spark, tmp_path):
    (tmp_path / "x.dat").write_text("1|2|x|a|b|c|d\n" * 50)
    stages = read_stages(spark, [str(tmp_path / "x.dat")], columns=6)
    assert list(stages) == ["count", "all_text", "some_columns", "some_columns_cast"]
    assert stages["count"].head()[0] == 50
    assert stages["some_columns_cast"].head()[:3] == (1.0, 2.0, None)
    assert set(measure(stages)) == set(stages)
