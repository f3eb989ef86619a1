import math

import duckdb
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthclose.functions import casts, months

NUMBERS = [
    "12.5", " 7 ", "\t7\n", "+5", "-5", ".5", "5.", ".", "", "  ", "1d", "1D", "1f", "1.5F", "0x10",
    "0X1f", "0x1p3", "0b101", "-0x10", "1_000", "1__0", "_1", "1_", "1_0.5", "1,2", "1 2", "１２", "abc",
    "1.5", "2.5", "-2.5", "0.5", "-0.5", "0.49999999999", "1.4999999999999999999999", "1e3", "1E3",
    "149e-2", "150e-2", "1e-30", "1e", "1e5.5", "++1", "NaN", "nan", "inf", "-Infinity", "INF", "1e400",
    "9223372036854775807", "9223372036854775807.4", "9223372036854775807.5", "9223372036854775808",
    "-9223372036854775808", "12345678901234567890", "9" * 50_000 + "x",
    "999999999999999999", "17.0", "-17.5", "1e18", "1e19", "true", "00012", "-0",
]


def spark_casts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = df.select("s", casts.to_double(F.col("s")), casts.to_bigint(F.col("s"))).collect()
    return {r[0]: (r[1], r[2]) for r in out}


def sql_casts(texts):
    con = duckdb.connect()
    query = "select try_cast(? as double), try_cast(? as bigint)"
    return {t: con.execute(query, [t, t]).fetchone() for t in texts}


def same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a):
        return math.isnan(b)
    return a == b


def assert_same_casts(spark, texts):
    ours, theirs = spark_casts(spark, texts), sql_casts(texts)
    for t in texts:
        assert same(ours[t][0], theirs[t][0]), ("double", t, ours[t], theirs[t])
        assert ours[t][1] == theirs[t][1], ("bigint", t, ours[t], theirs[t])


def test_casts_follow_sql(spark):
    assert_same_casts(spark, NUMBERS)


@settings(
    max_examples=8, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate]
)
@given(st.lists(st.from_regex(r"\A ?[+-]?[0-9]{0,9}[.]?[0-9]{0,8}(e-?[0-9])? ?\Z"), min_size=40,
                max_size=40))
def test_casts_follow_sql_on_generated_numbers(spark, texts):
    assert_same_casts(spark, texts)


def test_strip_all_strips_what_python_strips(spark):
    texts = ["  a b ", "　가　", "\x1f x \x85", "\xa0", "", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = {r[0]: r[1] for r in df.select("s", casts.strip_all(F.col("s"))).collect()}
    assert out == {t: t.strip() for t in texts}


def test_total_loses_no_digits_and_keeps_nan(spark):
    tiny = spark.range(1_000_000).select(F.lit(0.00004).alias("x"))
    assert abs(tiny.agg(casts.total(F.col("x"))).head()[0] - 40) < 1e-6
    exact = spark.range(1_000_000).select(F.lit("0.00004").cast("decimal(9,5)").alias("x"))
    assert str(exact.agg(casts.total(F.col("x"))).head()[0]) == "40.00000"
    odd = spark.createDataFrame([(0.1,), (float("nan"),), (None,)], "x double")
    assert str(odd.agg(casts.total(F.col("x"))).head()[0]) == "nan"
    large = spark.createDataFrame([(1e19,), (2e19,)], "x double")
    assert large.agg(casts.total(F.col("x"))).head()[0] == 3e19


@pytest.mark.parametrize(
    "month, n, expected",
    [("202603", 1, "202602"), ("202601", 1, "202512"), ("202601", 13, "202412"),
     ("202612", -1, "202701"), ("202606", -19, "202801"), ("202606", 0, "202606")],
)
def test_prev_month(spark, month, n, expected):
    assert months.prev_month(month, n) == expected
    df = spark.createDataFrame([(month,)], "m string")
    assert df.select(months.shift_month(F.col("m"), n)).head()[0] == expected


def test_params():
    assert months.month_params("202601") == {
        "SDM": "202601", "LM": "202512", "LM2": "202511", "YYYY": "2026", "MM": "01",
        "yyyymm": "202601",
    }
    filled = months.fill_month("t{yyyymm}_${LM}_${OTHER}", "202601", months.month_params("202601"))
    assert filled == "t202601_202512_${OTHER}"


def test_month_text_of_numbers(spark):
    df = spark.createDataFrame([(202601.0, 202601, "202601")], "a double, b bigint, c string")
    out = df.select(*[casts.month_text(F.col(c), t) for c, t in df.dtypes]).head()
    assert tuple(out) == ("202601",) * 3
