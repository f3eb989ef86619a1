"""Every registered query against its SQL, over the small tables, and the shape of the plans."""

import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from monthclose.bindings import checks, domain, relational
from monthclose.bindings.common import new_store, table
from monthclose.functions.casts import total
from monthclose.operators.compare import month_change
from monthclose.plans import monthly
from monthclose.sources.delimited import parse_lenient, parse_strict
from monthclose.sources.fixed import parse_fixed_bytes, parse_fixed_chars
from monthclose.sources.layouts import Field

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER",
         "boolean": "BOOLEAN"}
QUERIES = {name: query for group in entry._GROUPS for name, query in group.QUERIES.items()}
ORACLE = {name: sql for group in entry._GROUPS for name, sql in group.ORACLE.items()}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def test_every_query_has_its_sql():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns, order = sorted(types), [d[0] for d in result.description]
    expected = sorted(
        tuple(plain(row[order.index(c)]) for c in columns) for row in result.fetchall()
    )
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    assert got == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# -- plans -------------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize(
    "query, most",
    [
        (domain.d3_held_premium_by_month, 1),
        (domain.d8_allocation_totals, 1),
        (domain.d9_deferral_totals, 1),
        (domain.d12_ledger_gap_count, 1),
        (checks.v3_check_diff, 1),
        (checks.v6_duplicate_keys, 1),
        (relational.a7_a9_nested_having, 1),
        (domain.d17_coverage_change, 1),
        (domain.d18_amount_change, 1),
        # Rows and allowed keys are each exchanged once; the join adds nothing.
        (relational.j5_semi_join_total, 2),
    ],
)
def test_exchanges(spark, query, most):
    df = query(spark, SF)
    assert exchanges(df) <= most
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_deferrals_read_their_source_once(spark):
    assert plan(domain.d9_deferral_totals(spark, SF)).count("FileScan") == 1


def test_two_months_of_one_table_are_read_once(spark):
    for query in (domain.d17_coverage_change, domain.d18_amount_change):
        assert plan(query(spark, SF)).count("FileScan") == 1


def test_one_pass_and_joined_months_agree(spark):
    rows = spark.createDataFrame(
        [("199803", "a", 5.0), ("199803", None, 1.0), ("199802", "a", 2.0), ("199802", "b", 4.0),
         ("199802", None, 3.0), ("199803", "c", None), ("199801", "a", 100.0)],
        "CLS_YYMM string, CVRCD string, PRM double",
    )
    now, before = (rows.where(F.col("CLS_YYMM") == m).groupBy("CVRCD").agg(F.sum("PRM").alias("PRM"))
                   for m in ("199803", "199802"))
    for how in ("full", "left"):
        joined = month_change(now, before, "CVRCD", "PRM", how=how)
        once = monthly.change_within(rows, "199803", "199802", "PRM", how=how)
        assert sorted(map(repr, once.collect())) == sorted(map(repr, joined.collect()))


def test_one_month_of_net_expense_reaches_the_scan(spark):
    text = plan(domain.d10_net_expense(spark, SF))
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01" in text
    assert "GreaterThanOrEqual(o_orderdate,1998-03-01" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(relational.j5_semi_join_total(spark, SF))
    assert "EqualTo(l_returnflag,R)" in text and "StringStartsWith(o_orderpriority,1)" in text
    assert "l_shipdate" not in text


def test_business_groups_are_a_hash_lookup(spark):
    df = domain.d10_business_group(spark, SF)
    assert "INSET" in df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(df)


def test_months_are_pushed_down(spark):
    assert "GreaterThanOrEqual(l_shipdate,1998-02-01" in plan(domain.d17_coverage_change(spark, SF))


def test_total_line_reuses_the_groups(spark):
    df = checks.v4_row_count_grouped(spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_top_rows_are_not_sorted_as_a_whole(spark):
    assert "TakeOrderedAndProject" in plan(relational.a10_a11_top(spark, SF))


@pytest.mark.parametrize("parse", ["strict", "lenient", "bytes", "chars"])
def test_generated_methods_stay_small(spark, parse):
    """The JVM compiles no method above 8000 bytes; thirty columns with casts have to stay below."""
    names = [f"c{i}" for i in range(30)]
    layout = [Field(i * 5, i * 5 + 5, n) for i, n in enumerate(names)]
    lines = spark.createDataFrame([("1|a",)], "value string").repartition(2)
    df = {
        "strict": lambda: parse_strict(lines, names, numeric=names[:10], bigint=names[10:20], flag="bad"),
        "lenient": lambda: parse_lenient(lines, names, numeric=names[:10], bigint=names[10:20]).rows,
        "bytes": lambda: parse_fixed_bytes(lines, layout, names[:10]),
        "chars": lambda: parse_fixed_chars(lines, layout, names[:10]),
    }[parse]()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))
    assert all(int(size) < 8000 for size in sizes)


def test_one_month_is_pruned(spark):
    store = new_store(spark, "prune")
    rows = table(spark, SF, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("ym"), "o_totalprice"
    )
    store.load_month("o", rows, "ym", many_months=True)
    month = store.month_rows("o", "199803")
    assert "PartitionFilters: [isnotnull(_ym" in plan(month)
    assert month.agg(total(F.col("o_totalprice"))).head()[0] > 0
