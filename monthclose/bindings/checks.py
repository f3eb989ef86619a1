"""Registered queries: checks and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from monthclose.bindings.common import MONTH, cents, new_store, table
from monthclose.functions.casts import total
from monthclose.functions.months import month_of, month_params
from monthclose.operators.checks import (
    Checks, TableCheck, check_value, diff_totals, duplicate_keys, grouped_counts, largest_first, show_sums, table_checks,
)
from monthclose.operators.compare import reconcile
from monthclose.operators.reports import export_sheets, next_version, sheet_query, with_total
from monthclose.sources.files import work_dir


def _count(df):
    return df.agg(F.count(F.lit(1)).alias("n"))


def v1_check(spark, sf):
    """One check of each kind."""
    orders = table(spark, sf, "orders")
    checks = [
        check_value(_count(orders.where(F.col("o_totalprice") < 0)), "no negative orders"),
        check_value(_count(orders.where(F.col("o_orderstatus") == "P")), "no pending orders"),
        check_value(_count(orders), "orders", "nonzero"),
        check_value(_count(table(spark, sf, "region")), "regions", 5),
        check_value(_count(table(spark, sf, "nation")), "nations", 24),
        check_value(duplicate_keys(orders, ["o_orderkey"]).select("cnt"), "unique orders"),
    ]
    return reduce(lambda a, b: a.unionAll(b), checks)


def v1_table_checks(spark, sf):
    """Checks and sums of one table, all in one scan."""
    return table_checks(table(spark, sf, "lineitem"), [
        TableCheck("lines", expect="nonzero"),
        TableCheck("no negative quantity", "l_quantity < 0"),
        TableCheck("no returns", "l_returnflag = 'R'"),
        TableCheck("statuses", value="count(DISTINCT l_linestatus)", expect=2),
        TableCheck("shipped", "l_linestatus = 'F'", "sum(cast(l_quantity as bigint))", None),
        TableCheck("nothing", "l_quantity < 0", "sum(cast(l_quantity as bigint))"),
    ])


def v2_check_sum(spark, sf):
    lines = table(spark, sf, "lineitem")
    sums = lines.agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.count(F.lit(1)).alias("cnt"),
        F.max(F.when(F.col("l_quantity") < 0, F.col("l_quantity"))).alias("none"),
    )
    return show_sums(sums, "line items")


def _quantities(spark, sf, flag):
    """Rows of one return flag, not added up; the first suppliers are unknown."""
    lines = table(spark, sf, "lineitem").where(F.col("l_returnflag") == flag)
    return lines.select(
        F.when(F.col("l_suppkey") >= 5, F.col("l_suppkey")).alias("k"),
        F.col("l_quantity").cast("bigint").alias("s"),
    )


def v3_check_diff(spark, sf):
    return reconcile(_quantities(spark, sf, "A"), _quantities(spark, sf, "R"), ["k"], "s")


def v3_diff_totals(spark, sf):
    return diff_totals(v3_check_diff(spark, sf))


def v3_largest(spark, sf):
    return largest_first(v3_check_diff(spark, sf), ["k"]).limit(20)


def v3_two_keys(spark, sf):
    """Amounts by month and status, on two keys and with a wide threshold."""
    orders = table(spark, sf, "orders").select(
        month_of(F.col("o_orderdate")).alias("ym"), F.col("o_orderstatus").alias("st"),
        F.col("o_totalprice").alias("amt"),
    )
    lines = table(spark, sf, "lineitem").select(
        month_of(F.col("l_shipdate")).alias("ym"), F.col("l_linestatus").alias("st"),
        F.col("l_extendedprice").alias("amt"),
    )
    return cents(reconcile(orders, lines, ["ym", "st"], "amt", threshold=5_000_000))


def v4_row_count_grouped(spark, sf):
    return grouped_counts(table(spark, sf, "orders").where("o_totalprice > 1000"), ["o_orderstatus"])


def v4_row_count_two_keys(spark, sf):
    lines = table(spark, sf, "lineitem")
    return grouped_counts(lines, ["l_returnflag", "l_linestatus"])


def _store_with_tables(spark, sf, label):
    store = new_store(spark, label)
    store.replace("orders", table(spark, sf, "orders"))
    by_status = table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        total(F.col("o_totalprice")).alias("amt")
    )
    store.replace("out_status", by_status)
    return store


def v5_checks_run(spark, sf):
    """A run of checks on a store, with missing tables and columns: what was noted."""
    store = _store_with_tables(spark, sf, "v5")
    checks = Checks(store, work_dir(spark, "v5o"), month_params(MONTH))
    checks.require("orders", "absent")
    checks.check("orders there", "SELECT COUNT(*) FROM orders", "nonzero")
    checks.check("no table", "SELECT COUNT(*) FROM absent")
    checks.check("no column", "SELECT COUNT(absent) FROM orders")
    checks.row_count("orders", where="date_format(o_orderdate, 'yyyyMM') = '${SDM}'")
    checks.row_count("orders", group_by="o_orderstatus")
    checks.row_count("absent")
    checks.check_diff(
        "status / all",
        "SELECT o_orderstatus AS st, COUNT(*) AS n FROM orders GROUP BY o_orderstatus",
        "SELECT 'F' AS st, COUNT(*) AS n FROM orders", ["st"], "n",
    )
    return checks.summary()


def v6_duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem")
    return duplicate_keys(
        lines.select(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2")),
        ["k1", "k2"],
    )


def x1_sheet_top(spark, sf):
    store = new_store(spark, "x1")
    store.replace("orders", table(spark, sf, "orders"))
    query, _ = sheet_query(
        "orders",
        {
            "sheet": "top_${SDM}",
            "columns": ["o_orderkey AS k", "o_custkey AS c", "o_totalprice AS amt"],
            "where": "o_orderstatus = 'F'",
            "order_by": "o_totalprice DESC, o_orderkey",
            "limit": 1000,
        },
        MONTH,
        month_params(MONTH),
    )
    return store.query(query)


def x2_export(spark, sf):
    """Sheets written and read back: rows per sheet that has any."""
    store = _store_with_tables(spark, sf, "x2")
    sheets = {
        "orders": [
            "all_{yyyymm}",
            {"sheet": "urgent", "where": "o_orderpriority = '1-URGENT'"},
            {"sheet": "none", "where": "o_totalprice < 0"},
            {"sheet": "broken", "where": "no_such_column = 1"},
        ],
        "free": {"sheet": "by_customer",
                 "sql": "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey"},
    }
    path, _ = export_sheets(store, "report", sheets, work_dir(spark, "x2o"), month_params(MONTH))
    names = (f"all_{MONTH}", "urgent", "by_customer", "status")
    counts = [
        spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("sheet"), "rows"
        )
        for name in names
    ]
    return reduce(lambda a, b: a.unionAll(b), counts)


def x3_x5_summary(spark, sf):
    """The summary of a set: asked-for tables, tables with the automatic prefix, and the total."""
    store = _store_with_tables(spark, sf, "x5")
    _, summary = export_sheets(
        store, "report", {"orders": "orders"}, work_dir(spark, "x5o"), month_params(MONTH)
    )
    return summary.drop("seconds")


def x4_next_version(spark, sf):
    """File names by day: the major number is the year, the minor one the month."""
    names = table(spark, sf, "orders").select(
        F.concat(
            F.lit("job_199803_v"), F.date_format("o_orderdate", "yy"),
            F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(
                F.date_format("o_orderdate", ".MM")
            ),
            F.lit(".xlsx"),
        ).alias("name")
    )
    return next_version(names, "job_199803").unionAll(next_version(names, "job_199804"))


def x5_with_total(spark, sf):
    """Rows per event type with the closing line."""
    counts = table(spark, sf, "events").groupBy(F.col("event_type").alias("table")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return with_total(counts.select(F.lit(1).alias("no"), "table", F.col("table").alias("sheet"), "rows"))


QUERIES = {
    name: f for name, f in list(globals().items()) if name[0] in "vx" and name[1:2].isdigit()
}

_DIFF_SQL = """select coalesce(a.k, b.k) as k, coalesce(a.s, 0) as val_a, coalesce(b.s, 0) as val_b,
    coalesce(a.s, 0) - coalesce(b.s, 0) as diff from (
    select case when l_suppkey < 5 then null else l_suppkey end as k,
    cast(sum(cast(l_quantity as bigint)) as bigint) as s from lineitem where l_returnflag = 'A'
    group by 1) a full outer join (select case when l_suppkey < 5 then null else l_suppkey end as k,
    cast(sum(cast(l_quantity as bigint)) as bigint) as s from lineitem where l_returnflag = 'R'
    group by 1) b on a.k is not distinct from b.k
    where abs(coalesce(a.s, 0) - coalesce(b.s, 0)) > 1"""

ORACLE = {
    "v1_check": """select label, expect, v as value, case when ok then 'OK' else 'NG' end as status
        from (select 'no negative orders' as label, 'zero' as expect,
        count(*) filter (o_totalprice < 0) as v, count(*) filter (o_totalprice < 0) = 0 as ok from orders
        union all select 'no pending orders', 'zero', count(*) filter (o_orderstatus = 'P'),
        count(*) filter (o_orderstatus = 'P') = 0 from orders
        union all select 'orders', 'nonzero', count(*), count(*) > 0 from orders
        union all select 'regions', '5', count(*), count(*) = 5 from region
        union all select 'nations', '24', count(*), count(*) = 24 from nation
        union all select 'unique orders', 'zero', 0, true) c""",
    "v1_table_checks": """select label, expect, cast(v as varchar) as value, case when ok then 'OK' else 'NG' end as status from (
        select 'lines' as label, 'nonzero' as expect, count(*) as v, count(*) > 0 as ok from lineitem
        union all select 'no negative quantity', 'zero', count(*), count(*) = 0 from lineitem where l_quantity < 0
        union all select 'no returns', 'zero', count(*), count(*) = 0 from lineitem where l_returnflag = 'R'
        union all select 'statuses', '2', count(distinct l_linestatus), count(distinct l_linestatus) = 2 from lineitem
        union all select 'shipped', 'shown', sum(cast(l_quantity as bigint)), true from lineitem where l_linestatus = 'F'
        union all select 'nothing', 'zero', sum(cast(l_quantity as bigint)), sum(l_quantity) = 0 from lineitem
            where l_quantity < 0) c""",
    "v2_check_sum": """select 'line items' as label, name, value from (
        select 'qty' as name, cast(cast(sum(cast(l_quantity as bigint)) as bigint) as varchar) as value
        from lineitem union all select 'cnt', cast(count(*) as varchar) from lineitem
        union all select 'none', 'NULL') t""",
    "v3_check_diff": _DIFF_SQL,
    "v3_diff_totals": f"""select count(*) as diffs, cast(sum(val_a) as bigint) as val_a,
        cast(sum(val_b) as bigint) as val_b, cast(sum(diff) as bigint) as diff from ({_DIFF_SQL}) d""",
    "v3_largest": f"select * from ({_DIFF_SQL}) d order by abs(diff) desc, k nulls first limit 20",
    "v3_two_keys": """select coalesce(a.ym, b.ym) as ym, coalesce(a.st, b.st) as st,
        cast(coalesce(a.s, 0) as double) as val_a, cast(coalesce(b.s, 0) as double) as val_b,
        cast(coalesce(a.s, 0) - coalesce(b.s, 0) as double) as diff from (
        select strftime(o_orderdate, '%Y%m') as ym, o_orderstatus as st,
        sum(cast(o_totalprice as decimal(28,4))) as s from orders group by 1, 2) a
        full outer join (select strftime(l_shipdate, '%Y%m') as ym, l_linestatus as st,
        sum(cast(l_extendedprice as decimal(28,4))) as s from lineitem group by 1, 2) b
        on a.ym is not distinct from b.ym and a.st is not distinct from b.st
        where abs(coalesce(a.s, 0) - coalesce(b.s, 0)) > 5000000""",
    "v4_row_count_grouped": """select o_orderstatus as key, count(*) as cnt from orders
        where o_totalprice > 1000 group by o_orderstatus
        union all select 'total' as key, count(*) as cnt from orders where o_totalprice > 1000""",
    "v4_row_count_two_keys": """select l_returnflag || ' | ' || l_linestatus as key, count(*) as cnt
        from lineitem group by l_returnflag, l_linestatus
        union all select 'total', count(*) from lineitem""",
    "v5_checks_run": f"""select * from (values ('absent', 'exists', 'no table', 'SKIP'),
        ('no table', 'zero', 'no table', 'SKIP'), ('no column', 'zero', 'no column', 'SKIP'),
        ('absent', 'rows', 'no table', 'SKIP')) t(label, expect, value, status)
        union all select 'orders there', 'nonzero', cast(count(*) as varchar), 'OK' from orders
        union all select 'orders', 'rows', cast(count(*) as varchar), 'OK' from orders
        where strftime(o_orderdate, '%Y%m') = '{MONTH}'
        union all select 'orders', 'rows', cast(count(*) as varchar), 'OK' from orders
        union all select 'status / all', 'same', cast(count(distinct o_orderstatus) as varchar), 'NG'
        from orders""",
    "v6_duplicate_keys": """select l_orderkey as k1, l_linenumber as k2, count(*) as cnt from lineitem
        group by 1, 2 having count(*) > 1""",
    "x1_sheet_top": """select o_orderkey as k, o_custkey as c, o_totalprice as amt from orders
        where o_orderstatus = 'F' order by o_totalprice desc, o_orderkey limit 1000""",
    "x2_export": f"""select 'all_{MONTH}' as sheet, count(*) as rows from orders
        union all select 'urgent', count(*) from orders where o_orderpriority = '1-URGENT'
        union all select 'by_customer', count(distinct o_custkey) from orders
        union all select 'status', count(distinct o_orderstatus) from orders""",
    "x3_x5_summary": """select cast(no as int) as no, "table", sheet, cast(rows as bigint) as rows from (
        select 1 as no, 'orders' as "table", 'orders' as sheet, count(*) as rows from orders
        union all select 2, 'out_status', 'status', count(distinct o_orderstatus) from orders
        union all select null, '합계', null, count(*) + count(distinct o_orderstatus) from orders) t""",
    "x4_next_version": """select 'job_199803' as prefix, v as version, 'job_199803_' || v as next from (
        select 'v' || cast(max(mj) as varchar) || '.' ||
        lpad(cast(max(mn) filter (mj = top) + 1 as varchar), 2, '0') as v from (
        select *, max(mj) over () as top from (select year(o_orderdate) % 100 as mj,
        case when o_orderkey % 3 = 0 then 0 else month(o_orderdate) end as mn from orders) a) b) c
        union all select 'job_199804', 'v0.01', 'job_199804_v0.01'""",
    "x5_with_total": """select 1 as no, event_type as "table", event_type as sheet, count(*) as rows
        from events group by event_type union all select null, '합계', null, count(*) from events""",
}
