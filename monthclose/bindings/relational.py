"""Registered queries: predicates, joins, aggregates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthclose.bindings.common import MONTH, cents, money_sql, new_store, table, text
from monthclose.functions.casts import double_to_bigint, month_text, total
from monthclose.functions.months import (
    fill_params, month_of, month_params, shift_month, with_month_params,
)
from monthclose.operators.compare import (
    full_join_null_safe, month_change, rows_where_key_in, totals_where_key_in,
)


def p1_p9_projection(spark, sf):
    """Literals, aliases, equality, inequality, lists and prefixes."""
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderstatus") != "P")
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW"))
        .where(~F.col("o_custkey").isin(1, 2, 3))
        .where(F.col("o_orderpriority").like("%-%") & (F.col("o_totalprice") > 100000))
        .select(F.col("o_orderkey").alias("k"), F.lit("LA").alias("bgb"), F.lit("0").alias("cgb"),
                F.col("o_totalprice").alias("amt"))
    )


def _with_null(spark, sf):
    """Customers whose nation is unknown where they owe money."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )


_WITH_NULL_SQL = """select c_custkey as k, case when c_acctbal >= 0 then c_nationkey end as nation,
    c_mktsegment as segment from customer"""


def p4_not_in_null(spark, sf):
    """NOT IN does not keep NULL."""
    return _with_null(spark, sf).where(~F.col("nation").isin(1, 2, 3)).select("k")


def p5_is_null(spark, sf):
    return _with_null(spark, sf).where(F.col("nation").isNull()).select("k")


def p7_not_distinct(spark, sf):
    """Rows whose nation is the same as the number of their segment, NULL and NULL included."""
    number = F.when(F.col("segment") == "BUILDING", 3).when(F.col("segment") == "MACHINERY", 5)
    return _with_null(spark, sf).where(F.col("nation").eqNullSafe(number)).select("k", "segment")


def p10_cte(spark, sf):
    """Chained results: orders per customer, and how many customers have how many."""
    return spark.sql(
        "WITH a AS (SELECT o_custkey, COUNT(*) AS n FROM {o} GROUP BY o_custkey), "
        "b AS (SELECT n, COUNT(*) AS customers FROM a GROUP BY n) "
        "SELECT n, customers FROM b",
        o=table(spark, sf, "orders"),
    )


def j1_inner(spark, sf):
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("k"), F.col("c_name").alias("name")
    )


def _nations(spark, sf, name, key):
    """Balance per nation; the highest nations are unknown."""
    rows = table(spark, sf, name)
    nation = F.when(F.col(f"{key}_nationkey") < 20, F.col(f"{key}_nationkey"))
    return rows.groupBy(nation.alias("k")).agg(total(F.col(f"{key}_acctbal")).alias("s"))


def _nations_sql(name, key):
    return f"""select case when {key}_nationkey < 20 then {key}_nationkey end as k,
        {money_sql(f'{key}_acctbal')} as s from {name} group by 1"""


def j3_full_join(spark, sf):
    """NULL keys of the two sides stay apart."""
    return cents(month_change(
        _nations(spark, sf, "customer", "c"), _nations(spark, sf, "supplier", "s"), "k", "s"
    ))


def j4_null_safe_full(spark, sf):
    """Two keys; NULL keys match."""
    def per_day(name, prefix, day):
        rows = table(spark, sf, name)
        kind = F.substring(F.col("o_orderpriority" if prefix == "o" else "l_returnflag"), 1, 1)
        known = F.when(~kind.isin("1", "N"), F.lit("x"))
        return rows.groupBy(month_of(F.col(day)).alias("ym"), known.alias("kind")).agg(
            F.count(F.lit(1)).alias(f"n_{prefix}")
        )

    return full_join_null_safe(
        per_day("orders", "o", "o_orderdate"), per_day("lineitem", "l", "l_shipdate"),
        ["ym", "kind"], ["n_o"], ["n_l"],
    )


def j5_semi_join(spark, sf):
    urgent = table(spark, sf, "orders").where(F.col("o_orderpriority").startswith("1"))
    lines = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return rows_where_key_in(
        lines.select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey",
        urgent.select("o_orderkey"),
    )


def j5_semi_join_total(spark, sf):
    """Count and amount of such rows, without shuffling the rows themselves."""
    urgent = table(spark, sf, "orders").where(F.col("o_orderpriority").startswith("1"))
    lines = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    sums = {"n": F.count(F.lit(1)), "s": total(F.col("l_extendedprice"))}
    return cents(totals_where_key_in(lines, "l_orderkey", urgent.select("o_orderkey"), sums))


def a1_a4_group_by_expression(spark, sf):
    """Several sums by a computed key."""
    kind = F.when(F.col("l_quantity") > 25, "large").otherwise("small").alias("kind")
    return cents(table(spark, sf, "lineitem").groupBy(kind, F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("cnt"),
        total(F.col("l_extendedprice")).alias("price"),
        total(F.col("l_quantity")).alias("qty"),
    ))


def a5_distinct(spark, sf):
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


def a6_distinct_of_groups(spark, sf):
    """A key left out of the result makes groups equal; distinct then drops the repeats."""
    counts = table(spark, sf, "orders").groupBy("o_orderstatus", "o_custkey").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select("o_orderstatus", "n").distinct()


def a7_a9_nested_having(spark, sf):
    """Signed sums stacked, added up again, and kept where they are large."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("s")
    )
    balances = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), (-F.col("c_acctbal")).alias("s")
    )
    sums = orders.unionAll(balances).groupBy("k").agg(total(F.col("s")).alias("s"))
    return cents(sums.where(F.abs("s") > 1000000))


def a8_empty_total(spark, sf):
    """A total over no rows is 0."""
    none = table(spark, sf, "orders").where(F.col("o_totalprice") < 0)
    return none.agg(F.coalesce(total(F.col("o_totalprice")), F.lit(0.0)).alias("s"))


def a10_a11_top(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
        .orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber")
        .limit(100)
    )


def a12_union_all(spark, sf):
    customers = table(spark, sf, "customer").select(text(F.col("c_custkey")).alias("k"), "c_acctbal")
    suppliers = table(spark, sf, "supplier").select(text(F.col("s_suppkey")), "s_acctbal")
    return customers.unionAll(suppliers)


def f1_f6_scalars(spark, sf):
    """Substring, trim, case, coalesce, arithmetic and casts to text."""
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.substring("l_linestatus", 1, 2).alias("sub"),
        F.trim(F.concat(F.lit("  "), "l_returnflag", F.lit(" "))).alias("trimmed"),
        F.when(F.col("l_returnflag") == "A", "a").alias("only_a"),
        F.coalesce(F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")), F.lit(0)).alias("c"),
        F.abs(F.col("l_quantity") - 25).alias("d"),
        (price * -1 + F.col("l_quantity")).alias("e"),
        text(double_to_bigint(F.col("l_quantity") / 2)).alias("half"),
        month_text(F.col("l_quantity") + 202600, "double").alias("ym"),
    )


def f9_month_shift(spark, sf):
    ym = month_of(F.col("o_orderdate"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        shift_month(ym, 1).alias("before"),
        shift_month(ym, 14).alias("long_before"),
        shift_month(ym, -1).alias("after"),
    )


def f10_month_params(spark, sf):
    months = table(spark, sf, "orders").select(month_of(F.col("o_orderdate")).alias("yyyymm"))
    return with_month_params(months.distinct(), "yyyymm")


def f11_filled_query(spark, sf):
    """Parameters put into a condition; an unknown one is left alone."""
    condition = fill_params("date_format(o_orderdate, 'yyyyMM') in ('${SDM}', '${LM}')",
                            month_params(MONTH))
    return table(spark, sf, "orders").where(condition).select(
        F.col("o_orderkey").alias("k"),
        F.lit(fill_params("${LM2} ${NOT_KNOWN}", month_params(MONTH))).alias("t"),
    )


QUERIES = {
    name: f for name, f in list(globals().items()) if name[0] in "pjaf" and name[1:2].isdigit()
}

ORACLE = {
    "p1_p9_projection": """select o_orderkey as k, 'LA' as bgb, '0' as cgb, o_totalprice as amt
        from orders where o_orderstatus <> 'P' and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')
        and o_custkey not in (1, 2, 3) and o_orderpriority like '%-%' and o_totalprice > 100000""",
    "p4_not_in_null": f"select k from ({_WITH_NULL_SQL}) t where nation not in (1, 2, 3)",
    "p5_is_null": f"select k from ({_WITH_NULL_SQL}) t where nation is null",
    "p7_not_distinct": f"""select k, segment from ({_WITH_NULL_SQL}) t where nation is not distinct from
        case segment when 'BUILDING' then 3 when 'MACHINERY' then 5 end""",
    "p10_cte": """with a as (select o_custkey, count(*) as n from orders group by o_custkey)
        select n, count(*) as customers from a group by n""",
    "j1_inner": """select o_orderkey as k, c_name as name from orders
        join customer on o_custkey = c_custkey""",
    "j3_full_join": f"""select coalesce(a.k, b.k) as k, coalesce(a.s, 0) as cur,
        coalesce(b.s, 0) as prev, round(coalesce(a.s, 0) - coalesce(b.s, 0), 2) as chg
        from ({_nations_sql('customer', 'c')}) a
        full outer join ({_nations_sql('supplier', 's')}) b on a.k = b.k""",
    "j4_null_safe_full": """select coalesce(a.ym, b.ym) as ym, coalesce(a.kind, b.kind) as kind,
        n_o, n_l from (select strftime(o_orderdate, '%Y%m') as ym,
        case when substr(o_orderpriority, 1, 1) not in ('1', 'N') then 'x' end as kind,
        count(*) as n_o from orders group by 1, 2) a full outer join (
        select strftime(l_shipdate, '%Y%m') as ym,
        case when l_returnflag not in ('1', 'N') then 'x' end as kind,
        count(*) as n_l from lineitem group by 1, 2) b
        on a.ym is not distinct from b.ym and a.kind is not distinct from b.kind""",
    "j5_semi_join": """select l_orderkey, l_linenumber, l_quantity from lineitem
        where l_returnflag = 'R' and l_orderkey in (
        select distinct o_orderkey from orders where substr(o_orderpriority, 1, 1) = '1')""",
    "j5_semi_join_total": f"""select cast(count(*) as bigint) as n, {money_sql('l_extendedprice')} as s
        from lineitem where l_returnflag = 'R' and l_orderkey in (
        select distinct o_orderkey from orders where substr(o_orderpriority, 1, 1) = '1')""",
    "a1_a4_group_by_expression": f"""select case when l_quantity > 25 then 'large' else 'small' end
        as kind, l_returnflag as flag, count(*) as cnt, {money_sql('l_extendedprice')} as price,
        {money_sql('l_quantity')} as qty from lineitem group by 1, 2""",
    "a5_distinct": "select distinct o_orderstatus, o_orderpriority from orders",
    "a6_distinct_of_groups": """select distinct o_orderstatus, count(*) as n from orders
        group by o_orderstatus, o_custkey""",
    "a7_a9_nested_having": """select k, cast(sum(s) as double) as s from (
        select o_custkey as k, sum(cast(o_totalprice as decimal(28,4))) as s from orders group by 1
        union all select c_custkey, -sum(cast(c_acctbal as decimal(28,4))) from customer group by 1) u
        group by k having abs(sum(s)) > 1000000""",
    "a8_empty_total": """select coalesce(cast(sum(o_totalprice) as double), 0) as s from orders
        where o_totalprice < 0""",
    "a10_a11_top": """select l_orderkey, l_linenumber, l_extendedprice from lineitem
        order by l_extendedprice desc, l_orderkey, l_linenumber limit 100""",
    "a12_union_all": """select cast(c_custkey as varchar) as k, c_acctbal from customer
        union all select cast(s_suppkey as varchar), s_acctbal from supplier""",
    "f1_f6_scalars": """select l_orderkey as k, substr(l_linestatus, 1, 2) as sub,
        trim('  ' || l_returnflag || ' ') as trimmed, case when l_returnflag = 'A' then 'a' end as only_a,
        coalesce(case when l_linenumber > 3 then l_linenumber end, 0) as c, abs(l_quantity - 25) as d,
        l_extendedprice * -1 + l_quantity as e,
        cast(cast(cast(l_quantity / 2 as decimal(38,10)) as bigint) as varchar) as half,
        cast(cast(l_quantity + 202600 as bigint) as varchar) as ym from lineitem""",
    "f9_month_shift": """select o_orderkey as k,
        strftime(date_trunc('month', o_orderdate) - interval 1 month, '%Y%m') as before,
        strftime(date_trunc('month', o_orderdate) - interval 14 month, '%Y%m') as long_before,
        strftime(date_trunc('month', o_orderdate) + interval 1 month, '%Y%m') as after from orders""",
    "f10_month_params": """select yyyymm, yyyymm as SDM,
        strftime(strptime(yyyymm || '01', '%Y%m%d') - interval 1 month, '%Y%m') as LM,
        strftime(strptime(yyyymm || '01', '%Y%m%d') - interval 2 month, '%Y%m') as LM2,
        substr(yyyymm, 1, 4) as YYYY, substr(yyyymm, 5, 2) as MM
        from (select distinct strftime(o_orderdate, '%Y%m') as yyyymm from orders) t""",
    "f11_filled_query": """select o_orderkey as k, '199801 ${NOT_KNOWN}' as t from orders
        where strftime(o_orderdate, '%Y%m') in ('199803', '199802')""",
}
