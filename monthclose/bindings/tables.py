"""Registered queries: loading, replacing and building tables, and whole jobs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from monthclose.bindings.common import (
    BEFORE, MONTH, cents, fixed_line, joined, money_sql, new_store, table, text, write_lines,
)
from monthclose.functions.casts import total
from monthclose.functions.months import in_months, month_of, month_params
from monthclose.operators.derived import KeptSums
from monthclose.operators.registry import LoadRegistry, latest_loads, not_yet_loaded
from monthclose.operators.store import MonthStore
from monthclose.plans import premium, samples
from monthclose.plans.extracts import FIO841, FIO843
from monthclose.plans.job import run_job
from monthclose.plans.load import load_set
from monthclose.sources.delimited import BAD, parse_strict
from monthclose.sources.files import list_names, rename, touch, work_dir
from monthclose.streaming.arrivals import arrivals, load_arrivals

#: Lines of one file of the premium job's extracts.
EXTRACT_ROWS = 100_000


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("ln"),
        month_of(F.col("l_shipdate")).alias("ym"),
        F.col("l_quantity").alias("qty"),
    )


_LINES_SQL = """select l_orderkey as k, l_linenumber as ln, strftime(l_shipdate, '%Y%m') as ym,
    l_quantity as qty from lineitem"""


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def m1_create(spark, sf):
    store = new_store(spark, "m1")
    store.append("customers", _customers(spark, sf))
    return store.table("customers")


def m2_month_replace(spark, sf):
    """All months loaded, then one of them again with other quantities."""
    store = new_store(spark, "m2")
    rows = _lines(spark, sf)
    store.load_month("lines", rows, "ym", many_months=True)
    again = rows.where(F.col("ym") == MONTH).withColumn("qty", F.col("qty") * 2)
    store.load_month("lines", again, "ym")
    return store.table("lines")


def m2_rerun(spark, sf):
    """The same extract loaded twice: its month once, rows of other months and of none twice."""
    store = new_store(spark, "m2r")
    rows = _lines(spark, sf).withColumn("ym", F.when(F.col("ln") != 7, F.col("ym")))
    store.load_month("lines", rows, "ym", many_months=True)
    store.load_month("lines", rows, "ym", many_months=True)
    return store.table("lines")


def m2_empty_month(spark, sf):
    """An extract without rows of its month empties the month. The month column is a number."""
    store = new_store(spark, "m2e")
    rows = _lines(spark, sf).withColumn("ym", F.col("ym").cast("double"))
    store.load_month("lines", rows, "ym", many_months=True)
    store.load_month("lines", rows.where(F.col("qty") < 0), "ym")
    return store.table("lines").groupBy("ym").agg(F.count(F.lit(1)).alias("cnt"))


def m3_replace(spark, sf):
    store = new_store(spark, "m3")
    store.replace("customers", _customers(spark, sf))
    store.replace("customers", _customers(spark, sf).where(F.col("c_acctbal") > 0))
    return store.table("customers")


def m4_append(spark, sf):
    store = new_store(spark, "m4")
    for _ in range(2):
        store.append("customers", _customers(spark, sf))
    return store.table("customers")


def _history(spark, sf):
    """Orders as loads: a table per customer, a file per day."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("t"), text(F.col("o_custkey"))).alias("table_name"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("file_name"),
        F.col("o_orderkey").alias("row_count"),
        F.col("o_orderdate").alias("loaded_at"),
    )


_HISTORY_SQL = """select 't' || cast(o_custkey as varchar) as table_name,
    strftime(o_orderdate, '%Y%m%d') as file_name, o_orderkey as row_count, o_orderdate as loaded_at
    from orders"""
_LATEST_SQL = f"""select table_name, file_name, row_count from (select *, row_number() over (
    partition by table_name order by loaded_at desc, file_name desc, row_count desc) as rn
    from ({_HISTORY_SQL}) h) r where rn = 1"""


def m5_registry(spark, sf):
    return latest_loads(_history(spark, sf)).select("table_name", "file_name", "row_count")


def m5_not_yet_loaded(spark, sf):
    history = _history(spark, sf)
    candidates = history.select("table_name", "file_name").distinct()
    return not_yet_loaded(candidates, history)


def m5_skip_loaded(spark, sf):
    """A second load of the same file is skipped, and done when it is forced."""
    store, folder = new_store(spark, "m5"), work_dir(spark, "m5f")
    line = joined("|", F.col("c_custkey"), F.col("c_name"))
    write_lines(table(spark, sf, "customer"), line, f"{folder}/c_{MONTH}.dat")
    tables = {"c": {
        "type": "pipe", "file": "c_{yyyymm}.dat", "month_col": None, "cols": ["k", "name"],
        "encoding": "utf-8",
    }}
    runs = [load_set(store, tables, folder, force=force) for force in (False, False, True)]
    registry = LoadRegistry(store).history().select("table_name", "file_name", "row_count")
    return registry.withColumn("skipped", F.lit(sum(len(r.skipped) for r in runs)).cast("bigint"))


def m2_merged_loads(spark, sf):
    """Loads of two months, each with rows of all months, merged: the rows of every month and how many loads were merged."""
    store, lines = new_store(spark, "m2m"), _lines(spark, sf)
    for part, month in enumerate((MONTH, BEFORE)):
        store.load_month("l", lines.where(F.col("ln") % 2 == part), "ym", month=month, many_months=True)
    merged = store.merge_loads("l")
    held = store.months_rows("l", "199501", "199912").groupBy("ym").agg(
        F.count("*").alias("n"), F.sum("k").alias("keys"))
    return held.withColumn("merged", F.lit(merged > 0))


def m6_kept_sums(spark, sf):
    """Sums by key kept up when one month is replaced: equal to a full rebuild, and one month is read."""
    store, lines = new_store(spark, "m6k"), _lines(spark, sf)
    sums = KeptSums(store, "kept", "l", ["ln"], {"qty": "cast(qty as bigint)", "n": "cast(1 as bigint)"})
    store.load_month("l", lines, "ym", many_months=True)
    sums.refresh()
    store.load_month("l", lines.where((F.col("ym") == MONTH) & (F.col("ln") < 4)), "ym")
    months = sums.refresh()
    return sums.frame().withColumn("months_read", F.lit(months))


def _deliver(df, line, folder, name):
    """One file for each value of the column ``n``: ``folder/name`` with the value in it."""
    drop = work_dir(df.sparkSession, "delivery")
    df.select("n", line.alias("value")).repartition(4, "n").write.partitionBy("n").text(f"{drop}/t")
    for part in list_names(df.sparkSession, f"{drop}/t"):
        for file in list_names(df.sparkSession, f"{drop}/t/{part}"):
            touch(df.sparkSession, f"{folder}/_made")
            rename(df.sparkSession, f"{drop}/t/{part}/{file}", f"{folder}/{name.format(part[2:])}")


def m5_arrivals(spark, sf):
    """Files loaded as they arrive, one of them a second time with other rows: the ledger, and what is stored of each file."""
    store, folder = new_store(spark, "m5a"), work_dir(spark, "m5af")
    orders = table(spark, sf, "orders").select("o_orderkey", month_of(F.col("o_orderdate")).alias("ym")).withColumn(
        "n", F.col("o_orderkey") % 4)
    line = joined("|", F.col("ym"), F.col("o_orderkey"))
    deliveries = (("first", orders), ("second", orders.where("o_orderkey % 8 = 3")), ("none", orders.limit(0)))
    for name, rows in deliveries:
        _deliver(rows, line, f"{folder}/{name}", "orders_{}.dat")
        load_arrivals(
            store, "arrived", folder, "*.dat", lambda lines: parse_strict(lines, ["ym", "k"], bigint=["k"], flag=BAD), "ym",
            f"{folder}/_checkpoint", nested=True).awaitTermination()
    held = store.table("arrived").groupBy(F.concat(F.lit("orders_"), F.col("k") % 4, F.lit(".dat")).alias("file_name")).agg(
        F.count("*").alias("held"), F.countDistinct("ym").alias("months"), F.sum("k").alias("keys"))
    return arrivals(store, "arrived").join(held, "file_name").select("file_name", "row_count", "held", "months", "keys")


def f8_load_time(spark, sf):
    """A load notes its time, which lies between the beginning of the query and its end."""
    store = new_store(spark, "f8")
    store.append("customers", _customers(spark, sf))
    begin = spark.range(1).select(F.current_timestamp().alias("t")).head()["t"]
    LoadRegistry(store).record("customers", "c.dat", store.table("customers").count())
    noted = F.col("loaded_at")
    return LoadRegistry(store).entries().select(
        "table_name", "row_count", ((noted >= F.lit(begin)) & (noted <= F.current_timestamp())).alias("in_time")
    )


def m6_ctas(spark, sf):
    """A table built by a query, then built again from itself."""
    store = new_store(spark, "m6")
    store.replace("customers", _customers(spark, sf))
    params = month_params(MONTH)
    store.sql(
        "CREATE OR REPLACE TABLE rich_${SDM} AS SELECT c_custkey, c_acctbal FROM customers "
        "WHERE c_acctbal > 0",
        params,
    )
    store.sql(
        "create or replace table rich_${SDM} as select c_custkey, c_acctbal * 2 as c_acctbal "
        "from rich_${SDM} where c_acctbal > 5000",
        params,
    )
    return store.table(f"rich_{MONTH}")


def m7_query_file(spark, sf):
    store, folder = new_store(spark, "m7"), work_dir(spark, "m7f")
    store.replace("customers", _customers(spark, sf))
    query = "CREATE OR REPLACE TABLE big AS\nSELECT c_custkey FROM customers WHERE c_acctbal > ${MIN}"
    spark.createDataFrame([(line,) for line in query.split("\n")], "value string").coalesce(
        1
    ).write.text(f"{folder}/query.sql")
    store.sql_file(f"{folder}/query.sql", {"MIN": 0}, MIN=9000)
    return store.table("big")


def j6_attached_month(spark, sf):
    """This month's totals joined with those of the attached month before."""
    this = new_store(spark, "m8")
    before = MonthStore(spark, this.root, BEFORE, this.name)
    for store in (this, before):
        rows = table(spark, sf, "lineitem").where(
            in_months(F.col("l_shipdate"), store.month, store.month)
        )
        sums = rows.groupBy(F.col("l_suppkey").alias("k")).agg(
            total(F.col("l_quantity")).alias("amt")
        )
        store.replace(f"agg{store.month}", sums)
    params = month_params(MONTH)
    this.attach({"LM": BEFORE, "LM2": "190001"})
    return this.query(
        "SELECT a.k, a.amt AS cur, b.amt AS prev FROM agg${SDM} a "
        "LEFT JOIN LM.agg${LM} b ON a.k = b.k",
        params,
    )


def m9_load_set(spark, sf):
    """Two tables load, one has no file: what became of each, with the rows written."""
    store, folder = new_store(spark, "m9"), work_dir(spark, "m9f")
    customers, suppliers = table(spark, sf, "customer"), table(spark, sf, "supplier")
    write_lines(
        customers, joined("|", F.lit(MONTH), F.col("c_custkey"), F.col("c_acctbal")),
        f"{folder}/customer_{MONTH}.dat",
    )
    # Every fourth line has one field too many, which only the lenient reading can deal with.
    line = joined("|", F.col("s_suppkey"), F.col("s_name"))
    extra = F.when(F.col("s_suppkey") % 4 == 1, "|x").otherwise("")
    write_lines(suppliers, F.concat(line, extra), f"{folder}/supplier_{MONTH}.dat")
    tables = {
        "customers": {
            "type": "pipe", "file": "customer_{yyyymm}.dat", "month_col": "ym",
            "cols": ["ym", "k", "amt"], "numeric": ["amt"], "encoding": "utf-8",
        },
        "suppliers_{yyyymm}": {
            "type": "pipe", "file": "supplier_{yyyymm}.dat", "month_col": None, "cols": ["k", "name"],
            "encoding": "utf-8",
        },
        "absent": {"type": "pipe", "file": "absent_{yyyymm}.dat", "month_col": None, "cols": ["k"]},
    }
    result = load_set(store, tables, folder)
    outcome = [(name, "failed", 0, 0) for name in result.failed] + [
        (name, "loaded", rows, result.rejected.get(name, 0)) for name, rows in result.rows.items()
    ]
    stored = (
        store.table("customers").select(F.lit("customers").alias("name"), "k")
        .unionAll(store.table(f"suppliers_{MONTH}").select(F.lit(f"suppliers_{MONTH}"), "k"))
        .groupBy("name").agg(F.count("k").alias("stored"))
    )
    outcome = spark.createDataFrame(
        outcome, "name string, outcome string, row_count bigint, rejected bigint"
    )
    return outcome.join(stored, "name", "left")


def m10_job_premium(spark, sf):
    """The premium job from fixed-width extracts to the reconciled totals."""
    store, folder = new_store(spark, "m10"), work_dir(spark, "m10f")
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    income = {
        "CLS_YYMM": month_of(F.col("l_shipdate")),
        "PLYNO": F.col("l_orderkey"),
        "INS_IMCD": F.col("l_linestatus"),
        "RP_PRM": F.col("l_extendedprice"),
        "AF_PRM": F.col("l_quantity"),
    }
    held = {
        "CLS_YYMM": month_of(F.col("o_orderdate")),
        "PLYNO": F.col("o_orderkey"),
        "INS_IMCD": F.col("o_orderstatus"),
        "AP_PRM": F.col("o_totalprice"),
        "BZCS_DV_PS": F.lit(1),
    }
    # Most of a line is blank. A compressed file is read by one task, so there are many small ones.
    for rows, values, settings in ((lines, income, FIO841), (orders, held, FIO843)):
        path = f"{folder}/{settings['file'].format(yyyymm=MONTH)}"
        write_lines(rows, fixed_line(settings["cols"], values), path, compression="gzip", file_rows=EXTRACT_ROWS)
    # These extracts hold every month of their tables.
    tables = {name: {**settings, "many_months": True} for name, settings in premium.JOB.tables.items()}
    report = run_job(store, replace(premium.JOB, tables=tables), folder, f"{folder}/out")
    if report.errors:
        raise RuntimeError(str(report.errors))
    return cents(store.table("BASE_DATA_CH").join(store.table("BASE_DATA_CH_843"), "INS_IMCD", "full"))


def m10_job_checks(spark, sf):
    """The sample job over gzip files: its check results, and the rows of its table."""
    store, folder = new_store(spark, "m10c"), work_dir(spark, "m10cf")
    events = table(spark, sf, "events")
    line = joined("|", F.col("event_type"), F.col("user_id"), F.col("value"))
    for name in (f"btLtrJ930_020_{MONTH}01_a.dat.gz", f"btLtrJ930_020_all_{MONTH}01_a.dat.gz"):
        write_lines(events, line, f"{folder}/{name}", compression="gzip")
    report = run_job(store, samples.JOB, folder, f"{folder}/out")
    checks = spark.createDataFrame(
        report.checks, "label string, expect string, value string, status string"
    )
    rows = store.table("bt930_020_all").agg(F.count(F.lit(1)).alias("row_count"), F.lit("sample_agg").alias("label"))
    return checks.select("label", "expect", "value", "status").join(rows, "label", "left")


def m11_conditional(spark, sf):
    """A step that runs only if its table is there, and a drop of a table that may not be."""
    store = new_store(spark, "m11")
    store.replace("customers", _customers(spark, sf))
    store.sql("DROP TABLE IF EXISTS nothing")
    for name in ("customers", "nothing"):
        if store.exists(name):
            store.sql(f"CREATE TABLE copy_of_{name} AS SELECT c_custkey FROM {name}")
    store.sql("DROP TABLE IF EXISTS customers")
    names = spark.createDataFrame([(n,) for n in store.tables()], "name string")
    copied = store.table("copy_of_customers").select(F.lit("copy_of_customers").alias("name"))
    return names.join(copied.groupBy("name").agg(F.count(F.lit(1)).alias("row_count")), "name", "left")


QUERIES = {
    name: f for name, f in list(globals().items()) if name[0] in "mjf" and name[1:2].isdigit()
}

_CUSTOMERS_SQL = "select c_custkey, c_name, c_acctbal from customer"

ORACLE = {
    "m1_create": _CUSTOMERS_SQL,
    "m2_month_replace": _LINES_SQL.replace(
        "l_quantity as qty",
        f"case when strftime(l_shipdate, '%Y%m') = '{MONTH}' then l_quantity * 2 "
        "else l_quantity end as qty",
    ),
    "m2_rerun": f"""select k, ln, case when ln <> 7 then ym end as ym, qty from ({_LINES_SQL}) t
        union all select k, ln, case when ln <> 7 then ym end as ym, qty from ({_LINES_SQL}) t
        where ym <> '{MONTH}' or ln = 7""",
    "m2_empty_month": f"""select cast(ym as double) as ym, count(*) as cnt from ({_LINES_SQL}) t
        where ym <> '{MONTH}' group by 1""",
    "m3_replace": f"{_CUSTOMERS_SQL} where c_acctbal > 0",
    "m4_append": f"{_CUSTOMERS_SQL} union all {_CUSTOMERS_SQL}",
    "m5_registry": _LATEST_SQL,
    "m5_not_yet_loaded": f"""select distinct h.table_name, h.file_name from ({_HISTORY_SQL}) h
        left join ({_LATEST_SQL}) l on h.table_name = l.table_name and h.file_name = l.file_name
        where l.table_name is null""",
    "m5_skip_loaded": f"""select 'c' as table_name, 'c_{MONTH}.dat' as file_name,
        (select count(*) from customer) as row_count, cast(1 as bigint) as skipped
        from (values (1), (2)) v(i)""",
    "m2_merged_loads": f"""select strftime(l_shipdate, '%Y%m') as ym, count(*) as n, cast(sum(l_orderkey) as bigint) as keys,
        true as merged from lineitem where strftime(l_shipdate, '%Y%m') between '199501' and '199912'
        and not (strftime(l_shipdate, '%Y%m') = '{BEFORE}' and l_linenumber % 2 = 0) group by 1""",
    "m6_kept_sums": f"""select l_linenumber as ln, cast(sum(cast(l_quantity as bigint)) as bigint) as qty,
        count(*) as n, 1 as months_read from lineitem
        where strftime(l_shipdate, '%Y%m') <> '{MONTH}' or l_linenumber < 4 group by 1""",
    "m5_arrivals": """select 'orders_' || (o_orderkey % 4) || '.dat' as file_name, count(*) as row_count, count(*) as held,
        count(distinct strftime(o_orderdate, '%Y%m')) as months, cast(sum(o_orderkey) as bigint) as keys
        from orders where o_orderkey % 4 <> 3 or o_orderkey % 8 = 3 group by 1""",
    "f8_load_time": "select 'customers' as table_name, count(*) as row_count, true as in_time from customer",
    "m6_ctas": """select c_custkey, c_acctbal * 2 as c_acctbal from customer
        where c_acctbal > 5000""",
    "m7_query_file": "select c_custkey from customer where c_acctbal > 9000",
    "j6_attached_month": f"""select a.k as k, a.amt as cur, b.amt as prev from
        (select l_suppkey as k, {money_sql('l_quantity')} as amt from lineitem
        where strftime(l_shipdate, '%Y%m') = '{MONTH}' group by 1) a left join
        (select l_suppkey as k, {money_sql('l_quantity')} as amt from lineitem
        where strftime(l_shipdate, '%Y%m') = '{BEFORE}' group by 1) b on a.k = b.k""",
    "m9_load_set": f"""select 'customers' as name, 'loaded' as outcome, count(*) as row_count,
        cast(0 as bigint) as rejected, count(*) as stored from customer
        union all select 'suppliers_{MONTH}', 'loaded', count(*) filter (s_suppkey % 4 <> 1),
        count(*) filter (s_suppkey % 4 = 1), count(*) filter (s_suppkey % 4 <> 1) from supplier
        union all select 'absent', 'failed', 0, 0, null""",
    "m10_job_premium": f"""select coalesce(a.i, b.i) as INS_IMCD, a.rp as RP_PRM, a.af as AF_PRM,
        b.ap as AP_PRM from (select l_linestatus as i, {money_sql('l_extendedprice')} as rp,
        {money_sql('l_quantity')} as af from lineitem group by 1) a
        full outer join (select o_orderstatus as i, {money_sql('o_totalprice')} as ap from orders
        group by 1) b on a.i = b.i""",
    "m10_job_checks": """select 'sample_agg' as label, 'nonzero' as expect,
        cast(count(distinct event_type) as varchar) as value, 'OK' as status,
        count(*) as row_count from events""",
    "m11_conditional": "select 'copy_of_customers' as name, count(*) as row_count from customer",
}
