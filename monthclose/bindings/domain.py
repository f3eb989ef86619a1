"""Registered queries: the monthly jobs' own tables and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthclose.bindings.common import (
    BEFORE, COVERAGE_SQL, HANDLING_SQL, MAINTENANCE_SQL, MONTH, TOTALS_SQL, VOUCHERS_SQL,
    cents, coverage_rows, handling_rows, held_rows, income_rows, maintenance_rows, money_sql, table, text,
    voucher_rows,
)
from monthclose.functions.casts import total
from monthclose.functions.months import in_months, month_of
from monthclose.operators.compare import month_change, reconcile
from monthclose.plans import allocation, closing, monthly, premium, samples

LINE_MONTH = "strftime(l_shipdate, '%Y%m')"


def d1_premium_by_line(spark, sf):
    return cents(premium.premium_by_line(income_rows(spark, sf)))


def d2_held_premium_by_line(spark, sf):
    return cents(premium.held_premium_by_line(held_rows(spark, sf)))


def d3_held_premium_by_month(spark, sf):
    return cents(premium.held_premium_by_month(held_rows(spark, sf)))


def d4_agency_anomalies(spark, sf):
    return premium.agency_anomalies(held_rows(spark, sf), staff=("2-",), agencies=("F",))


def d5_income_against_held(spark, sf):
    income = income_rows(spark, sf).select("INS_IMCD", F.col("RP_PRM").alias("AMT"))
    held = held_rows(spark, sf).select("INS_IMCD", F.col("AP_PRM").alias("AMT"))
    return cents(reconcile(income, held, ["INS_IMCD"], "AMT"))


def d6_allocation_mapping(spark, sf):
    return allocation.allocation_rows(maintenance_rows(spark, sf))


def d7_stacked_allocations(spark, sf):
    return allocation.stacked(maintenance_rows(spark, sf), handling_rows(spark, sf))


def _totals(spark, sf, month=None):
    return allocation.allocation_totals(
        allocation.stacked(maintenance_rows(spark, sf, month), handling_rows(spark, sf, month))
    )


def d8_allocation_totals(spark, sf):
    return cents(_totals(spark, sf))


def d9_deferral_totals(spark, sf):
    channel = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        month_of(F.col("l_shipdate")).alias("CLS_YYMM"),
        F.concat(text(channel % 4 + 1), text(F.col("l_suppkey") % 3 + 1)).alias("SL_TPCD"),
        F.col("l_extendedprice").alias("RL_CREW_NWCRT"),
        F.col("l_quantity").alias("RL_NWCRT_DPCS"),
    )
    return cents(allocation.deferral_totals(rows))


def d10_net_expense(spark, sf):
    return cents(allocation.net_expense(_totals(spark, sf, MONTH), MONTH))


def d10_business_group(spark, sf):
    lines = maintenance_rows(spark, sf)
    totals = lines.groupBy("INS_IMCD").agg(total(F.col("DVAMT")).alias("S"))
    group = allocation.business_group(F.col("INS_IMCD")).alias("BGB")
    return cents(totals.select("INS_IMCD", group, "S"))


def d11_expense_trend(spark, sf):
    return cents(allocation.expense_trend(_totals(spark, sf)))


def d12_ledger_gaps(spark, sf):
    return cents(allocation.ledger_gaps(voucher_rows(spark, sf), _totals(spark, sf)))


def d12_ledger_gap_count(spark, sf):
    orders = table(spark, sf, "orders").select(
        text(F.col("o_orderkey")).alias("NTACC_CD"), F.col("o_totalprice").alias("WONCR_POAMT")
    )
    lines = table(spark, sf, "lineitem").select(
        text(F.col("l_orderkey")).alias("NTACC_CD"), F.col("l_extendedprice").alias("S")
    )
    return allocation.ledger_gaps(orders, lines).select().groupBy().agg(
        F.count(F.lit(1)).alias("gaps")
    )


def d13_missing_coverage(spark, sf):
    claims = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", "LA").otherwise("FA").alias("IKD_GRPCD"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("CVRCD"),
    )
    return closing.missing_coverage(claims, "CVRCD")


def d14_unallocated_phone_sales(spark, sf):
    return closing.unallocated_phone_sales(_totals(spark, sf), voucher_rows(spark, sf))


def d15_reclosed_amount(spark, sf):
    return cents(closing.reclosed_amount(_totals(spark, sf), voucher_rows(spark, sf)))


def d16_coverage_totals(spark, sf):
    return cents(monthly.coverage_totals(coverage_rows(spark, sf), MONTH))


def d17_coverage_change(spark, sf):
    return cents(monthly.change_within(coverage_rows(spark, sf), MONTH, BEFORE, "PRM"))


def d18_amount_change(spark, sf):
    return cents(monthly.change_within(coverage_rows(spark, sf), MONTH, BEFORE, "AMT", how="left"))


def d19_largest_premiums(spark, sf):
    return monthly.largest_premiums(coverage_rows(spark, sf), MONTH)


def d20_sample_count(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("COL1"))
    return samples.count_by(events)


def j2_left_month_change(spark, sf):
    """Customers' order totals this month, against the month before."""
    def by_customer(month):
        orders = table(spark, sf, "orders").where(in_months(F.col("o_orderdate"), month, month))
        return orders.groupBy(F.col("o_custkey").alias("k")).agg(
            total(F.col("o_totalprice")).alias("s")
        )

    return cents(month_change(by_customer(MONTH), by_customer(BEFORE), "k", "s", how="left"))


QUERIES = {
    name: f for name, f in list(globals().items()) if name[0] in "dj" and name[1:2].isdigit()
}

# The pension group's line codes and the accounts, stated for the SQL on their own.
_PENSION = """
    'LA02660', 'LA02661', 'LA02662', 'LA02663', 'LA02664', 'LA02665', 'LA02666', 'LA02667', 'LA02668',
    'LA02669', 'LA02670', 'LA02699', 'LA02800', 'LA02802', 'LA02803', 'LA02804', 'LA02805', 'LA02806',
    'LA02807', 'LA02808', 'LA02809', 'LA02810', 'LA02812', 'LA02813', 'LA02814', 'LA02815', 'LA02816',
    'LA02818', 'LA02819', 'LA02820', 'LA02821', 'LA02822', 'LA02823', 'LA02824', 'LA02825', 'LA02826',
    'LA02827', 'LA02828', 'LA02829', 'LA02830', 'LA02831', 'LA02833', 'LA02835', 'LA02836', 'LA02838',
    'LA02839', 'LA02840', 'LA02841', 'LA02842', 'LA02844', 'LA02845', 'LA02846', 'LA02847', 'LA02848',
    'LA02850', 'LA02851', 'LA02852', 'LA02854', 'LA02855', 'LA02856', 'LA02858', 'LA02859', 'LA02860',
    'LA02861', 'LA02862', 'LA02863', 'LA02864', 'LA02866', 'LA02867', 'LA02868', 'LA02869', 'LA02872',
    'LA02873', 'LA02874', 'LA02875', 'LA02878', 'LA02879', 'LA02880', 'LA02881', 'LA02882', 'LA02883',
    'LA02885', 'LA02886', 'LA02887', 'LA02888', 'LA02889', 'LA02890', 'LA02891', 'LA02892', 'LA02900',
    'LA02901', 'LA02903', 'LA02904', 'LA02905', 'LA02906', 'LA02907', 'LA02908', 'LA02910', 'LA02911',
    'LA02920', 'LA02921', 'LA02930', 'LA02931', 'LA02941', 'LA02951', 'LA02961', 'LA02971', 'LA02981',
    'LA02991'"""
_DEFERRAL = ("5125030001", "5125010001", "5125050001")
_AMORTISATION = ("5131030001", "5131010001", "5131050001")
_GROUP_SQL = f"""case when substr(INS_IMCD, 1, 2) = 'CA' then '자동차'
    when substr(INS_IMCD, 1, 2) in ('FA', 'MA') then '일반'
    when INS_IMCD in ({_PENSION}) then '장기연금' when INS_IMCD in ('LA02801') then '장기우매당'
    when substr(INS_IMCD, 1, 2) = 'RA' then '퇴직' else '에러' end"""
_MAPPED = """select SLPDT as YYYYMM, NTACC_CD, BZCS_TPCD, RR_ORGCD, SL_TPCD, INS_IMCD,
    case when CVRCD = '*' then '0' else CVRCD end as DGB, DVAMT as S"""
_CHANNEL = "cast(l_linenumber % 4 + 1 as varchar) || cast(l_suppkey % 3 + 1 as varchar)"


def _booked(accounts, amount):
    direct, home, agent = accounts
    return f"""select {LINE_MONTH} as YYYYMM, case when ch in ('11', '21', '31', '42') then '{direct}'
        when ch = '41' then '{home}' when ch in ('12', '13', '22', '32') then '{agent}' end
        as NTACC_CD, {amount} as S from (select *, {_CHANNEL} as ch from lineitem) t
        where ch in ('11', '21', '31', '41', '42', '12', '13', '22', '32')"""


def _coverage_totals(month):
    return f"""select CVRCD, count(*) as CNT, {money_sql('PRM')} as TOTAL_PRM
        from ({COVERAGE_SQL}) t where CLS_YYMM = '{month}' group by CVRCD"""


def _change(key, value, now, before, how):
    if how == "left":
        return f"""select a.{key} as {key}, a.{value} as cur, b.{value} as prev,
            round(a.{value} - coalesce(b.{value}, 0), 2) as chg
            from ({now}) a left join ({before}) b on a.{key} = b.{key}"""
    return f"""select coalesce(a.{key}, b.{key}) as {key}, coalesce(a.{value}, 0) as cur,
        coalesce(b.{value}, 0) as prev,
        round(coalesce(a.{value}, 0) - coalesce(b.{value}, 0), 2) as chg
        from ({now}) a full outer join ({before}) b on a.{key} = b.{key}"""


def _amounts(month):
    return f"""select CVRCD, {money_sql('AMT')} as AMT from ({COVERAGE_SQL}) t
        where CLS_YYMM = '{month}' group by CVRCD"""


def _by_customer(month):
    return f"""select o_custkey as k, {money_sql('o_totalprice')} as s from orders
        where strftime(o_orderdate, '%Y%m') = '{month}' group by o_custkey"""


ORACLE = {
    "d1_premium_by_line": f"""select l_linestatus as INS_IMCD, {money_sql('l_extendedprice')} as RP_PRM,
        {money_sql('l_quantity')} as AF_PRM from lineitem group by l_linestatus""",
    "d2_held_premium_by_line": f"""select o_orderstatus as INS_IMCD,
        {money_sql('o_totalprice')} as AP_PRM from orders group by o_orderstatus""",
    "d3_held_premium_by_month": f"""select strftime(o_orderdate, '%Y%m') as CLS_YYMM,
        o_orderstatus as INS_IMCD, {money_sql('o_totalprice')} as AP_PRM,
        cast(count(*) as double) as BZCS_DV_PS from orders group by 1, 2""",
    "d4_agency_anomalies": """select distinct o_orderstatus as DH_ORGCD, o_orderpriority as DH_STFNO
        from orders where substr(o_orderpriority, 1, 2) in ('2-')
        and substr(o_orderstatus, 1, 1) not in ('F')""",
    "d5_income_against_held": """select k as INS_IMCD, cast(a as double) as val_a,
        cast(b as double) as val_b, cast(a - b as double) as diff from (
        select coalesce(a.k, b.k) as k, coalesce(a.s, 0) as a, coalesce(b.s, 0) as b
        from (select l_linestatus as k, sum(cast(l_extendedprice as decimal(28,4))) as s
        from lineitem group by 1) a full outer join (select o_orderstatus as k,
        sum(cast(o_totalprice as decimal(28,4))) as s from orders group by 1) b
        on a.k is not distinct from b.k) t where abs(a - b) > 1""",
    "d6_allocation_mapping": f"{_MAPPED} from ({MAINTENANCE_SQL}) t",
    "d7_stacked_allocations": f"{_MAPPED} from ({MAINTENANCE_SQL} union all {HANDLING_SQL}) t",
    "d8_allocation_totals": TOTALS_SQL,
    "d9_deferral_totals": f"""select YYYYMM, '일반관리비' as GB, NTACC_CD, 'LA' as BGB, '0' as CGB,
        {money_sql('S')} as S from ({_booked(_DEFERRAL, 'l_extendedprice * -1')}
        union all {_booked(_AMORTISATION, 'l_quantity')}) u group by YYYYMM, NTACC_CD""",
    "d10_net_expense": f"""select INS_IMCD, {_GROUP_SQL} as BGB, SL_TPCD,
        case when INS_IMCD = 'CA91001' then '1' when substr(INS_IMCD, 1, 2) = 'CA' then CVRCD
        else '0' end as CGB, {money_sql('S')} as S from ({TOTALS_SQL}) t
        where YYYYMM = '{MONTH}' and BZCS_TPCD <> '02' group by 1, 2, 3, 4""",
    "d10_business_group": f"""select INS_IMCD, {_GROUP_SQL} as BGB, {money_sql('DVAMT')} as S
        from ({MAINTENANCE_SQL}) t group by 1, 2""",
    "d11_expense_trend": f"""select YYYYMM, NTACC_CD, substr(INS_IMCD, 1, 2) as BGB, SL_TPCD,
        {money_sql('S')} as S from ({TOTALS_SQL}) t
        where substr(NTACC_CD, 1, 4) in ('5121', '5127', '5128', '5129') group by 1, 2, 3, 4""",
    "d12_ledger_gaps": f"""select NTACC_CD, cast(sum(s) as double) as diff from (
        select NTACC_CD, cast(WONCR_POAMT as decimal(28,4)) as s from ({VOUCHERS_SQL}) v
        union all select NTACC_CD, -cast(S as decimal(28,4)) as s from ({TOTALS_SQL}) t) u
        group by NTACC_CD having abs(sum(s)) > 1""",
    "d12_ledger_gap_count": """select count(*) as gaps from (select k, sum(s) as diff from (
        select o_orderkey as k, cast(o_totalprice as decimal(18,2)) as s from orders
        union all select l_orderkey as k, -cast(l_extendedprice as decimal(18,2)) as s
        from lineitem) u group by k having abs(sum(s)) > 1) v""",
    "d13_missing_coverage": """select count(*) as missing from (select c_mktsegment,
        case when c_acctbal < 0 then null else c_nationkey end as cd from customer) t
        where c_mktsegment = 'BUILDING' and cd is null""",
    "d14_unallocated_phone_sales": f"""select count(*) as n from ({TOTALS_SQL}) t
        where substr(INS_IMCD, 1, 2) = 'CA' and SL_TPCD = '21' and NTACC_CD in (
        select distinct NTACC_CD from ({VOUCHERS_SQL}) v where substr(BZCS_02_DVCD, 1, 1) = 'E')""",
    "d15_reclosed_amount": f"""select coalesce({money_sql('S')}, 0) as S from ({TOTALS_SQL}) t
        where substr(INS_IMCD, 1, 2) = 'CA' and SL_TPCD = '14' and NTACC_CD in (
        select distinct NTACC_CD from ({VOUCHERS_SQL}) v where substr(BZCS_02_DVCD, 1, 1) = 'E'
        and BZCS_02_DVCD not in ('E07', 'E08', 'E09', 'E10', 'E11', 'E12', 'E13'))""",
    "d16_coverage_totals": _coverage_totals(MONTH),
    "d17_coverage_change": _change(
        "CVRCD", "TOTAL_PRM", _coverage_totals(MONTH), _coverage_totals(BEFORE), "full"
    ),
    "d18_amount_change": _change("CVRCD", "AMT", _amounts(MONTH), _amounts(BEFORE), "left"),
    "d19_largest_premiums": f"""select PLYNO, CVRCD, PRM from ({COVERAGE_SQL}) t
        where CLS_YYMM = '{MONTH}' order by PRM desc, PLYNO, CVRCD limit 1000""",
    "d20_sample_count": "select event_type as COL1, count(*) as CNT from events group by event_type",
    "j2_left_month_change": _change("k", "s", _by_customer(MONTH), _by_customer(BEFORE), "left"),
}
