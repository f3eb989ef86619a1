"""Shared pieces of the registered queries: tables, extract files made from them, and shapes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.functions.months import in_months, month_of
from monthclose.operators.store import MonthStore
from monthclose.sources.encoding import charset_settings, encoded
from monthclose.sources.files import work_dir

MONTH, BEFORE = "199803", "199802"


# Declared, so that no job has to open files for a schema before a query can be planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def new_store(spark: SparkSession, label: str, month: str = MONTH) -> MonthStore:
    """A store of its own for one query."""
    return MonthStore(spark, work_dir(spark, label), month, name=f"q{uuid.uuid4().hex[:12]}")


def text(c: Column) -> Column:
    return c.cast("string")


def joined(delimiter: str, *columns: Column) -> Column:
    """A delimited line; NULL becomes an empty field."""
    return F.concat_ws(delimiter, *[F.coalesce(text(c), F.lit("")) for c in columns])


def write_lines(
    df: DataFrame, value: Column, path: str, encoding: str = "utf-8", compression: str = "none", file_rows: int = 0
) -> str:
    """Write one text line per row, in an encoding; ``file_rows`` is the most that a file of the folder holds (0: no limit)."""
    with charset_settings(df.sparkSession):
        raw = df.select(encoded(value, encoding).cast("string").alias("value"))
    raw.write.option("compression", compression).option("maxRecordsPerFile", file_rows).text(path)
    return path


# Shapes: the given tables under the column names of the extracts.


def income_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        month_of(F.col("l_shipdate")).alias("CLS_YYMM"),
        F.col("l_linestatus").alias("INS_IMCD"),
        F.col("l_extendedprice").alias("RP_PRM"),
        F.col("l_quantity").alias("AF_PRM"),
    )


def held_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        month_of(F.col("o_orderdate")).alias("CLS_YYMM"),
        F.col("o_orderstatus").alias("INS_IMCD"),
        F.col("o_totalprice").alias("AP_PRM"),
        F.lit(1.0).alias("BZCS_DV_PS"),
        F.col("o_orderstatus").alias("DH_ORGCD"),
        F.col("o_orderpriority").alias("DH_STFNO"),
    )


def _line_code(quantity: Column, key: Column) -> Column:
    return (
        F.when(quantity < 5, "CA91001")
        .when(quantity < 10, "CA00002")
        .when(quantity < 15, "MA00001")
        .when(quantity < 20, "RA00001")
        .otherwise(F.concat(F.lit("LA02"), text(key % 340 + 660)))
    )


LINE_CODE_SQL = (
    "case when l_quantity < 5 then 'CA91001' when l_quantity < 10 then 'CA00002' "
    "when l_quantity < 15 then 'MA00001' when l_quantity < 20 then 'RA00001' "
    "else 'LA02' || cast(l_partkey % 340 + 660 as varchar) end"
)


def maintenance_rows(spark: SparkSession, sf: str, month: str | None = None) -> DataFrame:
    """Line items as allocated maintenance expense, of one month if it is given."""
    flag = F.col("l_returnflag")
    lines = table(spark, sf, "lineitem")
    if month:
        lines = lines.where(in_months(F.col("l_shipdate"), month, month))
    return lines.select(
        month_of(F.col("l_shipdate")).alias("SLPDT"),
        F.concat(F.lit("512"), text(F.col("l_linenumber")), F.lit("030001")).alias("NTACC_CD"),
        F.when(flag == "A", "01").when(flag == "N", "02").otherwise("03").alias("BZCS_TPCD"),
        F.lit("R1").alias("RR_ORGCD"),
        F.when(F.col("l_linestatus") == "O", "21").otherwise("14").alias("SL_TPCD"),
        _line_code(F.col("l_quantity"), F.col("l_partkey")).alias("INS_IMCD"),
        F.when(F.col("l_discount") > 0.05, "*").otherwise(flag).alias("CVRCD"),
        F.col("l_extendedprice").alias("DVAMT"),
    )


MAINTENANCE_SQL = f"""select strftime(l_shipdate, '%Y%m') as SLPDT,
    '512' || cast(l_linenumber as varchar) || '030001' as NTACC_CD,
    case l_returnflag when 'A' then '01' when 'N' then '02' else '03' end as BZCS_TPCD,
    'R1' as RR_ORGCD, case when l_linestatus = 'O' then '21' else '14' end as SL_TPCD,
    {LINE_CODE_SQL} as INS_IMCD,
    case when l_discount > 0.05 then '*' else l_returnflag end as CVRCD,
    l_extendedprice as DVAMT from lineitem"""


def handling_rows(spark: SparkSession, sf: str, month: str | None = None) -> DataFrame:
    """Orders as allocated claim handling expense, of one month if it is given."""
    orders = table(spark, sf, "orders")
    if month:
        orders = orders.where(in_months(F.col("o_orderdate"), month, month))
    return orders.select(
        month_of(F.col("o_orderdate")).alias("SLPDT"),
        F.concat(F.lit("512"), F.substring("o_orderpriority", 1, 1), F.lit("030001")).alias(
            "NTACC_CD"
        ),
        F.lit("01").alias("BZCS_TPCD"),
        F.lit("R1").alias("RR_ORGCD"),
        F.lit("21").alias("SL_TPCD"),
        F.when(F.col("o_orderstatus") == "P", "CA00002").otherwise("FA00001").alias("INS_IMCD"),
        F.when(F.col("o_orderstatus") == "F", "*").otherwise(F.col("o_orderstatus")).alias("CVRCD"),
        F.col("o_totalprice").alias("DVAMT"),
    )


HANDLING_SQL = """select strftime(o_orderdate, '%Y%m') as SLPDT,
    '512' || substr(o_orderpriority, 1, 1) || '030001' as NTACC_CD, '01' as BZCS_TPCD,
    'R1' as RR_ORGCD, '21' as SL_TPCD,
    case when o_orderstatus = 'P' then 'CA00002' else 'FA00001' end as INS_IMCD,
    case when o_orderstatus = 'F' then '*' else o_orderstatus end as CVRCD,
    o_totalprice as DVAMT from orders"""

# Allocation totals as SQL, for the queries built on them.
TOTALS_SQL = f"""select SLPDT as YYYYMM, NTACC_CD, RR_ORGCD, BZCS_TPCD, SL_TPCD, INS_IMCD,
    case when CVRCD = '*' then '0' else CVRCD end as CVRCD,
    cast(sum(cast(DVAMT as decimal(28,4))) as double) as S
    from ({MAINTENANCE_SQL} union all {HANDLING_SQL}) t group by 1, 2, 3, 4, 5, 6, 7"""


def voucher_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as vouchers, with a kind of expense that holds direct ones."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("512"), F.substring("o_orderpriority", 1, 1), F.lit("030001")).alias(
            "NTACC_CD"
        ),
        F.when(F.col("o_orderpriority").startswith("1"), "E01")
        .when(F.col("o_orderpriority").startswith("2"), "E07")
        .otherwise("A01")
        .alias("BZCS_02_DVCD"),
        F.col("o_totalprice").alias("WONCR_POAMT"),
    )


VOUCHERS_SQL = """select '512' || substr(o_orderpriority, 1, 1) || '030001' as NTACC_CD,
    case substr(o_orderpriority, 1, 1) when '1' then 'E01' when '2' then 'E07' else 'A01' end
    as BZCS_02_DVCD, o_totalprice as WONCR_POAMT from orders"""


def coverage_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items of this month and the one before as premium by coverage."""
    lines = table(spark, sf, "lineitem").where(in_months(F.col("l_shipdate"), BEFORE, MONTH))
    return lines.select(
        month_of(F.col("l_shipdate")).alias("CLS_YYMM"),
        text(F.col("l_orderkey")).alias("PLYNO"),
        text(F.col("l_suppkey")).alias("CVRCD"),
        F.col("l_extendedprice").alias("PRM"),
        F.col("l_quantity").alias("AMT"),
    )


COVERAGE_SQL = """select strftime(l_shipdate, '%Y%m') as CLS_YYMM,
    cast(l_orderkey as varchar) as PLYNO, cast(l_suppkey as varchar) as CVRCD,
    l_extendedprice as PRM, l_quantity as AMT from lineitem"""


def cents(df: DataFrame) -> DataFrame:
    """Amounts of a result to the two places of the given tables, past which a sum depends on its order."""
    return df.select(*[
        F.round(F.col(f"`{name}`"), 2).alias(name) if dtype == "double" else F.col(f"`{name}`")
        for name, dtype in df.dtypes
    ])


def money_sql(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(28,4))) as double)"


def fixed_line(layout, values: dict[str, Column]) -> Column:
    """A fixed-width ASCII line: each value padded to its field, blanks in between."""
    pieces, at = [], 0
    for (start, end), name in layout:
        if start > at:
            pieces.append(F.lit(" " * (start - at)))
        value = text(values[name]) if name in values else F.lit("")
        pieces.append(F.rpad(value, end - start, " "))
        at = end
    return F.concat(*pieces)
