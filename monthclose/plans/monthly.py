"""Month comparison job: coverage totals of a month, and their change since the month before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.functions.casts import total
from monthclose.operators.checks import Checks
from monthclose.operators.compare import month_change
from monthclose.operators.store import MonthStore
from monthclose.plans.extracts import DAMBO
from monthclose.plans.job import Job

TOP_ROWS = 1000


def coverage_totals(coverages: DataFrame, month: str) -> DataFrame:
    return (
        coverages.where(F.col("CLS_YYMM") == month)
        .groupBy("CVRCD")
        .agg(F.count(F.lit(1)).alias("CNT"), total(F.col("PRM")).alias("TOTAL_PRM"))
    )


def coverage_change(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Change of the coverage totals; a coverage of either month alone is kept."""
    return month_change(current, previous, "CVRCD", "TOTAL_PRM")


def amount_change(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Amount by coverage this month and last. Coverage codes repeat, so both sides are added up."""
    def by_coverage(rows: DataFrame) -> DataFrame:
        return rows.groupBy("CVRCD").agg(total(F.col("AMT")).alias("AMT"))

    return month_change(by_coverage(current), by_coverage(previous), "CVRCD", "AMT", how="left")


def change_within(
    coverages: DataFrame, month: str, before: str, value: str, how: str = "full"
) -> DataFrame:
    """``coverage_change`` or, with ``how="left"``, ``amount_change`` of two months of one table, in one pass.

    A row without a coverage code matches nothing, so its months stay apart.
    """
    key, ym = F.col("CVRCD"), F.col("CLS_YYMM")
    now, before_now = F.col("cur"), F.coalesce("prev", F.lit(0))
    sums = (
        coverages.where(ym.isin(month, before))
        .groupBy("CVRCD", F.when(key.isNull(), ym).alias("_alone"))
        .agg(
            total(F.when(ym == month, F.col(value))).alias("cur"),
            total(F.when(ym == before, F.col(value))).alias("prev"),
            F.count_if(ym == month).alias("_now"),
        )
    )
    if how == "left":
        return sums.where("_now > 0").select("CVRCD", now, "prev", (now - before_now).alias("chg"))
    now = F.coalesce("cur", F.lit(0))
    return sums.select(
        "CVRCD", now.alias("cur"), before_now.alias("prev"), (now - before_now).alias("chg")
    )


def largest_premiums(coverages: DataFrame, month: str, rows: int = TOP_ROWS) -> DataFrame:
    """The report of the largest premiums of a month."""
    return (
        coverages.where(F.col("CLS_YYMM") == month)
        .select("PLYNO", "CVRCD", "PRM")
        .orderBy(F.col("PRM").desc(), "PLYNO", "CVRCD")
        .limit(rows)
    )


def logic(store: MonthStore, params: dict[str, str]) -> None:
    month, before = params["SDM"], params["LM"]
    coverages = store.table(f"dambo{month}")
    store.replace(f"agg_{month}", coverage_totals(coverages, month))
    earlier = _earlier(store, f"agg_{before}")
    if earlier is not None:
        store.replace(f"compare_{month}", coverage_change(store.table(f"agg_{month}"), earlier))
    earlier = _earlier(store, f"dambo{before}")
    if earlier is not None:
        store.replace("monthly_compare", amount_change(coverages, earlier))


def _earlier(store: MonthStore, table: str) -> DataFrame | None:
    """A table of the month before, from this store or the attached one."""
    if store.exists(table):
        return store.table(table)
    attached = f"`{store.aliases.get('LM', store.db)}`.`{table}`"
    return store.spark.table(attached) if store.spark.catalog.tableExists(attached) else None


def validate(checks: Checks, params: dict[str, str]) -> None:
    month = params["SDM"]
    checks.row_count(f"dambo{month}")
    checks.row_count(f"agg_{month}")
    if checks.require(f"compare_{month}"):
        checks.row_count(f"compare_{month}")
        checks.check_sum(
            "당월 보험료 합계",
            f"SELECT SUM(cur) AS cur, SUM(prev) AS prev, SUM(chg) AS chg FROM compare_{month}",
        )


JOB = Job(
    name="monthly",
    desc="comparison of months",
    tables={"dambo{yyyymm}": DAMBO},
    logic=logic,
    validate=validate,
    sheets={
        "dambo{yyyymm}": [
            "담보별원본",
            {
                "sheet": "당월필터",
                "columns": ["PLYNO", "CVRCD", "PRM"],
                "where": "CLS_YYMM = '${SDM}'",
                "order_by": "PRM DESC, PLYNO, CVRCD",
                "limit": TOP_ROWS,
            },
        ],
        "monthly_compare": "당월전월비교",
    },
)
