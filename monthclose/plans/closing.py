"""Closing job: checks over vouchers and closing extracts."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.functions.casts import total
from monthclose.operators.checks import Checks
from monthclose.operators.compare import totals_where_key_in
from monthclose.plans.extracts import BS101, BS104, BS105, ERP
from monthclose.plans.job import Job

log = logging.getLogger("monthclose")

# Kinds of expense, and the direct ones that are not closed again.
DIRECT_EXPENSE = "E"
NOT_RECLOSED = ("E07", "E08", "E09", "E10", "E11", "E12", "E13")
CAR_LINES, LONG_TERM = "CA", "LA"
PHONE_CHANNEL, RECLOSED_CHANNEL = "21", "14"


def missing_coverage(claims: DataFrame, coverage: str, group: str = LONG_TERM) -> DataFrame:
    """How many rows of an insurance kind lack their coverage code."""
    lost = (F.col("IKD_GRPCD") == group) & F.col(coverage).isNull()
    return claims.where(lost).select().groupBy().agg(F.count(F.lit(1)).alias("missing"))


def direct_accounts(vouchers: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """Accounts that carry direct expense."""
    kind = F.col("BZCS_02_DVCD")
    rows = vouchers.where(F.substring(kind, 1, 1) == DIRECT_EXPENSE)
    if without:
        rows = rows.where(~kind.isin(*without))
    return rows.select("NTACC_CD")


def car_rows(totals: DataFrame, channel: str) -> DataFrame:
    return totals.where(
        (F.substring("INS_IMCD", 1, 2) == CAR_LINES) & (F.col("SL_TPCD") == channel)
    )


def unallocated_phone_sales(totals: DataFrame, vouchers: DataFrame) -> DataFrame:
    """Car allocation rows of the phone channel on accounts with direct expense."""
    return totals_where_key_in(
        car_rows(totals, PHONE_CHANNEL), "NTACC_CD", direct_accounts(vouchers),
        {"n": F.count(F.lit(1))},
    ).select(F.coalesce("n", F.lit(0)).alias("n"))


def reclosed_amount(totals: DataFrame, vouchers: DataFrame) -> DataFrame:
    """Amount of car rows of the re-closed channel on such accounts; 0 if there is none."""
    amount = totals_where_key_in(
        car_rows(totals, RECLOSED_CHANNEL), "NTACC_CD", direct_accounts(vouchers, NOT_RECLOSED),
        {"S": total(F.col("S"))},
    )
    return amount.select(F.coalesce("S", F.lit(0)).alias("S"))


def validate(checks: Checks, params: dict[str, str]) -> None:
    store = checks.store
    for table in ("erp", "bs101", "bs104", "bs105"):
        checks.row_count(table)
    for table, coverage in (("bs104", "CVRCD"), ("bs105", "CLM_CVRCD")):
        if checks.require(table):
            checks.check(f"{table} IBNR 담보코드", missing_coverage(store.table(table), coverage))
    totals = f"sa_{params['SDM']}"
    if checks.require(totals, "erp"):
        allocated, vouchers = store.table(totals), store.table("erp")
        checks.check("자동차 TM/CM 비비례 배분", unallocated_phone_sales(allocated, vouchers))
        log.info("re-closed amount: %s", reclosed_amount(allocated, vouchers).head()["S"])


JOB = Job(
    name="closing",
    desc="closing checks",
    tables={"erp": ERP, "bs101": BS101, "bs104": BS104, "bs105": BS105},
    validate=validate,
    sheets={
        "erp": "ERP_BS100",
        "bs101": "BS101_원수실적",
        "bs104": "BS104_지급보험금",
        "bs105": "BS105_지급준비금",
    },
)
