"""Premium job: totals by insurance line, and reconciliation of income with contracts held."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.functions.casts import total
from monthclose.operators.checks import Checks
from monthclose.operators.store import MonthStore
from monthclose.plans.extracts import FIO841, FIO843
from monthclose.plans.job import Job


def premium_by_line(income: DataFrame) -> DataFrame:
    """Received and afterwards due premium by insurance line."""
    return income.groupBy("INS_IMCD").agg(
        total(F.col("RP_PRM")).alias("RP_PRM"), total(F.col("AF_PRM")).alias("AF_PRM")
    )


def held_premium_by_line(held: DataFrame) -> DataFrame:
    return held.groupBy("INS_IMCD").agg(total(F.col("AP_PRM")).alias("AP_PRM"))


def held_premium_by_month(held: DataFrame) -> DataFrame:
    """Premium and contract counts by closing month and line."""
    return held.groupBy("CLS_YYMM", "INS_IMCD").agg(
        total(F.col("AP_PRM")).alias("AP_PRM"), total(F.col("BZCS_DV_PS")).alias("BZCS_DV_PS")
    )


def agency_anomalies(
    held: DataFrame, staff: tuple[str, ...] = ("2S",), agencies: tuple[str, ...] = ("E",)
) -> DataFrame:
    """Agency and staff pairs in which such staff belongs to another kind of agency."""
    return (
        held.where(F.substring("DH_STFNO", 1, 2).isin(*staff))
        .where(~F.substring("DH_ORGCD", 1, 1).isin(*agencies))
        .select("DH_ORGCD", "DH_STFNO")
        .distinct()
    )


def logic(store: MonthStore, params: dict[str, str]) -> None:
    store.replace("BASE_DATA_CH", premium_by_line(store.table("fio841")))
    held = store.table("fio843")
    store.replace("BASE_DATA_CH_843", held_premium_by_line(held))
    store.replace("BASE_DATA_CH2", held_premium_by_month(held))
    store.replace("CH", agency_anomalies(held))


def validate(checks: Checks, params: dict[str, str]) -> None:
    for table in ("fio841", "fio843", "BASE_DATA_CH", "BASE_DATA_CH_843", "BASE_DATA_CH2"):
        checks.row_count(table)
    checks.check("취급기관 이상", "SELECT COUNT(*) FROM CH")
    if checks.require("fio841", "fio843"):
        income, held = checks.store.table("fio841"), checks.store.table("fio843")
        checks.check_diff(
            "fio841 vs fio843 보험료",
            income.select("INS_IMCD", F.col("RP_PRM").alias("AMT")),
            held.select("INS_IMCD", F.col("AP_PRM").alias("AMT")),
            keys=["INS_IMCD"],
            value="AMT",
        )


JOB = Job(
    name="premium",
    desc="premium totals",
    tables={"fio841": FIO841, "fio843": FIO843},
    logic=logic,
    validate=validate,
    sheets={
        "fio841": "fio841",
        "fio843": "fio843",
        "BASE_DATA_CH": "집계_841보험료",
        "BASE_DATA_CH_843": "집계_843보험료",
        "BASE_DATA_CH2": "집계_843건수",
        "CH": "취급기관이상체크",
    },
)
