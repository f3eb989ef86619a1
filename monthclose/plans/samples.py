"""Sample job: how often each value of the first column occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.operators.checks import Checks
from monthclose.operators.store import MonthStore
from monthclose.plans.extracts import BT930, BT930_ALL
from monthclose.plans.job import Job


def count_by(rows: DataFrame, column: str = "COL1") -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("CNT"))


def logic(store: MonthStore, params: dict[str, str]) -> None:
    store.replace("sample_agg", count_by(store.table("bt930_020")))


def validate(checks: Checks, params: dict[str, str]) -> None:
    checks.check("sample_agg", "SELECT COUNT(*) FROM sample_agg", expect="nonzero")


JOB = Job(
    name="samples",
    desc="coverage samples",
    tables={"bt930_020": BT930, "bt930_020_all": BT930_ALL},
    logic=logic,
    validate=validate,
)
