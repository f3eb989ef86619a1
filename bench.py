"""Headline queries and read stages: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the cores. Each query is built and
run once to warm up, then three times; its median counts, and the first run is reported as cold. The extract
files for the read stages are written once, before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.bindings import checks, domain, relational, sources
from monthclose.bindings.common import MONTH, fixed_line, joined, table, write_lines
from monthclose.functions.months import month_of
from monthclose.operators.stages import read_stages
from monthclose.operators.store import MonthStore
from monthclose.plans.extracts import FIO843
from monthclose.sources.files import work_dir
from monthclose.sources.layouts import table_spec
from monthclose.sources.scan import scan

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = {
    "d1_premium_by_line": domain.d1_premium_by_line,
    "d3_held_premium_by_month": domain.d3_held_premium_by_month,
    "d8_allocation_totals": domain.d8_allocation_totals,
    "d9_deferral_totals": domain.d9_deferral_totals,
    "d10_net_expense": domain.d10_net_expense,
    "d12_ledger_gap_count": domain.d12_ledger_gap_count,
    "d14_unallocated_phone_sales": domain.d14_unallocated_phone_sales,
    "d16_coverage_totals": domain.d16_coverage_totals,
    "d17_coverage_change": domain.d17_coverage_change,
    "j5_semi_join_total": relational.j5_semi_join_total,
    "v3_check_diff": checks.v3_check_diff,
    "v3_two_keys": checks.v3_two_keys,
    "v6_duplicate_keys": checks.v6_duplicate_keys,
    "s9_typed": sources.s9_typed,
    "s6_quoted_fields": sources.s6_quoted_fields,
}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.monotonic()
    action()
    return time.monotonic() - started


def extracts(spark: SparkSession) -> dict[str, object]:
    """Actions over extract files that are written here, ahead of the measurement."""
    folder = work_dir(spark, "bench")
    lines = table(spark, SF, "lineitem").repartition(int(CPUS))
    write_lines(
        lines, joined("|", *[F.col(c) for c in lines.columns]), f"{folder}/lineitem.dat"
    )
    values = {
        "CLS_YYMM": F.lit(MONTH), "PLYNO": F.col("l_orderkey"), "INS_IMCD": F.col("l_returnflag"),
        "AP_PRM": F.col("l_extendedprice"), "BZCS_DV_PS": F.lit(1),
    }
    name = FIO843["file"].format(yyyymm=MONTH)
    write_lines(lines, fixed_line(FIO843["cols"], values), f"{folder}/{name}")
    status = F.when(F.col("l_returnflag") == "A", "완료").otherwise("진행중")
    korean = joined("|", month_of(F.col("l_shipdate")), status, F.col("l_extendedprice"))
    write_lines(lines, korean, f"{folder}/korean.dat", "cp949")

    actions = {
        f"b1_{stage}": (lambda df=df: run(df))
        for stage, df in read_stages(spark, [f"{folder}/lineitem.dat"], columns=7).items()
    }

    def scanned(kind, file, **settings):
        spec = table_spec("t", {"type": kind, "file": file, "month_col": None, **settings})
        return lambda: run(scan(spark, spec, folder, MONTH).plain_rows())

    fixed = {k: FIO843[k] for k in ("cols", "numeric")}
    actions["s1_fwf_bytes"] = scanned("fwf", name, **fixed)
    actions["s2_fwf_chars"] = scanned("fwf", name, native=True, encoding="utf-8", **fixed)
    actions["s3_pipe_cp949"] = scanned(
        "pipe", "korean.dat", cols=["ym", "s", "n"], numeric=["n"], encoding="cp949"
    )
    actions["s11_pipe_unknown_encoding"] = scanned(
        "pipe", "korean.dat", cols=["ym", "s", "n"], numeric=["n"]
    )
    store = MonthStore(spark, folder + "/store", MONTH, f"bench{os.getpid()}")
    spec = table_spec("fio843", FIO843)

    def month_load():
        store.load_month("fio843", scan(spark, spec, folder, MONTH).plain_rows(), "CLS_YYMM")

    actions["m2_month_load"] = month_load
    return actions


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("monthclose-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Not noting the call site of every column expression makes building a query much cheaper.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    actions = {n: (lambda q=q: run(q(spark, SF))) for n, q in HEADLINE.items()} | extracts(spark)
    cold, warm = {}, {}
    for name, action in actions.items():
        cold[name] = round(timed(action), 3)
        warm[name] = round(statistics.median(timed(action) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total of median warm query times",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(SF.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
