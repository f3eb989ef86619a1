import gzip
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from monthclose.bindings import tables
from monthclose.bindings.common import SCHEMAS
from monthclose.operators.store import MonthStore
from monthclose.plans import allocation, closing, monthly, premium, samples
from monthclose.plans.job import Job, run_job, run_jobs
from monthclose.sources.delimited import BAD, parse_strict
from monthclose.streaming.arrivals import load_arrivals


def pipe(spec, **values):
    """A line of an extract with some of its columns filled."""
    return "|".join(str(values.get(c, "")) for c in spec["cols"]) + "\n"


def fixed(spec, **values):
    line = bytearray(b" " * max(end for (_, end), _ in spec["cols"]))
    for (start, end), name in spec["cols"]:
        line[start:end] = str(values.get(name, "")).rjust(end - start)[: end - start].encode()
    return bytes(line) + b"\n"


def test_premium_job(store, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    income = [("CA1", 100), ("CA1", 50), ("FA1", 7)]
    held = [("CA1", 149.5, "E1", "2S01"), ("MA1", 3, "A1", "2S02"), ("FA1", 7, "A1", "1X")]
    (folder / "fioBtLtrJ841_01_202601.DAT").write_bytes(b"".join(
        fixed(premium.FIO841, CLS_YYMM="202601", INS_IMCD=i, RP_PRM=p, AF_PRM=1) for i, p in income
    ))
    (folder / "fioBtLtrJ843_01_202601.DAT").write_bytes(b"".join(
        fixed(premium.FIO843, CLS_YYMM="202601", INS_IMCD=i, AP_PRM=p, DH_ORGCD=o, DH_STFNO=s,
              BZCS_DV_PS=1)
        for i, p, o, s in held
    ))
    report = run_job(store, premium.JOB, str(folder), str(tmp_path / "out"))
    assert report.errors == {} and report.load.loaded == ["fio841", "fio843"]
    assert rows(store.table("BASE_DATA_CH")) == [("CA1", 150.0, 2.0), ("FA1", 7.0, 1.0)]
    assert rows(store.table("CH")) == [("A1", "2S02")]
    noted = {c[0]: c[2:] for c in report.checks}
    assert noted["취급기관 이상"] == ("1", "NG")
    # 150 and 149.5 are close enough; the line of one side alone is not.
    assert noted["fio841 vs fio843 보험료"] == ("1", "NG")
    assert report.export_path.endswith("premium_202601_v0.01")
    assert report.summary.where("no is null").head()["rows"] == 15


def test_allocation_and_closing_jobs(spark, store, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sa01 = [
        dict(SLPDT="202601", NTACC_CD="5121000001", BZCS_TPCD="01", SL_TPCD="21", INS_IMCD="CA91001",
             CVRCD="*", DVAMT=10),
        dict(SLPDT="202601", NTACC_CD="5121000001", BZCS_TPCD="01", SL_TPCD="21", INS_IMCD="CA91001",
             CVRCD="0", DVAMT=5),
        dict(SLPDT="202601", NTACC_CD="5133000001", BZCS_TPCD="02", SL_TPCD="14", INS_IMCD="CA1",
             CVRCD="7", DVAMT=4),
        dict(SLPDT="202601", NTACC_CD="5127000001", BZCS_TPCD="01", SL_TPCD="11", INS_IMCD="LA02801",
             CVRCD="", DVAMT=1),
    ]
    sa02 = [dict(SLPDT="202601", NTACC_CD="5133000001", BZCS_TPCD="03", SL_TPCD="14", INS_IMCD="CA1",
                 CVRCD="7", DVAMT=6)]
    erp = [
        dict(SLPDT="20260131", NTACC_CD="5121000001", BZCS_02_DVCD="E01", WONCR_POAMT=15.5),
        dict(SLPDT="20260131", NTACC_CD="5133000001", BZCS_02_DVCD="E07", WONCR_POAMT=100),
        dict(SLPDT="20260131", NTACC_CD="5127000001", BZCS_02_DVCD="A01", WONCR_POAMT=1),
    ]
    bs = [dict(CLS_YYMM="202601", IKD_GRPCD="LA", CVRCD=""), dict(CLS_YYMM="202601", IKD_GRPCD="CA")]
    for name, spec, lines in (
        ("RS100", allocation.SA01, sa01), ("RS101", allocation.SA02, sa02), ("BS100", closing.ERP, erp),
        ("BS104", closing.BS104, bs), ("BS101", closing.BS101, bs),
    ):
        (folder / f"{name}_202601.dat").write_text("".join(pipe(spec, **v) for v in lines))
    store.replace("ey_a2601", spark.createDataFrame(
        [("11", "202601", 100.0, 10.0), ("41", "202601", 1.0, 2.0), ("99", "202601", 9.0, 9.0)],
        "SL_TPCD string, CLS_YYMM string, RL_CREW_NWCRT double, RL_NWCRT_DPCS double",
    ))
    run_job(store, closing.JOB, str(folder), str(tmp_path / "out"), stages=["load"])
    report = run_job(store, allocation.JOB, str(folder), str(tmp_path / "out"))
    assert report.errors == {}
    assert rows(store.table("out_SA000")) == [
        ("CA1", "자동차", "14", "7", 6.0), ("CA91001", "자동차", "21", "1", 15.0),
        ("LA02801", "장기우매당", "11", "0", 1.0),
    ]
    assert rows(store.table("out_SA001").select("NTACC_CD", "BGB", "S")) == [
        ("5121000001", "CA", 15.0), ("5127000001", "LA", 1.0),
    ]
    assert rows(store.table("TEMP01").select("NTACC_CD", "S")) == [
        ("5125010001", -1.0), ("5125030001", -100.0), ("5131010001", 2.0), ("5131030001", 10.0),
    ]
    noted = {c[0]: c[2:] for c in report.checks}
    assert noted["전표 vs 배분결과"] == ("1", "NG")
    sheets = {r["sheet"] for r in report.summary.collect()}
    assert {"SA01_유지비배분", "sa000", "sa001"} <= sheets

    report = run_job(store, closing.JOB, str(folder), str(tmp_path / "out"), skip_load=True)
    noted = {c[0]: c[2:] for c in report.checks}
    assert report.load is None and noted["bs105"] == ("no table", "SKIP")
    assert noted["bs104 IBNR 담보코드"] == ("1", "NG")
    assert noted["자동차 TM/CM 비비례 배분"] == ("1", "NG")
    totals, vouchers = store.table("sa_202601"), store.table("erp")
    # The only account of the re-closed channel carries a kind of expense that is not closed again.
    assert closing.reclosed_amount(totals, vouchers).head()["S"] == 0
    more = vouchers.withColumn("BZCS_02_DVCD", F.lit("E01"))
    assert closing.reclosed_amount(totals, more).head()["S"] == 10


def test_business_groups(spark):
    codes = ["CA1", "FA1", "MA1", "RA1", "LA02660", "LA02801", "LA02991", "LA02999", "X", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r[0] for r in df.select(allocation.business_group(F.col("c"))).collect()]
    assert got == ["자동차", "일반", "일반", "퇴직", "장기연금", "장기우매당", "장기연금", "에러", "에러", "에러"]
    assert len(allocation.PENSION_CODES) == len(set(allocation.PENSION_CODES)) == 109


def _coverages(folder, month, lines):
    folder.mkdir(parents=True)
    with gzip.open(folder / f"btLtrJ930_020_{month}31_x.dat.gz", "wt") as f:
        f.writelines(f"{month}|p{i}|{c}|{p}|{p}|{i}\n" for i, (c, p) in enumerate(lines))


def test_months_with_attached_month(spark, store, rows, tmp_path):
    _coverages(tmp_path / "in" / "202512", "202512", [("a", 1), ("a", 2), ("b", 5)])
    _coverages(tmp_path / "in" / "202601", "202601", [("a", 4), ("c", 1)])
    before = MonthStore(spark, store.root, "202512", store.name)
    reports = run_jobs(
        [before, store], [monthly.JOB], str(tmp_path / "in"), str(tmp_path / "out"),
        attach={"LM": "${LM}"},
    )
    assert {r: bool(x.errors) for r, x in reports.items()} == {
        ("202512", "monthly"): False, ("202601", "monthly"): False,
    }
    assert not before.exists("compare_202512")
    assert rows(store.table("compare_202601")) == [
        ("a", 4.0, 3.0, 1.0), ("b", 0.0, 5.0, -5.0), ("c", 1.0, 0.0, 1.0),
    ]
    assert rows(store.table("monthly_compare")) == [("a", 4.0, 3.0, 1.0), ("c", 1.0, None, 1.0)]
    noted = {c[0]: c[2] for c in reports[("202601", "monthly")].checks}
    assert noted["당월 보험료 합계"] == "{'cur': '5.0', 'prev': '8.0', 'chg': '-3.0'}"


def test_stage_failures_do_not_stop_a_job(store, tmp_path):
    done = []

    def fail(*args):
        raise ValueError("no")

    job = Job("j", params=lambda month: {"FY": month[:4] + "01"}, prejob=fail, logic=fail,
              validate=lambda checks, params: done.append(params["FY"]))
    report = run_job(store, job, str(tmp_path), str(tmp_path / "out"))
    assert list(report.errors) == ["prejob", "logic"] and done == ["202601"]
    report = run_job(store, job, str(tmp_path), str(tmp_path / "out"), stages=["validate"])
    assert report.errors == {}


def test_sample_job_counts(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "COL1 string")
    assert rows(samples.count_by(df)) == [(None, 1), ("a", 2)]


def test_arrivals_are_loaded_once(spark, store, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def parse(lines):
        return parse_strict(lines, ["ym", "k"])

    def arrive():
        load_arrivals(
            store, "t", str(folder), "*.dat", parse, "ym", str(tmp_path / "checkpoint")
        ).awaitTermination()

    (folder / "a.dat").write_text("202601|a\n202601|b\n")
    (folder / "skip.tmp").write_text("202601|zzz\n")
    arrive()
    (folder / "b.dat").write_text("202602|c\n")
    arrive()
    arrive()
    assert rows(store.table("t")) == [("202601", "a"), ("202601", "b"), ("202602", "c")]
    (folder / "c.dat").write_text("202601|a2\n|none\n")
    arrive()
    kept = [(None, "none"), ("202601", "a"), ("202601", "a2"), ("202601", "b"), ("202602", "c")]
    assert rows(store.table("t")) == kept
    # A stream that starts anew reads the same files and leaves the same rows.
    load_arrivals(
        store, "t", str(folder), "*.dat", parse, "ym", str(tmp_path / "checkpoint2")
    ).awaitTermination()
    assert rows(store.table("t")) == kept


def test_a_malformed_arrival_stops_the_stream_and_is_read_again(spark, store, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive():
        load_arrivals(
            store, "t", str(folder), "*.dat",
            lambda lines: parse_strict(lines, ["ym", "k"], flag=BAD), "ym", str(tmp_path / "checkpoint"),
        ).awaitTermination()

    (folder / "a.dat").write_text("202601|a\n202601|b|c\n")
    with pytest.raises(StreamingQueryException, match="1 malformed lines in a.dat"):
        arrive()
    assert rows(store.table("t")) == []
    (folder / "a.dat").write_text("202601|a\n202601|b\n")
    arrive()
    assert rows(store.table("t")) == [("202601", "a"), ("202601", "b")]


@pytest.mark.parametrize("channel, account", [("11", "5125030001"), ("41", "5125010001"),
                                              ("13", "5125050001"), ("77", None)])
def test_booking_accounts(spark, channel, account):
    df = spark.createDataFrame([(channel,)], "c string")
    got = df.select(allocation.booking_account(F.col("c"), allocation.DEFERRAL_ACCOUNTS)).head()[0]
    assert got == account


def test_extracts_of_the_premium_job_are_small_files(spark, tmp_path, monkeypatch):
    """A blank-padded line of the income extract has 253 bytes; the folder holds a small part of that, in several files."""
    day = datetime(1998, 3, 5)
    lines = [(k, 1, 1, 1, 2.0, k + 0.25, 0.0, 0.0, "N", "OF"[k % 2], day) for k in range(2500)]
    orders = [(k, 1, "OFP"[k % 3], 0.5, day, "1-URGENT") for k in range(300)]
    for name, values in (("lineitem", lines), ("orders", orders)):
        spark.createDataFrame(values, SCHEMAS[name]).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(tables, "work_dir", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(tables, "EXTRACT_ROWS", 1000)
    got = {r["INS_IMCD"]: (r["RP_PRM"], r["AF_PRM"], r["AP_PRM"]) for r in tables.m10_job_premium(spark, str(tmp_path)).collect()}
    assert got == {
        "O": (sum(range(0, 2500, 2)) + 1250 * 0.25, 2500.0, 50.0), "F": (sum(range(1, 2500, 2)) + 1250 * 0.25, 2500.0, 50.0),
        "P": (None, None, 50.0)}
    extract = list((tmp_path / "m10f").glob("*841*/part-*"))
    assert len(extract) == 3 and sum(f.stat().st_size for f in extract) < 2500 * 253 / 5
