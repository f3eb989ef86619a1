from datetime import datetime

import pytest
from pyspark.sql import functions as F

from monthclose.operators.derived import KeptSums
from monthclose.operators.registry import LoadRegistry, latest_loads, not_yet_loaded
from monthclose.operators.store import MonthStore
from monthclose.plans.load import load_set
from monthclose.sources import encoding, files, scan

SCHEMA = "ym string, k string, v double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_month_replace_keeps_other_months_and_nulls(spark, store, rows):
    first = frame(spark, ("202601", "a", 1.0), ("202602", "b", 2.0), (None, "c", 3.0), ("", "d", 4.0))
    assert store.load_month("t", first, "ym") == {"rows": 4}
    second = frame(spark, ("20260115", "a2", 1.0), ("202602", "b2", 2.0), (None, "c2", 3.0))
    store.load_month("t", second, "ym")
    assert {r[1] for r in rows(store.table("t"))} == {"a2", "b", "b2", "c", "c2", "d"}
    # Once more: the month is replaced, the rest is added again.
    store.load_month("t", second, "ym")
    assert sorted(r[1] for r in rows(store.table("t"))) == [
        "a2", "b", "b2", "b2", "c", "c2", "c2", "d",
    ]
    assert store.table("t").columns == ["ym", "k", "v"]


def test_month_without_rows_is_emptied(spark, store, rows):
    store.load_month("t", frame(spark, ("202601", "a", 1.0), ("202602", "b", 2.0)), "ym")
    counted = store.load_month("t", frame(spark, ("202602", "c", 1.0)).where("k = 'x'"), "ym")
    assert counted == {"rows": 0}
    assert [r[1] for r in rows(store.table("t"))] == ["b"]


def test_month_column_as_number_and_other_month(spark, store, rows):
    numbers = frame(spark, ("202601", "a", 1.0), ("202602", "b", 2.0)).withColumn(
        "ym", F.col("ym").cast("double")
    )
    store.load_month("t", numbers, "ym")
    store.load_month("t", numbers.where("k = 'b'"), "ym", month="202602", many_months=True)
    assert [r[1] for r in rows(store.table("t"))] == ["a", "b"]
    assert [r[1] for r in store.month_rows("t", "202602").collect()] == ["b"]


def test_failed_load_leaves_the_month_as_it_was(spark, store, rows):
    store.load_month("t", frame(spark, ("202601", "a", 1.0)), "ym")
    broken = frame(spark, ("202601", "b", 2.0)).withColumn(
        "v", F.raise_error(F.lit("no")).cast("double")
    )
    with pytest.raises(Exception):
        store.load_month("t", broken, "ym")
    assert [r[1] for r in rows(store.table("t"))] == ["a"]


def test_replace_may_read_itself_and_change_columns(spark, store, rows):
    store.replace("t", frame(spark, ("202601", "a", 1.0)))
    store.replace("t", store.table("t").unionAll(store.table("t")))
    assert store.table("t").count() == 2
    store.replace("t", store.table("t").select("k").distinct())
    assert rows(store.table("t")) == [("a",)]


def test_a_month_table_can_become_a_plain_one_and_back(spark, store):
    df = frame(spark, ("202601", "a", 1.0))
    store.load_month("t", df, "ym")
    store.replace("t", df)
    assert store.tables() == ["t"] and store.table("t").count() == 1
    store.load_month("t", df, "ym")
    assert store.tables() == ["t"] and store.table("t").count() == 1
    store.drop("t")
    assert store.tables() == []


def test_append(spark, store):
    df = frame(spark, ("202601", "a", 1.0))
    store.append("t", df)
    store.append("t", df)
    assert store.table("t").count() == 2


def test_sql_builds_drops_and_fills(spark, store, tmp_path):
    store.replace("t", frame(spark, ("202601", "a", 1.0), ("202601", "b", 5.0)))
    params = {"SDM": "202601", "MIN": 2}
    assert store.sql("CREATE OR REPLACE TABLE x_${SDM} AS SELECT k FROM t WHERE v > ${MIN};", params) == 1
    assert store.sql("create table if not exists x_202601 as select * from t") == 1
    with pytest.raises(ValueError):
        store.sql("create table x_202601 as select * from t")
    (tmp_path / "q.sql").write_text("CREATE OR REPLACE TABLE y AS\n SELECT * FROM t WHERE v > ${MIN}")
    assert store.sql_file(str(tmp_path / "q.sql"), params, MIN=0) == 2
    store.sql("DROP TABLE IF EXISTS y")
    store.sql("DROP TABLE IF EXISTS y")
    assert store.missing("t", "y") == ["y"]
    assert spark.catalog.currentDatabase() == "default"


def test_attached_month(spark, store, rows):
    before = MonthStore(spark, store.root, "202512", store.name)
    before.replace("t", frame(spark, ("202512", "a", 1.0)))
    store.replace("t", frame(spark, ("202601", "a", 2.0)))
    assert store.attach({"LM": "202512", "LM2": "202511"}) == ["LM"]
    got = store.query("SELECT a.k, a.v, b.v FROM t a JOIN LM.t b ON a.k = b.k WHERE a.k <> 'LM.'")
    assert rows(got) == [("a", 2.0, 1.0)]
    store.detach()
    assert store.aliases == {}


# -- registry and loading ----------------------------------------------------------------------


def test_latest_loads(spark, rows):
    at = datetime(2026, 1, 1)
    history = spark.createDataFrame(
        [("a", "f1", 1, at), ("a", "f2", 2, at.replace(hour=1)), ("b", "f1", 3, at)],
        "table_name string, file_name string, row_count bigint, loaded_at timestamp",
    )
    assert [r[:3] for r in rows(latest_loads(history))] == [("a", "f2", 2), ("b", "f1", 3)]
    candidates = spark.createDataFrame(
        [("a", "f1"), ("a", "f2"), ("c", "f1")], "table_name string, file_name string"
    )
    assert rows(not_yet_loaded(candidates, history)) == [("a", "f1"), ("c", "f1")]


def test_registry(store):
    registry = LoadRegistry(store)
    registry.record("t", "f1", 10)
    assert registry.loaded_rows("t", "f1") == 10
    registry.record("t", "f2", 20)
    assert registry.loaded_rows("t", "f1") is None
    assert LoadRegistry(store).loaded_rows("t", "f2") == 20
    assert store.tables() == []


TABLES = {
    "good_{yyyymm}": {"type": "pipe", "file": "good_{yyyymm}.DAT", "month_col": "ym",
                      "cols": ["ym", "k", "v"], "numeric": ["v"]},
    "uneven": {"type": "pipe", "file": "uneven.dat", "month_col": None, "cols": ["k", "s"]},
    "missing": {"type": "pipe", "file": "missing.dat", "month_col": None, "cols": ["k"]},
    "wrong": {"type": "pipe", "file": "good_{yyyymm}.dat", "cols": ["k"]},
}


@pytest.fixture
def extracts(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good_202601.dat").write_bytes("202601|가|1.5\n202601|나|x\n".encode("cp949"))
    (folder / "uneven.dat").write_bytes(b"1| a \n2\n3|b|long\n")
    return str(folder)


def test_load_set(store, rows, extracts):
    result = load_set(store, TABLES, extracts)
    assert result.loaded == ["good_202601", "uneven"]
    assert result.failed == ["missing", "wrong"]
    assert result.rows == {"good_202601": 2, "uneven": 2} and result.rejected == {"uneven": 1}
    assert rows(store.table("good_202601")) == [("202601", "가", 1.5), ("202601", "나", None)]
    assert rows(store.table("uneven")) == [("1", "a"), ("2", None)]
    assert rows(store.table("uneven__rejected").select("line")) == [("3|b|long",)]


def test_load_set_skips_forces_and_overwrites(store, extracts):
    first = load_set(store, TABLES, extracts, only=["good_{yyyymm}", "unknown"])
    assert first.loaded == ["good_202601"] and first.skipped == []
    again = load_set(store, TABLES, extracts, only=["good_202601"])
    assert again.loaded == again.skipped == ["good_202601"]
    forced = load_set(store, TABLES, extracts, only=["good_202601"], force=True)
    assert forced.skipped == [] and store.table("good_202601").count() == 2
    always = {"g": {**TABLES["good_{yyyymm}"], "overwrite": True}}
    for _ in range(2):
        assert load_set(store, always, extracts).skipped == []


def test_strict_reading_is_replaced_by_the_lenient_one(store, rows, extracts, tmp_path):
    (tmp_path / "in" / "m.dat").write_bytes(b"202601|a\n202601|b|c\n202512|d\n|e\nit's|f\n2026/1|g\n")
    tables = {"m": {"type": "pipe", "file": "m.dat", "month_col": "ym", "cols": ["ym", "k"]}}
    result = load_set(store, tables, extracts)
    assert result.rows == {"m": 5} and result.rejected == {"m": 1}
    assert sorted(r[1] for r in rows(store.table("m"))) == ["a", "d", "e", "f", "g"]


def test_quoted_line_breaks_are_loaded_whole(store, rows, extracts, tmp_path):
    (tmp_path / "in" / "q.dat").write_bytes('202601|"가\n|b"\n202512|c\n'.encode("cp949"))
    tables = {"q": {"type": "pipe", "file": "q.dat", "month_col": "ym", "cols": ["ym", "k"]}}
    result = load_set(store, tables, extracts)
    assert result.rows == {"q": 2} and not result.rejected
    assert rows(store.table("q")) == [("202512", "c"), ("202601", "가\n|b")]


def test_a_month_can_be_loaded_from_itself(spark, store, rows):
    store.load_month("t", frame(spark, ("202601", "a", 1.0), ("202602", "b", 2.0)), "ym")
    store.load_month("t", store.month_rows("t", "202601").withColumn("v", F.col("v") * 10), "ym")
    assert rows(store.table("t")) == [("202601", "a", 10.0), ("202602", "b", 2.0)]


def test_a_hot_month_is_split_when_rebalanced(spark, store):
    """One month with most of the rows is written by more than one task."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    rows = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, "202601").otherwise(F.concat(F.lit("20260"), F.col("id") % 9 + 1))
        .alias("ym"),
        F.uuid().alias("k"),
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        counted = store.load_month("t", rows, "ym", many_months=True)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = store.spark.table(store._id("t__months")).where("_ym = '202601'").inputFiles()
    hot = [f for f in files if "_ym=202601" in f]
    assert counted == {"rows": 200_000} and len(hot) > 1


def test_an_undeclared_encoding_costs_a_second_reading_only_on_a_hit(spark, tmp_path, monkeypatch, rows):
    looked = []
    real = encoding.profile_encodings
    monkeypatch.setattr(scan, "profile_encodings",
                        lambda lines: looked.append(1) or real(lines))
    (tmp_path / "in").mkdir()
    store = MonthStore(spark, str(tmp_path / "s"), "202601", "enc")
    for kind, more in (("pipe", {"cols": ["ym", "s"]}),
                       ("fwf", {"cols": [((0, 6), "ym"), ((7, 12), "s")], "native": True})):
        tables = {f"t_{kind}": {"type": kind, "file": "t.dat", "month_col": "ym", **more}}
        for charset, times in (("utf-8", 0), ("cp949", 1)):
            looked.clear()
            (tmp_path / "in" / "t.dat").write_bytes("202601|완료\n202601|x\n".encode(charset))
            assert load_set(store, tables, str(tmp_path / "in"), force=True).failed == []
            assert rows(store.table(f"t_{kind}")) == [("202601", "x"), ("202601", "완료")]
            assert len(looked) == times


def test_files_of_a_set_are_never_garbled(spark, tmp_path, rows):
    (tmp_path / "m_1.dat").write_bytes("1|완료\n".encode("cp949"))
    (tmp_path / "m_2.dat").write_bytes("2|완료\n".encode())
    store = MonthStore(spark, str(tmp_path / "s"), "202601", "multi")
    tables = {"m": {"type": "pipe", "file": "m_*", "month_col": None, "cols": ["k", "s"], "multi": True}}
    assert load_set(store, tables, str(tmp_path)).rows == {"m": 2}
    assert rows(store.table("m")) == [("1", "완료"), ("2", "완료")]
    # Other files, as many as before, are not taken for the ones loaded.
    (tmp_path / "m_2.dat").rename(tmp_path / "m_3.dat")
    assert load_set(store, tables, str(tmp_path)).skipped == []


@pytest.mark.parametrize("step, shown", [("insertInto", "old"), ("rename", "old"), ("_clean_up", "new")])
def test_a_load_that_dies_shows_either_the_old_rows_or_the_new(spark, tmp_path, rows, monkeypatch, step, shown):
    """Between any two steps, for this session and for one that takes the tables over."""
    store = MonthStore(spark, str(tmp_path / "s"), "202601", f"one{step.strip('_').lower()}")
    store.load_month("t", frame(spark, ("202601", "old", 1.0), ("202602", "kept", 2.0)), "ym")

    class Died(BaseException):
        pass

    def die(*args, **kwargs):
        raise Died

    again = frame(spark, ("202601", "new", 3.0))
    with monkeypatch.context() as patched:
        if step == "insertInto":  # written, but not yet known to be complete
            write = MonthStore._write
            patched.setattr(MonthStore, "_write", lambda self, df, do: (write(self, df, do), die()))
        elif step == "rename":
            patched.setattr("monthclose.sources.files.rename", die)
        else:
            clean_up, calls = MonthStore._clean_up, []
            patched.setattr(MonthStore, "_clean_up",
                            lambda self, t: clean_up(self, t) if not calls.append(1) and len(calls) == 1 else die())
        with pytest.raises(Died):
            store.load_month("t", again, "ym")
    expected = [("202601", shown), ("202602", "kept")]
    assert rows(store.table("t").select("ym", "k")) == expected
    other = MonthStore(spark, str(tmp_path / "s"), "202601", f"two{step.strip('_').lower()}")
    assert rows(other.table("t").select("ym", "k")) == expected
    store.load_month("t", frame(spark, ("202601", "newest", 3.0)), "ym")
    assert rows(store.table("t").select("ym", "k")) == [("202601", "newest"), ("202602", "kept")]
    assert not (tmp_path / "s/202601/_state/t__months").exists()


class Died(BaseException):
    pass


def _dies(patched, where, step):
    """Let a method die before (or, with a + in front, after) it has done its work."""
    work = getattr(where, step.lstrip("+"))

    def die(*args, **kwargs):
        if step.startswith("+"):
            work(*args, **kwargs)
        raise Died

    patched.setattr(where, step.lstrip("+"), die)


@pytest.mark.parametrize("step, shown", [
    ("+_write", "old"), ("rename", "old"), ("+rename", "new"), ("_show_version", "new"), ("_sweep", "new"),
    ("_drop_versions", "new"), ("+_drop_versions", "new")])
@pytest.mark.parametrize("action", ["replace", "append"])
def test_a_replacement_that_dies_leaves_the_old_table_or_the_new_one(spark, tmp_path, rows, monkeypatch, action, step, shown):
    label = f"{action}{step.strip('+').replace('_', '')}{step.startswith('+')}".lower()
    root = str(tmp_path / "s")
    store = MonthStore(spark, root, "202601", f"one{label}")
    store.replace("t", frame(spark, ("202601", "a", 1.0), ("202601", "b", 2.0)))
    store.append("t", frame(spark, ("202601", "c", 3.0)))
    old, fresh = ["a", "b", "c"], frame(spark, ("202601", "n", 9.0)).withColumn("v", F.col("v").cast("double"))
    new = ["n"] if action == "replace" else [*old, "n"]
    with monkeypatch.context() as patched:
        _dies(patched, files if "rename" in step else MonthStore, step)
        with pytest.raises(Died):
            getattr(store, action)("t", fresh)
    expected = new if shown == "new" else old
    other = MonthStore(spark, root, "202601", f"two{label}")  # a process that takes the tables over
    assert [r[1] for r in rows(other.table("t"))] == expected and other.tables() == ["t"]
    if "_show" not in step:
        assert [r[1] for r in rows(store.table("t"))] in (old, new)
    store.append("t", frame(spark, ("202601", "z", 9.0)))
    assert [r[1] for r in rows(store.table("t"))] == [*expected, "z"]
    third = MonthStore(spark, root, "202601", f"three{label}")
    assert [r[1] for r in rows(third.table("t"))] == [*expected, "z"]
    assert len([p for p in (tmp_path / "s/202601").iterdir() if p.name.startswith("t__v")]) == 1


@pytest.mark.parametrize("step", ["+_write", "rename", "_leave_versions", "_clean_up"])
def test_a_plain_table_stays_until_its_first_month_load_counts(spark, tmp_path, rows, monkeypatch, step):
    label = step.strip("+").replace("_", "")
    store = MonthStore(spark, str(tmp_path / "s"), "202601", f"one{label}")
    store.replace("t", frame(spark, ("202601", "plain", 1.0)))
    with monkeypatch.context() as patched:
        _dies(patched, files if step == "rename" else MonthStore, step)
        with pytest.raises(Died):
            store.load_month("t", frame(spark, ("202601", "month", 1.0)), "ym")
    other = MonthStore(spark, str(tmp_path / "s"), "202601", f"two{label}")
    expected = "month" if step == "_clean_up" else "plain"
    assert [r[1] for r in rows(store.table("t"))] == [r[1] for r in rows(other.table("t"))] == [expected]
    store.load_month("t", frame(spark, ("202601", "again", 1.0)), "ym")
    assert [r[1] for r in rows(store.table("t"))] == ["again"]


def test_a_malformed_arrival_leaves_the_rows_it_brought_before(spark, store, rows):
    good = frame(spark, ("202601", "a", 1.0), ("202602", "b", 2.0))
    assert store.add_load("t", good, "ym", "x=1/ü.dat") == {"rows": 2}
    store.add_load("t", frame(spark, ("202601", "other", 1.0)), "ym", "x2")
    counted = store.add_load("t", good.withColumn("_bad", F.col("k") == "b"), "ym", "x=1/ü.dat")
    assert counted == {"rows": 2, "bad": 1}
    assert [r[1] for r in rows(store.table("t"))] == ["a", "other", "b"]
    store.add_load("t", frame(spark, (None, "c", 1.0)), "ym", "x=1/ü.dat")
    assert sorted(r[1] for r in rows(store.table("t"))) == ["c", "other"]


@pytest.mark.parametrize("step, shown", [("+_write", "old"), ("rename", "old"), ("+rename", "new")])
def test_an_arrival_that_dies_shows_either_its_old_rows_or_the_new(spark, tmp_path, rows, monkeypatch, step, shown):
    label = f"arr{step.strip('+').replace('_', '')}{step.startswith('+')}".lower()
    store = MonthStore(spark, str(tmp_path / "s"), "202601", f"one{label}")
    store.add_load("t", frame(spark, ("202601", "old", 1.0), ("202602", "old", 1.0)), "ym", "x")
    store.add_load("t", frame(spark, ("202601", "y", 1.0)), "ym", "y")
    with monkeypatch.context() as patched:
        _dies(patched, files if "rename" in step else MonthStore, step)
        with pytest.raises(Died):
            store.add_load("t", frame(spark, ("202601", "new", 1.0)), "ym", "x")
    other = MonthStore(spark, str(tmp_path / "s"), "202601", f"two{label}")
    assert sorted(r[1] for r in rows(other.table("t"))) == (["new", "y"] if shown == "new" else ["old", "old", "y"])


def test_a_table_whose_months_are_all_empty_is_known_to_the_next_process(spark, tmp_path):
    store = MonthStore(spark, str(tmp_path / "s"), "202601", "emptied1")
    store.load_month("t", frame(spark, ("202601", "a", 1.0)), "ym")
    store.load_month("t", frame(spark, ("202601", "a", 1.0)).where("k = 'x'"), "ym")
    other = MonthStore(spark, str(tmp_path / "s"), "202601", "emptied2")
    assert other.missing("t") == [] and other.table("t").columns == ["ym", "k", "v"] and other.table("t").count() == 0


def test_append_keeps_the_columns(spark, store, rows):
    store.replace("t", frame(spark, ("202601", "a", 1.0)))
    store.append("t", spark.createDataFrame([(202602, "b", "2")], "x int, y string, z string"))
    assert rows(store.table("t")) == [("202601", "a", 1.0), ("202602", "b", 2.0)]
    with pytest.raises(ValueError):
        store.append("t", spark.createDataFrame([(1,)], "x int"))
    counted = store.append("t", frame(spark, ("202603", "c", 1.0)).withColumn("_bad", F.lit(True)))
    assert counted["bad"] == 1 and store.table("t").count() == 2
    store.load_month("m", frame(spark, ("202601", "a", 1.0)), "ym")
    with pytest.raises(ValueError):
        store.append("m", frame(spark, ("202601", "a", 1.0)))


def _files(folder):
    return [p for p in folder.rglob("*.parquet") if not p.name.startswith(".")]


@pytest.mark.parametrize("step", [None, "+_write", "rename", "+rename", "_clean_up"])
def test_merged_loads_have_the_same_rows_in_fewer_files(spark, tmp_path, rows, monkeypatch, step):
    label = f"merge{(step or 'none').strip('+').replace('_', '')}{str(step).startswith('+')}".lower()
    root = tmp_path / "s"
    store = MonthStore(spark, str(root), "202601", f"one{label}")
    for k in range(4):  # every load has rows of a later month, of a month that needs quoting, and of none
        many = spark.range(40).select(
            F.element_at(F.array(*map(F.lit, ("202602", "it's", "202603"))), (F.col("id") % 3 + 1).cast("int")).alias("ym"),
            F.concat(F.lit(f"l{k}-"), "id").alias("k"), F.col("id").cast("double").alias("v"))
        store.load_month("t", many.unionByName(frame(spark, (None, f"none{k}", 0.0), ("202601", f"this{k}", 1.0))), "ym")
    store.add_load("t", frame(spark, ("202602", "arrival", 1.0)), "ym", "x")
    before, count = rows(store.table("t")), len(_files(root))
    reader = store.table("t").select("ym", "k")  # resolved now, read after the switch
    with monkeypatch.context() as patched:
        if step is None:
            clean_up = MonthStore._clean_up
            patched.setattr(MonthStore, "_clean_up", lambda self, t: (len(rows(reader)) == len(before) or 1 / 0, clean_up(self, t)))
            assert store.merge_loads("t") == 12
        elif step == "_clean_up":
            clean_up, calls = MonthStore._clean_up, []
            patched.setattr(MonthStore, "_clean_up", lambda self, t: clean_up(self, t) if not calls.append(1) and len(calls) == 1
                            else (_ for _ in ()).throw(Died()))
            with pytest.raises(Died):
                store.merge_loads("t")
        else:
            _dies(patched, files if "rename" in step else MonthStore, step)
            with pytest.raises(Died):
                store.merge_loads("t")
    other = MonthStore(spark, str(root), "202601", f"two{label}")
    assert rows(other.table("t")) == before
    if step is None:
        assert len(_files(root)) < count and store.merge_loads("t") == 0
        plan = store.months_rows("t", "202602", "202602")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "202602" in plan.split("PartitionFilters")[1].split("]")[0]
    other.load_month("t", frame(spark, ("202602", "fresh", 1.0)), "ym", month="202602")
    assert sorted(r[1] for r in other.month_rows("t", "202602").collect()) == ["fresh"]
    assert len([r for r in other.table("t").collect() if r[0] != "202602"]) == len([r for r in before if r[0] != "202602"])


def test_kept_sums_read_the_loads_that_are_new(spark, store, rows):
    def load(month, *found):
        store.load_month("t", frame(spark, *found), "ym", month=month)

    def rebuilt():
        return rows(store.table("t").groupBy("k").agg(F.sum("v"), F.sum(F.lit(1).cast("bigint"))))

    sums = KeptSums(store, "kept", "t", ["k"], {"v": "v", "n": "cast(1 as bigint)"})
    load("202601", ("202601", "a", 1.0), ("202601", None, 2.0), (None, "a", 5.0))
    load("202602", ("202602", "a", 3.0), ("202602", "b", 4.0))
    assert sums.refresh() == 3 and rows(sums.frame()) == rebuilt()
    assert sums.refresh() == 0 and rows(sums.frame()) == rebuilt()
    load("202602", ("202602", "c", 7.0))
    changed = sums.changed().inputFiles()
    assert changed and all("_ym=202602/" in f for f in changed)
    assert sums.refresh() == 1 and rows(sums.frame()) == rebuilt()
    load("202601")  # an empty month: nothing to read, its sums go
    assert sums.refresh() == 0 and rows(sums.frame()) == rebuilt()
    store.add_load("t", frame(spark, ("202601", "a", 1.0)), "ym", "x")
    load("202602", ("202602", "d", 1.0), ("202603", "d", 1.0))
    load("202604", ("202603", "d", 2.0))
    store.merge_loads("t")
    assert sums.refresh() >= 2 and rows(sums.frame()) == rebuilt()
    other = KeptSums(store, "kept", "t", ["k", "ym"], {"v": "v"})  # sums of another kind take the table over
    assert other.refresh() == len(store.loads("t"))
    assert rows(other.frame()) == rows(store.table("t").groupBy("k", "ym").agg(F.sum("v")))
    again = MonthStore(spark, store.root, store.month, store.name + "b")
    assert KeptSums(again, "kept", "t", ["k", "ym"], {"v": "v"}).refresh() == 0


@pytest.mark.parametrize("step", ["+point", "point", "rename"])
def test_kept_sums_that_die_are_made_again(spark, store, rows, monkeypatch, step):
    sums = KeptSums(store, "kept", "t", ["k"], {"v": "v"})
    store.load_month("t", frame(spark, ("202601", "a", 1.0)), "ym")
    sums.refresh()
    store.load_month("t", frame(spark, ("202602", "a", 2.0)), "ym", month="202602")
    with monkeypatch.context() as patched:
        _dies(patched, files if step == "rename" else MonthStore, step)
        with pytest.raises(Died):
            sums.refresh()
    assert rows(sums.frame()) == [("a", 3.0 if step == "+point" else 1.0)]
    sums.refresh()
    assert rows(sums.frame()) == [("a", 3.0)]
