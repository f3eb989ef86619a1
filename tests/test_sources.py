import csv
import gzip
import io
import json
import random
import zipfile

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from monthclose.sources import delimited, encoding, files, jdbc, layouts, records, scan
from monthclose.sources.layouts import table_spec
from monthclose.sources.lines import raw_lines


def write(path, data):
    path.write_bytes(data)
    return str(path)


def spec(kind, file="x.dat", **more):
    return table_spec("t", {"type": kind, "file": file, "month_col": None, **more})


def read(spark, folder, s, month="202601"):
    return scan.scan(spark, s, str(folder), month)


# -- fixed width -------------------------------------------------------------------------------

LAYOUT = [((0, 6), "ym"), ((6, 16), "name"), ((16, 22), "amt")]
FIXED = (
    "202601" + "가나다라 " + "  12.5" + "\n"       # two bytes per character: the number does not shift
    "\r\n"                                         # blank
    "202601ab\n"                                   # short
    "202602" + "　홍 " + "     " + "1d    " + "\r\n"  # ideographic space, bad number
    "2026"
)


def python_fixed(data):
    """Plain Python over the same bytes."""
    out = []
    for raw in io.BytesIO(data):
        line = raw.rstrip(b"\r\n")
        if not line:
            continue
        ym, name, amt = (line[s:e].decode("cp949", "replace").strip() for (s, e), _ in LAYOUT)
        try:
            amt = float(amt)
        except ValueError:
            amt = None
        out.append((ym, name, amt))
    return sorted(out, key=str)


def test_fixed_bytes(spark, tmp_path):
    data = FIXED.encode("cp949") + b"\n202601\xff\xb0\xa1\xb0     \n"
    write(tmp_path / "x.dat", data)
    rows = read(spark, tmp_path, spec("fwf", cols=LAYOUT, numeric=["amt"])).rows
    assert rows.dtypes == [("ym", "string"), ("name", "string"), ("amt", "double")]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == python_fixed(data)


def test_fixed_bytes_restores_settings(spark, tmp_path):
    write(tmp_path / "x.dat", FIXED.encode("cp949"))
    read(spark, tmp_path, spec("fwf", cols=LAYOUT)).rows
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_decoding_agrees_with_python_on_every_legal_pair(spark):
    pairs = [bytes([a, b]) for a in range(0x81, 0xFF) for b in range(0x41, 0xFF)]

    def legal(pair):
        try:
            return pair.decode("cp949")
        except UnicodeDecodeError:
            return None

    expected = {p: legal(p) for p in pairs if legal(p)}
    df = spark.createDataFrame([(p,) for p in expected], "raw binary")
    with encoding.charset_settings(spark):
        out = df.select("raw", encoding.decoded(F.col("raw"), "cp949").alias("s"))
    assert {bytes(r.raw): r.s for r in out.collect()} == expected


def test_fixed_chars(spark, tmp_path):
    write(tmp_path / "x.dat", b"202601abc        1.5\n\n202602\n")
    cols = [((0, 6), "ym"), ((6, 16), "name"), ((16, 22), "amt")]
    s = spec("fwf", cols=cols, numeric=["amt"], native=True)
    assert [tuple(r) for r in read(spark, tmp_path, s).rows.collect()] == [
        ("202601", "abc", 1.5), ("202602", "", None),
    ]


# -- delimited ---------------------------------------------------------------------------------


def test_pipe_edge_rows(spark, tmp_path):
    text = (
        '202601|가"나|1.5\n202601|"x|y"|2.5\n202601|"a""b"| -2.5 \n202602||1d\n'
        "202601| s |1e3\n202601|t|1|\n\n202601|back\\slash|1,2\n"
    )
    write(tmp_path / "x.dat", text.encode("cp949"))
    got = read(spark, tmp_path, spec("pipe", cols=["ym", "s", "n"], bigint=["n"])).rows
    assert [tuple(r) for r in got.collect()] == [
        ("202601", '가"나', 2, False), ("202601", "x|y", 3, False), ("202601", 'a"b', -3, False),
        ("202602", None, None, False), ("202601", " s ", 1000, False), ("202601", "t", 1, False),
        ("202601", "back\\slash", None, False),
    ]


def test_trim_is_for_spaces(spark, tmp_path):
    write(tmp_path / "x.dat", b" a |\tb\n")
    got = read(spark, tmp_path, spec("pipe", cols=["a", "b"], trim=True)).rows.drop("_bad")
    assert [tuple(r) for r in got.collect()] == [("a", "\tb")]


def test_malformed_lines_strict_and_lenient(spark, tmp_path):
    write(tmp_path / "x.dat", b'1|a\n2\n3|c|x\n4|"open\n5|"e"e\n6|\tf \n')
    extract = read(spark, tmp_path, spec("pipe", cols=["k", "s"], numeric=["k"]))
    flags = {r["k"]: r["_bad"] for r in extract.rows.collect()}
    assert flags == {1: False, 2: True, 3: True, 4: True, 5: True, 6: False}
    rows, rejected = extract.lenient()
    assert [tuple(r) for r in rows.collect()] == [
        (1, "a"), (2, None), (4, '"open'), (5, '"e"e'), (6, "f"),
    ]
    assert [tuple(r) for r in rejected.collect()] == [("3|c|x", 3, 2, "x.dat")]


def test_every_line_too_long_keeps_leading_names(spark, tmp_path):
    write(tmp_path / "x.dat", b"1|a|x\n2|b|y\n")
    extract = read(spark, tmp_path, spec("pipe", cols=["k", "s"]))
    assert [tuple(r) for r in extract.rows.collect()] == [("1", "a", False), ("2", "b", False)]


def test_select_keeps_file_order_and_checks_names(spark, tmp_path):
    write(tmp_path / "x.dat", b"1|a|x\n")
    got = read(spark, tmp_path, spec("pipe", cols=["k", "s", "t"], select_cols=["t", "k"]))
    assert [tuple(r) for r in got.plain_rows().collect()] == [("1", "x")]
    with pytest.raises(ValueError):
        read(spark, tmp_path, spec("pipe", cols=["k", "s", "t"], select_cols=["nope"]))


def test_quoted_fields_agree_with_a_csv_parser(spark):
    fields = ["", "a", 'q"q', "x,y", '"', '""', ",", " lead", 'end"', "한글,", "日本"]
    table = [[fields[(i * 7 + j * 3) % len(fields)] for j in range(4)] for i in range(40)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(table)
    lines = [(line,) for line in out.getvalue().splitlines()]
    parsed = delimited.parse_strict(
        spark.createDataFrame(lines, "value string"), list("abcd"), ",", flag="bad"
    )
    got = [tuple(r) for r in parsed.collect()]
    assert got == [(*[f or None for f in row], False) for row in table]


def test_spaces_around_quotes(spark):
    lines = [(' "a|b"|"c" |d', ), ('  "a"|x|y',), (' "a|x|y',)]
    df = spark.createDataFrame(lines, "value string")
    got = [tuple(r) for r in delimited.parse_strict(df, list("abc"), "|", flag="bad").collect()]
    assert got == [("a|b", "c", "d", False), ('  "a"', "x", "y", False), (' "a', "x", "y", True)]


def test_generated_lines_agree_with_duckdb(spark, tmp_path):
    """Quoted and plain fields of all kinds, as a strict SQL reader sees them."""
    pick = random.Random(7)
    marks = ["a", "b", "|", '"', " ", "가", "1", "\\", "\t", "x,y"]
    out = io.StringIO()
    for quoting in (csv.QUOTE_MINIMAL, csv.QUOTE_ALL):
        writer = csv.writer(out, delimiter="|", lineterminator="\n", quoting=quoting)
        for _ in range(1000):
            writer.writerow(
                ["".join(pick.choices(marks, k=pick.randint(0, 6))) for _ in range(4)]
            )
    path = tmp_path / "x.dat"
    path.write_text(out.getvalue(), encoding="utf-8")
    columns = ", ".join(f"'{c}': 'VARCHAR'" for c in "abcd")
    expected = duckdb.connect().execute(
        f"select *, false from read_csv('{path}', delim='|', header=false, auto_detect=false, "
        f"columns={{{columns}}})"
    ).fetchall()
    got = read(spark, tmp_path, spec("pipe", cols=list("abcd"))).rows
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, expected))


RECORDS = '1|"a\r\nb|""c"""|x\n2|"c\nd"|"y"\r\n3||z\r\n\n4|"가\n나"|p\n'


@pytest.mark.parametrize("encoding", ["utf-8", "cp949"])
@pytest.mark.parametrize("declared", [True, False])
def test_line_breaks_inside_quotes(spark, tmp_path, encoding, declared):
    write(tmp_path / "x.dat", RECORDS.encode(encoding))
    extract = read(spark, tmp_path, spec("pipe", cols=["k", "s", "t"], numeric=["k"], multiline=declared))
    rows = extract.rows if declared else extract.spanning()
    assert sorted(tuple(r) for r in rows.collect()) == [
        (1, 'a\r\nb|"c"', "x", False), (2, "c\nd", "y", False), (3, None, "z", False), (4, "가\n나", "p", False),
    ]
    if declared:
        assert rows.select("t").collect() and extract.hopeful.where("_garbled").count() == (encoding == "cp949")


def test_malformed_records_that_span_lines(spark, tmp_path):
    write(tmp_path / "x.dat", b'1|"a\nb"\r\n2|"c\nd"|y|z\n3|"p\n"|q|\n4|r|s\n5|"open|t\n6|u|v\n')
    whole = spec("pipe", cols=["k", "s", "t"], multiline=True)
    assert {r["k"]: r["_bad"] for r in read(spark, tmp_path, whole).rows.select("k", "_bad").collect()} == {
        "1": True, "2": True, "3": False, "4": False, "5": True}
    # An odd number of quotes: some field never ends, so lines are read one by one.
    assert read(spark, tmp_path, spec("pipe", cols=["k", "s", "t"])).spanning() is None


CUT = 'h|x|y\n1|"a\r\nb|""c"""|x\n2|"c\n\n\nd"|"y"\r\n3||z\r\n\n4|"가\n나\n"|"p\n""\n"\n5|q|"\n\n"\n6|"""\n"|z'
CUT_ROWS = [("1", 'a\r\nb|"c"', "x"), ("2", "c\n\n\nd", "y"), ("3", None, "z"), ("4", "가\n나\n", 'p\n"\n'), ("5", "q", "\n\n"),
            ("6", '"\n', "z")]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 10, 13, 19, 31, 64])
def test_records_are_whole_wherever_their_file_is_cut(spark, tmp_path, size):
    """With splits of one byte every byte of the file is a cut."""
    write(tmp_path / "x_1.dat", CUT.encode())
    write(tmp_path / "x_2.dat", (CUT + "\n").encode())
    s = spec("pipe", "x_?", cols=["k", "s", "t"], multi=True, multiline=True, header=True, encoding="utf-8")
    with encoding.session_settings(spark, {
        "spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1"}):
        got = sorted((tuple(r) for r in read(spark, tmp_path, s).plain_rows().collect()), key=str)
    assert got == sorted(CUT_ROWS * 2, key=str)


def test_one_file_with_quoted_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    text = "".join(f'{k}|"{"line " * (k % 50)}\n{"x" * (k % 97)}""|\n"|{k * 2}\n' for k in range(4000))
    write(tmp_path / "x.dat", text.encode())
    s = spec("pipe", "x.dat", cols=["k", "s", "t"], multiline=True, encoding="utf-8")
    with encoding.session_settings(spark, {"spark.sql.files.maxPartitionBytes": str(len(text) // 12)}):
        rows = read(spark, tmp_path, s).plain_rows()
        got = rows.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in got}) >= 8
    assert sorted((int(r.k), r.s, int(r.t)) for r in got) == [
        (k, f'{"line " * (k % 50)}\n{"x" * (k % 97)}"|\n', k * 2) for k in range(4000)]


def test_records_are_handed_on_in_small_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "BATCH_BYTES", 10_000)
    lines = [b'%d|"%s|' % (k // 2, b"x" * 900) if k % 2 == 0 else b'y"|z' for k in range(200)] + [b"w" * 30_000, b"v"]
    batch = pa.RecordBatch.from_pydict({
        "value": lines, "path": ["p"] * 202, "file": ["f"] * 202, "block": [0] * 202, "owner": pa.array([None] * 202, pa.int64())})
    out = [b.column("record").to_pylist() for b in records._pieces(iter([batch, batch.slice(0, 0)]), header=False)]
    assert sum(out, []) == [b"\n".join(lines[k : k + 2]) for k in range(0, 200, 2)] + lines[200:]
    assert all(sum(map(len, b)) < 12_000 or len(b) <= 2 for b in out) and len(out) > 9
    write(tmp_path / "x.dat", b'1|"a\nb"\n')
    assert records.whole_records(spark, [str(tmp_path / "x.dat")]).count() == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "10000"


def test_csv_that_spans_lines_has_one_header_per_file(spark, tmp_path):
    write(tmp_path / "x_1.csv", b'k,s\n1,"a\n"\nk,s\n2\n')
    write(tmp_path / "x_2.csv", b'k,s\n3,"b,\nc"\n')
    s = spec("csv", "x_?", header=True, multi=True, multiline=True)
    got = sorted(tuple(r) for r in read(spark, tmp_path, s).rows.collect())
    assert got == [("1", "a\n", False), ("2", None, False), ("3", "b,\nc", False), ("k", "s", False)]


def test_long_delimiter_and_long_field(spark):
    long = "1||" + '"' + 'x""|' * 100_000 + '"' + "||2"
    df = spark.createDataFrame([("a||b||c",), (long,)], "value string")
    got = delimited.parse_strict(df, list("abc"), "||", flag="bad").collect()
    assert tuple(got[0]) == ("a", "b", "c", False)
    assert (got[1]["a"], len(got[1]["b"]), got[1]["c"], got[1]["bad"]) == ("1", 300_000, "2", False)


def test_csv_names_padding_and_header(spark, tmp_path):
    write(tmp_path / "x.csv", b"k,s,n\n1,a,2\n2\n3,\"b,c\",z\n")
    s = spec("csv", "x.csv", cols=["k", "s", "n"], numeric=["n"], header=True)
    assert [tuple(r) for r in read(spark, tmp_path, s).rows.collect()] == [
        ("1", "a", 2.0, False), ("2", None, None, False), ("3", "b,c", None, False),
    ]
    s = spec("csv", "x.csv", numeric=["n"])
    got = read(spark, tmp_path, s).plain_rows()
    assert got.columns == ["k", "s", "n"] and got.count() == 3


def test_header_goes_by_its_place(spark, tmp_path):
    write(tmp_path / "x_1.csv", b"\nk,s\n1,a\x01b\nk,s\n")
    with gzip.open(tmp_path / "x_2.csv.gz", "wb") as f:
        f.write("K,S\n2,가\n\n".encode())
    with zipfile.ZipFile(tmp_path / "x_3.zip", "w") as z:
        z.writestr("a.csv", "\nk,s\n3,c\nk,s\n")
        z.writestr("b.csv", "other,header\n4,d")
    s = spec("csv", "x_?", cols=["k", "s"], header=True, multi=True)
    got = sorted(tuple(r) for r in read(spark, tmp_path, s).plain_rows().collect())
    assert got == [("1", "a\x01b"), ("2", "가"), ("3", "c"), ("4", "d"), ("k", "s"), ("k", "s")]


def test_auto_names(spark, tmp_path):
    write(tmp_path / "x.dat", b'1|"a|b"|3\n')
    got = read(spark, tmp_path, spec("pipe")).plain_rows()
    assert [r.asDict() for r in got.collect()] == [{"col_0": "1", "col_1": "a|b", "col_2": "3"}]


def test_empty_file(spark, tmp_path):
    write(tmp_path / "x.dat", b"")
    got = read(spark, tmp_path, spec("pipe", cols=["a", "b"])).plain_rows()
    assert got.columns == ["a", "b"] and got.count() == 0


# -- compression, encodings, files -------------------------------------------------------------


def test_gzip_zip_and_plain_together(spark, tmp_path):
    with gzip.open(tmp_path / "p_1.dat.gz", "wb") as f:
        f.write("1|가\n".encode())
    with zipfile.ZipFile(tmp_path / "p_2.zip", "w") as z:
        z.writestr("a.dat", "2|나\r\n3|다\r\n")
        z.mkdir("folder")
        z.writestr("folder/b.dat", "5|마\n6|바")
    write(tmp_path / "p_3.dat", "4|라\n".encode())
    s = spec("pipe", "p_?.*", cols=["k", "s"], multi=True)
    # A wildcard after the last dot is no known extension, so each extension is tried in turn.
    with pytest.raises(FileNotFoundError):
        read(spark, tmp_path, s)
    s = spec("pipe", "p_?", cols=["k", "s"], multi=True)
    extract = read(spark, tmp_path, s)
    assert extract.label.startswith("3 files ")
    assert extract.label != scan.file_label(["p_1.dat", "p_2.zip", "p_4.dat"], s)
    got = sorted(tuple(r) for r in extract.plain_rows().collect())
    assert got == [("1", "가"), ("2", "나"), ("3", "다"), ("4", "라"), ("5", "마"), ("6", "바")]


def test_archives_are_read_in_tasks_of_their_own_and_by_blocks(spark, tmp_path):
    paths, expected = [], []
    for i in range(9):
        paths.append(str(tmp_path / f"a_{i}.zip"))
        with zipfile.ZipFile(paths[-1], "w") as z:
            z.writestr("x.dat", "".join(f"{i}-{j}\r\n" for j in range(700_000 if i == 0 else 3)))
        expected += [f"{i}-{j}" for j in range(700_000 if i == 0 else 3)]
    lines = raw_lines(spark, paths, spread=False)
    tasks = lines.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("file").alias("n"))
    assert sorted(tuple(r) for r in tasks.collect()) == [(i, 1) for i in range(9)]
    assert raw_lines(spark, paths, header=True).count() == lines.count() - len(paths)
    assert sorted(r["value"] for r in lines.collect()) == sorted(expected)


def test_mixed_encodings_are_told_apart_per_file(spark, tmp_path):
    write(tmp_path / "a.dat", "1|한글\n2|x\n".encode("cp949"))
    write(tmp_path / "b.dat", "3|한글\n".encode())
    lines = raw_lines(spark, [str(tmp_path / "a.dat"), str(tmp_path / "b.dat")])
    profile = {r["file"]: tuple(r)[1:] for r in encoding.profile_encodings(lines).collect()}
    assert profile == {"a.dat": ("cp949", 2, 1), "b.dat": ("utf-8", 1, 0)}
    s = spec("pipe", "*.dat", cols=["k", "s"])
    paths = [str(tmp_path / "a.dat"), str(tmp_path / "b.dat")]
    got = scan.scan_paths(spark, s, paths).plain_rows()
    assert sorted(tuple(r) for r in got.collect()) == [("1", "한글"), ("2", "x"), ("3", "한글")]


def test_file_resolution():
    names = ["a_202601.dat", "a_202601.DAT", "a_202601.csv", "b_1_x.dat.gz", "b_2_x.dat.gz", "c.dat.gz"]
    assert files.resolve_files(names, "a_202601.DAT") == ["a_202601.DAT"]
    assert files.resolve_files(names + ["a_202601.zip"], "a_202601.csv") == ["a_202601.zip"]
    assert files.resolve_files(names, "c.dat.gz") == ["c.dat.gz"]
    assert files.resolve_files(names, "b_?_*.dat.gz") == ["b_2_x.dat.gz"]
    assert files.resolve_files(names, "b_?_*", multi=True) == ["b_1_x.dat.gz", "b_2_x.dat.gz"]
    with pytest.raises(FileNotFoundError):
        files.resolve_files(names, "z.dat")


def test_latest_files_treats_underscore_literally(spark):
    names = spark.createDataFrame([("a_1",), ("ab1",), ("a_2",)], "name string")
    got = files.latest_files(names, ["a_?", "z*"]).collect()
    assert {tuple(r) for r in got} == {("a_?", "a_2", 2), ("z*", None, 0)}


def test_layouts(spark):
    fields = layouts.layout_from_json(json.dumps([[[0, 6], "a"], [[6, 8], "b"]]))
    assert fields == (layouts.Field(0, 6, "a"), layouts.Field(6, 8, "b"))
    assert layouts.layout_from_json('["a", "b"]') == ("a", "b")
    with pytest.raises(KeyError):
        table_spec("t", {"type": "pipe", "file": "x"})
    with pytest.raises(ValueError):
        table_spec("t", {"type": "tape", "month_col": None})


def test_columnar_source(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "1.5"), ("b", "x")], "s string, n string")
    df.write.parquet(str(tmp_path / "x.parquet"))
    got = read(spark, tmp_path, spec("parquet", "x.parquet", numeric=["n"])).rows
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1.5), ("b", None)]


def test_preview(spark):
    count, columns, head = scan.preview(spark.range(10).toDF("id"), 3)
    assert (count, columns, len(head)) == (10, ["id"], 3)


# -- database (no connection is made) ----------------------------------------------------------


@pytest.mark.parametrize(
    "database, url",
    [
        ({"dsn": "h:1523/SVC"}, "jdbc:oracle:thin:@//h:1523/SVC"),
        ({"dsn": "h:1523:SID"}, "jdbc:oracle:thin:@h:1523:SID"),
        ({"dsn": "h:1523", "sid": "S"}, "jdbc:oracle:thin:@h:1523:S"),
        ({"dsn": "h", "service_name": "S"}, "jdbc:oracle:thin:@//h:1521/S"),
        ({"url": "jdbc:x:y"}, "jdbc:x:y"),
    ],
)
def test_jdbc_url(database, url):
    assert jdbc.jdbc_url(database) == url


def test_query_options(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT a\nFROM t WHERE ym = '{yyyymm}';\n", encoding="utf-8")
    database = {"dsn": "h:1/S", "user": "u", "sql_file": str(tmp_path / "q.sql"),
                "partition": ("a", 0, 100, 4)}
    got = jdbc.query_options(spark, database, "202601")
    assert got["dbtable"] == "(SELECT a\nFROM t WHERE ym = '202601'\n) q"
    assert (got["fetchsize"], got["user"], got["numPartitions"]) == ("50000", "u", "4")


def test_few_compressed_files_are_spread_out(spark, tmp_path):
    for i in range(2):
        with gzip.open(tmp_path / f"few_{i}.gz", "wt") as f:
            f.write("x\n" * 10)
    many = tmp_path / "many.gz"
    spark.range(100).selectExpr("cast(id as string) as value").repartition(9).write.option(
        "compression", "gzip"
    ).text(str(many))

    def spread(paths):
        text = raw_lines(spark, paths)._jdf.queryExecution().executedPlan().toString()
        return "RoundRobinPartitioning" in text

    assert spread([str(tmp_path / f"few_{i}.gz") for i in range(2)])
    assert not spread([str(many)])
    assert not spread([write(tmp_path / "plain.dat", b"x\n")])
