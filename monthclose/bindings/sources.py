"""Registered queries: extract files are written from the given tables and scanned back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from monthclose.bindings.common import joined, table, text, write_lines
from monthclose.functions.casts import to_bigint, to_double
from monthclose.functions.months import month_of
from monthclose.operators.stages import read_stages
from monthclose.sources.delimited import parse_strict
from monthclose.sources.encoding import charset_settings, encoded, profile_encodings
from monthclose.sources.files import latest_files, work_dir
from monthclose.sources.layouts import layout_from_json, table_spec
from monthclose.sources.lines import raw_lines
from monthclose.sources.scan import preview, scan

# Two bytes per character in cp949, three in UTF-8.
_STATUS_NAMES = {"F": "완료", "O": "진행중", "P": "보류"}
_STATUS_SQL = "case o_orderstatus when 'F' then '완료' when 'O' then '진행중' else '보류' end"

_LAYOUT = (
    ((0, 6), "ym"), ((6, 16), "status"), ((16, 26), "k"), ((26, 41), "amt"), ((41, 57), "priority"),
)
_ORDER_SQL = f"""select strftime(o_orderdate, '%Y%m') as ym, {_STATUS_SQL} as status,
    cast(o_orderkey as varchar) as k, o_totalprice as amt, o_orderpriority as priority from orders"""


def _status_name():
    status = F.col("o_orderstatus")
    name = F.lit(_STATUS_NAMES["P"])
    for code in "OF":
        name = F.when(status == code, _STATUS_NAMES[code]).otherwise(name)
    return name


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "*",
        month_of(F.col("o_orderdate")).alias("ym"),
        _status_name().alias("status"),
    )


def _spec(kind, file, **settings):
    return table_spec("orders", {"type": kind, "file": file, "month_col": "ym", **settings})


def _scan(spark, folder, spec):
    return scan(spark, spec, folder, "199803").plain_rows()


def _fixed_line(status, width):
    """A fixed-width order line; ``status`` fills ``width`` bytes."""
    return F.concat(
        "ym", status, F.repeat(F.lit(" "), width),
        F.lpad(text(F.col("o_orderkey")), 10, " "),
        F.lpad(text(F.col("o_totalprice").cast("decimal(15,2)")), 15, " "),
        F.rpad("o_orderpriority", 16, " "),
    )


def s1_fwf_bytes(spark, sf):
    folder = work_dir(spark, "s1")
    line = _fixed_line(F.col("status"), 10 - 2 * F.length("status"))
    write_lines(_orders(spark, sf), line, f"{folder}/orders_199803.DAT", "cp949")
    spec = _spec("fwf", "orders_{yyyymm}.DAT", cols=_LAYOUT, numeric=["amt"])
    return _scan(spark, folder, spec)


def s2_fwf_chars(spark, sf):
    folder = work_dir(spark, "s2")
    line = _fixed_line(F.col("o_orderstatus"), F.lit(9))
    write_lines(_orders(spark, sf), line, f"{folder}/orders_199803.DAT")
    spec = _spec(
        "fwf", "orders_{yyyymm}.DAT", cols=_LAYOUT, numeric=["amt"], native=True, encoding="utf-8"
    )
    return _scan(spark, folder, spec)


def _pipe_line(delimiter="|"):
    return joined(
        delimiter, F.col("ym"), F.col("status"), F.col("o_orderkey"), F.col("o_totalprice"),
        F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")),
    )


_PIPE_COLS = ["ym", "status", "k", "amt", "priority"]
_PIPE_SQL = f"""select strftime(o_orderdate, '%Y%m') as ym, {_STATUS_SQL} as status, o_orderkey as k,
    o_totalprice as amt, nullif(o_orderpriority, '3-MEDIUM') as priority from orders"""


def s3_pipe(spark, sf):
    folder = work_dir(spark, "s3")
    write_lines(_orders(spark, sf), _pipe_line(), f"{folder}/orders_199803.dat")
    spec = _spec("pipe", "orders_{yyyymm}.DAT", cols=_PIPE_COLS, numeric=["amt"], bigint=["k"])
    return _scan(spark, folder, spec)


def s3b_pipe_lenient(spark, sf):
    """Lenient reading: white space of any kind goes, a blank field is NULL."""
    folder = work_dir(spark, "s3b")
    line = joined(
        "|", F.col("o_orderkey"), F.concat(F.lit(" \t"), "o_orderstatus", F.lit("　")),
        F.when(F.col("o_orderpriority") == "5-LOW", "  ").otherwise(F.col("o_orderpriority")),
    )
    write_lines(table(spark, sf, "orders"), line, f"{folder}/orders.dat")
    spec = _spec("pipe", "orders.dat", cols=["k", "st", "priority"], encoding="utf-8")
    return scan(spark, spec, folder, "199803").lenient().rows


def s4_csv(spark, sf):
    """Names with commas and quotes; the last field is left off on every third line."""
    folder = work_dir(spark, "s4")
    name = F.concat(F.lit('"'), F.replace("p_name", F.lit(" "), F.lit(', ""')), F.lit('"'))
    line = F.when(
        F.col("p_partkey") % 3 == 0, joined(",", F.col("p_partkey"), name)
    ).otherwise(joined(",", F.col("p_partkey"), name, F.col("p_retailprice")))
    write_lines(table(spark, sf, "part"), line, f"{folder}/part.csv")
    spec = _spec("csv", "part.csv", cols=["k", "name", "price"], numeric=["price"])
    return _scan(spark, folder, spec)


def s4_csv_header(spark, sf):
    """Names from the header line of each part file; a row of the table equals the header."""
    folder = work_dir(spark, "s4h")
    first = F.col("c_custkey") == 1
    named = table(spark, sf, "customer").select(
        F.when(first, "c_custkey").otherwise(F.col("c_custkey").cast("string")).alias("c_custkey"),
        F.when(first, "c_name").otherwise(F.col("c_name")).alias("c_name"),
        F.when(first, "c_acctbal").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"))
    named.write.option("header", True).csv(f"{folder}/customer.csv")
    spec = _spec("csv", "customer.csv", header=True, numeric=["c_acctbal"])
    return _scan(spark, folder, spec)


def s5_auto_names(spark, sf):
    folder = work_dir(spark, "s5")
    line = joined("|", F.col("s_suppkey"), F.col("s_name"), F.col("s_acctbal"))
    write_lines(table(spark, sf, "supplier"), line, f"{folder}/supplier.dat")
    return _scan(spark, folder, _spec("pipe", "supplier.dat"))


def s6_width_pad(spark, sf):
    """The file has more fields than the layout has names."""
    folder = work_dir(spark, "s6")
    line = joined("|", F.col("page_id"), F.col("url"), F.lit("x"), F.lit("y"))
    write_lines(table(spark, sf, "pages"), line, f"{folder}/pages.dat")
    spec = _spec("pipe", "pages.dat", cols=["k", "url"], bigint=["k"])
    return _scan(spark, folder, spec)


def _uneven(spark, sf, label):
    """Lines with two to four fields, three being right; the first line has three."""
    folder = work_dir(spark, label)
    extra = F.col("o_orderkey") % 5
    line = F.when(
        extra == 1, joined("|", F.col("o_orderkey"), F.col("o_orderstatus"))
    ).when(
        extra == 2,
        joined("|", F.col("o_orderkey"), F.col("o_orderstatus"), F.lit("x"), F.lit("more")),
    ).otherwise(joined("|", F.col("o_orderkey"), F.col("o_orderstatus"), F.lit('"a|b"')))
    write_lines(table(spark, sf, "orders"), line, f"{folder}/orders.dat")
    spec = _spec("pipe", "orders.dat", cols=["k", "st", "note"], bigint=["k"], encoding="utf-8")
    return scan(spark, spec, folder, "199803").lenient()


def s7_lenient(spark, sf):
    return _uneven(spark, sf, "s7").rows


def s7_rejected(spark, sf):
    """Over-long lines are set aside whole."""
    return _uneven(spark, sf, "s7r").rejected.select("line", "fields", "expected")


def s8_select_cols(spark, sf):
    folder = work_dir(spark, "s8")
    write_lines(_orders(spark, sf), _pipe_line(), f"{folder}/orders.dat")
    spec = _spec(
        "pipe", "orders.dat", cols=_PIPE_COLS, numeric=["amt"], select_cols=["amt", "ym"],
        encoding="utf-8",
    )
    return _scan(spark, folder, spec)


_DAMAGED = ("{p}", " {k} ", "{k}.5", "-{k}.5", "{k}d", "1,{k}", "", "{k}e2", "0x{k}", "NaN", "inf", "1_{k}")


def _damaged():
    """The order key as text, spoiled in turn by each of the ways above."""
    key = text(F.col("o_orderkey"))
    out = F.lit(None).cast("string")
    for i, form in reversed(list(enumerate(_DAMAGED))):
        value = F.replace(F.lit(form), F.lit("{k}"), key)
        value = F.replace(value, F.lit("{p}"), text(F.col("o_totalprice")))
        out = F.when(F.col("o_orderkey") % len(_DAMAGED) == i, value).otherwise(out)
    return out


def s9_typed(spark, sf):
    """Text to double and bigint; what is no number becomes NULL. NaN is shown as text."""
    rows = table(spark, sf, "orders").select("o_orderkey", _damaged().alias("s"))
    d = to_double(F.col("s"))
    return rows.select(
        F.col("o_orderkey").alias("k"),
        "s",
        F.when(~F.isnan(d) & (F.abs(d) < 1e300), d).alias("d"),
        F.isnan(d).alias("is_nan"),
        (d > 1e300).alias("is_inf"),
        to_bigint(F.col("s")).alias("b"),
    )


def _damaged_sql():
    forms = []
    for i, form in enumerate(_DAMAGED):
        value = f"replace('{form}', '{{k}}', cast(o_orderkey as varchar))"
        if "{p}" in form:
            value = "cast(o_totalprice as varchar)"
        forms.append(f"when {i} then {value}")
    return f"case o_orderkey % {len(_DAMAGED)} {' '.join(forms)} end"


def _compressed(spark, sf, label, name, compression):
    folder = work_dir(spark, label)
    write_lines(_orders(spark, sf), _pipe_line(), f"{folder}/{name}", "cp949", compression)
    spec = _spec("pipe", name, cols=_PIPE_COLS, numeric=["amt"], bigint=["k"])
    return _scan(spark, folder, spec)


def s10_gzip(spark, sf):
    return _compressed(spark, sf, "s10", "orders.dat.gz", "gzip")


def s10_zip(spark, sf):
    """Zip archives of two members each; one archive per task."""
    folder = work_dir(spark, "s10z")
    with charset_settings(spark):
        lines = _orders(spark, sf).select(encoded(_pipe_line(), "cp949").alias("value"))
    lines.repartition(4).mapInArrow(_write_archive(folder), "written bigint").count()
    spec = _spec(
        "pipe", "orders_*.zip", cols=_PIPE_COLS, numeric=["amt"], bigint=["k"], multi=True,
        encoding="cp949",
    )
    return _scan(spark, folder, spec)


def _write_archive(folder):
    """Write the lines of a task into one archive: a member for each half of every batch, and an empty folder."""
    def write(batches):
        import zipfile

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        name = f"{folder}/orders_{TaskContext.get().partitionId()}.zip"
        if "://" in name or name.startswith("file:"):
            system, path = fs.FileSystem.from_uri(name)
        else:
            system, path = fs.LocalFileSystem(), name
        written = 0
        with system.open_output_stream(path) as out, zipfile.ZipFile(out, "w") as archive:
            archive.mkdir("empty")
            for n, batch in enumerate(batches):
                lines = batch.column("value").to_pylist()
                written += len(lines)
                half = len(lines) // 2
                for part in (lines[:half], lines[half:]):
                    archive.writestr(f"orders_{n}_{len(part)}_{len(archive.namelist())}.dat",
                                     b"".join(line + b"\n" for line in part))
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["written"])

    return write


def _two_encodings(spark, sf, label):
    """The same lines twice: one file in cp949 and one in UTF-8, as one task writes one file."""
    folder = work_dir(spark, label)
    orders = _orders(spark, sf)
    for encoding in ("cp949", "utf-8"):
        name = encoding.replace("-", "")
        write_lines(orders, _pipe_line(), f"{folder}/part_{name}.dat", encoding)
    return folder


def s11_encoding_profile(spark, sf):
    """Encoding and line counts per file, added up per encoding."""
    folder = _two_encodings(spark, sf, "s11")
    profile = profile_encodings(raw_lines(spark, [f"{folder}/part_{e}.dat" for e in ("cp949", "utf8")]))
    return profile.groupBy("encoding").agg(
        F.sum("line_count").alias("line_count"), F.sum("invalid_lines").alias("invalid_lines")
    )


def s12_transcode(spark, sf):
    """A cp949 extract read as UTF-8 text without a declared encoding."""
    folder = work_dir(spark, "s12")
    write_lines(_orders(spark, sf), _pipe_line(), f"{folder}/orders.dat", "cp949")
    spec = _spec("pipe", "orders.dat", cols=_PIPE_COLS, numeric=["amt"], bigint=["k"])
    return _scan(spark, folder, spec)


def s12_round_trip(spark, sf):
    """Encoded to cp949 and decoded again inside one plan."""
    with charset_settings(spark):
        names = _orders(spark, sf).select(
            F.col("o_orderkey").alias("k"), encoded(F.col("status"), "cp949").alias("raw")
        )
        return names.select(
            "k", F.octet_length("raw").alias("size"), F.decode("raw", "x-windows-949").alias("name")
        )


def s13_latest_file(spark, sf):
    """The last file name per pattern, from a listing with one name per order and day."""
    names = table(spark, sf, "orders").select(
        F.concat(
            F.lit("bt"), F.substring("o_orderpriority", 1, 1), F.lit("_"),
            F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".dat.gz"),
        ).alias("name")
    )
    return latest_files(names, ["bt1_1998????.dat.gz", "bt2_*", "bt9_*"])


def s14_multi_file(spark, sf):
    """Several files under one pattern, in two encodings that are not declared, read as one extract."""
    folder = work_dir(spark, "s14")
    orders = _orders(spark, sf)
    for status, encoding in (("F", "utf-8"), ("O", "cp949"), ("P", "cp949")):
        rows = orders.where(F.col("o_orderstatus") == status)
        write_lines(rows, _pipe_line(), f"{folder}/orders_{status}.dat", encoding)
    spec = _spec(
        "pipe", "orders_*.dat", cols=_PIPE_COLS, numeric=["amt"], bigint=["k"], multi=True
    )
    return _scan(spark, folder, spec)


def s16_json_layout(spark, sf):
    """The layout of a fixed-width file, given as JSON."""
    folder = work_dir(spark, "s16")
    line = F.concat(F.lpad(text(F.col("c_custkey")), 10, " "), F.rpad("c_name", 20, " "))
    write_lines(table(spark, sf, "customer"), line, f"{folder}/customer.dat")
    layout = layout_from_json(json.dumps([[[0, 10], "k"], [[10, 30], "name"]]))
    spec = table_spec("c", {
        "type": "fwf", "file": "customer.dat", "month_col": None, "native": True,
        "cols": [((f.start, f.end), f.name) for f in layout], "encoding": "utf-8",
    })
    return _scan(spark, folder, spec)


def s17_preview(spark, sf):
    """Row and column counts of an extract, and how many of the rows shown are rows of the table."""
    rows = s3_pipe(spark, sf)
    count, columns, head = preview(rows, 7)
    shown = spark.createDataFrame(head, rows.schema)
    there = shown.join(_orders(spark, sf).select(F.col("o_orderkey").alias("k")), "k", "left_semi")
    return there.agg(F.count(F.lit(1)).alias("shown")).select(
        "shown", F.lit(count).cast("bigint").alias("row_count"),
        F.lit(len(columns)).cast("bigint").alias("column_count"),
    )


def s18_dispatch(spark, sf):
    """The same orders from each kind of source, counted per kind."""
    orders = _orders(spark, sf)
    folder = work_dir(spark, "s18")
    line = _fixed_line(F.col("o_orderstatus"), F.lit(9))
    write_lines(orders, line, f"{folder}/fixed.dat")
    write_lines(orders, _pipe_line(), f"{folder}/pipe.dat")
    write_lines(orders, _pipe_line(","), f"{folder}/comma.csv")
    orders.select("ym", F.col("o_totalprice").alias("amt")).write.parquet(f"{folder}/cols.parquet")
    specs = {
        "fwf": _spec("fwf", "fixed.dat", cols=_LAYOUT, numeric=["amt"]),
        "pipe": _spec("pipe", "pipe.dat", cols=_PIPE_COLS, numeric=["amt"], encoding="utf-8"),
        "csv": _spec("csv", "comma.csv", cols=_PIPE_COLS, numeric=["amt"], encoding="utf-8"),
        "parquet": _spec("parquet", "cols.parquet", numeric=["amt"]),
    }
    out = None
    for kind, spec in specs.items():
        rows = _scan(spark, folder, spec).select(F.lit(kind).alias("kind"), "ym", "amt")
        out = rows if out is None else out.unionAll(rows)
    amount = F.sum(F.col("amt").cast("decimal(18,2)")).cast("double")
    return out.groupBy("kind").agg(F.count("ym").alias("cnt"), amount.alias("amt"))


def b1_read_stages(spark, sf):
    """Rows, columns and sums of the four read stages; the time is measured in bench.py."""
    folder = work_dir(spark, "b1")
    columns = [F.col(c) for c in table(spark, sf, "lineitem").columns]
    write_lines(table(spark, sf, "lineitem"), joined("|", *columns), f"{folder}/lineitem.dat")
    out = None
    for stage, df in read_stages(spark, [f"{folder}/lineitem.dat"], columns=7).items():
        width = len(df.columns)
        key, quantity = F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("double").alias("qty")
        rows = df.withColumns({"key": key, "qty": quantity}) if stage == "count" else df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("col_0").cast("bigint")).alias("key"),
            F.sum(F.col("col_4").cast("double")).alias("qty"),
            *[F.max(c).alias(c) for c in df.columns],
        )
        one = rows.select(
            F.lit(stage).alias("stage"), "rows", F.lit(width).cast("bigint").alias("columns"), "key", "qty"
        )
        out = one if out is None else out.unionAll(one)
    return out


def s6_quoted_fields(spark, sf):
    """Web pages as quoted fields: delimiters, quotes and line breaks inside are part of the text."""
    folder = work_dir(spark, "s6q")
    quoted = F.concat(F.lit('"'), F.replace("html", F.lit('"'), F.lit('""')), F.lit('"'))
    line = joined("|", F.col("page_id"), quoted, F.col("url"))
    write_lines(table(spark, sf, "pages"), line, f"{folder}/pages.dat")
    spec = _spec("pipe", "pages.dat", cols=["k", "html", "url"], bigint=["k"], multiline=True)
    return _scan(spark, folder, spec)


QUERIES = {
    name: f for name, f in list(globals().items())
    if name[0] in "sb" and name[1:2].isdigit()
}

ORACLE = {
    "s1_fwf_bytes": _ORDER_SQL,
    "s2_fwf_chars": _ORDER_SQL.replace(_STATUS_SQL, "o_orderstatus"),
    "s3_pipe": _PIPE_SQL,
    "s3b_pipe_lenient": """select cast(o_orderkey as varchar) as k, o_orderstatus as st,
        nullif(o_orderpriority, '5-LOW') as priority from orders""",
    "s4_csv": """select cast(p_partkey as varchar) as k, replace(p_name, ' ', ', "') as name,
        case when p_partkey % 3 <> 0 then p_retailprice end as price from part""",
    "s4_csv_header": """select case when c_custkey = 1 then 'c_custkey' else cast(c_custkey as varchar) end as c_custkey,
        case when c_custkey = 1 then 'c_name' else c_name end as c_name,
        case when c_custkey <> 1 then c_acctbal end as c_acctbal from customer""",
    "s5_auto_names": """select cast(s_suppkey as varchar) as col_0, s_name as col_1,
        cast(s_acctbal as varchar) as col_2 from supplier""",
    "s6_width_pad": "select page_id as k, url from pages",
    "s6_quoted_fields": "select page_id as k, nullif(html, '') as html, url from pages",
    "s7_lenient": """select o_orderkey as k, o_orderstatus as st,
        case when o_orderkey % 5 = 1 then null else 'a|b' end as note
        from orders where o_orderkey % 5 <> 2""",
    "s7_rejected": """select cast(o_orderkey as varchar) || '|' || o_orderstatus || '|x|more' as line,
        4 as fields, 3 as expected from orders where o_orderkey % 5 = 2""",
    "s8_select_cols": "select strftime(o_orderdate, '%Y%m') as ym, o_totalprice as amt from orders",
    "s9_typed": f"""select k, s, case when not isnan(d) and abs(d) < 1e300 then d end as d,
        coalesce(isnan(d), false) as is_nan,
        case when isnan(d) then true else d > 1e300 end as is_inf, try_cast(s as bigint) as b
        from (select *, try_cast(s as double) as d from (select o_orderkey as k,
        {_damaged_sql()} as s from orders) x) y""",
    "s10_gzip": _PIPE_SQL,
    "s10_zip": _PIPE_SQL,
    "s11_encoding_profile": """select 'cp949' as encoding, count(*) as line_count,
        count(*) as invalid_lines from orders
        union all select 'utf-8', count(*), 0 from orders""",
    "s12_transcode": _PIPE_SQL,
    "s12_round_trip": f"""select o_orderkey as k, cast(2 * length({_STATUS_SQL}) as int) as size,
        {_STATUS_SQL} as name from orders""",
    "s13_latest_file": """select p.pattern, max(n.name) as name, count(n.name) as matches from (values
        ('bt1_1998????.dat.gz', 'bt1\\_1998____.dat.gz'), ('bt2_*', 'bt2\\_%'), ('bt9_*', 'bt9\\_%'))
        p(pattern, l) left join (select 'bt' || substr(o_orderpriority, 1, 1) || '_' ||
        strftime(o_orderdate, '%Y%m%d') || '.dat.gz' as name from orders) n
        on n.name like p.l escape '\\' group by p.pattern""",
    "s14_multi_file": _PIPE_SQL,
    "s16_json_layout": "select cast(c_custkey as varchar) as k, c_name as name from customer",
    "s17_preview": """select cast(least(count(*), 7) as bigint) as shown, count(*) as row_count,
        cast(5 as bigint) as column_count from orders""",
    "s18_dispatch": """select kind, count(*) as cnt,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as amt
        from orders, (values ('fwf'), ('pipe'), ('csv'), ('parquet')) k(kind) group by kind""",
    "b1_read_stages": """select stage, (select count(*) from lineitem) as rows, columns,
        case when stage <> 'count' then (select cast(sum(l_orderkey) as bigint) from lineitem) end as key,
        case when stage <> 'count' then (select sum(l_quantity) from lineitem) end as qty from (values
        ('count', cast(1 as bigint)), ('all_text', 11), ('some_columns', 7),
        ('some_columns_cast', 7)) s(stage, columns)""",
}
