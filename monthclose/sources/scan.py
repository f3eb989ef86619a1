"""From a table specification to DataFrames."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.functions.casts import strip_all, to_double
from monthclose.functions.months import fill_month
from monthclose.sources import delimited, files, layouts
from monthclose.sources.delimited import BAD
from monthclose.sources.encoding import GARBLED, decode_lines, hopeful_fields, hopeful_lines, profile_encodings
from monthclose.sources.fixed import parse_fixed_bytes, parse_fixed_chars
from monthclose.sources.jdbc import read_query
from monthclose.sources.layouts import TableSpec
from monthclose.sources.lines import first_line, raw_lines



@dataclass
class Extract:
    """A readable extract.

    ``rows`` is the strict reading. Where lines can be malformed it has a Boolean column BAD; if any
    is true, the whole extract has to be read again with ``lenient()``.

    Where the encoding is not declared, ``rows`` first looks at every line of every file. A load spares
    itself that: it writes ``hopeful``, the reading as UTF-8 with a Boolean column GARBLED, and only if
    that is true somewhere are the files looked at and read again.

    ``spanning`` is the strict reading of an extract whose quoted fields go on in the next line; None if they do not.
    """

    strict: Callable[[], DataFrame]
    label: str
    lenient: Callable[[], delimited.Rows] | None = None
    hopeful: DataFrame | None = None
    spanning: Callable[[], DataFrame | None] = lambda: None

    @cached_property
    def rows(self) -> DataFrame:
        return self.strict()

    def plain_rows(self) -> DataFrame:
        return self.rows.drop(BAD)


def find_files(
    spark: SparkSession, spec: TableSpec, folder: str, month: str, params: Mapping = {}
) -> list[str]:
    """Paths of the files a specification names for a month."""
    pattern = fill_month(spec.file, month, params)
    names = files.resolve_files(files.list_names(spark, folder), pattern, spec.multi)
    return [f"{folder.rstrip('/')}/{name}" for name in names]


def file_label(paths: list[str], spec: TableSpec) -> str:
    """What the load registry remembers: the file name, or how many files there were and a mark of their names."""
    names = sorted(path.rsplit("/", 1)[-1] for path in paths)
    if not spec.multi:
        return names[-1]
    return f"{len(names)} files {hashlib.sha256('/'.join(names).encode()).hexdigest()[:16]}"


def scan(
    spark: SparkSession, spec: TableSpec, folder: str, month: str, params: Mapping = {}
) -> Extract:
    """Read one specification for one month."""
    if spec.type == layouts.DATABASE:
        return Extract(lambda: read_query(spark, spec.database, month), label="query")
    return scan_paths(spark, spec, find_files(spark, spec, folder, month, params))


def scan_paths(spark: SparkSession, spec: TableSpec, paths: list[str]) -> Extract:
    label = file_label(paths, spec)
    if spec.type == layouts.COLUMNAR:
        return Extract(lambda: scan_columnar(spark, spec, paths), label)
    if spec.type == layouts.FIXED:
        return scan_fixed(spark, spec, paths, label)
    return scan_delimited(spark, spec, paths, label)


def scan_columnar(spark: SparkSession, spec: TableSpec, paths: list[str]) -> DataFrame:
    """A dataset that brings its own column names and types; text is stripped."""
    df = spark.read.parquet(*paths)
    out = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if name in spec.numeric:
            c = to_double(strip_all(c)) if dtype == "string" else c.cast("double")
        elif dtype == "string":
            c = strip_all(c)
        out.append(c.alias(name))
    return df.select(*out)


def scan_fixed(spark: SparkSession, spec: TableSpec, paths: list[str], label: str = "") -> Extract:
    if not spec.native:
        lines = raw_lines(spark, paths, newline_only=True)
        return Extract(
            lambda: parse_fixed_bytes(lines, spec.cols, spec.numeric, spec.encoding or "cp949"), label
        )
    lines = raw_lines(spark, paths)

    def parse(part: DataFrame, encoding: str, keep=()) -> DataFrame:
        return parse_fixed_chars(part, spec.cols, spec.numeric, encoding, keep)

    return _extract(spark, spec, paths, lines, parse, label)


def scan_delimited(
    spark: SparkSession, spec: TableSpec, paths: list[str], label: str = ""
) -> Extract:
    """Pipe-separated and CSV files."""
    sep = spec.separator
    sample = first_line(spark, paths[0]) or ""
    width = max(_width(spark, sample, sep), 1)
    archives = any(p.lower().endswith(".zip") for p in paths)
    if spec.multiline:
        if archives:
            raise ValueError(f"[{spec.name}] archives are read by lines, not with multiline")
        width = max(width, delimited.record_width(spark, paths[0], sep))
    names = tuple(spec.cols)
    header = spec.header
    if not names and spec.type == layouts.CSV:
        # Without a layout a CSV file has to bring its names in the first line.
        header, names = True, _header_names(spark, spec, paths[0], sep)
    elif not names:
        header, names = False, delimited.auto_names(width)
    spec = replace(spec, cols=names)
    lines = raw_lines(spark, paths, header=header)
    common = dict(
        names=names, delimiter=sep, width=width,
        numeric=spec.numeric, bigint=spec.bigint, select=spec.select_cols,
    )
    pad = spec.type == layouts.CSV

    def strict(part: DataFrame, encoding: str, keep=()) -> DataFrame:
        text = decode_lines(part, encoding)
        return delimited.parse_strict(text, trim=spec.trim, pad=pad, flag=BAD, keep=keep, **common)

    def lenient() -> delimited.Rows:
        parts = [
            delimited.parse_lenient(decode_lines(part, encoding), keep=["file"], **common)
            for part, encoding in _parts(spark, spec, paths, lines)
        ]
        rows, rejected = parts[0]
        for more in parts[1:]:
            rows, rejected = rows.union(more.rows), rejected.union(more.rejected)
        return delimited.Rows(rows.drop("file"), rejected)

    def records(part: DataFrame, encoding: str, keep=()) -> DataFrame:
        return delimited.parse_records(part, encoding=encoding, trim=spec.trim, pad=pad, keep=keep, **common)

    def raw() -> DataFrame:
        return delimited.raw_records(spark, paths, max(width, len(names)), sep, header)

    def spanning() -> DataFrame | None:
        if archives or not delimited.spans_lines(lines, sep):
            return None
        return _by_encoding(spark, spec, paths, raw(), records)

    if spec.multiline:
        return _extract(spark, spec, paths, raw(), records, label, lenient, hopeful_fields)
    extract = _extract(spark, spec, paths, lines, strict, label, lenient)
    return replace(extract, spanning=spanning)


def _width(spark: SparkSession, sample: str, sep: str) -> int:
    """Fields in the first line."""
    if '"' not in sample:
        return sample.count(sep) + 1
    one = spark.createDataFrame([(sample,)], "value string")
    return one.select(delimited.count_fields(F.col("value"), sep)).head()[0]


def _header_names(spark, spec, path, sep) -> tuple[str, ...]:
    encoding = spec.encoding or "utf-8"
    if not spec.encoding and "cp949" in _file_encodings(spark, [path]).values():
        encoding = "cp949"
    head = raw_lines(spark, [path], spread=False).limit(1)
    fields = delimited.split_fields(F.col("value"), sep)
    row = decode_lines(head, encoding).select(fields.alias("names")).head()
    names = row["names"] if row else []
    return tuple(n if n else f"col_{i}" for i, n in enumerate(names))


def _extract(spark, spec, paths, lines, parse, label, lenient=None, hope=hopeful_lines) -> Extract:
    """An extract of lines or records; with a hopeful reading where the encoding is not declared."""
    hopeful = None if spec.encoding else parse(hope(lines), "utf-8", [GARBLED])
    return Extract(
        lambda: _by_encoding(spark, spec, paths, lines, parse), label, lenient, hopeful
    )


def _by_encoding(spark, spec, paths, lines, parse) -> DataFrame:
    parts = [parse(part, encoding) for part, encoding in _parts(spark, spec, paths, lines)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _parts(spark, spec, paths, lines):
    """The lines, once per encoding among the files."""
    if spec.encoding:
        return [(lines, spec.encoding)]
    encodings = _file_encodings(spark, paths)
    korean = sorted(name for name, encoding in encodings.items() if encoding == "cp949")
    if not korean:
        return [(lines, "utf-8")]
    if len(korean) == len(encodings):
        return [(lines, "cp949")]
    # A filter on the file name prunes the listing, so each part opens its own files only.
    is_korean = F.col("file").isin(korean)
    return [(lines.where(is_korean), "cp949"), (lines.where(~is_korean), "utf-8")]


def _file_encodings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Encoding per file name. The result has one small row per file; the reading is distributed.

    A file without lines has no row; it has nothing to decode either.
    """
    profile = profile_encodings(raw_lines(spark, paths, spread=False))
    return {row["file"]: row["encoding"] for row in profile.collect()}


def preview(df: DataFrame, n: int = 5) -> tuple[int, list[str], list]:
    """Row count, column names and the first rows, for a look at an extract."""
    return df.count(), df.columns, df.limit(n).collect()


__all__ = [
    "BAD", "Extract", "file_label", "find_files", "preview",
    "scan", "scan_columnar", "scan_delimited", "scan_fixed", "scan_paths",
]
