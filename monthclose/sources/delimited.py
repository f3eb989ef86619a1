"""Delimited lines: pipe-separated extracts and CSV.

A line becomes an array of fields, from which only the wanted columns are taken; an empty field is
NULL. A line without a quote (nearly every line) is split at the delimiter, and only a line with one pays
for a pattern. The patterns use possessive repeats, so a quoted field of any length is matched without
recursion.

Where quoted fields hold line breaks, lines are put together to records first (``records.py``), and Spark's CSV parser takes them apart
(``raw_records``).
"""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.functions.casts import strip_all, to_bigint, to_double
from monthclose.sources.encoding import charset_settings, decoded
from monthclose.sources.records import whole_records

QUOTE = '"'
# A Boolean column that marks malformed lines; a load counts it and does not store it.
BAD = "_bad"


class Rows(NamedTuple):
    """Parsed rows, and the lines that have too many fields to be rows."""

    rows: DataFrame
    rejected: DataFrame


def _patterns(delimiter: str) -> tuple[str, str, str]:
    """Delimiter, complete quoted field (one space may precede it) and plain field."""
    sep = re.escape(delimiter)
    quoted = rf" ?+{QUOTE}[^{QUOTE}]*+(?:{QUOTE}{QUOTE}[^{QUOTE}]*+)*+{QUOTE}(?=\s*(?:{sep}|$))"
    plain = rf"[^{sep}]*+" if len(delimiter) == 1 else rf"(?:(?!{sep}).)*+"
    return sep, quoted, plain


def split_fields(line: Column, delimiter: str) -> Column:
    """The fields of a line. Quotes are taken off in a lambda, for lines that have any."""
    sep, quoted, plain = _patterns(delimiter)
    pieces = F.regexp_extract_all(
        F.concat(F.lit(delimiter), line), F.lit(rf"{sep}({quoted}|{plain})"), F.lit(1)
    )
    return F.when(line.contains(QUOTE), F.transform(pieces, _unquoted)).otherwise(
        F.split(line, sep, -1)
    )


def _unquoted(field: Column) -> Column:
    text = F.when(field.startswith(" " + QUOTE), F.substring(field, 2, 1 << 30)).otherwise(field)
    inner = F.replace(
        F.substring(text, F.lit(2), F.length(text) - 2), F.lit(QUOTE * 2), F.lit(QUOTE)
    )
    closed = text.startswith(QUOTE) & text.endswith(QUOTE) & (F.length(text) > 1)
    return F.when(closed, inner).otherwise(field)


def count_fields(line: Column, delimiter: str) -> Column:
    """How many fields a line has; a delimiter inside quotes does not count."""
    plain = (
        F.octet_length(line) - F.octet_length(F.replace(line, F.lit(delimiter), F.lit("")))
    ) / len(delimiter.encode()) + 1
    return F.when(line.contains(QUOTE), F.size(split_fields(line, delimiter))).otherwise(
        plain.cast("int")
    )


def _malformed(fields: Column, open_quote: Column, width: int, pad: bool) -> Column:
    """Whether a strict reader refuses the line: wrong field count or a quote left open.

    One empty field too many (a delimiter at the end of the line) is accepted, and with ``pad`` also
    too few fields.
    """
    n = F.size(fields)
    fits = (n <= width) if pad else (n == width)
    extra_end = (n == width + 1) & (F.get(fields, F.lit(width)) == "")
    return ~(fits | extra_end) | open_quote


def _open_quote(line: Column, delimiter: str) -> Column:
    """Whether some field starts with a quote and does not end with one."""
    sep, quoted, plain = _patterns(delimiter)
    complete = rf"^(?:{sep}(?:{quoted}\s*+|(?! ?{QUOTE}){plain}))*+$"
    return line.contains(QUOTE) & ~F.concat(F.lit(delimiter), line).rlike(complete)


def parse_strict(
    lines: DataFrame,
    names: Sequence[str],
    delimiter: str = "|",
    width: int | None = None,
    numeric: Collection[str] = (),
    bigint: Collection[str] = (),
    select: Collection[str] = (),
    trim: bool = False,
    pad: bool = False,
    flag: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every line as a row. With ``flag``, a column of that name marks malformed lines.

    ``width`` is the number of fields in the file (columns past ``names`` are not selected), and
    ``select`` the columns wanted, always returned in file order.
    """
    texts, values = _typed(names, numeric, bigint, select, lambda c: F.trim(c) if trim else c)
    line, fields = F.col("value"), [split_fields(F.col("value"), delimiter).alias("_f")]
    if flag:
        expected = max(width or 0, len(names))
        fields.append(_open_quote(line, delimiter).alias("_open"))
        texts.append(_malformed(F.col("_f"), F.col("_open"), expected, pad).alias(flag))
        values.append(F.col(flag))
    return (
        _nonblank(lines).select(*fields, *keep).select(*texts, *keep).select(*values, *keep)
    )


def _record_options(delimiter: str) -> dict[str, str]:
    """How Spark's parser takes a record apart. Every byte is one character, to be decoded later."""
    return {"sep": delimiter, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "lineSep": "\n", "maxCharsPerColumn": "-1",
            "columnNameOfCorruptRecord": "_record"}


def record_width(spark: SparkSession, path: str, delimiter: str) -> int:
    """Fields in the first record."""
    reader = spark.read.options(**_record_options(delimiter), encoding="ISO-8859-1", columnPruning=False)
    return len(reader.csv(path).columns)


def raw_records(
    spark: SparkSession, paths: Sequence[str], width: int, delimiter: str = "|", header: bool = False
) -> DataFrame:
    """Records of files in which quoted fields may hold line breaks.

    ``_f`` has the undecoded fields, ``_record`` the text of a record with more or fewer fields than ``width``, and ``file``
    the file name. With ``header`` the first record of each file is left out.
    """
    columns = [f"_{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in [*columns, "_record"])
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    parsed = whole_records(spark, paths, header).select(F.from_csv(text, schema, _record_options(delimiter)).alias("_r"), "file")

    def raw(name: str) -> Column:
        return F.encode(F.col(f"_r.{name}"), "ISO-8859-1").cast("string")

    return parsed.select(F.array(*map(raw, columns)).alias("_f"), raw("_record").alias("_record"), "file")


def parse_records(
    records: DataFrame,
    names: Sequence[str],
    encoding: str,
    delimiter: str = "|",
    width: int | None = None,
    numeric: Collection[str] = (),
    bigint: Collection[str] = (),
    select: Collection[str] = (),
    trim: bool = False,
    pad: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The records of ``raw_records`` as ``parse_strict`` gives lines, with a column BAD."""
    spark = records.sparkSession
    texts, values = _typed(names, numeric, bigint, select, lambda c: F.trim(c) if trim else c)
    record = F.col("_record")
    malformed = _malformed(
        split_fields(record, delimiter), _open_quote(record, delimiter), max(width or 0, len(names)), pad)
    bad = F.coalesce(record.isNotNull() & malformed, F.lit(False)).alias(BAD)
    with charset_settings(spark):
        text = F.transform("_f", lambda f: decoded(f.cast("binary"), encoding))
        fields = records.select(text.alias("_f"), bad, *keep)
    return fields.select(*texts, BAD, *keep).select(*values, BAD, *keep)


def spans_lines(lines: DataFrame, delimiter: str) -> bool:
    """Whether quoted fields go on in the next line: some line leaves a quote open, and no file has an odd number of quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE), F.lit("")))
    files = lines.groupBy("file").agg(
        F.bool_or(_open_quote(F.col("value"), delimiter)).alias("open"), (F.sum(quotes) % 2).alias("odd"))
    found = files.agg(F.bool_or("open").alias("open"), F.max("odd").alias("odd")).first()
    return bool(found["open"]) and not found["odd"]


def parse_lenient(
    lines: DataFrame,
    names: Sequence[str],
    delimiter: str = "|",
    width: int | None = None,
    numeric: Collection[str] = (),
    bigint: Collection[str] = (),
    select: Collection[str] = (),
    keep: Sequence[str] = (),
    strip: bool = True,
) -> Rows:
    """Short lines are filled up with NULL, text is stripped, over-long lines are set aside whole."""
    texts, values = _typed(names, numeric, bigint, select, strip_all if strip else lambda c: c)
    limit = max(width or 0, len(names))
    line = F.col("value")
    n = count_fields(line, delimiter)
    too_long = (n > limit) & ~((n == limit + 1) & line.endswith(delimiter))
    data = _nonblank(lines)
    rows = (
        data.where(~too_long)
        .select(split_fields(line, delimiter).alias("_f"), *keep)
        .select(*texts, *keep)
        .select(*values, *keep)
    )
    rejected = data.where(too_long).select(
        line.alias("line"), n.alias("fields"), F.lit(limit).alias("expected"), *keep
    )
    return Rows(rows, rejected)


def auto_names(width: int) -> tuple[str, ...]:
    """Positional names for a file without a header or a layout."""
    return tuple(f"col_{i}" for i in range(width))


def _nonblank(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value") != "")


def _typed(names, numeric, bigint, select, clean) -> tuple[list[Column], list[Column]]:
    """The wanted columns as clean text from the field array, and then cast.

    These are two projections: a cast looks at its text more than once, and would otherwise take it out of
    the array each time.
    """
    unknown = set(select) - set(names)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    texts, values = [], []
    for i, name in enumerate(names):
        if select and name not in select:
            continue
        text = F.nullif(clean(F.get(F.col("_f"), F.lit(i))), F.lit(""))
        value = F.col(f"`{name}`")
        if name in bigint:
            value = to_bigint(value)
        elif name in numeric:
            value = to_double(value)
        texts.append(text.alias(name))
        values.append(value.alias(name))
    return texts, values
