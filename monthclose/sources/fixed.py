"""Fixed-width lines, by byte position (two-byte text never shifts a field) or by character."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.functions.casts import rarely, strip_all, to_double
from monthclose.sources.encoding import charset_settings, decoded
from monthclose.sources.layouts import Field

_NOT_BLANK = r"[^\r\n]"
_PRINTABLE = r"^[ -~]*\r?\z"


def parse_fixed_bytes(
    lines: DataFrame,
    layout: Sequence[Field],
    numeric: Collection[str] = (),
    encoding: str = "cp949",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Slice the bytes of a line, decode each field and strip it.

    Blank lines are dropped. A field past the end of a short line is ``''``, or NULL as a number.
    """
    def other(field: Field) -> Column:
        # A number is ASCII wherever it stands, and so are most fields of a line with other text.
        def text(piece: Column) -> Column:
            raw = piece.cast("string")
            if field.name in numeric:
                return strip_all(raw)
            return F.when(raw.rlike(_PRINTABLE), F.trim(raw)).otherwise(
                strip_all(decoded(piece, encoding))
            )

        return rarely(_slice(F.col("_raw"), field), text)

    with charset_settings(lines.sparkSession):
        return _parse(_raw_lines(lines, keep), layout, numeric, other, keep)


def parse_fixed_chars(
    lines: DataFrame,
    layout: Sequence[Field],
    numeric: Collection[str] = (),
    encoding: str = "utf-8",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Slice by character position; right for ASCII files, and for text with one-cell characters."""
    def other(field: Field) -> Column:
        return rarely(
            F.col("_raw"), lambda raw: F.trim(_slice(decoded(raw, encoding), field))
        )

    with charset_settings(lines.sparkSession):
        return _parse(_raw_lines(lines, keep), layout, numeric, other, keep)


def _raw_lines(lines: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The bytes of each line that is not blank, and whether they are printable ASCII."""
    line = F.col("value")
    without_return = F.substring(line.cast("binary"), F.lit(1), F.octet_length(line) - 1)
    return lines.where(line.rlike(_NOT_BLANK)).select(
        F.when(line.endswith("\r"), without_return).otherwise(line.cast("binary")).alias("_raw"),
        line.rlike(_PRINTABLE).alias("_printable"),
        *keep,
    )


def _parse(raw, layout, numeric, other, keep) -> DataFrame:
    """Fields as text, then as numbers (a second projection, for a cast looks at its text twice).

    In a printable line bytes are characters and only spaces can be stripped, so that it is cut up without
    being decoded. For any other line ``other`` gives the text of a field.
    """
    layout = [Field(start, end, name) for start, end, name in layout]
    texts = [
        F.when(F.col("_printable"), F.trim(_slice(F.col("_raw"), field).cast("string")))
        .otherwise(other(field))
        .alias(field.name)
        for field in layout
    ]
    values = [
        to_double(F.col(f"`{f.name}`")).alias(f.name) if f.name in numeric else F.col(f"`{f.name}`")
        for f in layout
    ]
    return raw.select(*texts, *keep).select(*values, *keep)


def _slice(value: Column, field: Field) -> Column:
    return F.substring(value, field.start + 1, field.end - field.start)
