"""Encodings: decode two-byte Korean text in the scan, and profile files.

No converted copy of a file is written: the raw bytes of a line are decoded by a built-in
expression. Spark only knows the Korean charset under its Java name, and only replaces bad bytes
instead of failing, while two session settings are on. Both are captured when the DataFrame is
built, so they are set around that step and put back.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Encoding names that mean cp949 (a superset of EUC-KR), and those that mean UTF-8.
CP949_NAMES = ("cp949", "euc-kr", "euckr", "euc_kr", "ms949", "x-windows-949")
UTF8_NAMES = ("utf-8", "utf8", "ascii")

# A Boolean column that marks lines which are not valid UTF-8; a load counts it and does not store it.
GARBLED = "_garbled"

_KOREAN = "x-windows-949"
_SETTINGS = {
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
}


def charset_settings(spark: SparkSession):
    """The two charset settings, for the time in which a DataFrame is being built."""
    return session_settings(spark, _SETTINGS)


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]):
    """Change settings of the session and put them back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def is_utf8(encoding: str) -> bool:
    name = encoding.lower()
    if name in UTF8_NAMES:
        return True
    if name in CP949_NAMES:
        return False
    raise ValueError(f"unknown encoding: {encoding}")


def decoded(raw: Column, encoding: str) -> Column:
    """Bytes to text; a bad byte becomes U+FFFD. Build the select inside charset_settings."""
    if is_utf8(encoding):
        return F.make_valid_utf8(raw.cast("string"))
    return F.decode(raw, _KOREAN)


def encoded(text: Column, encoding: str) -> Column:
    """Text to bytes. Build the select inside charset_settings."""
    return F.encode(text, "utf-8" if is_utf8(encoding) else _KOREAN)


def decode_lines(lines: DataFrame, encoding: str, column: str = "value") -> DataFrame:
    """Replace the raw bytes of ``column`` by text."""
    if is_utf8(encoding):
        return lines.withColumn(column, F.make_valid_utf8(F.col(column)))
    with charset_settings(lines.sparkSession):
        return lines.withColumn(column, decoded(F.col(column).cast("binary"), encoding))


def hopeful_lines(lines: DataFrame) -> DataFrame:
    """Lines of unknown encoding, to be read as UTF-8, with a mark on those that are not."""
    return lines.withColumn(GARBLED, ~F.is_valid_utf8("value"))


def hopeful_fields(records: DataFrame) -> DataFrame:
    """The same for records that are arrays of fields."""
    return records.withColumn(GARBLED, F.exists("_f", lambda f: ~F.is_valid_utf8(F.coalesce(f, F.lit("")))))


def profile_encodings(lines: DataFrame, file_col: str = "file") -> DataFrame:
    """Per file: its encoding, its lines, and its lines that are not valid UTF-8.

    A file whose every line is valid UTF-8 is UTF-8, any other is cp949. Every byte is looked at,
    not a sample; the partial aggregation leaves one row per file and task to shuffle.
    """
    valid = F.is_valid_utf8("value")
    return (
        lines.groupBy(file_col)
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.count_if(~valid).alias("invalid_lines"),
        )
        .select(
            file_col,
            F.when(F.col("invalid_lines") == 0, "utf-8").otherwise("cp949").alias("encoding"),
            "line_count",
            "invalid_lines",
        )
    )
