"""Month arithmetic and query parameters.

A month is the six-character string ``YYYYMM``. The plain functions are used once per run to name
tables and files; the column functions do the same for a whole DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prev_month(month: str, n: int = 1) -> str:
    """The month ``n`` months before ``month``; a negative ``n`` goes forward."""
    index = int(month[:4]) * 12 + int(month[4:]) - 1 - n
    return f"{index // 12}{index % 12 + 1:02d}"


def month_params(month: str) -> dict[str, str]:
    """The parameters every query may use as ``${KEY}``."""
    return {
        "SDM": month,
        "LM": prev_month(month, 1),
        "LM2": prev_month(month, 2),
        "YYYY": month[:4],
        "MM": month[4:],
        "yyyymm": month,
    }


def fill_params(text: str, params: Mapping[str, object]) -> str:
    """Put parameter values in place of ``${KEY}``; an unknown key stays as it is."""
    for key, value in params.items():
        text = text.replace("${" + key + "}", str(value))
    return text


def fill_month(text: str, month: str, params: Mapping[str, object]) -> str:
    """Fill ``{yyyymm}`` and then ``${KEY}``."""
    return fill_params(text.replace("{yyyymm}", month), params)


def month_of(ts: Column) -> Column:
    """``YYYYMM`` of a date or timestamp column."""
    return (F.year(ts) * 100 + F.month(ts)).cast("string")


def in_months(ts: Column, first: str, last: str) -> Column:
    """Whether a timestamp lies in a range of months. As a range it can be pushed down to the scan."""
    end = prev_month(last, -1)
    return (ts >= F.lit(f"{first[:4]}-{first[4:]}-01").cast("timestamp_ntz")) & (
        ts < F.lit(f"{end[:4]}-{end[4:]}-01").cast("timestamp_ntz")
    )


def shift_month(month: Column, n: int = 1) -> Column:
    """Column form of :func:`prev_month`."""
    return F.date_format(F.add_months(F.to_date(month, "yyyyMM"), -n), "yyyyMM")


def with_month_params(df: DataFrame, month: str) -> DataFrame:
    """Add the standard parameters of a month column as columns."""
    m = F.col(month)
    return df.select(
        "*",
        m.alias("SDM"),
        shift_month(m, 1).alias("LM"),
        shift_month(m, 2).alias("LM2"),
        F.substring(m, 1, 4).alias("YYYY"),
        F.substring(m, 5, 2).alias("MM"),
    )
