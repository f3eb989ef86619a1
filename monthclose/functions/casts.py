"""Text clean-up and lenient casts: a value that is no number becomes NULL, never an error.

Everything here is a built-in expression. What only a rare value needs is kept in a lambda (``rarely``):
Spark compiles a projection of plain expressions into one method, and the JVM leaves a method of more
than 8000 bytes of code uncompiled, which a table of thirty cast columns would exceed several times. A
projection with a lambda is compiled column by column instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode text stripping removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Possessive, so that a long run of digits that ends badly is not tried again digit by digit.
_NUMBER = r"^\s*+[+-]?(?:[0-9]++(?:[.][0-9]*+)?|[.][0-9]++)(?:[eE][+-]?[0-9]++)?\s*+$"


def strip_all(c: Column) -> Column:
    """Strip every kind of white space; ``trim`` alone strips spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def rarely(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)``, as a lambda over an array of one."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def to_double(c: Column) -> Column:
    """Text to double with SQL rules.

    Spark reads ``1d`` and ``0x1p3`` as numbers and not ``1_000``, and a cast of something that is no number
    throws and catches an exception inside, at a hundred times the cost. So the text is looked at
    first, and only what is a number for certain is cast.
    """
    def unusual(x: Column) -> Column:
        digits = _without_separators(x)
        named = x.rlike(r"(?i)^\s*([+-]?inf(inity)?|nan)\s*$")
        return F.when(named | digits.rlike(_NUMBER), digits.try_cast("double"))

    return (
        F.when(c.rlike(_NUMBER), c.try_cast("double"))
        .when(c.rlike("[_nN]"), rarely(c, unusual))
    )


def to_bigint(c: Column) -> Column:
    """Text to bigint with SQL rules: a fraction or exponent is accepted and rounded half up.

    So are the digit separator ``_`` and numbers written as ``0x1f`` or ``0b101``. An integer pays for one
    pattern and one cast, a short number such as ``17.0`` for two patterns.
    """
    def unusual(digits: Column) -> Column:
        # A decimal keeps 18 places; cutting off the rest first keeps 1.4999… below one half.
        cut = F.regexp_replace(digits, r"([.][0-9]{18})[0-9]+", "$1")
        by_decimal = F.round(cut.try_cast("decimal(38,18)"), 0).try_cast("bigint")
        hexadecimal, binary = (F.conv(F.substring(digits, 3, 64), base, 10) for base in (16, 2))
        return (
            F.when(digits.rlike(_NUMBER), by_decimal)
            .when(digits.rlike(r"^0[xX][0-9a-fA-F]+$"), hexadecimal.try_cast("bigint"))
            .when(digits.rlike(r"^0[bB][01]+$"), binary.try_cast("bigint"))
        )

    # Up to 15 characters a double holds every digit, so that its half is the half of the text.
    short = (F.octet_length(c) <= 15) & c.rlike(r"^[+-]?[0-9]++[.][0-9]*+$")
    d = F.when(short, c.try_cast("double"))
    by_double = (F.signum(d) * F.floor(F.abs(d) + 0.5)).cast("bigint")
    return (
        F.when(c.rlike(r"^\s*[+-]?[0-9]{1,18}\s*$"), c.try_cast("bigint"))
        .when(short, by_double)
        .when(c.rlike("[0-9]"), rarely(_without_separators(c), unusual))
    )


def _without_separators(c: Column) -> Column:
    """Drop an underscore between two digits."""
    return F.regexp_replace(c, r"(?<=[0-9a-fA-F])_(?=[0-9a-fA-F])", "")


def double_to_bigint(c: Column) -> Column:
    """A double column to bigint by rounding half away from zero (a plain cast cuts it off)."""
    return F.round(c.try_cast("decimal(38,10)"), 0).try_cast("bigint")


def month_text(c: Column, dtype: str) -> Column:
    """A month column as text; a number goes through bigint, for ``2.02601E5`` is no month."""
    if dtype == "string":
        return c
    if dtype in ("double", "float") or dtype.startswith("decimal"):
        return double_to_bigint(c.cast("double")).cast("string")
    return c.cast("string")


def total(c: Column) -> Column:
    """Sum in the column's own type: doubles as doubles (NaN stays NaN), decimals exactly.

    The last digits of a sum of doubles depend on the order of the rows; a caller who needs them to be
    the same every time passes a decimal column.
    """
    return F.sum(c)
