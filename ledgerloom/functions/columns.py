"""Column expressions shared by the operators: typing, money, keys, ratios.

Everything here is made of built-in functions, so it stays inside code generation.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(10,4)"
# Sums over an order, a customer or a product are wider than one row's money, so that a
# key holding a large share of all rows cannot overflow. 18 digits still fit a long.
MONEY_SUM = "decimal(18,2)"
RATE_SUM = "decimal(18,4)"

Caster = Callable[[Column, str], Column]


# ---- text to typed values -------------------------------------------------------------

def filled(c: Column) -> Column:
    """True where a text value is present."""
    return c.isNotNull() & (c != "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def typed(c: Column, type_name: str) -> Column:
    """Blank is NULL, anything else must parse (ANSI cast raises otherwise)."""
    return blank_to_null(c).cast(type_name)


def typed_lenient(c: Column, type_name: str) -> Column:
    """Blank and malformed values are NULL; count the latter with ``quality.rejected_values``."""
    return blank_to_null(c).try_cast(type_name)


def flag(c: Column, yes: str, default: str) -> Column:
    """Text to boolean: NULL counts as ``default``, only ``yes`` (any case) is true."""
    return F.upper(F.coalesce(c, F.lit(default))) == yes.upper()


def bare_amount(c: Column) -> Column:
    """Drop currency signs and thousands separators."""
    return F.translate(c, "$,", "")


def drop_leading_apostrophe(c: Column) -> Column:
    """Spreadsheet exports guard leading zeros with one apostrophe."""
    return F.when(F.startswith(c, F.lit("'")), F.substr(c, F.lit(2))).otherwise(c)


# ---- keys -----------------------------------------------------------------------------

def email_key(c: Column) -> Column:
    return F.lower(c)


def email_hash(c: Column) -> Column:
    return F.sha2(F.lower(c), 256)


def method_code(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("_")))


def surrogate(c: Column) -> Column:
    """Key of a dimension row, made from its natural key.

    128 bits, because 64-bit hashes of some 10^10 customers would be expected to collide.
    It does not change between runs and can be computed on the fact side without a lookup.
    """
    return F.md5(c)


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic (cheaper than formatting text)."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


# ---- arithmetic -----------------------------------------------------------------------

def ratio(numerator: Column, denominator: Column, times: int = 1) -> Column:
    """Double quotient, 0 where the denominator is not positive."""
    quotient = numerator.cast("double") / denominator.cast("double")
    if times != 1:
        quotient = quotient * F.lit(float(times))
    return F.when(denominator > 0, quotient).otherwise(F.lit(0.0))


def mean(c: Column) -> Column:
    """Average as double of an exact sum; NULL over no values."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def divide_half_away(numerator: Column, denominator: Column) -> Column:
    """Integer quotient of two integers rounded half away from zero; NULL over zero.

    The arguments are bigint or decimal(38,0) columns; the result is bigint.
    """
    size = F.abs(denominator)
    half = F.when(numerator < 0, -size).otherwise(size)
    divisor = F.nullif(denominator, F.lit(0)) * 2
    return F.call_function("div", numerator * 2 + half, divisor)


def multiply_divide(a: Column, b: Column, denominator: Column) -> Column:
    """a * b / denominator over bigint columns, rounded half away from zero.

    Nearly all amounts are small enough for bigint arithmetic; the others take the same
    steps in decimals.
    """
    product = F.abs(a.cast("double") * b.cast("double"))
    size = F.abs(denominator.cast("double"))
    wide = divide_half_away(
        a.cast("decimal(20,0)") * b.cast("decimal(14,0)"), denominator.cast("decimal(20,0)")
    )
    return (
        F.when(product + size < F.lit(4.0e18), divide_half_away(a * b, denominator))
        .when(product > size * F.lit(9.0e18), F.raise_error(F.lit("quotient exceeds bigint")))
        .otherwise(wide)
    )


def scaled(c: Column, digits: int) -> Column:
    """A decimal column as a whole number of 10^-digits units."""
    return (c * F.lit(10**digits)).cast("bigint")


def unscaled(c: Column, digits: int, type_name: str) -> Column:
    """Inverse of ``scaled``, exact."""
    return (c.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(type_name)
