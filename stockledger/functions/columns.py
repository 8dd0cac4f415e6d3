"""Column expressions. All are built-in Spark expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockledger.schemas import UNKNOWN_CATEGORY

# What a decimal long looks like as text: no blanks, no fraction. Fixed value.
LONG_TEXT = r"\A[+-]?[0-9]+\z"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _fail(message: Column | str) -> Column:
    return F.raise_error(message if isinstance(message, Column) else F.lit(message)).cast("bigint")


def try_long(column: Column | str) -> Column:
    """Text as bigint; null where it is null, not a whole number or out of range."""
    text = _col(column).cast("string")
    return F.when(text.rlike(LONG_TEXT), text.try_cast("bigint"))


def strict_long(column: Column | str, what: str = "value") -> Column:
    """Text as bigint; null and bad text fail the query."""
    shown = F.coalesce(_col(column).cast("string"), F.lit("null"))
    return F.coalesce(
        try_long(column), _fail(F.concat(F.lit(f"{what} is not a whole number: "), shown))
    )


def required(column: Column | str, what: str = "value") -> Column:
    """A bigint column that must not be null (no text to parse)."""
    return F.coalesce(_col(column).cast("bigint"), _fail(f"{what} must not be null"))


def non_negative(column: Column | str, what: str = "quantity") -> Column:
    """Negative values fail the query; nulls pass (see :func:`required`)."""
    value = _col(column)
    return F.when(value < 0, _fail(f"{what} must not be negative")).otherwise(value)


def zero_fill(column: Column | str) -> Column:
    return F.coalesce(_col(column), F.lit(0).cast("bigint"))


def or_unknown(column: Column | str) -> Column:
    return F.coalesce(_col(column), F.lit(UNKNOWN_CATEGORY).cast("bigint"))


def signed_case(sign: Column | str, value: Column | str) -> Column:
    """The value of a change row as an addend: '+' adds it, '-' takes it back."""
    sign, value = _col(sign), _col(value)
    return (
        F.when(sign == "+", value)
        .when(sign == "-", -value)
        .otherwise(_fail("sign must be + or -"))
    )


def upper_line(column: Column | str) -> Column:
    return F.upper(_col(column))


def long_to_bytes(column: Column | str) -> Column:
    """A bigint as the eight big-endian bytes a topic of longs carries."""
    return F.unhex(F.lpad(F.hex(_col(column)), 16, "0"))


def long_from_bytes(column: Column | str) -> Column:
    """Inverse of :func:`long_to_bytes`."""
    return F.conv(F.hex(_col(column)), 16, -10).cast("bigint")
