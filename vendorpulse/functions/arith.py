"""Null-safe arithmetic shared by the feature layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money columns of every output: exact, wide enough for any per-seller total.
MONEY = T.DecimalType(38, 4)


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` in double precision; NULL (not an error) when ``den`` is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_div_sql(num: str, den: str) -> str:
    """:func:`safe_div` of two SQL expressions, as text."""
    return f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"


def money(c: Column) -> Column:
    return c.cast(MONEY)


# Money inside aggregations: integer units of 10^-4.  Decimal sums wider than
# 18 digits are BigDecimal-backed and allocate on every update; 64-bit sums
# are plain adds.  Exact for inputs with at most 4 decimals (prices, freight,
# payments), range ±9.2e14 per total.
MONEY_SCALE = 4


def to_units(c: Column) -> Column:
    return F.round(c * F.lit(10 ** MONEY_SCALE)).cast("bigint")


def from_units(c: Column) -> Column:
    return (c.cast(MONEY) / F.lit(10 ** MONEY_SCALE)).cast(MONEY)
