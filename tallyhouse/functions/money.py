"""Money is summed exactly, so that totals do not depend on row order.

What cannot be summed exactly fails, with ANSI mode on or off; no digit and no value is dropped.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding in binary of an amount in whole cents, relative to its cents: a few units in the last place.
_ROUNDING = 2.0**-50
_LARGEST = 2.0**63


def total(column: Column) -> Column:
    """Sum of a decimal amount at its own scale. A sum beyond 38 digits fails."""
    return _or_fail(F.sum(column), column, "a total exceeds the digits of its type")


def total_of_doubles(column: Column) -> Column:
    """Exact sum, as decimal, of amounts in whole cents that are stored as double.

    Summing cents as integers costs a third of a conversion to decimal per row. An amount that is not in whole
    cents, or not finite, fails, and so does a group whose sum leaves 9e16 units of money.
    """
    cents = column * 100
    whole = F.rint(cents)
    sound = (F.abs(cents - whole) <= F.abs(cents) * _ROUNDING) & (F.abs(whole) < _LARGEST)
    checked = F.when(sound, whole.cast("bigint")).when(
        column.isNotNull(), F.raise_error(F.concat(F.lit("not an amount in whole cents: "), column.cast("string")))
    )
    summed = _or_fail(F.try_sum(checked), column, "a total exceeds 9e16 units of money")
    return summed.cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def _or_fail(summed: Column, column: Column, message: str) -> Column:
    """The sum, unless it is null although there were amounts: an overflow."""
    return F.coalesce(summed, F.when(F.count(column) > 0, F.raise_error(F.lit(message))))
