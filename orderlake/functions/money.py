"""Sums and means of amounts that lose no digit and, for amounts of up to six decimals, do not
depend on the order in which rows arrive.

Amounts are doubles in every layer, and double addition depends on row order. So each amount is
split into whole millionths, summed as decimals, and the double that is left, which is exactly zero
for amounts of up to six decimals below 1e15. A total is a struct of both sums; only the result
turns back into a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "struct<exact:decimal(38,6),rest:double>"

_UNITS = 1_000_000
_FAST_LIMIT = 2.0**33  # below it, millionths are whole numbers a double holds
_EXACT_LIMIT = 1e15  # above it, a double has no place for cents


def _millionths(amount: Column) -> Column:
    """The part of an amount that is summed exactly, as a decimal with six places."""
    # Counting millionths is several times cheaper than casting to a decimal, which goes through
    # text; only larger amounts take that way.
    counted = F.rint(amount * _UNITS).cast("bigint").cast("decimal(22,0)") * F.lit(1e-6).cast(
        "decimal(6,6)"
    )
    return (
        F.when(F.abs(amount) < _FAST_LIMIT, counted.cast("decimal(28,6)"))
        .when(F.abs(amount) < _EXACT_LIMIT, amount.cast("decimal(28,6)"))
        .when(amount.isNotNull(), F.lit(0).cast("decimal(28,6)"))
    )


def exact_sum(c: str | Column) -> Column:
    """Total of a double column; null amounts do not count."""
    amount = (F.col(c) if isinstance(c, str) else c).cast("double")
    exact = _millionths(amount)
    small = F.rint(amount * _UNITS) / _UNITS
    rest = amount - F.when(F.abs(amount) < _FAST_LIMIT, small).otherwise(
        exact.cast("string").cast("double")
    )
    return F.struct(F.sum(exact).alias("exact"), F.sum(rest).alias("rest"))


def sum_of(total: str) -> Column:
    """Total of a column of totals."""
    return F.struct(
        F.sum(f"{total}.exact").cast("decimal(38,6)").alias("exact"),
        F.sum(f"{total}.rest").alias("rest"),
    )


def _decimal_to_double(number: Column) -> Column:
    """The double nearest to a decimal with six places.

    Below 2**53 millionths the cast divides two whole numbers a double holds, which rounds
    correctly; above, it would be off by one unit in the last place, so text is read instead.
    """
    return F.when(F.abs(number) < _FAST_LIMIT, number.cast("double")).otherwise(
        number.cast("string").cast("double")
    )


def to_double(total: Column) -> Column:
    """The amount of a total."""
    return _decimal_to_double(total["exact"]) + total["rest"]


def mean(total: Column, n: Column) -> Column:
    """Mean as a double from a total; null when nothing was counted."""
    return F.when(n > 0, to_double(total) / n)


def mean_cents(total: Column, n: Column) -> Column:
    """Mean rounded half up to two places.

    Totals without a rest are divided as decimals, so that halves of a cent are seen exactly. What
    decimals cannot hold has no cents in a double either and is divided as such.
    """
    fits = (F.abs(total["exact"]) < F.lit(1e18)) & (n < 10**12) & (total["rest"] == 0)
    exact = F.when(fits, total["exact"]).cast("decimal(24,6)")
    ratio = exact / F.when(fits & (n > 0), n).cast("decimal(12,0)")
    return F.when(fits, F.round(ratio, 2).cast("string").cast("double")).otherwise(
        F.round(mean(total, n), 2)
    )
