"""Exact money at the speed of integers.

Stored amounts are DOUBLE with whole cents. They are summed as integer cents in three parts of 22
bits at most beside the sign, so a sum does not depend on the order of the rows and costs no
decimal arithmetic per row. A part is below 2**22, so its BIGINT sum holds for 2**41 rows of a key.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

PART = 22
CENT = Decimal("0.01")
MILLION = 1_000_000


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def cents(column: str | Column) -> Column:
    """An amount in whole cents; null for what is not a number or too large for a BIGINT."""
    column = _column(column)
    return F.when(~F.isnan(column), F.rint(column * 100).try_cast("bigint"))


def countable(column: str | Column) -> Column:
    """An amount, null where ``cents`` is: what all measures of a group leave out alike."""
    return F.when(cents(column).isNotNull(), _column(column))


def count_excluded(column: str | Column) -> Column:
    """Aggregate: amounts that are there but not countable."""
    return F.count_if(_column(column).isNotNull() & cents(column).isNull())


def exact_total(integers: Column) -> Column:
    """Aggregate: sum of BIGINT values as a decimal, whatever its size."""
    mask = F.lit((1 << PART) - 1)
    high = F.sum(F.shiftright(integers, 2 * PART)).cast("decimal(20,0)")
    middle = F.sum(F.shiftright(integers, PART).bitwiseAND(mask)).cast("decimal(20,0)")
    low = F.sum(integers.bitwiseAND(mask)).cast("decimal(20,0)")
    upper = (high * F.lit(Decimal(1 << PART)) + middle).cast("decimal(30,0)")
    return (upper * F.lit(Decimal(1 << PART)) + low).cast("decimal(38,0)")


def exact_sum(column: str | Column) -> Column:
    """Aggregate: sum of an amount as a decimal with two digits."""
    return in_money(exact_total(cents(column)))


def exact_sum_unrounded(column: str | Column) -> Column:
    """Aggregate: sum of an amount to the millionth, as a decimal with six digits.

    Whole units and millionths are summed apart. A row has a million of the latter at most, so their
    BIGINT sum holds for 2**43 rows of a key.
    """
    amount = countable(column)
    whole = F.floor(amount)
    rest = F.sum(F.rint((amount - whole) * MILLION).cast("bigint")).cast("decimal(20,0)")
    total = exact_total(whole) * F.lit(Decimal(MILLION)) + rest
    return (total.cast("decimal(38,0)") * F.lit(Decimal(1) / MILLION)).cast("decimal(38,6)")


def in_money(total_cents: Column) -> Column:
    return total_cents.cast("decimal(24,0)") * F.lit(CENT)


def as_double(column: Column, digits: int | None = None) -> Column:
    if digits is not None:
        column = F.round(column, digits)
    return column.cast("double")


def exact_mean(total: Column, count: Column) -> Column:
    """Decimal quotient with digits to spare for rounding it; null for an empty group."""
    return F.try_divide(total.cast("decimal(24,2)"), count.cast("decimal(20,0)"))


def mean_in_cents(total_cents: Column, count: Column) -> Column:
    """Mean of a few BIGINT cents as an amount, rounded half away from zero to cents."""
    twice = F.abs(total_cents) * 2 + count
    rounded = (twice - F.pmod(twice, count * 2)) / (count * 2)
    return F.when(count > 0, F.signum(total_cents) * rounded / 100)


def divided_to_cents(amount: Column, rate: Column) -> Column:
    """``amount`` by a rate with four digits, rounded half away from zero to cents.

    Millionths of the amount by ten-thousandths of the rate are the cents wanted. The quotient is
    taken on whole numbers of any size. No rate, or zero, gives null, as does no number.
    """
    units = (rate * 10000).cast("decimal(18,0)")
    millionths = (amount.try_cast("decimal(30,6)") * 1_000_000).cast("decimal(36,0)")
    twice = (F.abs(millionths) * 2 + units).cast("decimal(38,0)")
    divisor = (units * 2).cast("decimal(20,0)")
    whole = F.when(units > 0, twice - F.pmod(twice, divisor)).cast("decimal(38,0)")
    quotient = F.try_divide(whole, divisor).cast("decimal(38,0)")
    return F.signum(amount) * (quotient * F.lit(CENT)).cast("double")
