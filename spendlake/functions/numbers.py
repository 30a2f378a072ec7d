"""Sums, guarded ratios and keys."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Bits of each part of an amount below its whole units.
_BITS = 26
_PARTS = 3


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def amount_parts(amount: Column | str) -> list[Column]:
    """A DOUBLE amount as longs that add up without rounding: whole units and three parts.

    Each part holds 26 more bits, all with the sign of the amount, so amounts down to 2**-78
    (3e-24) are kept to the last bit; what lies below is rounded to that.
    """
    rest = as_column(amount).cast("double")
    parts = [rest.cast("long")]
    for number in range(_PARTS):
        rest = (rest - parts[-1]) * F.lit(float(1 << _BITS))
        parts.append((F.rint(rest) if number == _PARTS - 1 else rest).cast("long"))
    return parts


def _carried(parts: list[Column]) -> list[Column]:
    """The same amount with every part below the units between 0 and 2**26."""
    mask = F.lit((1 << _BITS) - 1).cast("long")
    result, carry = [], F.lit(0).cast("long")
    for part in parts[:0:-1]:
        part = part + carry
        result.insert(0, part.bitwiseAND(mask))
        carry = F.shiftright(part, _BITS)
    return [parts[0] + carry, *result]


def joined_amount(parts: list[Column]) -> Column:
    """The DOUBLE nearest to sums of the parts, ties to even.

    The magnitude is cut into two numbers of at most 53 bits, so that only their addition rounds;
    bits that lie far below the last one of the result are folded into one, which is enough to
    tell a tie.
    """
    sign = F.when(_carried(parts)[0] < 0, -1).otherwise(1).cast("long")
    whole, high, middle, low = _carried([part * sign for part in parts])
    step = F.lit(1 << _BITS).cast("long")
    double = lambda value, bits: value.cast("double") * F.lit(2.0**-bits)
    small = double(whole * step + high, 26) + double(middle * step + low, 78)
    rest = (high * step + middle).bitwiseOR((low != 0).cast("long"))
    large = double(whole, 0) + double(rest, 52)
    tail = whole.bitwiseAND(F.lit(2047).cast("long"))
    huge = double(whole - tail, 0) + (double(tail, 0) + F.when(rest != 0, 0.5).otherwise(0.0))
    value = F.when(whole < 1 << 27, small).when(whole < 1 << 53, large).otherwise(huge)
    return value * sign.cast("double")


def exact_sum(amount: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum of a DOUBLE amount that does not depend on the order of the rows.

    A float sum changes with the way rows are split over tasks, so two runs (or one
    retried task) can disagree in the last digits.  Here the bits of the amounts are summed as
    longs, which no order can change, and put together once per group; a decimal sum takes many
    times as long.  No row is rounded above 2**-78.  An amount that is not a number, infinite or
    beyond a long is an error, as is a total beyond one.
    """
    sums = [F.sum(part) for part in amount_parts(amount)]
    return joined_amount([part if over is None else part.over(over) for part in sums])


def exact_mean(amount: Column | str, over: WindowSpec | None = None) -> Column:
    """Mean of the non-NULL amounts, from the exact sum."""
    counted = F.count(as_column(amount))
    if over is not None:
        counted = counted.over(over)
    return exact_sum(amount, over) / F.nullif(counted, F.lit(0)).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator where the denominator is above zero, else NULL."""
    below = as_column(denominator)
    return F.when(below > 0, as_column(numerator) / below)


def zero_if_null(value: Column | str, zero: int | float = 0) -> Column:
    return F.coalesce(as_column(value), F.lit(zero))


def key_of(*parts: Column | str) -> Column:
    """Parts joined with ``|``; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("|"), as_column(part).cast("string")]
    return F.concat(*pieces[1:])


def day_count(day: Column | str) -> Column:
    """Exact number of distinct days in a group that lies within one month: a bit per day."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(as_column(day)) - 1)
    return F.coalesce(F.bit_count(F.bit_or(bit)).cast("long"), F.lit(0).cast("long"))
