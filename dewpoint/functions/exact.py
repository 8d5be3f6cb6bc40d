"""Sums of doubles that do not depend on the order of adding.

A double is a whole number times a power of two. Numbers whose exponents fall into the same
group of 8 are whole multiples of one power of two, below 2 ** 62, and whole numbers can be
added in any order. So values are summed by group as integers, in three parts of 21 bits
that leave room for 2 ** 42 values, and the groups' sums are put together exactly at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

GROUP_BITS = 8
PART_BITS = 21
# The groups of values that are no numbers.
NAN, INFINITE, MINUS_INFINITE = 1000, 1001, 1002
_LEAST = -1127  # exponent of the unit of group 0: the least double has 2 ** -1074
_MASK = (1 << PART_BITS) - 1
# Beyond so many groups or values the sum may pass 38 digits.
_NARROW, _FEW = 3, 2**30


def exponent_group(value: Column) -> Column:
    """The group of a double's exponent; null for null and zero, which add nothing."""
    exponent = F.floor(F.log2(F.abs(value)))
    number = F.floor((exponent + 1074) / GROUP_BITS).cast("int")
    return (
        F.when(value.isNull() | (value == 0), F.lit(None).cast("int"))
        .when(F.isnan(value), F.lit(NAN))
        .when(value == float("inf"), F.lit(INFINITE))
        .when(value == float("-inf"), F.lit(MINUS_INFINITE))
        .otherwise(number)
    )


def in_units(value: Column, group: Column) -> Column:
    """The value as a whole number of its group's units; 0 where it adds nothing."""
    units = _scaled(value, -(group * GROUP_BITS + _LEAST)).cast("long")
    return F.when(group < NAN, units).otherwise(F.lit(0).cast("long"))


def parts_of(units: Column) -> list[Column]:
    """Three numbers of 21 bits, the last with the sign, to be summed each."""
    return [
        units.bitwiseAND(_MASK),
        F.shiftright(units, PART_BITS).bitwiseAND(_MASK),
        F.shiftright(units, 2 * PART_BITS),
    ]


def exact_average(sums: Column, n: Column) -> Column:
    """The average of ``n`` values from their sums by group, an array of (group, parts).

    The exact sum, rounded once to a double, divided by ``n``; null if ``n`` is 0. As in
    any sum of doubles, NaN or infinities of both signs give NaN, other infinities stay.
    """
    def holds(group: int) -> Column:
        return F.exists(sums, lambda s: s["group"] == group)

    def finite(numbers: Column) -> Column:
        groups = F.transform(numbers, lambda s: s["group"])
        ends = F.struct(F.array_min(groups).alias("least"), F.array_max(groups).alias("most"))
        return _let(
            ends,
            lambda e: F.when(F.size(numbers) == 0, F.lit(0.0))
            .when(
                (e["most"] - e["least"] <= _NARROW) & (n < _FEW),
                _narrow_sum(numbers, e["least"]),
            )
            .otherwise(_wide_sum(numbers, e["least"], e["most"])),
        )

    total = (
        F.when(F.forall(sums, lambda s: s["group"] < NAN), finite(sums))
        .when(holds(NAN) | (holds(INFINITE) & holds(MINUS_INFINITE)), F.lit(float("nan")))
        .when(holds(INFINITE), F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    return F.when(n > 0, total / n)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scaled(value: Column, exponent: Column) -> Column:
    """The value times 2 ** exponent; in two steps, neither of which leaves the doubles."""
    half = F.floor(exponent / 2)
    two = F.lit(2.0)
    return value * F.pow(two, half) * F.pow(two, exponent - half)


def _whole(number: Column | int) -> Column:
    return (F.lit(number) if isinstance(number, int) else number).cast("decimal(38,0)")


def _units_of(entry: Column) -> Column:
    low, middle, high = (_whole(entry[f"part{i}"]) for i in range(3))
    return low + middle * _whole(1 << PART_BITS) + high * _whole(1 << 2 * PART_BITS)


def _narrow_sum(numbers: Column, least: Column) -> Column:
    steps = F.array(*[_whole(1 << GROUP_BITS * i) for i in range(_NARROW + 1)])
    total = F.aggregate(
        numbers,
        _whole(0),
        lambda sum_, s: _whole(sum_ + _units_of(s) * F.get(steps, s["group"] - least)),
    )
    return _scaled(total.cast("double"), least * GROUP_BITS + _LEAST)


def _wide_sum(numbers: Column, least: Column, most: Column) -> Column:
    """Groups far apart: all digits of the sum to the base of a group, by carrying."""
    base = 1 << GROUP_BITS

    def carried(state: Column, group: Column) -> Column:
        here = F.aggregate(
            F.filter(numbers, lambda s: s["group"] == group),
            state["carry"],
            lambda sum_, s: _whole(sum_ + _units_of(s)),
        )
        digit = F.pmod(here, _whole(base))
        return F.struct(
            _whole((here - digit) / _whole(base)).alias("carry"),
            F.concat(state["digits"], F.array(digit.cast("int"))).alias("digits"),
        )

    def rounded(d: Column) -> Column:
        """From the first 8 digits and whether more follow.

        A sum below 0 has the carry -1. The number without its sign is then that of the
        digits taken from the highest digit, and 1 more at the end: at the end of the first
        8 if only zeros follow these.
        """
        below, digits, lead = d["carry"] < 0, d["digits"], d["lead"]
        more = F.exists(F.slice(digits, lead + 8, F.size(digits)), lambda x: x > 0)
        first = F.aggregate(
            F.slice(digits, lead, 8),
            _whole(0),
            lambda sum_, x: _whole(
                sum_ * _whole(base) + _whole(F.when(below, base - 1 - x).otherwise(x))
            ),
        )
        kept = _whole(
            first * _whole(2) + _whole(F.when(more, 1).when(below, 2).otherwise(0))
        )
        place = F.size(digits) - lead - 15  # of the last digit kept, without the zeros
        exponent = least * GROUP_BITS + _LEAST + place * GROUP_BITS - 1
        value = _scaled(kept.cast("double"), exponent)
        return F.when(lead == 0, F.lit(0.0)).when(below, -value).otherwise(value)

    def led(d: Column) -> Column:
        falling = F.concat(F.reverse(d["digits"]), F.array_repeat(F.lit(0), 8))
        unlike = F.transform(falling, lambda x: x != F.when(d["carry"] < 0, base - 1).otherwise(0))
        return F.struct(
            d["carry"].alias("carry"),
            falling.alias("digits"),
            F.array_position(unlike, True).cast("int").alias("lead"),
        )

    nothing = F.struct(_whole(0).alias("carry"), F.array().cast("array<int>").alias("digits"))
    # The carry of the highest group takes less than 16 digits.
    all_ = F.aggregate(F.sequence(least, most + 16), nothing, carried)
    return _let(_let(all_, led), rounded)
