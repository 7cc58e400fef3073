"""Sums of doubles that do not depend on the order of addition.

A double sum is rounded after every addition, so the same ticks in another order, or dealt
over another number of partitions, can give another sum; where it lies beside a whole
number, ``floor`` then makes a difference of one. Here every value is cut into signed whole
numbers of ``LIMB_BITS`` bits, one per limb of a fixed grid. Those are added as longs, which
is exact, so Spark combines them before the shuffle in any order and in streaming state.
The limbs are put together once per group.

The grid goes from ``2**LOWEST`` up to ``2**HIGHEST``. What a value has below the grid (less
than 1.3e-29) is cut off, value by value, so it cannot depend on the order either. A group
with a value from ``2**HIGHEST`` (7.9e28) up, or with one that is not finite, has the plain
double sum. A group can take ``2**38`` values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tickflow.functions.scalar import floor_double

LIMB_BITS = 24
LOWEST, HIGHEST = -96, 96
_LIMBS = range(LOWEST, HIGHEST, LIMB_BITS)
_MASK = (1 << LIMB_BITS) - 1
# Up to here the top limb, put in its place, fits into a decimal of 38 digits.
_TOP = 1 << 53


def _limbs(value: Column) -> list[Column]:
    """The value's signed limbs, lowest first. All steps are exact: remainders of doubles
    are, and so is the division by a power of two. Null where the grid does not reach."""
    inside = F.when(F.abs(value) < 2.0**HIGHEST, value)
    return [((inside % (2.0 ** (low + LIMB_BITS))) / 2.0**low).cast("long") for low in _LIMBS]


def put_together(beyond: Column, plain: Column, limbs: list[Column]) -> Column:
    """The floor of a sum from the sums of its limbs (lowest first), the plain sum, and
    whether some value was beyond the grid."""
    # Carries go up; shifts round down, so what the fraction passes on makes the floor.
    totals = limbs[:1]
    for limb in limbs[1:]:
        totals.append(limb + F.shiftright(totals[-1], LIMB_BITS))
    digits = [total.bitwiseAND(F.lit(_MASK).cast("long")) for total in totals[-LOWEST // LIMB_BITS : -1]]
    top = totals[-1]
    whole = top.cast("decimal(17,0)") * F.lit(Decimal(1 << (HIGHEST - LIMB_BITS)))
    for place, digit in enumerate(digits):
        whole = whole + digit.cast("decimal(8,0)") * F.lit(Decimal(1 << (place * LIMB_BITS)))
    return (
        F.when(beyond, floor_double(plain))
        .when(F.abs(top) < _TOP, whole.cast("double"))
        .otherwise(floor_double(plain))
    )


def exact_floor_sum(value: Column) -> Column:
    """The floor of the exact sum of a group's doubles, as a double; an aggregate.

    Nulls are skipped; a group of nulls is null. From ``2**53`` on it is the double nearest
    to the exact sum's floor."""
    beyond = F.max(~(F.abs(value) < 2.0**HIGHEST))
    return put_together(beyond, F.sum(value), [F.sum(limb) for limb in _limbs(value)])


# What Spark keeps of an unfinished group: the aggregates in the order in which
# ``put_together`` names them, the highest limb first.
STATE = "beyond boolean, plain double, " + ", ".join(f"limb{i} long" for i in reversed(range(len(_LIMBS))))


def unfinished(state: str) -> Column:
    """The floor of the sum so far from a column of Spark's state."""
    named = F.col(state).cast(f"struct<{STATE.replace(' ', ':').replace(',:', ',')}>")
    limbs = [named[f"limb{i}"] for i in range(len(_LIMBS))]
    return put_together(named["beyond"], named["plain"], limbs)
