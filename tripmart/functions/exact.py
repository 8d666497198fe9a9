"""Sums of doubles that do not depend on the order of the rows.

A value is split into its whole part and the rest in units of 2**-40, and the rest into two halves
of twenty bits, so that plain sums of longs hold for 2**43 rows. Integer sums are the same in any
order and under any partitioning; they are turned into a double once, at the end. Splitting rounds
a value by 2**-41 at most. Values from 2**53 on are whole anyway. A whole sum beyond a long is NULL;
a single value of 2**62 or more counts as infinite.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF = 2**20
_UNIT = 2**40
_LIMIT = 2**62
PARTS = ("whole", "high", "low", "odd")


def _split(value: Column) -> dict[str, Column]:
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(float(_LIMIT)))
    known = F.when(finite, value.cast("double"))
    units = F.floor((known - F.floor(known)) * F.lit(float(_UNIT)) + F.lit(0.5))
    return {
        "whole": F.floor(known),
        "high": F.shiftright(units, 20),
        "low": units.bitwiseAND(F.lit(_HALF - 1)),
        # NaN and infinities take the sum over, whatever their order.
        "odd": F.when(
            value.isNotNull() & ~finite, value.cast("double") * F.lit(float("inf"))
        ),
    }


def sum_parts(value: Column, name: str) -> list[Column]:
    """Aggregates ``<name>_<part>`` from which the sum of ``value`` follows."""
    sums = [F.try_sum(part) for part in _split(value).values()]
    return [s.alias(f"{name}_{part}") for s, part in zip(sums, PARTS, strict=True)]


def merged_parts(name: str) -> list[Column]:
    """Aggregates that add up parts of the same sum."""
    return [F.try_sum(f"{name}_{part}").alias(f"{name}_{part}") for part in PARTS]


def part_names(name: str) -> list[str]:
    return [f"{name}_{part}" for part in PARTS]


def total(name: str) -> Column:
    """The sum, from its parts; NULL if no value was known."""
    whole, high, low, odd = (F.col(n) for n in part_names(name))
    wide = "decimal(38,0)"
    units = (
        whole.cast("decimal(20,0)") * F.lit(_UNIT).cast("decimal(13,0)")
        + high.cast("decimal(20,0)") * F.lit(_HALF).cast("decimal(7,0)")
        + low.cast("decimal(20,0)")
    ).cast(wide)
    return F.coalesce(odd, units.cast("double") / F.lit(float(_UNIT)))
