"""Period grains as data: one entry per grain, so adding a grain is one line.

Each grain gives the period start of a date and the start of the periods just
before and after.  Period starts are aligned (Monday for weeks, the 1st for
months), so month arithmetic on them is exact.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grain:
    name: str
    start: Callable[[Column], Column]
    shift: Callable[[Column, int], Column]


GRAINS: dict[str, Grain] = {
    "day": Grain("day", lambda d: d, lambda s, n: F.date_add(s, n)),
    # weeks start on Monday
    "week": Grain("week", lambda d: F.trunc(d, "week"), lambda s, n: F.date_add(s, 7 * n)),
    "month": Grain("month", lambda d: F.trunc(d, "month"), lambda s, n: F.add_months(s, n)),
}

DEFAULT_GRAINS = ("day", "week", "month")


def by_grain(grain_col: Column, per_grain: Callable[[Grain], Column], grains=DEFAULT_GRAINS) -> Column:
    """A ``CASE grain WHEN ..`` chain built from the grain table."""
    expr = None
    for name in grains:
        g = GRAINS[name]
        expr = (F.when(grain_col == name, per_grain(g)) if expr is None
                else expr.when(grain_col == name, per_grain(g)))
    return expr


def prior_start(grain_col: Column, start_col: Column, grains=DEFAULT_GRAINS) -> Column:
    return by_grain(grain_col, lambda g: g.shift(start_col, -1), grains)


def next_start(grain_col: Column, start_col: Column, grains=DEFAULT_GRAINS) -> Column:
    return by_grain(grain_col, lambda g: g.shift(start_col, 1), grains)


def period_structs(date_col: Column, grains=DEFAULT_GRAINS) -> Column:
    """``array(struct(grain, period_start), ...)``: one element per grain, for ``inline``."""
    return F.array(*[
        F.struct(F.lit(name).alias("period_grain"), GRAINS[name].start(date_col).alias("period_start"))
        for name in grains
    ])
