"""Column-expression helpers shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: str | Column, digits: int) -> Column:
    """Round a non-negative double half away from zero on the scaled value.

    ``F.round`` rounds the decimal text of the double and so differs from the
    reference for ratios such as 23/40 (0.57499.. as a double).
    """
    scale = float(10**digits)
    x = col_(c)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def md5_key(*parts: str | Column, sep: str = "|") -> Column:
    """md5 of the parts joined by ``sep``, a null part counted as empty text.

    ``concat_ws`` would skip nulls and shift the separators, so each part is
    coalesced first.
    """
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(col_(p).cast("string"), F.lit("")))
    return F.md5(F.concat(*pieces))


def month_start(c: str | Column) -> Column:
    """First day of the month of a date or timestamp (Date, session zone)."""
    return F.trunc(F.to_date(col_(c)), "month")


def months_apart(later: str | Column, earlier: str | Column) -> Column:
    """Count of month boundaries between two dates (calendar month difference)."""
    a, b = F.to_date(col_(later)), F.to_date(col_(earlier))
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("long")


def capitalised(c: str | Column) -> Column:
    """``resurrected`` -> ``Resurrected`` (legend label of the cohort charts)."""
    return F.initcap(col_(c))


def titled_label(c: str | Column) -> Column:
    """``miles_earned`` -> ``Miles Earned`` (chart labels of the serving queries)."""
    return F.initcap(F.regexp_replace(col_(c), "_", " "))
