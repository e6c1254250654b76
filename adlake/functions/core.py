"""Column helpers shared by every family (settled semantics S1-S3, S6-S9).

All helpers return ``Column`` expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- dates (S1)

def sunday_week(d: ColLike) -> Column:
    """Week of year with weeks starting on Sunday, 0..53 (strftime ``%U``).

    Days before the first Sunday of the year are week 0.  Spark's
    ``weekofyear`` is ISO and differs on about 40% of days.
    """
    d = _c(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def week_start_sunday(d: ColLike) -> Column:
    d = F.to_date(_c(d))
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end_saturday(d: ColLike) -> Column:
    return F.date_add(week_start_sunday(d), 6)


def days_back(as_of: str | Column, n: int) -> Column:
    """``as_of - n days``; ``as_of`` is a parameter, never CURRENT_DATE."""
    base = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return F.date_sub(base, n)


def previous_month_bounds(as_of: str) -> tuple[Column, Column]:
    """First and last day of the calendar month before ``as_of``."""
    first_this = F.trunc(F.to_date(F.lit(as_of)), "month")
    first_prev = F.add_months(first_this, -1)
    return first_prev, F.date_sub(first_this, 1)


# ----------------------------------------------------------- NULL-safe maths

def safe_divide(a: ColLike, b: ColLike) -> Column:
    """S3: NULL when the divisor is 0 or NULL (ANSI mode raises on ``/ 0``)."""
    return F.try_divide(_c(a), _c(b))


def greatest_strict(*cols: ColLike) -> Column:
    """S2: GREATEST that returns NULL when any input is NULL (Spark's skips
    NULLs)."""
    cs = [_c(c) for c in cols]
    all_set = reduce(lambda x, y: x & y, [c.isNotNull() for c in cs])
    return F.when(all_set, F.greatest(*cs))


def is_true(c: ColLike) -> Column:
    """3-valued ``x IS TRUE``."""
    return F.coalesce(_c(c), F.lit(False))


def sum_null_propagating(cols: Iterable[ColLike]) -> Column:
    return reduce(lambda x, y: x + y, [_c(c) for c in cols])


# ------------------------------------------------------------------- text

def contains_text(haystack: ColLike, needle: ColLike, mode: str = "contains",
                  ignore_case: bool = False) -> Column:
    """S6: literal substring test by default; ``mode='like'`` builds the
    ``'%' || key || '%'`` pattern, where ``%``/``_`` inside the key act as
    wildcards exactly as in the SQL source."""
    h, n = _c(haystack), _c(needle)
    if ignore_case:
        h, n = F.lower(h), F.lower(n)
    if mode == "like":
        return F.like(h, F.concat(F.lit("%"), n, F.lit("%")))
    return F.contains(h, n)


def truncate_upper(c: ColLike, width: int = 50) -> Column:
    """S7: ``UPPER(TRIM(LPAD(TRIM(t), width)))`` = trim, cut to ``width``
    characters, trim again, upper-case."""
    return F.upper(F.trim(F.lpad(F.trim(_c(c)), width, " ")))


def money(c: ColLike) -> Column:
    """Exact money: decimal(18,2), so sums do not depend on row order."""
    return _c(c).cast("decimal(18,2)")


def money_sum(c: ColLike) -> Column:
    return F.sum(money(c)).cast("double")
