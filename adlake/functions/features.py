"""Row-level feature derivation (SF15-SF20, ML2) as native Column expressions.

The source applies Python functions row by row; every rule here is a
``when`` chain or string function, evaluated in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake.operators.relational import dict_map

# Duration unit -> days
UNIT_DAYS = {"year": 365.0, "years": 365.0, "week": 7.0, "weeks": 7.0,
             "month": 30.5, "months": 30.5, "days": 1.0, "day": 1.0}
# sex_upon_outcome -> sex, and -> neutered state
SEX = {"Neutered Male": "Male", "Spayed Female": "Female", "Intact Male": "Male",
       "Intact Female": "Female", "Unknown": "Unknown"}
NEUTERED = {"Neutered Male": "Neutered", "Spayed Female": "Neutered", "Intact Male": "Intact",
            "Intact Female": "Intact", "Unknown": "Unknown"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sex_of(outcome) -> Column:
    """'Spayed Female' -> 'Female'; unmapped and NULL stay NULL."""
    return dict_map(outcome, SEX)


def neutered_state(outcome) -> Column:
    return dict_map(outcome, NEUTERED)


def split_nth(text, sep: str, n: int) -> Column:
    """n-th token (0-based) of ``split(text, sep)``; NULL when missing."""
    return F.get(F.split(_c(text), sep), n)


def duration_days(text) -> Column:
    """'2 years' -> 730.0; unit mapped through UNIT_DAYS; a missing number
    counts as 0."""
    unit = dict_map(split_nth(text, " ", 1), UNIT_DAYS)
    num = F.coalesce(split_nth(text, " ", 0).try_cast("double"), F.lit(0.0))
    return num * unit


def time_of_day(hour) -> Column:
    h = _c(hour)
    return (F.when((h > 5) & (h < 12), F.lit("morning"))
            .when((h > 11) & (h < 16), F.lit("afternoon"))
            .when((h > 15) & (h < 20), F.lit("evening"))
            .otherwise(F.lit("night")))


def life_stage(age_years) -> Column:
    """<=1.5 baby, (1.5, 7] adult, >7 senior; NULL age stays NULL."""
    a = _c(age_years)
    return (F.when(a <= 1.5, F.lit("baby")).when(a <= 7, F.lit("adult"))
            .when(a.isNotNull(), F.lit("senior")))


def weekend_flag(weekday_name) -> Column:
    return F.when(_c(weekday_name).isin("Saturday", "Sunday"), F.lit("weekend")).otherwise(F.lit("weekday"))


def stay_band(days) -> Column:
    """Days in care, truncated to an integer first: <1, [1,7), [7,30.5), >=30.5."""
    d = _c(days).cast("int")
    return (F.when(d < 1, F.lit("less than a day"))
            .when(d < 7, F.lit("for a day or week"))
            .when(d < 30.5, F.lit("more than a week"))
            .when(d.isNotNull(), F.lit("more than month")))


def mix_flag(text, token: str = "Mix", yes: str = "IsMix", no: str = "simple") -> Column:
    return F.when(F.contains(_c(text), F.lit(token)), F.lit(yes)).otherwise(F.lit(no))


def simple_breed(text, token: str = "Mix") -> Column:
    """Remove the token, then keep the part before the first '/'."""
    return F.get(F.split(F.regexp_replace(_c(text), token, ""), "/"), 0)
