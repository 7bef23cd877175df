"""Numeric validation and columns derived from several numeric sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
HOURS_PER_YEAR = 8766
AGE_YEARS = (9, 60)
GRAMS_LIMIT = (100, 5000)
KILOGRAM_LIMIT = 20


def grams(x: Column) -> Column:
    """Values up to 20 are kilograms."""
    return F.when(x <= KILOGRAM_LIMIT, x * 1000).otherwise(x)


def positive_grams(x: Column) -> Column:
    """Like ``grams`` for positive values only (used when weights are merged)."""
    return F.when((x > 0) & (x <= KILOGRAM_LIMIT), x * 1000).otherwise(x)


def implausible_grams(x: Column) -> Column:
    return F.coalesce((x < GRAMS_LIMIT[0]) | (x > GRAMS_LIMIT[1]), F.lit(False))


def years_from_hours_entry(x: Column) -> Column:
    """An age above 200 was entered in hours."""
    return F.when(x > 200, F.bround(x / HOURS_PER_YEAR, 1)).otherwise(x)


def in_range(x: Column, low: float | None, high: float | None) -> Column:
    """Null outside the inclusive range; a missing bound is open."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (x < low)
    if high is not None:
        bad = bad | (x > high)
    return F.when(~bad, x)


def age_years(hours: Column) -> Column:
    """Whole years from an age in hours, null outside 9 to 60."""
    years = F.bround(hours / HOURS_PER_YEAR)
    return F.when(years.between(*AGE_YEARS), years)


def first_weight(*sources: Column) -> Column:
    return F.coalesce(*[positive_grams(x) for x in sources])


def spread(*sources: Column) -> Column:
    """Largest difference between the sources that are present (0 for one)."""
    if len(sources) < 2:
        return F.lit(0.0)
    return F.coalesce(F.greatest(*sources) - F.least(*sources), F.lit(0.0))


def age_source(years: Column, derived: Column) -> Column:
    return (F.when(years.isNotNull(), "matageyrs")
            .when(derived.isNotNull(), "matagedate_derived").otherwise("none"))
