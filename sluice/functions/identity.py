"""Normalised identity fields used to compare records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import is_in, trim

# Birth-outcome spellings per class.
LIVE_WORDS = ("LB", "LIVEBIRTH", "ENND")
STILL_WORDS = ("STB", "STBM", "STBF", "SB", "SBF", "SBM")


def sex_letter(col: Column) -> Column:
    s = F.upper(F.substring(trim(col), 1, 1))
    return F.when(s.isin("M", "F"), s)


def yes_flag(col: Column) -> Column:
    s = F.lower(trim(col))
    return F.when(s.isNull() | (s == ""), F.lit(None)).otherwise(s.isin("y", "yes", "true", "1"))


def plausible(col: Column, low: float, high: float) -> Column:
    x = col.try_cast("double")
    return F.when(x.between(low, high), x)


def outcome_class(col: Column) -> Column:
    s = F.upper(F.regexp_replace(col, "[^A-Za-z]", ""))
    return (F.when(is_in(s, LIVE_WORDS), "live")
            .when(is_in(s, STILL_WORDS) | s.startswith("STILLBIRTH"), "still")
            .when(s == "MISC", "misc"))


def birth_order(col: Column) -> Column:
    s = trim(col)
    return F.when(s.rlike("^(Tw|Tr)[0-9]$"), s)


def entity_letter(k: Column) -> Column:
    """A to Z, then Z27, Z28, ..."""
    return (F.when(k <= 26, F.char(k + 64))
            .otherwise(F.concat(F.lit("Z"), k.cast("string"))))


def flag_text(*flags: Column) -> Column:
    """Set flags joined with ';', or 'none'."""
    joined = F.array_join(F.array_compact(F.array(*flags)), ";")
    return F.when(joined == "", "none").otherwise(joined)
