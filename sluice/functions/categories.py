"""Clean-up of categorical and free-text answers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.shapes import parse_datetime
from sluice.functions.text import MISSING_WORDS, is_in, trim

HEADER_LIKE = r"^[A-Z][a-z]+(\s[A-Z][a-z]+){2,}\??$"
ISO_LIKE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"
MONTH_LIKE = ("^(January|February|March|April|May|June|July|August|September|October|"
              "November|December)")


def replace_aliases(col: Column, aliases: Mapping[str, Iterable[str]]) -> Column:
    """canonical -> aliases, applied in the given order."""
    for canonical, words in aliases.items():
        col = F.when(is_in(col, words), F.lit(canonical)).otherwise(col)
    return col


def clean_category(col: Column, aliases: Mapping[str, Iterable[str]] | None = None,
                   delete: Iterable[str] = (), categorical: bool = True) -> Column:
    """Aliases, then disallowed values, then (categorical only) text that looks
    like a column header or a date, then missing-value words become null."""
    x = replace_aliases(col, aliases or {})
    delete = tuple(delete)
    if delete:
        x = F.when(~is_in(x, delete), x)
    if categorical:
        x = F.when(~(x.rlike(HEADER_LIKE) | x.rlike(ISO_LIKE) | x.rlike(MONTH_LIKE)), x)
    return F.when(~is_in(trim(x), MISSING_WORDS), x)


def split_date(col: Column) -> Column:
    """Dates held in a mixed yes/no-or-date column."""
    return parse_datetime(col)
