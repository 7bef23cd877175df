"""Small text helpers shared by every operator."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that stand for a missing record id.
NULL_WORDS = ("", "na", "null", "nan", "none", "n/a", "<na>")

# The words that stand for a missing answer (case matters).
MISSING_WORDS = ("nan", "none", "na", "n/a", "null", "", "NaN", "None", "NA", "N/A", "NULL")

BLANKS = " \t\r\n"


def c(name: str) -> Column:
    """Column by its literal name; form columns carry dots, so quote them."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim(col: Column) -> Column:
    """Strip blanks, tabs and line ends (plain ``trim`` strips blanks only)."""
    return F.btrim(col, F.lit(BLANKS))


def is_in(col: Column, words: Iterable[str]) -> Column:
    """Null-safe membership: a null cell is not a member."""
    return F.coalesce(col.isin(*words), F.lit(False))


def normalise_cell(col: Column) -> Column:
    """Cell as a text reader hands it over: trimmed, empty and ``NA`` missing."""
    t = trim(col)
    return F.when((t != "") & (t != "NA"), t)


def base_name(name: str) -> str:
    """Question key of a value column."""
    return re.sub(r"\.value$", "", re.sub(r"\.valuedischarge$", "", name))


def any_base(name: str) -> str:
    """Question key of a value or label column."""
    return re.sub(r"\.(valuedischarge|labeldischarge|value|label)$", "", name)


def header_name(name: str) -> str:
    """Compact lower-case form of a header, whatever export style it came in."""
    name = re.sub(r"\s*\.\s*", ".", name.strip())
    return re.sub(r"[\s_]+", "", name).lower()


def lookup_key(name: str) -> str:
    """Form used to match a column with a form field."""
    return re.sub(r"[^A-Za-z0-9]", "", base_name(name)).lower()


def header_name_col(col: Column) -> Column:
    """``header_name`` over a column of names."""
    dotted = F.regexp_replace(trim(col), r"\s*\.\s*", ".")
    return F.lower(F.regexp_replace(dotted, r"[\s_]+", ""))


def db_name_col(col: Column) -> Column:
    """Letters and digits of a key name, lower case."""
    return F.regexp_replace(F.lower(trim(col)), "[^a-z0-9]", "")


def snake_name_col(col: Column) -> Column:
    """CamelCase key name as snake_case."""
    x = F.lower(trim(F.regexp_replace(col, "([a-z0-9])([A-Z])", "$1_$2")))
    x = F.regexp_replace(F.regexp_replace(x, "[^a-z0-9_]", "_"), "_+", "_")
    return F.regexp_replace(x, "(^_|_$)", "")


def lookup_key_col(col: Column) -> Column:
    """``lookup_key`` over a column of names."""
    return F.lower(F.regexp_replace(F.regexp_replace(col, r"\.value(discharge)?$", ""),
                                    "[^A-Za-z0-9]", ""))


def snake_name(name: str) -> str:
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).strip().lower()
    name = re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "_", name))
    return re.sub(r"(^_|_$)", "", name)
