"""Personal-data patterns over column names and cell values."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import any_base, trim

# Column-name patterns that are always removed (any case).  Names
# tied to one product belong in the run's own pattern table.
NAME_PATTERNS = (
    r"name\.value$",
    r"cell\.value$",
    r"phone\.value$",
    r"address\.value$",
    r"hcwid",
    r"hospnum",
    r"stuid",
    r"uidbid\.value$",
    r"uiddc\.value$",
    r"drid\.value$",
    r"^(firm|concall|hcwsigdis|dataentryname(other)?)\.(value|label)(discharge)?$",
    r"^(mother|moth|mat|mum)s?(dob|dateofbirth)\.(value|label)$",
)

# Quasi-identifier name patterns, flagged and kept.
QUASI_PATTERNS = (
    "village", "district", "province", r"tribe\.value$", r"ethnicity\.value$",
    r"religion\.value$", "address", "matagedate",
)

# Cell shapes, tested on trimmed text in this order.  The last three
# look anywhere in the text; they are written so that most positions of a long
# text fail on their first character:
#   email           one character before "@" is enough to know there is an address
#   zw_national_id  2 digits, 6-7 digits, a letter, 2 digits, blanks or hyphens
#                   between, not inside a longer run of letters and digits
#   mw_national_id  a run of exactly 8 letters and digits, at least two of each,
#                   not part of a longer or hyphenated run; looked up from its
#                   first digit back to the start of the run
_RUN_OF_EIGHT = (r"(?<![A-Za-z0-9-])(?=[A-Za-z0-9]{8}(?![A-Za-z0-9-]))"
                 r"(?=[0-9]*[A-Za-z][0-9]*[A-Za-z])(?=[A-Za-z]*[0-9][A-Za-z]*[0-9])")
VALUE_PATTERNS: dict[str, str] = {
    "phone_international": r"^\+?(263[0-9]{9}|265[0-9]{7,9})$",
    "phone_local_zw": r"^0[67][0-9]{8}$",
    "phone_local_mwi": r"^0[89][0-9]{8}$",
    "email": r"[a-zA-Z0-9._%+\-]@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}",
    "nhs_number": r"^[0-9]{3}[- ][0-9]{3}[- ][0-9]{4}$",
    "zw_national_id": (r"[0-9](?<![A-Za-z0-9][0-9])[0-9][- ]{0,2}[0-9]{6,7}"
                       r"[- ]{0,2}[A-Za-z][- ]{0,2}[0-9]{2}(?![A-Za-z0-9])"),
    "mw_national_id": rf"[0-9](?<={_RUN_OF_EIGHT}[A-Za-z]{{0,6}}[0-9])",
}

# Structural columns whose cells are counted, never redacted.
EXEMPT_COLUMNS = (
    "uid", "facility", "uniquekey", "baby_id",
    "startedat", "completedat", "ingestedat",
    "startedatdischarge", "completedatdischarge", "ingestedatdischarge",
    "scriptversion", "scriptid",
)

# Keys whose answer options name members of staff.
STAFF_KEYS = (r"^(hcwsig|hcwsigdis|signature|eqhcwsig|dataentryname|dataentrynameother|"
              r"otherclinicians|eqdqc|concall|firm|delhcwname|hcwname|hcwid|hcwiddis|"
              r"drid|reviewid)$")
STAFF_VALUES_NOTE = "Not listed (staff identifier)"


def any_pattern(patterns: Iterable[str]) -> str:
    """One pattern for "any of these", so a clean cell is scanned once."""
    return "|".join(f"(?:{p})" for p in patterns)


def value_pattern(col: Column, patterns: Mapping[str, str] = VALUE_PATTERNS) -> Column:
    """Name of the first pattern the trimmed cell matches, else null."""
    t = trim(col)
    hit = F.lit(None).cast("string")
    for name, pattern in reversed(list(patterns.items())):
        hit = F.when(t.rlike(pattern), F.lit(name)).otherwise(hit)
    return F.when(t.rlike(any_pattern(patterns.values())), hit) if len(patterns) > 1 else hit


def redact(col: Column, patterns: Mapping[str, str] = VALUE_PATTERNS) -> Column:
    """Cell, or null when any pattern matches."""
    return F.when(~trim(col).rlike(any_pattern(patterns.values())), col)


def is_staff_key_col(col: Column) -> Column:
    key = F.replace(F.regexp_replace(col, r"(\.value|\.label)$", ""), F.lit("_"), F.lit(""))
    return F.coalesce(key.rlike("(?i)" + STAFF_KEYS), F.lit(False))


def matching_pattern(name: str, patterns: Iterable[str]) -> str | None:
    return next((p for p in patterns if re.search(p, name, re.IGNORECASE)), None)


def candidate_names(name: str, renames: Mapping[str, str] | None = None,
                    harmonised: Mapping[str, str] | None = None) -> list[str]:
    """Raw-name forms an output column may stand for: itself, <key>.value, and
    for a harmonised name <question key>.value, with reserved renames undone."""
    undo = {v: k for k, v in (renames or {}).items()}
    names = [name]
    if not re.search(r"\.(label|labeldischarge)$", name):
        names.append(any_base(name) + ".value")
    names += [k + ".value" for k, v in (harmonised or {}).items() if v == name]
    return list(dict.fromkeys(undo.get(n, n) for n in names))
