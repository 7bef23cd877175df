"""Column plans: what each column of a table is, decided from its name."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import base_name, header_name, header_name_col, lookup_key_col
from sluice.plans.config import KEY_COLUMNS, DISCHARGE_TIMES, SYSTEM_TIMES, RunConfig
from sluice.plans.dictionary import Dictionary

SYSTEM_COLUMNS = (*KEY_COLUMNS, *SYSTEM_TIMES, *DISCHARGE_TIMES, "scriptversion", "scriptid")


def plan_header(raw: Sequence[str], cfg: RunConfig) -> list[tuple[int, str]]:
    """(position, name) of the columns kept: normalised, reserved collisions
    renamed, parent-key and listed metadata columns left out."""
    names = [cfg.reserved_renames.get(header_name(n), header_name(n)) for n in raw]
    return [(i, n) for i, n in enumerate(names)
            if not n.endswith(".parentkey") and n not in cfg.metadata_columns]


def undocumented(raw: Sequence[str], dictionary: Dictionary, cfg: RunConfig) -> list[str]:
    """Data columns the dictionary does not know; they pass through as text."""
    names = [header_name(n) for n in raw]
    return [n for n in names if n not in dictionary.known_columns
            and n not in SYSTEM_COLUMNS and n not in cfg.metadata_columns
            and not n.endswith(".parentkey")]


def column_type(name: str, lists: Mapping[str, frozenset[str]]) -> str:
    """Type of a column; the first list that holds its name, base or base.value
    wins, in the order numeric, boolean, categorical, object, datetime."""
    if name in KEY_COLUMNS:
        return "unchanged"
    base = base_name(name)
    for t in ("numeric", "boolean", "categorical", "object", "datetime"):
        if {name, base, base + ".value"} & lists[t]:
            return t
    return "unchanged"


def column_types(names: Sequence[str], dictionary: Dictionary, cfg: RunConfig) -> dict[str, str]:
    lists = dictionary.type_lists(cfg)
    return {n: column_type(n, lists) for n in names}


def pass_through(names: Sequence[str], types: Mapping[str, str]) -> list[str]:
    """Untyped value and bare columns that stay as text."""
    return [n for n in names if n not in KEY_COLUMNS and types[n] == "unchanged"
            and (re.search(r"\.value(discharge)?$", n) or "." not in n)]


def label_pairs(names: Sequence[str]) -> dict[str, str]:
    """value column -> its label column."""
    have = set(names)
    pairs = {n: re.sub(r"\.value(discharge)?$", r".label\1", n) for n in names
             if re.search(r"\.value(discharge)?$", n)}
    return {v: lab for v, lab in pairs.items() if lab in have}


def output_names(names: Sequence[str]) -> dict[str, str]:
    """Names without value suffixes; two columns may not end up with one name."""
    return _unique({n: base_name(n) for n in names})


def harmonised_names(names: Sequence[str], harmonised: Mapping[str, str]) -> dict[str, str]:
    return _unique({n: harmonised.get(base_name(n), n) for n in names})


def _unique(renames: dict[str, str]) -> dict[str, str]:
    seen: dict[str, str] = {}
    for old, new in renames.items():
        if new in seen:
            raise ValueError(f"columns '{seen[new]}' and '{old}' would both be named '{new}'")
        seen[new] = old
    return renames


def name_role(name: Column) -> Column:
    """value, label, valuedischarge, labeldischarge, parentkey or bare."""
    suffix = F.regexp_extract(name, r"\.(valuedischarge|labeldischarge|value|label|parentkey)$", 1)
    return F.when(suffix == "", "bare").otherwise(suffix)


def describe_names(df, raw: str):
    """Plan columns for a table of raw header names."""
    name = header_name_col(F.col(raw))
    out = df.withColumn("name", name)
    return (out.withColumn("role", name_role(F.col("name")))
            .withColumn("base", F.regexp_replace(
                "name", r"\.(valuedischarge|labeldischarge|value|label|parentkey)$", ""))
            .withColumn("lookup_key", lookup_key_col(F.col("name"))))
