"""Duplicate and twin columns resolved by how much they hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import c


def non_null_counts(df: DataFrame) -> dict[str, int]:
    """Non-null cells per column, in one pass (one row reaches the driver)."""
    names = df.columns
    row = df.agg(*[F.count(c(n)).alias(f"n{i}") for i, n in enumerate(names)]).first()
    return {n: row[f"n{i}"] for i, n in enumerate(names)}


def merge_duplicates(df: DataFrame, names: Sequence[str], counts: dict[str, int] | None = None,
                     ) -> DataFrame:
    """One column per name.  ``df`` has unique positional names, ``names`` says
    what each stands for; of several copies the fullest comes first and its
    gaps are filled from the others in column order."""
    groups: dict[str, list[str]] = {}
    for position, name in zip(df.columns, names, strict=True):
        groups.setdefault(name, []).append(position)
    if any(len(g) > 1 for g in groups.values()):
        counts = counts or non_null_counts(df.select(
            *[c(p) for g in groups.values() if len(g) > 1 for p in g]))
    out = []
    for name, copies in groups.items():
        if len(copies) > 1:
            best = max(copies, key=lambda p: counts[p])
            copies = [best, *[p for p in copies if p != best]]
            out.append(F.coalesce(*[c(p) for p in copies]).alias(name))
        else:
            out.append(c(copies[0]).alias(name))
    return df.select(*out)


def twin_choice(names: Sequence[str], counts: dict[str, int]) -> list[str]:
    """Columns kept: label columns go; per prefix the bare or the ``.value``
    column stays, whichever holds more (bare on a tie), else the first."""
    groups: dict[str, list[str]] = {}
    for n in names:
        if "label" not in n:
            groups.setdefault(n.split(".")[0], []).append(n)
    kept = set()
    for prefix, group in groups.items():
        bare, value = prefix, prefix + ".value"
        if bare in group and value in group:
            kept.add(bare if counts[bare] >= counts[value] else value)
        else:
            kept.add(next((x for x in (value, bare) if x in group), group[0]))
    return [n for n in names if n in kept]


def resolve_twins(df: DataFrame, protect: Sequence[str] = ()) -> DataFrame:
    names = [n for n in df.columns if n not in protect]
    prefixes = [n.split(".")[0] for n in names if "label" not in n]
    both = [n for n in names if "label" not in n and prefixes.count(n.split(".")[0]) > 1]
    counts = non_null_counts(df.select(*[c(n) for n in both])) if both else {}
    kept = twin_choice(names, counts)
    return df.select(*[c(n) for n in df.columns if n in protect or n in kept])
