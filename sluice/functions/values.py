"""Coded values: dictionary token resolution, multi-select lists, recodes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import is_in, trim

# Words read as Y / N on a yes-no(-unknown) field.
YES_WORDS = ("true", "yes", "t", "y")
NO_WORDS = ("false", "no", "f", "n")

# Multi-select columns checked besides those of the dictionary.
MULTISELECT_KEYS = ("resus", "delivinter")

# Delivery-mode words and their numeric codes.
DELIVERY_MODE_CODES = {
    "SVD": "1", "Vent": "2", "For": "3", "ElCS": "4", "ECS": "5",
    "CSPrLab": "5", "CSPoLab": "5", "IVD": "7", "ID": "7",
}


@dataclass(frozen=True)
class ValueMap:
    """Resolution table of one question key."""

    canonical: tuple[str, ...]
    lookup: Mapping[str, str]   # lower-case token -> canonical code
    codes: tuple[str, ...]      # lower-case raw and canonical codes


def _unambiguous(pairs: Iterable[tuple[str | None, str | None]]) -> dict[str, str]:
    """Lower-case key -> target, without keys that lead to several targets."""
    seen: dict[str, set[str]] = {}
    for key, target in pairs:
        k = (key or "").strip().lower()
        if k and target:
            seen.setdefault(k, set()).add(target)
    return {k: next(iter(t)) for k, t in seen.items() if len(t) == 1}


def build_value_map(rows: Iterable[Mapping]) -> ValueMap:
    """``ValueMap`` from the dictionary rows of one key (raw_code, option_label,
    canonical_code).  Precedence of a token: canonical code, raw code, option
    label, then a yes/no word where every canonical code is Y, N or U."""
    rows = list(rows)
    raw = [r["raw_code"] for r in rows if r["raw_code"] is not None]
    canonical = list(dict.fromkeys(r["canonical_code"] for r in rows
                                   if r["canonical_code"] is not None)) or list(dict.fromkeys(raw))
    by_canonical = _unambiguous((x, x) for x in canonical)
    by_code = _unambiguous((r["raw_code"], r["canonical_code"]) for r in rows)
    by_label = _unambiguous((r["option_label"], r["canonical_code"]) for r in rows)
    words: dict[str, str] = {}
    if canonical and all(x.strip().upper() in ("Y", "N", "U") for x in canonical):
        words.update({w: by_canonical["y"] for w in YES_WORDS if "y" in by_canonical})
        words.update({w: by_canonical["n"] for w in NO_WORDS if "n" in by_canonical})
    return ValueMap(tuple(canonical), {**words, **by_label, **by_code, **by_canonical},
                    tuple(dict.fromkeys(x.lower() for x in raw + canonical)))


def _literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def resolve_token(token: Column, vm: ValueMap) -> Column:
    """Canonical code of one token, null when it does not resolve."""
    t = trim(token)
    hit = (F.try_element_at(_literal_map(vm.lookup), F.lower(t)) if vm.lookup
           else F.lit(None).cast("string"))
    return F.when(t == "", F.lit(None)).when(is_in(t, vm.canonical), t).otherwise(hit)


def _list_items(text: Column) -> Column:
    return F.transform(F.split(F.substring(text, F.lit(2), F.length(text) - 2), ","), trim)


def map_value(col: Column, vm: ValueMap) -> Column:
    """struct(value string, outcome string).

    A brace list ``{A,B}`` is rewritten only when every token resolves; a
    canonical code that is itself a list is spliced in, repeats removed.
    Anything unresolved is kept as it is.  Outcomes: canonical, replaced,
    list_replaced, list_unresolved, unresolved; null for an empty cell."""
    s = trim(col)
    is_list = s.startswith("{") & s.endswith("}") & (F.length(s) > 2)
    spliced = F.array_distinct(F.flatten(F.transform(
        F.transform(_list_items(s), lambda p: resolve_token(p, vm)),
        lambda x: F.when(x.startswith("{") & x.endswith("}"), _list_items(x))
        .otherwise(F.array(x)))))
    listed = F.when(F.forall(spliced, lambda x: x.isNotNull()),
                    F.concat(F.lit("{"), F.array_join(spliced, ","), F.lit("}")))
    scalar = resolve_token(s, vm)

    def out(value: Column, outcome: Column | str) -> Column:
        return F.struct(value.alias("value"),
                        (F.lit(outcome) if isinstance(outcome, str) else outcome).alias("outcome"))

    return (F.when(s.isNull() | (s == "") | (s == "{}"), out(col, F.lit(None).cast("string")))
            .when(is_in(s, vm.canonical), out(col, "canonical"))
            .when(is_list & listed.isNull(), out(col, "list_unresolved"))
            .when(is_list, out(listed, F.when(listed == s, "canonical").otherwise("list_replaced")))
            .when(scalar.isNull(), out(col, "unresolved"))
            .otherwise(out(scalar, F.when(scalar == s, "canonical").otherwise("replaced"))))


def brace_list(col: Column, vm: ValueMap | None) -> Column:
    """``["A","B"]`` as ``{A,B}``; ``[A, B]`` only when every item is a known code."""
    quoted = col.rlike(r'^\[".*"\]$')
    bare = col.rlike(r"^\[[^\"]*\]$")
    q_items = _list_items(F.replace(col, F.lit('"'), F.lit("")))
    items = _list_items(col)
    known = F.array(*[F.lit(x) for x in (vm.codes if vm else ())]).cast("array<string>")

    def braces(a: Column) -> Column:
        return F.concat(F.lit("{"), F.array_join(a, ","), F.lit("}"))

    return (F.when(quoted & F.forall(q_items, lambda x: x != ""), braces(q_items))
            .when(bare & F.forall(items, lambda x: (x != "") & F.array_contains(known, F.lower(x))),
                  braces(items))
            .otherwise(col))


def recode(col: Column, codes: Mapping[str, str] = DELIVERY_MODE_CODES) -> Column:
    """Listed words replaced by their code, the rest kept."""
    return F.coalesce(F.try_element_at(_literal_map(codes), col), col)


def strip_score_label(col: Column) -> Column:
    """``2 = moderate`` as ``2``."""
    return F.regexp_replace(col, r"^([0-9]+)\s*=.*$", "$1")
