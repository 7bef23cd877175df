"""Form skip conditions as Spark SQL expressions.

A condition such as ``$Sex = 'M' and ($Age > 3 or !$Twin = 'Y')`` is rewritten
once into SQL text with three-valued logic; whatever does not rewrite cleanly is
reported and never hides a field.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARISON = re.compile(
    r"""(?P<neg>!\s*)?\$(?P<key>\w+)\s*(?P<op>!=|>=|<=|=|<|>)\s*
        (?:'(?P<sq>[^']*)'|"(?P<dq>[^"]*)"|\$(?P<other>\w+)|(?P<bool>true|false)\b
           |(?P<num>[+-]?\d+(?:\.\d+)?))""", re.VERBOSE | re.IGNORECASE)
_REST = re.compile(r"^(\s|\(|\)|!|\band\b|\bor\b|\bnot\b|@\d+@)*$", re.IGNORECASE)


def field_key(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9]", "", name).lower()


def combine(screen: str | None, field: str | None) -> str:
    """A field is shown when its screen and its own condition both hold."""
    parts = [re.sub(r"[\r\n]+", " ", p or "").strip() for p in (screen, field)]
    parts = [p for p in parts if p]
    return parts[0] if len(parts) == 1 else " and ".join(f"({p})" for p in parts)


def combine_col(screen: Column, field: Column) -> Column:
    s = F.trim(F.regexp_replace(F.coalesce(screen, F.lit("")), "[\r\n]+", " "))
    f = F.trim(F.regexp_replace(F.coalesce(field, F.lit("")), "[\r\n]+", " "))
    return (F.when(s == "", f).when(f == "", s)
            .otherwise(F.concat(F.lit("("), s, F.lit(") and ("), f, F.lit(")"))))


def keys_of(condition: str) -> list[str]:
    return [field_key(k) for k in re.findall(r"\$(\w+)", condition)]


def to_sql(condition: str, columns: Mapping[str, str]) -> str | None:
    """SQL text of a condition over ``columns`` (field key -> column name), or
    None when it cannot be rewritten.  Unknown fields compare as null."""
    found: list[str] = []

    def operand(key: str) -> str:
        name = columns.get(field_key(key))
        return "CAST(NULL AS STRING)" if name is None else "`" + name.replace("`", "``") + "`"

    def comparison(m: re.Match) -> str:
        left, op = operand(m["key"]), m["op"]
        if m["other"]:
            right = operand(m["other"])
        elif m["bool"]:
            words = ("'true','yes','y','1','t'", "'false','no','n','0','f'")
            low = f"lower(trim({left}))"
            left = f"(CASE WHEN {low} IN ({words[0]}) THEN true WHEN {low} IN ({words[1]}) THEN false END)"
            right = m["bool"].lower()
        elif m["num"]:
            left, right = f"try_cast(trim({left}) AS DOUBLE)", f"CAST({m['num']} AS DOUBLE)"
        else:
            right = "'" + (m["sq"] if m["sq"] is not None else m["dq"]).replace("\\", "\\\\").replace("'", "\\'") + "'"
        found.append(f"({'NOT ' if m['neg'] else ''}({left} {op} {right}))")
        return f" @{len(found) - 1}@ "

    text = _COMPARISON.sub(comparison, re.sub(r"[\r\n\t]+", " ", condition).strip())
    if not found or not _REST.match(text):
        return None
    text = re.sub(r"!", " NOT ", text)
    words = re.findall(r"\(|\)|@\d+@|\w+", text)
    depth, value_next = 0, True
    for w in (x.lower() for x in words):
        if w == "(" or w == "not":
            if not value_next:
                return None
            depth += w == "("
        elif w in ("and", "or"):
            if value_next:
                return None
            value_next = True
        elif w == ")":
            depth -= 1
            if depth < 0 or value_next:
                return None
        else:
            if not value_next:
                return None
            value_next = False
    if depth or value_next:
        return None
    return re.sub(r"@(\d+)@", lambda m: found[int(m[1])], " ".join(words))


def compile_conditions(conditions: Iterable[str], columns: Mapping[str, str],
                       ) -> tuple[dict[str, Column], list[str]]:
    """Distinct conditions -> boolean column, and those that do not translate."""
    done: dict[str, Column] = {}
    failed: list[str] = []
    for text in dict.fromkeys(x for x in conditions if x and x.strip()):
        sql = to_sql(text, columns)
        if sql is None:
            failed.append(text)
        else:
            done[text] = F.expr(sql)
    return done, failed
