"""Reason codes for the empty cells of a cleaned table.

-6 redacted, -7 not applicable (the form did not show the field), -8 removed by
cleaning, -9 unknown; the first that applies counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.conditions import compile_conditions, field_key
from sluice.functions.pii import VALUE_PATTERNS, value_pattern
from sluice.functions.shapes import format_datetime
from sluice.functions.text import MISSING_WORDS, c, is_in, lookup_key, trim
from sluice.plans.config import KEY_COLUMNS
from sluice.session import bounded_rows

REDACTED, NOT_APPLICABLE, REMOVED, UNKNOWN = -6, -7, -8, -9


def reason_code(clean: Column, raw: Column, shown: Column | None = None,
                patterns: Mapping[str, str] = VALUE_PATTERNS) -> Column:
    """Code of one cell, null where the cell holds a value.  ``shown`` is the
    form condition (true, false or unknown)."""
    written = raw.isNotNull() & ~is_in(trim(raw), MISSING_WORDS)
    code = F.when(value_pattern(raw, patterns).isNotNull(), F.lit(REDACTED))
    if shown is not None:
        code = code.when(shown.eqNullSafe(F.lit(False)), F.lit(NOT_APPLICABLE))
    return F.when(clean.isNull(), code.when(written, F.lit(REMOVED)).otherwise(F.lit(UNKNOWN)))


def first_conditions(fields: DataFrame) -> DataFrame:
    """First non-empty condition per (script_id, field key), in form order."""
    return (fields.filter(F.coalesce(F.col("condition"), F.lit("")) != "")
            .groupBy("script_id", "field_key_lower")
            .agg(F.min_by("condition", F.struct("screen_idx", "field_idx")).alias("condition")))


def shown_columns(conditions: DataFrame, columns: Sequence[str], raw_of: Mapping[str, str],
                  ) -> tuple[dict[str, Column], list[str]]:
    """Column -> boolean "was shown" expression by script, and the conditions
    that could not be translated.  Each distinct text is translated once."""
    rows = bounded_rows(conditions, what="form conditions")
    by_key = {field_key(lookup_key(n)): raw_of[n] for n in columns if n in raw_of}
    compiled, failed = compile_conditions([r["condition"] for r in rows], by_key)
    shown: dict[str, Column] = {}
    for n in columns:
        texts: dict[str, list[str]] = {}
        for r in rows:
            if r["field_key_lower"] == lookup_key(n) and r["condition"] in compiled:
                texts.setdefault(r["condition"], []).append(r["script_id"])
        expr = None
        for text, scripts in texts.items():
            hit = F.col("script_id").isin(*scripts)
            expr = F.when(hit, compiled[text]) if expr is None else expr.when(hit, compiled[text])
        if expr is not None:
            shown[n] = expr
    return shown, failed


def data_columns(names: Sequence[str]) -> list[str]:
    return [n for n in names if n not in KEY_COLUMNS and not n.startswith("_")]


def reason_wide(df: DataFrame, columns: Sequence[str], raw_of: Mapping[str, str],
                shown: Mapping[str, Column] | None = None, keep: Sequence[str] = KEY_COLUMNS,
                ) -> DataFrame:
    """Integer code per empty cell, same columns as the cleaned table.  ``df``
    holds the clean columns and, under the names of ``raw_of``, their raw text."""
    none = F.lit(None).cast("string")
    return df.select(*[c(n) for n in keep], *[
        reason_code(c(n), c(raw_of[n]) if n in raw_of else none, (shown or {}).get(n))
        .cast("int").alias(n) for n in columns])


def reason_long(df: DataFrame, wide_of: Mapping[str, Column], raw_of: Mapping[str, str],
                keep: Sequence[str] = ("uid", "facility")) -> DataFrame:
    """One row per empty cell: variable, code, raw text."""
    none = F.lit(None).cast("string")
    cells = F.filter(F.array(*[F.struct(
        F.lit(n).alias("variable"), code.cast("int").alias("na_reason"),
        (c(raw_of[n]) if n in raw_of else none).alias("raw_value"))
        for n, code in wide_of.items()]), lambda x: x["na_reason"].isNotNull())
    return df.select(*[c(k) for k in keep], F.explode(cells).alias("cell")).select(
        *[c(k) for k in keep], "cell.*")


def reason_summary(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per variable: present, missing and the count of each code."""
    cells = F.array(*[F.struct(F.lit(n).alias("variable"), c(n).alias("code")) for n in columns])
    code = F.col("cell.code")
    out = wide.select(F.explode(cells).alias("cell")).groupBy("cell.variable").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(code.isNull()).alias("n_present"),
        F.count_if(code.isNotNull()).alias("n_missing"),
        F.count_if(code == NOT_APPLICABLE).alias("n_not_applicable"),
        F.count_if(code == REMOVED).alias("n_invalid"), F.count_if(code == UNKNOWN).alias("n_unknown"),
        F.count_if(code == REDACTED).alias("n_redacted"))
    return out.withColumn("pct_missing", F.bround(F.col("n_missing") * 100.0 / F.col("n_total"), 1))


def top_missing(summary: DataFrame, n: int = 20) -> DataFrame:
    return summary.orderBy(F.desc("n_missing"), "variable").limit(n)


def cell_text(col: Column, dtype: str) -> Column:
    """Text of a typed cell as the CSV output shows it."""
    if dtype.startswith("timestamp"):
        return format_datetime(col)
    if dtype == "boolean":
        return F.upper(col.cast("string"))
    if dtype in ("double", "float"):
        whole = (col == F.floor(col)) & (F.abs(col) < 1e15)
        return F.when(whole, col.cast("bigint").cast("string")).otherwise(col.cast("string"))
    if dtype == "string":
        return F.regexp_replace(col, r"\.000$", "")
    return col.cast("string")


def reason_coded(df: DataFrame, codes: Mapping[str, Column], keep: Sequence[str] = KEY_COLUMNS,
                 ) -> DataFrame:
    """The cleaned table as text, every empty cell showing its code."""
    types = dict(df.dtypes)
    return df.select(*[c(k) for k in keep], *[
        F.coalesce(cell_text(c(n), types[n]), code.cast("string")).alias(n) for n, code in codes.items()])
