"""Data-quality checks of a dictionary: one row per check with its bad rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import trim

# The columns each table must have.
REQUIRED = {
    "variables": ("environment", "dataset", "question_key", "raw_value_column", "raw_label_column",
                  "variable_label", "raw_data_type", "r_type", "section", "harmonised_variable_name",
                  "use_in_analysis", "weight_unit", "confidential", "record_id_role", "linkage_role",
                  "suggested_plausible_min", "suggested_plausible_max", "cleaning_note",
                  "key_unique_key", "pii_tier", "pii_category", "pii_matching_pattern"),
    "value_maps": ("question_key", "raw_code", "option_label", "option_order", "option_uuid",
                   "canonical_code"),
    "pii_patterns": ("pattern", "pattern_type", "pii_category", "reason", "countries", "examples",
                     "added_date", "notes"),
}
TIERS = ("1", "2", "quasi")


def missing_columns(tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    return {name: [x for x in REQUIRED[name] if x not in df.columns]
            for name, df in tables.items() if any(x not in df.columns for x in REQUIRED[name])}


def _count(df: DataFrame, table: str, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """All row conditions of one table in one pass."""
    row = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(name).alias("check"), F.lit(level).alias("level"),
                 F.col(f"c{i}").alias("n_bad")) for i, (name, level, _) in enumerate(checks)])).alias("x")
                      ).select("x.*")


def _single(df: DataFrame, table: str, name: str, level: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_bad")).select(
        F.lit(table).alias("table"), F.lit(name).alias("check"), F.lit(level).alias("level"), "n_bad")


def check_dictionary(variables: DataFrame, value_maps: DataFrame, pii_patterns: DataFrame | None = None,
                     expected_ranges: DataFrame | None = None) -> DataFrame:
    """(table, check, level, n_bad); a dictionary fails when an ``error`` row
    has ``n_bad`` above zero."""
    tier, low, high = F.col("pii_tier"), F.col("suggested_plausible_min"), F.col("suggested_plausible_max")
    use, confidential = (F.coalesce(x, F.lit(False)) for x in ("use_in_analysis", "confidential"))
    parts = [_count(variables, "variables", [
        ("analysis rows without r_type", "warning", use & F.col("r_type").isNull()),
        ("range minimum not below maximum", "error", low >= high),
        ("unknown pii_tier", "error", tier.isNotNull() & ~tier.isin(*TIERS)),
        ("tier 2 without a pattern", "warning", (tier == "2") & (F.coalesce(
            trim(F.col("pii_matching_pattern")), F.lit("")) == "")),
        ("confidential without tier 1 or 2", "warning",
         confidential & ~F.coalesce(tier.isin("1", "2"), F.lit(False))),
    ]), _single(value_maps.select("question_key").distinct().join(
        variables.select("question_key"), "question_key", "left_anti"),
        "value_maps", "keys not in variables", "warning")]
    if pii_patterns is not None:
        blank = F.coalesce(trim(F.col("pattern")), F.lit("")) == ""
        parts.append(_count(pii_patterns, "pii_patterns", [("blank pattern", "error", blank)]))
        parts.append(_single(pii_patterns.filter(~blank).groupBy("pattern").count().filter("count > 1"),
                             "pii_patterns", "duplicate pattern", "warning"))
        parts.append(_single(pii_patterns.agg(F.count(F.lit(1)).alias("n")).filter("n = 0"),
                             "pii_patterns", "empty table", "error"))
    if expected_ranges is not None:
        e = expected_ranges.select("question_key", F.col("suggested_plausible_min").alias("_lo"),
                                   F.col("suggested_plausible_max").alias("_hi"))
        off = e.join(variables, "question_key", "left").filter(
            ~(F.col("_lo").eqNullSafe(low) & F.col("_hi").eqNullSafe(high)))
        parts.append(_single(off, "variables", "range differs from the expected one", "warning"))
    return reduce(DataFrame.unionByName, parts)


def assert_dictionary(checks: DataFrame) -> None:
    bad = checks.filter("level = 'error' AND n_bad > 0").collect()
    if bad:
        raise ValueError("dictionary checks failed: "
                         + "; ".join(f"{r['table']}: {r['check']} ({r['n_bad']})" for r in bad))
