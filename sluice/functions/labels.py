"""Values recovered from the label column next to an empty value column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.shapes import format_datetime, numeric_shape, parse_datetime
from sluice.functions.text import is_in, trim

# Label texts that are answers in themselves (case matters).
PLACEHOLDERS = (
    "None", "Normal", "Norm", "none", "normal", "norm", "NONE", "NORMAL", "NORM",
    "True", "False", "TRUE", "FALSE", "Yes", "No", "YES", "NO", "Y", "N",
)


def whole_count(col: Column) -> Column:
    """Whole non-negative number, else null."""
    n = trim(col).try_cast("double")
    return F.when(F.isnan(n) | n.isin(float("inf")) | (n < 0) | (n != F.floor(n)), F.lit(None)).otherwise(n)


def visit_count(value: Column, label: Column) -> Column:
    """Visit count from the value, else from labels such as ``3 ANC visits``.

    struct(count, from_label, invalid, source, outcome, conflict).  ``None`` is
    zero; a range label (``More than 4 ...``) gives a source but no count."""
    from_value = whole_count(value)
    text = F.lower(F.coalesce(trim(label), F.lit("")))
    from_text = (F.when(text == "none", F.lit(0.0))
                 .when(text.rlike(r"^[0-9]+\s+anc\s+visits?$"),
                       F.regexp_extract(text, "^[0-9]+", 0).try_cast("double"))
                 .when(text.rlike(r"^[0-9]+(\.0+)?$"), whole_count(text)))
    is_range = text.rlike(r"^more than (4|8)\s+anc\s+visits$")
    filled = from_value.isNull() & from_text.isNotNull()
    written = F.coalesce(trim(value), F.lit("")) != ""
    source = (F.when(from_value.isNotNull(), "raw_numeric_value").when(filled, "raw_exact_label")
              .when(is_range, "raw_range_label").otherwise("unresolved"))
    outcome = (F.when(from_value.isNotNull(), "valid_value")
               .when(filled & (text == "none"), "label_none_as_zero")
               .when(filled, "label_exact_count").when(is_range, "label_more_than_n")
               .when(text == "not sure", "unresolved_not_sure")
               .when(text == "anc visits", "unresolved_no_number")
               .when(text.endswith("?"), "unresolved_question_text")
               .when(text == "", "unresolved_no_answer").otherwise("unresolved_other"))
    return F.struct(F.coalesce(from_value, from_text).alias("count"), filled.alias("from_label"),
                    (written & from_value.isNull()).alias("invalid"), source.alias("source"),
                    outcome.alias("outcome"),
                    F.coalesce(from_value != from_text, F.lit(False)).alias("conflict"))


# Named rules; add entries to offer further parsers to a run configuration.
LABEL_RULES: dict[str, Callable[[Column, Column], Column]] = {"anc_visit_count": visit_count}


def label_rule(name: str) -> Callable[[Column, Column], Column]:
    if name not in LABEL_RULES:
        raise ValueError(f"unknown label-to-value rule '{name}'")
    return LABEL_RULES[name]


def rule_value(value: Column, parsed: Column) -> Column:
    """Value column after a rule: filled from the label, invalid text dropped."""
    return (F.when(parsed["from_label"], F.format_string("%.0f", parsed["count"]))
            .when(parsed["invalid"], F.lit(None)).otherwise(value))


def visit_category(count: Column, source: Column) -> Column:
    """none, 1_3 or ge4; a range label counts as ge4 where no count is known."""
    n = whole_count(count.cast("string"))
    return (F.when(n == 0, "none").when(n <= 3, "1_3").when(n.isNotNull(), "ge4")
            .when(source == "raw_range_label", "ge4"))


def fill_placeholder(value: Column, label: Column) -> Column:
    return F.coalesce(value, F.when(is_in(label, PLACEHOLDERS), label))


def fill_number_or_datetime(value: Column, label: Column) -> Column:
    """Empty value from a label that is wholly a number, else wholly a datetime.
    Numbers keep the digits of the label, without separators."""
    t = trim(label)
    shape = numeric_shape(label)["shape"]
    digits = (F.when(shape == "thousands", F.replace(t, F.lit(","), F.lit("")))
              .when(shape == "decimal_comma", F.replace(t, F.lit(","), F.lit(".")))
              .when(shape == "fallback", F.regexp_extract(t, r"[0-9]+(\.[0-9]+)?", 0))
              .when(shape == "plain", t))
    number = F.when(~label.rlike("[^0-9.,+ -]"), digits)
    return F.coalesce(value, number, format_datetime(parse_datetime(label)))
