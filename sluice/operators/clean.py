"""Steps of one cleaning run over a table with named text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import labels, ranges, values
from sluice.functions.categories import clean_category
from sluice.functions.shapes import datetime_class, datetime_shape, numeric_shape, parse_boolean, parse_datetime
from sluice.functions.text import base_name, c, is_in
from sluice.operators.metrics import class_counts, flag_counts, union_all
from sluice.plans.columns import column_types, label_pairs
from sluice.plans.config import KEY_COLUMNS, RunConfig
from sluice.plans.dictionary import Dictionary


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """One select that swaps the listed columns and appends new ones."""
    return df.select(*[new[n].alias(n) if n in new else c(n) for n in df.columns],
                     *[x.alias(n) for n, x in new.items() if n not in df.columns])


def clean_values(df: DataFrame, dictionary: Dictionary) -> tuple[DataFrame, DataFrame]:
    """List encodings, dictionary codes, delivery modes and score labels."""
    maps = dictionary.value_maps
    keyed = {n: maps[base_name(n)] for n in df.columns if base_name(n) in maps}
    lists = {n: values.brace_list(c(n), keyed.get(n)) for n in df.columns
             if n in keyed or base_name(n) in values.MULTISELECT_KEYS}
    out = _replace(df, lists)
    mapped = _replace(out, {n: values.map_value(c(n), vm) for n, vm in keyed.items()})
    metrics = class_counts(mapped, "values", {n: c(n)["outcome"] for n in keyed}) if keyed else None
    out = _replace(mapped, {n: c(n)["value"] for n in keyed})
    fixed = {n: values.recode(c(n)) for n in ("modedelivery", "modedelivery.value") if n in out.columns}
    fixed.update({n: values.strip_score_label(c(n)) for n in out.columns if n.startswith("thomp")})
    out = _replace(out, fixed)
    return out, metrics if metrics is not None else flag_counts(df, "values", {("", "no_mapped_columns"): F.lit(False)})


def fill_from_labels(df: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Named rules, then placeholder words, then numbers and datetimes; the
    label columns that were used are dropped."""
    out, handled, parts = df, set(), []
    for field, rule in cfg.label_rules.items():
        parse = labels.label_rule(rule)
        value, label = field + ".value", field + ".label"
        if value not in df.columns:
            continue
        lab = c(label) if label in df.columns else F.lit(None).cast("string")
        out = out.withColumn("_rule", parse(c(value), lab))
        r = F.col("_rule")
        parts.append(class_counts(out, "label_rule", {value: r["outcome"]}))
        parts.append(flag_counts(out, "label_rule", {
            (value, "conflict"): r["conflict"], (value, "invalid"): r["invalid"] & ~r["from_label"]}))
        out = _replace(out, {value: labels.rule_value(c(value), r), field + "_source": r["source"]}).drop("_rule")
        handled.add(value)
    pairs = label_pairs(df.columns)
    open_pairs = {v: lab for v, lab in pairs.items() if v not in handled}
    placeholder = {(v, "placeholder"): c(v).isNull() & is_in(c(lab), labels.PLACEHOLDERS)
                   for v, lab in open_pairs.items()}
    if placeholder:
        parts.append(flag_counts(out, "label_fill", placeholder))
    filled = {v: labels.fill_number_or_datetime(labels.fill_placeholder(c(v), c(lab)), c(lab))
              for v, lab in open_pairs.items()}
    out = _replace(out, filled).drop(*pairs.values())
    return out, union_all(parts) if parts else flag_counts(df, "label_fill", {("", "no_label_columns"): F.lit(False)})


def assign_types(df: DataFrame, dictionary: Dictionary, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Every typed column parsed by the shape of its values, in one select; the
    second select splits values from shapes so each cell is parsed once."""
    types = column_types(df.columns, dictionary, cfg)
    shaped = {n: numeric_shape(c(n)) if t == "numeric" else datetime_shape(c(n))
              for n, t in types.items() if t in ("numeric", "datetime") and dict(df.dtypes)[n] == "string"}
    mid = _replace(df, shaped)
    classes = {n: c(n)["shape"] if types[n] == "numeric" else datetime_class(c(n)) for n in shaped}
    dropped = {(n, "offset_dropped"): c(n)["offset_dropped"] for n in shaped if types[n] == "datetime"}
    parts = [class_counts(mid, "types", classes)] if classes else []
    parts += [flag_counts(mid, "types", dropped)] if dropped else []
    out = _replace(mid, {**{n: c(n)["value"] for n in shaped},
                         **{n: parse_boolean(c(n)) for n, t in types.items() if t == "boolean"}})
    return out, union_all(parts) if parts else flag_counts(df, "types", {("", "no_typed_columns"): F.lit(False)})


def validate(df: DataFrame, dictionary: Dictionary, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Units, ranges, categories and dates; adds derived source columns."""
    types = column_types(df.columns, dictionary, cfg)
    new: dict[str, Column] = {}
    flags: dict[tuple[str, str], Column] = {}
    for n, t in types.items():
        base, x = base_name(n), c(n)
        if t == "numeric":
            if base in dictionary.weight_keys:
                flags[(n, "kilograms")] = x <= ranges.KILOGRAM_LIMIT
                x = ranges.grams(x)
                flags[(n, "implausible_weight")] = ranges.implausible_grams(x)
            if base == "matageyrs":
                flags[(n, "hours_as_years")] = x > 200
                x = ranges.years_from_hours_entry(x)
            if base in dictionary.ranges:
                kept = ranges.in_range(x, *dictionary.ranges[base])
                flags[(n, "out_of_range")] = x.isNotNull() & kept.isNull()
                x = kept
        elif t in ("categorical", "object"):
            x = clean_category(x, cfg.aliases.get(base), cfg.delete_values.get(base, ()), t == "categorical")
            flags[(n, "removed")] = c(n).isNotNull() & x.isNull()
        else:
            continue
        new[n] = x
    hours = next((n for n in ("matagedate.value", "matagedate") if types.get(n) == "numeric"), None)
    if hours:
        new["mat_age_date_years"] = ranges.age_years(c(hours))
        flags[(hours, "implausible_age")] = c(hours).isNotNull() & new["mat_age_date_years"].isNull()
    for key in cfg.mixed_date_columns:
        source = next((n for n in (key + ".value", key) if n in df.columns), None)
        if source and types[source] != "datetime":
            new[key + "_date"] = parse_datetime(c(source).cast("string"))
    metrics = flag_counts(df, "validate", flags or {("", "no_validated_columns"): F.lit(False)})
    return _replace(df, new), metrics


def derive(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weight, maternal age and visit category from several source columns
    (names without suffixes)."""
    have = set(df.columns)

    def number(n: str) -> Column:
        return c(n).cast("string").try_cast("double")

    new: dict[str, Column] = {}
    flags: dict[tuple[str, str], Column] = {}
    weights = [number(n) for n in ("birthweight", "bwt", "bwtdis") if n in have]
    new["birthweight_g"] = ranges.first_weight(*weights) if weights else F.lit(None).cast("double")
    if len(weights) > 1:
        flags[("birthweight_g", "sources_differ")] = ranges.spread(
            *[ranges.positive_grams(w) for w in weights]) > 1
    for n, target in (("admissionweight", "admission_weight_g"), ("dischweight", "discharge_weight_g")):
        if n in have:
            new[target] = ranges.positive_grams(number(n))
    if have & {"matageyrs", "mat_age_date_years"}:
        none = F.lit(None).cast("double")
        years = number("matageyrs") if "matageyrs" in have else none
        derived = number("mat_age_date_years") if "mat_age_date_years" in have else none
        new["mat_age_years_combined"] = F.coalesce(years, derived)
        new["mat_age_source"] = ranges.age_source(years, derived)
        flags[("mat_age_years_combined", "sources_differ")] = F.abs(years - derived) > 1
    if {"antenatalcare", "antenatalcare_source"} <= have:
        new["antenatalcare_category"] = labels.visit_category(c("antenatalcare"), c("antenatalcare_source"))
    metrics = flag_counts(df, "derive", flags or {("", "single_sources"): F.lit(False)})
    return _replace(df, new), metrics


def stage_groups(names: list[str], types: dict[str, str]) -> dict[str, list[str]]:
    """Column groups that are merged as one when record keys are not unique."""
    group = {"numeric": "numeric", "boolean": "boolean", "datetime": "datetime",
             "categorical": "category", "object": "category", "unchanged": "pass"}
    out: dict[str, list[str]] = {}
    for n in names:
        if n not in KEY_COLUMNS and not n.startswith("_"):
            out.setdefault(group[types.get(n, "unchanged")], []).append(n)
    return out
