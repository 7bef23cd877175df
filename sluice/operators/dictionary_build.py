"""Data dictionaries built from form metadata.

All (country, dataset) pairs are built in one job: every table carries both
columns and every step groups or joins on them.  Corrections are tables too."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.pii import (NAME_PATTERNS, QUASI_PATTERNS, STAFF_VALUES_NOTE, is_staff_key_col,
                                  value_pattern)
from sluice.functions.text import db_name_col, snake_name_col, trim
from sluice.operators.dedup import first_row
from sluice.operators.ranking import running_number

# Form data types and the types used here.
TYPE_MAP = {
    "number": "numeric", "period": "numeric", "timer": "numeric",
    "date": "datetime", "datetime": "datetime", "yesno": "boolean",
    "single_select": "categorical", "dropdown": "categorical", "multi_select": "categorical",
    "checklist": "categorical", "diagnosis": "categorical",
    "diagnosis_symptom_risk": "categorical", "diagnosis_symptom_sign": "categorical",
    "text": "object", "zw_edliz_summary_table": "object", "mwi_edliz_summary_table": "object",
}
TEXT_TYPES = ("text", "zw_edliz_summary_table", "mwi_edliz_summary_table")

# Datasets and the script titles they cover (any case).
DATASET_TITLES = {
    "admissions": "Admission",
    "discharges": "Discharge",
    "maternal_outcomes": "Maternal",
    "phc_admissions": "PHC.*Admission|Generic PHC Admission|Kasungu.*Admission",
    "phc_discharges": "PHC.*Discharge|Generic PHC Discharge|NeoDischarge.*PHC",
    "combined_maternity_outcomes": "Maternal|DHIS2 Mat|Maternity",
    "dhis2_maternal_outcomes": "DHIS2.*Mat|DHIS.*Matern",
    "maternity_completeness": "Maternal",
    "baseline": "Baseline|Retrospective",
    "infections": "Infection|NeoInfect",
    "twenty_8_day_follow_up": "28.?[Dd]ay|Follow.?[Uu]p|28.*[Ff]ollow|NeoFollow",
}

# Keys in grams, record keys and their roles.
WEIGHT_KEYS = ("admissionweight", "birthweight", "bwtdis", "aw", "bwbid", "dischweight")
RECORD_ROLES = {
    "uid": "record_uid", "facility": "record_facility", "uniquekey": "record_unique_key",
    "startedat": "record_start_timestamp", "completedat": "record_completion_timestamp",
    "ingestedat": "record_ingestion_timestamp", "startedatdischarge": "record_id",
    "completedatdischarge": "record_id", "ingestedatdischarge": "record_id",
    "uniquekeydischarge": "record_id",
}
LINK_ROLES = {"uid": "primary_linkage_key", "facility": "secondary_linkage_key"}

# Plausible ranges with hard limits (None = open end).
RANGES = {
    "apgar1": (0, 10), "apgar5": (0, 10), "apgar10": (0, 10), "satsair": (0, 100),
    "satso2": (0, 100), "dischsats": (0, 100), "thompscore": (0, 22), "bcreturntime": (0, 1440),
    "poshours": (0, 120), "timespent": (0, 72), "episode": (1, None),
}

SCOPE = ["country", "dataset"]


def _map(values: Mapping[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def replace_titles(usage: DataFrame, replacements: Sequence[tuple[str, str]],
                   column: str = "scripttitle") -> DataFrame:
    """Published titles instead of listed originals, the longest original first."""
    title = F.col(column)
    for original, published in sorted(replacements, key=lambda r: -len(r[0])):
        title = F.replace(title, F.lit(original), F.lit(published))
    return usage.withColumn(column, title)


def dataset_usage(usage: DataFrame, titles: Mapping[str, str] = DATASET_TITLES) -> DataFrame:
    """Usage rows (country, datakeyuniquekey, scripttitle) once per dataset whose
    title pattern they match; the patterns are tested in the row, without a join."""
    hits = F.array_compact(F.array(*[
        F.when(F.col("scripttitle").rlike("(?i)" + p), F.lit(d)) for d, p in titles.items()]))
    return usage.select("*", F.explode(hits).alias("dataset"))


def sections(usage: DataFrame) -> DataFrame:
    """Sorted distinct script titles per key, joined with '; '."""
    return (usage.select(*SCOPE, "datakeyuniquekey", "scripttitle").distinct()
            .groupBy(*SCOPE, "datakeyuniquekey")
            .agg(F.array_join(F.array_sort(F.collect_list("scripttitle")), "; ").alias("section")))


def latest_versions(keys: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One key row per (country, dataset, question_key): an override if listed,
    else the latest publish date (ties by key id)."""
    keys = keys.withColumn("question_key", db_name_col(F.col("name"))).filter("question_key != ''")
    chosen = F.lit(0)
    if overrides is not None:
        keys = keys.join(overrides.select(*SCOPE, "question_key", "uniqueKey")
                         .withColumn("_override", F.lit(1)), [*SCOPE, "question_key", "uniqueKey"], "left")
        chosen = F.coalesce("_override", F.lit(0))
    return first_row(keys, [*SCOPE, "question_key"],
                     [chosen.desc(), F.col("publishDate").desc_nulls_last(), F.col("uniqueKey")]).drop("_override")


def build_variables(data_keys: DataFrame, usage: DataFrame, overrides: DataFrame | None = None,
                    titles: Mapping[str, str] = DATASET_TITLES) -> DataFrame:
    """Variables table of every (country, dataset); ``options`` is kept for the
    value maps."""
    used = sections(dataset_usage(usage, titles))
    keys = (data_keys.filter((~F.col("isDeleted")) & (F.col("dataType") != "option"))
            .join(used.withColumnRenamed("datakeyuniquekey", "uniqueKey"), ["country", "uniqueKey"]))
    v = latest_versions(keys, overrides)
    key = F.col("question_key")
    null = F.lit(None)
    return v.select(
        *SCOPE, "question_key", F.concat(key, F.lit(".value")).alias("raw_value_column"),
        F.concat(key, F.lit(".label")).alias("raw_label_column"), F.col("label").alias("variable_label"),
        F.col("dataType").alias("raw_data_type"), _map(TYPE_MAP, F.col("dataType")).alias("r_type"),
        "section", snake_name_col(F.col("name")).alias("harmonised_variable_name"),
        (~(F.col("dataType").isin(*TEXT_TYPES) | F.coalesce("isDraft", F.lit(False)))).alias("use_in_analysis"),
        F.when(key.isin(*WEIGHT_KEYS), "grams").alias("weight_unit"), "confidential",
        _map(RECORD_ROLES, key).alias("record_id_role"), _map(LINK_ROLES, key).alias("linkage_role"),
        null.cast("double").alias("suggested_plausible_min"),
        null.cast("double").alias("suggested_plausible_max"),
        null.cast("string").alias("cleaning_note"), F.col("uniqueKey").alias("key_unique_key"), "options")


def append_variables(variables: DataFrame, extra: DataFrame) -> DataFrame:
    """Legacy and derived variables, where the key is not there yet."""
    new = extra.join(variables.select(*SCOPE, "question_key"), [*SCOPE, "question_key"], "left_anti")
    return variables.unionByName(new, allowMissingColumns=True)


def apply_ranges(variables: DataFrame, user_ranges: DataFrame | None = None,
                 ranges: Mapping[str, tuple] = RANGES) -> DataFrame:
    """Built-in ranges fill missing ends; a user range replaces both ends."""
    low = {k: float(a) for k, (a, _) in ranges.items() if a is not None}
    high = {k: float(b) for k, (_, b) in ranges.items() if b is not None}
    out = variables
    for column, table in (("suggested_plausible_min", low), ("suggested_plausible_max", high)):
        if table:
            out = out.withColumn(column, F.coalesce(column, _map(table, F.col("question_key"))))
    if user_ranges is None:
        return out
    user = user_ranges.filter("suggested_plausible_min IS NOT NULL OR suggested_plausible_max IS NOT NULL")
    user = user.select(trim(F.col("question_key")).alias("question_key"), F.lit(True).alias("_user"),
                       F.col("suggested_plausible_min").alias("_lo"),
                       F.col("suggested_plausible_max").alias("_hi"),
                       *([F.col("dataset")] if "dataset" in user_ranges.columns else []))
    on = [n for n in ("dataset", "question_key") if n in user.columns]
    out = out.join(user, on, "left")
    for column, new in (("suggested_plausible_min", "_lo"), ("suggested_plausible_max", "_hi")):
        out = out.withColumn(column, F.when(F.col("_user"), F.col(new)).otherwise(F.col(column)))
    return out.drop("_user", "_lo", "_hi")


def assign_pii_tiers(variables: DataFrame, patterns: Mapping[str, str] | None = None,
                     quasi: Sequence[str] = QUASI_PATTERNS) -> DataFrame:
    """pii_tier 1 (confidential), 2 (first matching name pattern), quasi.  A key
    is tested as it is and as ``<key>.value``.  ``patterns``: pattern -> category."""
    patterns = patterns or {p: "identifier" for p in NAME_PATTERNS}
    named = {p: "(?i)" + p for p in patterns}
    key = F.col("question_key")
    hits = [value_pattern(key, {p: e}) for p, e in named.items()]
    with_value = [value_pattern(F.concat(key, F.lit(".value")), {p: e}) for p, e in named.items()]
    found = F.coalesce(*[x for pair in zip(hits, with_value) for x in pair])
    loose = F.lit(False)
    for q in quasi:
        loose = loose | key.rlike("(?i)" + q) | F.concat(key, F.lit(".value")).rlike("(?i)" + q)
    one = F.coalesce("confidential", F.lit(False))
    return (variables.withColumn("pii_matching_pattern", found)
            .withColumn("pii_tier", F.when(one, "1").when(F.col("pii_matching_pattern").isNotNull(), "2")
                        .when(loose, "quasi"))
            .withColumn("pii_category", F.when(one, "direct_identifier")
                        .otherwise(_map(patterns, F.col("pii_matching_pattern")))))


def option_table(data_keys: DataFrame) -> DataFrame:
    return (data_keys.filter((F.col("dataType") == "option") & ~F.col("isDeleted"))
            .groupBy("country", F.col("uniqueKey").alias("option_uuid"))
            .agg(F.min(F.struct(trim(F.col("name")).alias("code"), trim(F.col("label")).alias("label"))).alias("o"))
            .select("country", "option_uuid", F.col("o.code").alias("raw_code"),
                    F.col("o.label").alias("option_label")))


def build_value_maps(variables: DataFrame, data_keys: DataFrame) -> DataFrame:
    """Options of the chosen key versions in their order, then options only
    earlier versions had.  A code or label listed before is not listed again."""
    options = option_table(data_keys)
    current = (variables.filter(F.size("options") > 0)
               .select(*SCOPE, "question_key", F.posexplode("options").alias("pos", "option_uuid"))
               .join(options, ["country", "option_uuid"]).filter("raw_code IS NOT NULL"))
    w = Window.partitionBy(*SCOPE, "question_key").orderBy("pos")
    current = current.withColumn("option_order", F.row_number().over(w))
    current = first_row(current, [*SCOPE, "question_key", "option_label"], [F.col("option_order")])
    versions = (data_keys.filter((~F.col("isDeleted")) & (F.col("dataType") != "option"))
                .withColumn("question_key", db_name_col(F.col("name"))).filter(F.size("options") > 0)
                .join(variables.select(*SCOPE, "question_key"), ["country", "question_key"])
                .select(*SCOPE, "question_key", "publishDate", "uniqueKey",
                        F.posexplode("options").alias("pos", "option_uuid"))
                .join(options, ["country", "option_uuid"])
                .filter(F.coalesce(F.col("raw_code"), F.lit("")) != "")
                .withColumn("option_label", F.coalesce(F.nullif("option_label", F.lit("")), "raw_code")))
    place = [F.col("publishDate").desc_nulls_last(), F.col("uniqueKey"), F.col("pos")]
    older = first_row(versions, [*SCOPE, "question_key", "raw_code"], place)
    for column in ("raw_code", "option_label"):
        older = older.join(current.select(*SCOPE, "question_key", column),
                           [*SCOPE, "question_key", column], "left_anti")
    last = current.groupBy(*SCOPE, "question_key").agg(F.max("option_order").alias("_last"))
    newest_first = -F.unix_micros(F.col("publishDate").cast("timestamp"))
    older = (running_number(older, [*SCOPE, "question_key"], newest_first, place[1:], "_number")
             .join(last, [*SCOPE, "question_key"], "left")
             .withColumn("option_order", (F.coalesce("_last", F.lit(0)) + F.col("_number")).cast("int")))
    columns = [*SCOPE, "question_key", "raw_code", "option_label", "option_order", "option_uuid"]
    out = current.select(*columns).unionByName(older.select(*columns))
    return out.withColumn("canonical_code", F.col("raw_code"))


def patch_variables(variables: DataFrame, patches: DataFrame) -> DataFrame:
    """Upsert: every non-null column of a patch row replaces the variable's."""
    keys = [*SCOPE, "question_key"]
    changed = [n for n in patches.columns if n not in keys]
    p = patches.select(*keys, *[F.col(n).alias(f"_p_{n}") for n in changed])
    out = variables.join(p, keys, "left")
    return out.select(*[F.coalesce(f"_p_{n}", n).alias(n) if n in changed else F.col(n)
                        for n in variables.columns])


def patch_value_maps(maps: DataFrame, add: DataFrame | None = None, canonical: DataFrame | None = None,
                     keep_label: DataFrame | None = None) -> DataFrame:
    """Rows added unless the label is there, canonical codes updated, and of
    several rows with one raw code only the one with ``keep_label`` kept."""
    keys = [*SCOPE, "question_key"]
    if add is not None:
        new = add.join(maps.select(*keys, "option_label"), [*keys, "option_label"], "left_anti")
        last = maps.groupBy(*keys).agg(F.max("option_order").alias("_last"))
        w = Window.partitionBy(*keys).orderBy("option_order")
        new = (new.join(last, keys, "left").withColumn(
            "option_order", (F.coalesce("_last", F.lit(0)) + F.row_number().over(w)).cast("int")).drop("_last"))
        maps = maps.unionByName(new, allowMissingColumns=True)
    if canonical is not None:
        c = canonical.select(*keys, "raw_code", F.col("canonical_code").alias("_new"))
        maps = (maps.join(c, [*keys, "raw_code"], "left")
                .withColumn("canonical_code", F.coalesce("_new", "canonical_code")).drop("_new"))
    if keep_label is not None:
        k = keep_label.select(*keys, "raw_code", F.col("option_label").alias("_keep"))
        n = maps.groupBy(*keys, "raw_code").agg(F.count(F.lit(1)).alias("_n"))
        maps = (maps.join(k, [*keys, "raw_code"], "left").join(n, [*keys, "raw_code"])
                .filter(F.col("_keep").isNull() | (F.col("_n") == 1) | (F.col("_keep") == F.col("option_label")))
                .drop("_keep", "_n"))
    return maps


def review_needed(variables: DataFrame, maps: DataFrame) -> DataFrame:
    """Variables a person has to look at, with the reason."""
    mapped = maps.select(*SCOPE, "question_key").distinct().withColumn("_mapped", F.lit(True))
    reason = (F.when((F.col("r_type") == "categorical") & F.col("_mapped").isNull(),
                     "Categorical with no value map entries")
              .when((F.col("r_type") == "numeric") & F.col("suggested_plausible_min").isNull()
                    & F.col("suggested_plausible_max").isNull(), "Numeric without plausible range")
              .when(F.col("r_type").isNull(), "Unknown dataType (not in PIPELINE_TYPE_MAP)"))
    return (variables.join(mapped, [*SCOPE, "question_key"], "left")
            .withColumn("review_reason", reason).filter("review_reason IS NOT NULL").drop("_mapped"))


def _most_common(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent non-empty value per key, ties by text order; counted in two
    steps so no group is collected."""
    n = (rows.filter(F.coalesce(F.col(column), F.lit("")) != "").groupBy(*keys, column)
         .agg(F.count(F.lit(1)).alias("_n")))
    return n.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("_n"), column)).alias(column))


def field_consensus(fields: DataFrame, keys: Sequence[str] = ("question_key",)) -> DataFrame:
    """One line per key over several forms: modal label, condition and options;
    ``optional`` only where all forms agree."""
    keys = list(keys)
    flags = fields.groupBy(*keys).agg(
        F.when(F.min("optional") == F.max("optional"), F.min("optional")).alias("optional"))
    out = flags
    for column in ("display_label", "skip_condition", "options_str"):
        out = out.join(_most_common(fields, keys, column), keys, "left")
    return (out.withColumn("skip_condition", F.coalesce("skip_condition", F.lit("")))
            .withColumn("options_str", F.coalesce("options_str", F.lit(""))))


def options_differ(consensus: DataFrame, maps: DataFrame, keys: Sequence[str] = ("question_key",)) -> DataFrame:
    """Adds ``valuemap_check``: true when form and dictionary codes differ, null
    when there is nothing to compare.  The code sets are compared by a full join
    of their members."""
    keys = list(keys)
    parts = F.transform(F.split("options_str", ";"), lambda o: trim(F.get(F.split(o, r"\|"), F.lit(0))))
    form = (consensus.select(*keys, F.explode(F.array_distinct(parts)).alias("code")).filter("code <> ''")
            .withColumn("_form", F.lit(True)))
    known = (maps.select(*keys, trim(F.col("raw_code")).alias("code")).filter("code <> ''").distinct()
             .withColumn("_known", F.lit(True)))
    off = form.join(known, [*keys, "code"], "full").groupBy(*keys).agg(
        F.max(F.col("_form").isNull() | F.col("_known").isNull()).alias("_off"))
    check = F.when(trim(F.col("options_str")) != "", F.coalesce("_off", F.lit(True)))
    return consensus.join(off, keys, "left").withColumn("valuemap_check", check).drop("_off")


def enrich_variables(variables: DataFrame, fields: DataFrame, maps: DataFrame) -> DataFrame:
    """Variables with display label, optional flag, skip condition and the
    option check, from the form scripts of the same (country, dataset)."""
    keys = [*SCOPE, "question_key"]
    info = options_differ(field_consensus(fields, keys), maps, keys).drop("options_str")
    return variables.join(info, keys, "left")


def consensus_order(fields: DataFrame, keys: Sequence[str] = ("question_key",)) -> DataFrame:
    """Place of each key in the forms: modal screen (ties by title), the lowest
    index of that screen, lowest field index, first label and condition, the
    longest option text."""
    keys = list(keys)
    place = F.struct("form_order", "screen_idx", "field_idx")
    titled = fields.withColumn("screen_title", F.coalesce(F.nullif("screen_title", F.lit("")), F.lit("Other")))
    modal = _most_common(titled, keys, "screen_title")
    at = (titled.join(modal, [*keys, "screen_title"]).groupBy(*keys, "screen_title")
          .agg(F.min("screen_idx").alias("screen_idx")))

    def first_text(column: str) -> Column:
        text = F.when(trim(F.col(column)) != "", F.col(column))
        return F.min_by(text, F.when(text.isNotNull(), place))

    rest = titled.groupBy(*keys).agg(
        F.min("field_idx").alias("field_idx"), first_text("display_label").alias("json_label"),
        first_text("skip_condition").alias("skip_condition"),
        F.coalesce(F.max("optional"), F.lit(False)).alias("optional"),
        F.coalesce(F.max_by("options_text", F.when(
            trim(F.col("options_text")) != "",
            F.struct(F.length("options_text"), -F.col("form_order"), -F.col("screen_idx"),
                     -F.col("field_idx")))), F.lit("")).alias("options_text"))
    return at.join(rest, keys)


def number_text(x: Column) -> Column:
    return F.when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def values_text(maps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``code = label`` lines per key in option order, one line per code."""
    first = first_row(maps, [*keys, "raw_code"], [F.col("option_order").asc_nulls_last()])
    lines = F.transform(F.array_sort(F.collect_list(F.struct(
        "option_order", F.concat_ws(" = ", "raw_code", F.coalesce("option_label", F.lit("NA"))).alias("t")))),
        lambda x: x["t"])
    return first.groupBy(*keys).agg(F.array_join(lines, "\n").alias("values_and_codes"))


def user_dictionary(variables: DataFrame, order: DataFrame, maps: DataFrame) -> DataFrame:
    """Reader-facing rows per (country, dataset): section, description, name,
    type, values, missing codes and the other datasets that have the variable.

    Confidential variables and those not used in analysis are left out."""
    keys = [*SCOPE, "question_key"]
    used = variables.filter((F.coalesce("pii_tier", F.lit("")) != "1") & F.coalesce("use_in_analysis", F.lit(True)))
    v = used.join(order.withColumnRenamed("skip_condition", "_form_skip").drop("optional"), keys)
    v = v.join(values_text(maps, keys), keys, "left")
    low, high = F.col("suggested_plausible_min"), F.col("suggested_plausible_max")
    numeric = (F.when(low.isNotNull() & high.isNotNull(),
                      F.concat(F.lit("Range: "), number_text(low), F.lit(" to "), number_text(high)))
               .when(low.isNotNull(), F.concat(F.lit("Range: >= "), number_text(low)))
               .when(high.isNotNull(), F.concat(F.lit("Range: <= "), number_text(high)))
               .otherwise("Numeric value"))
    r = F.col("r_type")
    from_form = F.array_join(F.transform(F.split("options_text", "; "), lambda o: F.regexp_replace(
        o, r"^\s*([^=]*?)\s*=\s*(.*?)\s*$", "$1 = $2")), "\n")
    values = (F.when(is_staff_key_col(F.col("question_key")), STAFF_VALUES_NOTE)
              .when(r == "numeric", numeric).when(r == "datetime", "Date / time value")
              .when(r == "object", "Free text").when(F.col("values_and_codes").isNotNull(), F.col("values_and_codes"))
              .when(trim(F.col("options_text")) != "", from_form)
              .when(r == "boolean", "true / false").otherwise(""))
    skip = F.coalesce(F.nullif(trim(F.col("skip_condition")) if "skip_condition" in variables.columns
                               else F.lit(""), F.lit("")), F.nullif(trim(F.col("_form_skip")), F.lit("")), F.lit(""))
    codes = F.array_join(F.array_compact(F.array(
        F.lit("-9 (unknown / missing)"),
        F.when(r.isin("numeric", "boolean", "categorical", "datetime"), F.lit("-8 (invalid / out of range)")),
        F.when(skip != "", F.lit("-7 (not applicable, skip logic)")),
        F.when((F.coalesce("pii_tier", F.lit("")) != "") & (F.col("pii_tier") != "1") & (r == "object"),
               F.lit("-6 (redacted, PII)")))), "\n")
    system = (F.coalesce("record_id_role", F.lit("")) != "") | (F.coalesce("linkage_role", F.lit("")) != "")
    label = F.col("display_label") if "display_label" in variables.columns else F.lit(None).cast("string")
    sets = (v.select("country", "question_key", "dataset").distinct().groupBy("country", "question_key")
            .agg(F.array_sort(F.collect_list("dataset")).alias("_sets")))
    v = v.join(sets, ["country", "question_key"])
    return v.select(
        *keys, F.when(system, "Administrative / System").otherwise(F.col("screen_title")).alias("section"),
        F.when(system, F.lit(-1)).otherwise(F.col("screen_idx")).alias("screen_idx"), "field_idx",
        F.coalesce(F.nullif(trim(label), F.lit("")), F.nullif(trim(F.col("json_label")), F.lit("")),
                   F.nullif(trim(F.col("variable_label")), F.lit("")), "question_key").alias("description"),
        F.coalesce(F.nullif(trim(F.col("harmonised_variable_name")), F.lit("")), "question_key")
        .alias("variable_name"),
        F.coalesce(_map({"numeric": "Numeric", "boolean": "Boolean", "categorical": "Categorical",
                         "object": "Text", "datetime": "Date/time"}, r), F.lit("")).alias("type"),
        values.alias("values_and_codes"), codes.alias("na_codes"),
        F.array_join(F.array_remove("_sets", F.col("dataset")), ", ").alias("available_in"))


def master_rows(user_rows: DataFrame, dataset_order: Sequence[str]) -> DataFrame:
    """First row of each variable name over the datasets in the given order; other datasets come last."""
    place = F.nullif(F.array_position(F.array(*[F.lit(d) for d in dataset_order]), F.col("dataset")), F.lit(0))
    return first_row(user_rows, ["country", "variable_name"],
                     [place.asc_nulls_last(), F.col("screen_idx"), F.col("field_idx"), F.col("question_key")])


def carry_over(base: DataFrame, enriched: DataFrame, columns: Sequence[str], base_time: float,
               enriched_time: float) -> DataFrame:
    """Script columns of an earlier enriched table, only when it is not older
    than the base and lists the same keys."""
    keys = [*SCOPE, "question_key"]
    stale = enriched_time < base_time
    same = not stale and (base.select(*keys).exceptAll(enriched.select(*keys)).isEmpty()
                          and enriched.select(*keys).exceptAll(base.select(*keys)).isEmpty())
    return base.join(enriched.select(*keys, *columns), keys, "left") if same else base
