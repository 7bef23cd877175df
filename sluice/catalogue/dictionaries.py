"""Dictionary build and checks; the part table plays the key export, the line
items say in which forms a key is used."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalogue import query
from sluice.catalogue.views import table, view
from sluice.functions.pii import NAME_PATTERNS, QUASI_PATTERNS
from sluice.operators import dictionary_build as build
from sluice.operators.dictionary_checks import check_dictionary
from sluice.operators.ranking import running_number
from sluice.session import cut_lineage

_TITLES = [("Dr Jane Roe", "Site A"), ("(Dr Jane Roe)", "(Ward B)")]
_DATASETS = {"admissions": "Admission", "discharges": "Discharge", "maternal_outcomes": "Maternal",
             "phc_admissions": "PHC.*Admission"}


def _usage(spark, sf_dir):
    return build.replace_titles(view(spark, sf_dir, "key_usage"), _TITLES)


def variables_table(spark, sf_dir):
    return build.build_variables(view(spark, sf_dir, "data_keys"), _usage(spark, sf_dir), titles=_DATASETS)


_HITS = ", ".join(f"CASE WHEN regexp_matches(scripttitle, '(?i){p}') THEN '{d}' END" for d, p in _DATASETS.items())
_KEYS = f"""us AS (SELECT country, datakeyuniquekey, replace(replace(scripttitle, '(Dr Jane Roe)', '(Ward B)'), 'Dr Jane Roe', 'Site A') AS scripttitle FROM key_usage),
 du AS (SELECT DISTINCT country, datakeyuniquekey AS uk, scripttitle, unnest([{_HITS}]) AS dataset FROM us),
 sec AS (SELECT country, dataset, uk, string_agg(scripttitle, '; ' ORDER BY scripttitle) AS section FROM du WHERE dataset IS NOT NULL GROUP BY ALL),
 kv AS (SELECT k.*, dataset, section, regexp_replace(lower(trim(name)), '[^a-z0-9]', '', 'g') AS question_key FROM data_keys k
   JOIN sec ON sec.country = k.country AND sec.uk = k.uniqueKey WHERE NOT isDeleted AND dataType <> 'option'),
 vd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, dataset, question_key ORDER BY publishDate DESC NULLS LAST, uniqueKey) AS rn
   FROM kv WHERE question_key <> '') z WHERE rn = 1)"""
_USES = ("data_keys", "key_usage")


@query("latest_version", f"""WITH {_KEYS} SELECT country, dataset, question_key, uniqueKey AS key_unique_key FROM vd""", _USES)
def latest_version(spark, sf_dir):
    return variables_table(spark, sf_dir).select("country", "dataset", "question_key", "key_unique_key")


_SNAKE = r"""regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(name, '([a-z0-9])([A-Z])', '\1_\2', 'g'))),
 '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '(^_|_$)', '', 'g')"""
_PAT = "CASE " + " ".join(f"WHEN regexp_matches(question_key, '(?i){p}') OR regexp_matches(question_key || '.value', '(?i){p}') THEN '{p}'"
                          for p in NAME_PATTERNS) + " END"
_QUASI = " OR ".join(f"regexp_matches(question_key, '(?i){p}') OR regexp_matches(question_key || '.value', '(?i){p}')" for p in QUASI_PATTERNS)
_RTYPE = """CASE dataType WHEN 'number' THEN 'numeric' WHEN 'datetime' THEN 'datetime' WHEN 'yesno' THEN 'boolean'
 WHEN 'dropdown' THEN 'categorical' WHEN 'text' THEN 'object' END"""
_VARS = f"""{_KEYS}, va AS (SELECT country, dataset, question_key, question_key || '.value' AS raw_value_column, question_key || '.label' AS raw_label_column,
 label AS variable_label, dataType AS raw_data_type, {_RTYPE} AS r_type, section, {_SNAKE} AS harmonised_variable_name,
 NOT (dataType = 'text' OR isDraft) AS use_in_analysis, confidential, uniqueKey AS key_unique_key, options,
 cast(CASE WHEN question_key = 'smallring' THEN 1 WHEN question_key = 'apgar5' THEN 0 END AS double) AS lo, CASE WHEN question_key = 'smallring' THEN NULL END AS hi,
 CASE WHEN confidential THEN '1' WHEN ({_PAT}) IS NOT NULL THEN '2' WHEN {_QUASI} THEN 'quasi' END AS pii_tier, ({_PAT}) AS pii_matching_pattern FROM vd)"""


def _ranged(spark, sf_dir):
    user = (table(spark, sf_dir, "part").select(F.regexp_replace("p_name", " ", "").alias("question_key")).distinct()
            .filter("question_key = 'smallring'")
            .select("question_key", F.lit(1.0).alias("suggested_plausible_min"),
                    F.lit(None).cast("double").alias("suggested_plausible_max")))
    return build.assign_pii_tiers(build.apply_ranges(variables_table(spark, sf_dir), user))


def _built(spark, sf_dir):
    """Variables and value maps, built once for the steps that read them again."""
    v = cut_lineage(_ranged(spark, sf_dir))
    return v, build.build_value_maps(v, view(spark, sf_dir, "data_keys"))


@query("dictionary_build", f"""WITH {_VARS} SELECT country, dataset, question_key, raw_value_column, raw_label_column, variable_label,
 raw_data_type, r_type, section, harmonised_variable_name, use_in_analysis, confidential, key_unique_key,
 lo AS suggested_plausible_min, pii_tier, pii_matching_pattern FROM va""", _USES)
def dictionary_build(spark, sf_dir):
    """Variables of every (country, dataset): versions, types, ranges, tiers."""
    return _ranged(spark, sf_dir).select(
        "country", "dataset", "question_key", "raw_value_column", "raw_label_column", "variable_label", "raw_data_type",
        "r_type", "section", "harmonised_variable_name", "use_in_analysis", "confidential", "key_unique_key",
        "suggested_plausible_min", "pii_tier", "pii_matching_pattern")


_OPT = """op AS (SELECT country, uniqueKey AS option_uuid, trim(name) AS raw_code, trim(label) AS option_label FROM data_keys WHERE dataType = 'option' AND NOT isDeleted),
 cur0 AS (SELECT country, dataset, question_key, unnest(options) AS option_uuid, generate_subscripts(options, 1) - 1 AS pos FROM va),
 cur1 AS (SELECT c.*, raw_code, option_label, row_number() OVER (PARTITION BY c.country, dataset, question_key ORDER BY pos) AS option_order
   FROM cur0 c JOIN op USING (country, option_uuid)),
 cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, dataset, question_key, option_label ORDER BY option_order) AS rn FROM cur1) z WHERE rn = 1),
 old0 AS (SELECT k.country, va.dataset, va.question_key, k.publishDate, k.uniqueKey, unnest(k.options) AS option_uuid, generate_subscripts(k.options, 1) - 1 AS pos
   FROM data_keys k JOIN va ON va.country = k.country AND va.question_key = regexp_replace(lower(trim(k.name)), '[^a-z0-9]', '', 'g')
   WHERE NOT k.isDeleted AND k.dataType <> 'option'),
 old1 AS (SELECT o.*, raw_code, coalesce(nullif(option_label, ''), raw_code) AS option_label FROM old0 o JOIN op USING (country, option_uuid) WHERE raw_code <> ''),
 old2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, dataset, question_key, raw_code
   ORDER BY publishDate DESC NULLS LAST, uniqueKey, pos) AS rn FROM old1) z WHERE rn = 1),
 old AS (SELECT * FROM old2 o WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.country = o.country AND c.dataset = o.dataset AND c.question_key = o.question_key AND c.raw_code = o.raw_code)
   AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.country = o.country AND c.dataset = o.dataset AND c.question_key = o.question_key AND c.option_label = o.option_label)),
 mx AS (SELECT country, dataset, question_key, max(option_order) AS m FROM cur GROUP BY ALL),
 vm AS (SELECT country, dataset, question_key, raw_code, option_label, option_order, option_uuid FROM cur UNION ALL
   SELECT country, dataset, question_key, raw_code, option_label, coalesce(m, 0) + row_number() OVER (PARTITION BY country, dataset, question_key
     ORDER BY publishDate DESC NULLS LAST, uniqueKey, pos), option_uuid FROM old LEFT JOIN mx USING (country, dataset, question_key))"""


@query("option_order", f"""WITH {_VARS}, {_OPT} SELECT country, dataset, question_key, raw_code, option_label, cast(option_order AS bigint) AS option_order,
 option_uuid FROM vm""", _USES)
def option_order(spark, sf_dir):
    """Value maps: options of the chosen versions, then those only earlier versions had."""
    maps = build.build_value_maps(variables_table(spark, sf_dir), view(spark, sf_dir, "data_keys"))
    return maps.select("country", "dataset", "question_key", "raw_code", "option_label",
                       F.col("option_order").cast("bigint").alias("option_order"), "option_uuid")


@query("review_needed", f"""WITH {_VARS}, {_OPT} SELECT country, dataset, question_key, CASE WHEN r_type = 'categorical' THEN 'Categorical with no value map entries'
 WHEN r_type = 'numeric' THEN 'Numeric without plausible range' ELSE 'Unknown dataType (not in PIPELINE_TYPE_MAP)' END AS review_reason FROM va
 WHERE r_type IS NULL OR (r_type = 'numeric' AND lo IS NULL) OR (r_type = 'categorical'
  AND NOT EXISTS (SELECT 1 FROM vm WHERE vm.country = va.country AND vm.dataset = va.dataset AND vm.question_key = va.question_key))""", _USES)
def review_needed(spark, sf_dir):
    v, maps = _built(spark, sf_dir)
    return build.review_needed(v, maps).select("country", "dataset", "question_key", "review_reason")


@query("dictionary_checks", f"""WITH {_VARS}, {_OPT}, n AS (SELECT dataset, question_key FROM va)
SELECT 'variables' AS "table", 'analysis rows without r_type' AS "check", 'warning' AS level, count(*) FILTER (use_in_analysis AND r_type IS NULL) AS n_bad FROM va
UNION ALL SELECT 'variables', 'range minimum not below maximum', 'error', 0
UNION ALL SELECT 'variables', 'unknown pii_tier', 'error', 0
UNION ALL SELECT 'variables', 'tier 2 without a pattern', 'warning', 0
UNION ALL SELECT 'variables', 'confidential without tier 1 or 2', 'warning', 0
UNION ALL SELECT 'value_maps', 'keys not in variables', 'warning', count(*) FROM (SELECT DISTINCT 'O' || question_key AS q FROM vm) x WHERE q NOT IN (SELECT question_key FROM va)""", _USES)
def dictionary_checks(spark, sf_dir):
    v, maps = _built(spark, sf_dir)
    return check_dictionary(v, maps.withColumn("question_key", F.concat(F.lit("O"), "question_key")))


_FIELDS_SQL = """fl AS (SELECT p_partkey, lower(p_brand) AS question_key, p_size % 8 AS screen_idx, p_partkey % 5 AS field_idx,
 CASE WHEN p_size % 9 = 0 THEN '' ELSE p_type END AS display_label, CASE WHEN p_size % 4 = 0 THEN '' ELSE '$' || p_name || ' = 1' END AS skip_condition,
 CASE WHEN p_size % 3 = 0 THEN '' ELSE substr(p_type, 1, 1) || '|' || p_type || ';' || substr(p_name, 1, 2) || '|x' END AS options_str,
 CASE WHEN p_brand = 'Brand#1' THEN true ELSE p_size % 2 = 0 END AS optional FROM part)"""


def form_fields(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        "p_partkey", F.lower("p_brand").alias("question_key"), (size % 8).alias("screen_idx"),
        (F.col("p_partkey") % 5).alias("field_idx"), F.col("p_partkey").alias("form_order"),
        F.when(size % 9 == 0, "").otherwise(F.col("p_type")).alias("display_label"), F.col("p_type").alias("screen_title"),
        F.when(size % 4 == 0, "").otherwise(F.concat(F.lit("$"), "p_name", F.lit(" = 1"))).alias("skip_condition"),
        F.when(size % 3 == 0, "").otherwise(F.concat(F.substring("p_type", 1, 1), F.lit("|"), "p_type", F.lit(";"),
                                                     F.substring("p_name", 1, 2), F.lit("|x"))).alias("options_str"),
        F.when(size % 3 == 0, "").otherwise(F.concat(F.substring("p_type", 1, 1), F.lit("="), "p_type")).alias("options_text"),
        F.when(F.col("p_brand") == "Brand#1", True).otherwise(size % 2 == 0).alias("optional"))


def _mode_sql(column: str) -> str:
    return (f"(SELECT question_key, arg_min({column}, (-n, {column})) AS {column} FROM (SELECT question_key, {column}, count(*) AS n FROM fl "
            f"WHERE {column} <> '' GROUP BY ALL) x GROUP BY question_key)")


@query("consensus_fields", f"""WITH {_FIELDS_SQL}, dict AS (SELECT lower(p_brand) AS question_key, list_sort(list_distinct(list(substr(p_type, 1, 1)) || list(substr(p_name, 1, 2)))) AS codes
  FROM part WHERE p_size % 3 <> 0 AND p_brand <> 'Brand#3' GROUP BY 1)
SELECT b.question_key, b.optional, d.display_label, coalesce(s.skip_condition, '') AS skip_condition, coalesce(o.options_str, '') AS options_str,
 CASE WHEN coalesce(o.options_str, '') = '' THEN NULL ELSE list_sort(list_distinct([string_split(x, '|')[1] for x in string_split(o.options_str, ';')])) IS DISTINCT FROM dict.codes END AS valuemap_check
FROM (SELECT question_key, CASE WHEN min(optional) = max(optional) THEN min(optional) END AS optional FROM fl GROUP BY 1) b
LEFT JOIN {_mode_sql('display_label')} d USING (question_key) LEFT JOIN {_mode_sql('skip_condition')} s USING (question_key)
LEFT JOIN {_mode_sql('options_str')} o USING (question_key) LEFT JOIN dict USING (question_key)""")
def consensus_fields(spark, sf_dir):
    """Modal label, condition and options per field, compared with the dictionary."""
    f = form_fields(spark, sf_dir)
    codes = f.filter("options_str <> '' AND question_key <> 'brand#3'").select(
        "question_key", F.explode(F.array(F.substring("options_str", 1, 1), F.regexp_extract("options_str", ";(.*)[|]x$", 1))).alias("raw_code"))
    return build.options_differ(build.field_consensus(f), codes)


@query("consensus_order", f"""WITH {_FIELDS_SQL}, t AS (SELECT fl.*, p_type FROM fl JOIN part USING (p_partkey)),
 md AS (SELECT question_key, arg_min(p_type, (-n, p_type)) AS screen_title FROM (SELECT question_key, p_type, count(*) AS n FROM t GROUP BY ALL) x GROUP BY 1),
 si AS (SELECT t.question_key, screen_title, min(screen_idx) AS screen_idx FROM t JOIN md ON md.question_key = t.question_key AND md.screen_title = t.p_type GROUP BY ALL)
SELECT si.*, r.field_idx, r.json_label, r.skip_condition, r.optional FROM si JOIN (SELECT question_key, min(field_idx) AS field_idx,
 arg_min(display_label, p_partkey) FILTER (trim(display_label) <> '') AS json_label, arg_min(skip_condition, p_partkey) FILTER (trim(skip_condition) <> '') AS skip_condition,
 bool_or(optional) AS optional FROM t GROUP BY 1) r USING (question_key)""")
def consensus_order(spark, sf_dir):
    """Place, label and condition of each field over all forms."""
    return build.consensus_order(form_fields(spark, sf_dir)).drop("options_text")


@query("numbered_options", """SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS option_order FROM part""")
def numbered_options(spark, sf_dir):
    """Running option number within a key of any size."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return running_number(p, ["p_brand"], F.col("p_size"), [F.col("p_partkey")], "option_order").drop("p_size")


@query("user_dictionary")
def user_dictionary(spark, sf_dir):
    """Reader-facing dictionary rows, one per dataset and variable."""
    v, maps = _built(spark, sf_dir)
    scope = v.select("country", "dataset", "question_key", "raw_data_type")
    fields = (form_fields(spark, sf_dir).drop("question_key")
              .withColumn("question_key", F.regexp_replace(F.lower("screen_title"), " ", "")))
    by_type = table(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_name", " ", "").alias("_k"))
    fields = fields.join(by_type, "p_partkey").withColumn("question_key", F.col("_k")).drop("_k")
    order = build.consensus_order(fields.join(scope.select("country", "dataset", "question_key"), "question_key"),
                                  ["country", "dataset", "question_key"])
    return build.user_dictionary(v, order, maps)


@query("master_rows")
def master_rows(spark, sf_dir):
    """First row of each variable over all datasets."""
    return build.master_rows(user_dictionary(spark, sf_dir), list(_DATASETS))
