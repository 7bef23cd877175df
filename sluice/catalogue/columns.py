"""Column decisions and run plans, with names and files read from table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalogue import query
from sluice.catalogue.views import table, view
from sluice.functions.pii import NAME_PATTERNS, QUASI_PATTERNS, value_pattern
from sluice.functions.text import snake_name_col
from sluice.operators.columns import merge_duplicates, resolve_twins
from sluice.plans.columns import describe_names
from sluice.plans.registry import DATASETS, file_plan, pair_files, registry


@query("merge_duplicate_columns", """SELECT c_custkey, CASE WHEN (SELECT count(bal_b) > count(bal_a) FROM dup_customer)
 THEN coalesce(bal_b, bal_a) ELSE coalesce(bal_a, bal_b) END AS balance FROM dup_customer""", ("dup_customer",))
def merge_duplicate_columns(spark, sf_dir):
    df = view(spark, sf_dir, "dup_customer").select("c_custkey", "bal_a", "bal_b").toDF("p0", "p1", "p2")
    return merge_duplicates(df, ["c_custkey", "balance", "balance"])


@query("resolve_prefix_columns", """SELECT c_custkey, CASE WHEN (SELECT count(seg) >= count(seg_value) FROM dup_customer)
 THEN seg ELSE seg_value END AS segment, CASE WHEN (SELECT count(seg) >= count(seg_value) FROM dup_customer)
 THEN 'seg' ELSE 'seg.value' END AS kept FROM dup_customer""", ("dup_customer",))
def resolve_prefix_columns(spark, sf_dir):
    df = view(spark, sf_dir, "dup_customer").select(
        "c_custkey", "seg", F.col("seg_value").alias("seg.value"), F.col("seg_label").alias("seg.label"))
    out = resolve_twins(df, protect=("c_custkey",))
    kept = out.columns[1]
    return out.toDF("c_custkey", "segment").withColumn("kept", F.lit(kept))


_NAME = r"""lower(regexp_replace(regexp_replace(trim(raw), '\s*\.\s*', '.', 'g'), '[\s_]+', '', 'g'))"""
_SUFFIX = r"\.(valuedischarge|labeldischarge|value|label|parentkey)$"


@query("column_plan", rf"""WITH n AS (SELECT *, {_NAME} AS name FROM header_names)
SELECT p_partkey, raw, name, CASE WHEN regexp_extract(name, '{_SUFFIX}', 1) = '' THEN 'bare'
  ELSE regexp_extract(name, '{_SUFFIX}', 1) END AS role, regexp_replace(name, '{_SUFFIX}', '') AS base,
  lower(regexp_replace(regexp_replace(name, '\.value(discharge)?$', ''), '[^A-Za-z0-9]', '', 'g')) AS lookup_key FROM n""",
    ("header_names",))
def column_plan(spark, sf_dir):
    return describe_names(view(spark, sf_dir, "header_names"), "raw")


@query("snake_names", r"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(
 concat(p_name, 'Of', p_type), '([a-z0-9])([A-Z])', '\1_\2', 'g'))), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'),
 '(^_|_$)', '', 'g') AS snake FROM part""")
def snake_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", snake_name_col(F.concat("p_name", F.lit("Of"), "p_type")).alias("snake"))


_T2 = "CASE " + " ".join(f"WHEN regexp_matches(name, '(?i){p}') THEN '{p}'" for p in NAME_PATTERNS) + " END"
_Q = " OR ".join(f"regexp_matches(name, '(?i){p}')" for p in QUASI_PATTERNS)


@query("pii_columns", f"""WITH n AS (SELECT *, {_NAME} AS name FROM header_names),
 t AS (SELECT name, {_T2} AS pattern, {_Q} AS quasi FROM n)
SELECT CASE WHEN pattern IS NOT NULL THEN 'removed_tier_2' WHEN quasi THEN 'quasi_identifier_kept' ELSE 'kept' END AS decision,
 coalesce(pattern, '') AS pattern, count(*) AS n FROM t GROUP BY ALL""", ("header_names",))
def pii_columns(spark, sf_dir):
    """Decision per header name: removed by pattern, flagged, kept."""
    names = describe_names(view(spark, sf_dir, "header_names"), "raw")
    pattern = value_pattern(F.col("name"), {p: "(?i)" + p for p in NAME_PATTERNS})
    quasi = value_pattern(F.col("name"), {p: "(?i)" + p for p in QUASI_PATTERNS}).isNotNull()
    t = names.select(pattern.alias("p"), quasi.alias("q"))
    return t.groupBy(F.when(F.col("p").isNotNull(), "removed_tier_2").when(F.col("q"), "quasi_identifier_kept")
                     .otherwise("kept").alias("decision"), F.coalesce("p", F.lit("")).alias("pattern")
                     ).agg(F.count(F.lit(1)).alias("n"))


_FILE = r"(?i)^(mwi|zim)_((db|mb)_)?(.+)_([0-9]{12}|[0-9]{8}|[0-9]{4}-[0-9]{2}-[0-9]{2})\.csv$"
_KNOWN = ", ".join(f"'{d[0]}'" for d in DATASETS)
_PAIR = "CASE dataset " + " ".join(f"WHEN '{d[0]}' THEN '{d[2]}'" for d in DATASETS if d[2]) + " END"


@query("batch_plan", rf"""WITH p AS (SELECT file_name, regexp_matches(file_name, '{_FILE}') AS ok,
  nullif(lower(concat(regexp_extract(file_name, '{_FILE}', 1), '_', regexp_extract(file_name, '{_FILE}', 2))), '_') AS prefix,
  nullif(upper(regexp_extract(file_name, '{_FILE}', 1)), '') AS country, lower(regexp_extract(file_name, '{_FILE}', 3)) AS src,
  nullif(lower(regexp_extract(file_name, '{_FILE}', 4)), '') AS dataset,
  nullif(regexp_extract(file_name, '{_FILE}', 5), '') AS stamp FROM (SELECT DISTINCT file_name FROM file_names) f),
 q AS (SELECT *, dataset IN ({_KNOWN}) AS known, CASE WHEN dataset IN ({_KNOWN}) THEN {_PAIR} END AS pair FROM p),
 r AS (SELECT * FROM q WHERE known),
 same AS (SELECT prefix, dataset, stamp, max(file_name) AS f FROM r GROUP BY ALL),
 latest AS (SELECT prefix, dataset, max(file_name) AS f FROM r GROUP BY ALL)
SELECT q.file_name, q.country, CASE WHEN NOT ok THEN NULL WHEN src = 'db' THEN 'database' WHEN src = 'mb' THEN 'metabase'
  ELSE 'auto' END AS source, q.dataset, coalesce(known, false) AS run,
  CASE WHEN NOT ok THEN 'filename does not match expected pattern'
   WHEN NOT known THEN concat('unrecognised dataset type ''', q.dataset, '''') END AS reason,
  coalesce(same.f, latest.f) AS paired_file
FROM q LEFT JOIN same ON same.prefix = q.prefix AND same.dataset = q.pair AND same.stamp = q.stamp
 LEFT JOIN latest ON latest.prefix = q.prefix AND latest.dataset = q.pair""", ("file_names",))
def batch_plan(spark, sf_dir):
    files = view(spark, sf_dir, "file_names").select("file_name").distinct()
    plan = pair_files(file_plan(files, registry(spark)))
    return plan.select("file_name", "country", "source", "dataset", "run", "reason", "paired_file")
