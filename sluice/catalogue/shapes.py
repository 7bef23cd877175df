"""Scan rules, shape parsers and their class counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sluice.catalogue import query
from sluice.catalogue.views import view
from sluice.functions.categories import split_date
from sluice.functions.shapes import (datetime_class, datetime_shape, format_datetime, numeric_shape,
                                     parse_boolean)
from sluice.functions.text import normalise_cell
from sluice.operators.dedup import dedup_patients
from sluice.operators.metrics import class_counts
from sluice.session import shared_folder
from sluice.sources.csv_records import scan
from sluice.sources.csv_text import combined_style, style_counts

NUM_CASE = r"""CASE WHEN s IS NULL OR s = '' THEN NULL
  WHEN regexp_matches(s, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$') THEN 'plain'
  WHEN regexp_matches(s, '^[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$') THEN 'thousands'
  WHEN regexp_matches(s, '^[+-]?[0-9]+,[0-9]{1,2}$') THEN 'decimal_comma'
  WHEN len(regexp_extract_all(s, '[0-9]+(\.[0-9]+)?')) = 1 THEN 'fallback'
  WHEN len(regexp_extract_all(s, '[0-9]+(\.[0-9]+)?')) > 1 THEN 'multi_number' ELSE 'non_numeric' END"""
NUM_VALUE = r"""CASE shape WHEN 'plain' THEN try_cast(s AS double) WHEN 'thousands' THEN try_cast(replace(s, ',', '') AS double)
  WHEN 'decimal_comma' THEN try_cast(replace(s, ',', '.') AS double)
  WHEN 'fallback' THEN try_cast(regexp_extract(s, '[0-9]+(\.[0-9]+)?') AS double) END"""


def num_sql(column: str) -> str:
    return (f"num AS (SELECT *, {NUM_VALUE} AS num_value FROM (SELECT *, {NUM_CASE} AS shape "
            f"FROM (SELECT *, trim({column}) AS s FROM dirty_orders) a) b)")


ISO = (r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}([ T][0-9]{1,2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?\s*"
       r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?)?$")
_T = r"([ T,]+[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?\s*([AaPp][Mm])?)?$"
DAY_FIRST = "|".join(rf"^[0-9]{{1,2}}{s}[0-9]{{1,2}}{s}([0-9]{{4}}|[0-9]{{2}}){_T}" for s in ("/", "-", r"\."))
MONTH_FIRST = "|".join(rf"^(0?[0-9]|1[0-2]){s}(1[3-9]|[2-9][0-9]){s}([0-9]{{4}}|[0-9]{{2}}){_T}"
                       for s in ("/", "-", r"\."))
_M = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
NAMED = rf"(?i)^{_M}\s+[0-9]{{1,2}},?\s+[0-9]{{4}}{_T}|^[0-9]{{1,2}}[ -]{_M}[ ,-]+[0-9]{{4}}{_T}"


def dt_sql(column: str, source: str = "dirty_orders") -> str:
    """DuckDB side of the datetime parser (formats the views write)."""
    iso = (r"try_cast(replace(regexp_replace(s, '(:[0-9]{2})\s*(Z|[+-][0-9]{2}:?[0-9]{2})$', '\1'), 'T', ' ') "
           "AS timestamp)")
    day = r"regexp_replace(regexp_replace(s, '[-.]', '/', 'g'), '/([0-9]{2})$', '/20\1')"
    return f"""dt AS (SELECT *, CASE route WHEN 'iso' THEN {iso}
      WHEN 'day_first' THEN coalesce(try_strptime({day}, '%d/%m/%Y %H:%M'), try_strptime({day}, '%d/%m/%Y'))
      WHEN 'month_name' THEN try_strptime(s, ['%B %d, %Y, %I:%M %p', '%d %B %Y']) END AS dt_value
    FROM (SELECT *, CASE WHEN s IS NULL OR s = '' OR s = 'NA' THEN NULL WHEN regexp_matches(s, '{ISO}') THEN 'iso'
      WHEN regexp_matches(s, '{MONTH_FIRST}') THEN 'month_first' WHEN regexp_matches(s, '{DAY_FIRST}') THEN 'day_first'
      WHEN regexp_matches(s, '{NAMED}') THEN 'month_name' ELSE 'other' END AS route
      FROM (SELECT *, trim({column}) AS s FROM {source}) a) b)"""


DT_CLASS = """CASE WHEN route IS NULL OR route = 'month_first' OR dt_value IS NOT NULL THEN route
  ELSE 'unparsed' END"""


@query("num_shape", f"WITH {num_sql('price_value')} SELECT _rid, shape, num_value FROM num", ("dirty_orders",))
def num_shape(spark, sf_dir):
    n = numeric_shape(F.col("price_value"))
    return (view(spark, sf_dir, "dirty_orders").select("_rid", n.alias("n"))
            .select("_rid", F.col("n.shape").alias("shape"), F.col("n.value").alias("num_value")))


@query("num_shape_counts", f"""WITH {num_sql('price_value')}
SELECT 'types' AS step, 'price_value' AS "column", shape AS metric, count(*) AS n FROM num
WHERE shape IS NOT NULL GROUP BY shape""", ("dirty_orders",))
def num_shape_counts(spark, sf_dir):
    df = view(spark, sf_dir, "dirty_orders").select(numeric_shape(F.col("price_value")).alias("n"))
    return class_counts(df, "types", {"price_value": F.col("n.shape")})


@query("dt_shape", f"""WITH {dt_sql('odate_value')}
SELECT _rid, {DT_CLASS} AS shape, strftime(dt_value, '%Y-%m-%d %H:%M:%S') AS dt_text,
  route IS NOT NULL AND route = 'iso' AND regexp_matches(s, ':[0-9]{{2}}\\s*(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$') AS offset_dropped
FROM dt""", ("dirty_orders",))
def dt_shape(spark, sf_dir):
    df = view(spark, sf_dir, "dirty_orders").select("_rid", datetime_shape(F.col("odate_value")).alias("d"))
    return df.select("_rid", datetime_class(F.col("d")).alias("shape"),
                     format_datetime(F.col("d.value")).alias("dt_text"), "d.offset_dropped")


@query("dt_shape_counts", f"""WITH {dt_sql('odate_value')}
SELECT 'types' AS step, 'odate_value' AS "column", {DT_CLASS} AS metric, count(*) AS n FROM dt
WHERE route IS NOT NULL GROUP BY 3""", ("dirty_orders",))
def dt_shape_counts(spark, sf_dir):
    df = view(spark, sf_dir, "dirty_orders").select(datetime_shape(F.col("odate_value")).alias("d"))
    return class_counts(df, "types", {"odate_value": datetime_class(F.col("d"))})


@query("bool_tokens", """SELECT _rid, CASE WHEN lower(trim(flag_value)) IN ('true','yes','y','1','t') THEN true
 WHEN lower(trim(flag_value)) IN ('false','no','n','0','f') THEN false END AS flag FROM dirty_orders""", ("dirty_orders",))
def bool_tokens(spark, sf_dir):
    return view(spark, sf_dir, "dirty_orders").select("_rid", parse_boolean(F.col("flag_value")).alias("flag"))


@query("mixed_date_split", f"""WITH {dt_sql('mixed_value')} SELECT _rid, mixed_value,
  strftime(dt_value, '%Y-%m-%d %H:%M:%S') AS mixed_date FROM dt""", ("dirty_orders",))
def mixed_date_split(spark, sf_dir):
    return view(spark, sf_dir, "dirty_orders").select(
        "_rid", "mixed_value", format_datetime(split_date(F.col("mixed_value"))).alias("mixed_date"))


_CELLS = ("uid", "facility", "price_value", "status_value", "prio_value", "flag_value", "note_value")


@query("scan_normalise", "SELECT _rid, " + ", ".join(
    f"CASE WHEN trim({n}) NOT IN ('', 'NA') THEN trim({n}) END AS {n}" for n in _CELLS) + " FROM dirty_orders",
    ("dirty_orders",))
def scan_normalise(spark, sf_dir):
    return view(spark, sf_dir, "dirty_orders").select(
        "_rid", *[normalise_cell(F.col(n)).alias(n) for n in _CELLS])


_BLANKS = "' ' || chr(9) || chr(13) || chr(10)"
# One cell with an open-ended quote, a comma and line ends of both kinds, one with quotes alone.
_HARD = "concat(source, ' \"', {n}(13), {n}(10), 'a,\"b\"\"', {n}(10), lang, '\" ,')", "concat('\"', lang, '\"')"


@query("csv_round_trip", "SELECT doc_id, n_chars, " + ", ".join(
    f"sha256(CASE WHEN trim({x}, {_BLANKS}) NOT IN ('', 'NA') THEN trim({x}, {_BLANKS}) END) AS {n}"
    for n, x in (("text_sha", "text"), ("note_sha", _HARD[0].format(n="chr")), ("quoted_sha", _HARD[1]))) + " FROM documents")
def csv_round_trip(spark, sf_dir):
    """Documents written as CSV text and scanned again: cells with line ends, quotes and commas come back."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    (docs.select("doc_id", "n_chars", "text", F.expr(_HARD[0].format(n="char")).alias("note"), F.expr(_HARD[1]).alias("quoted"))
     .write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(folder))
    found = scan(spark, folder)
    return found.rows.select(
        F.col("c0").cast("bigint").alias("doc_id"), F.col("c1").cast("bigint").alias("n_chars"),
        *[F.sha2(f"c{i}", 256).alias(n) for i, n in ((2, "text_sha"), (3, "note_sha"), (4, "quoted_sha"))])


_MONTHS = "(January|February|March|April|May|June|July|August|September|October|November|December)"


@query("style_detect", rf"""WITH x AS (SELECT unnest([price_value, price_label, odate_value, prio_value, mixed_value]) AS v
 FROM dirty_orders), n AS (SELECT
  count(*) FILTER (regexp_matches(v, '^\s*[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9]{{2}}:[0-9]{{2}}|\s*$)')) AS n_iso,
  count(*) FILTER (regexp_matches(v, '^\s*({_MONTHS}\s+[0-9]{{1,2}},\s*[0-9]{{4}}|[0-9]{{1,2}}\s+{_MONTHS}\s+[0-9]{{4}})')) AS n_month,
  count(*) FILTER (regexp_matches(v, '^[+-]?[0-9]{{1,3}}(,[0-9]{{3}})+(\.[0-9]+)?$')) AS n_thousands FROM x)
SELECT *, CASE WHEN n_iso > 0 AND (n_month > 0 OR n_thousands > 0) THEN 'mixed' WHEN n_iso > 0 THEN 'database'
  WHEN n_month > 0 THEN 'mixed' ELSE 'database' END AS style FROM n""", ("dirty_orders",))
def style_detect(spark, sf_dir):
    counts = style_counts(view(spark, sf_dir, "dirty_orders"),
                          ["price_value", "price_label", "odate_value", "prio_value", "mixed_value"])
    counts = counts.select(*[F.col(n).cast("bigint") for n in counts.columns])
    return counts.withColumn("style", combined_style("database", F.col("n_iso"), F.col("n_month"),
                                                     F.col("n_thousands")))


@query("typed_dedup_counts", f"""WITH {num_sql('price_value')}, num_in AS (
  SELECT * RENAME (shape AS price_class, s AS price_text) FROM num), {dt_sql('odate_value', 'num_in')},
 r AS (SELECT *, row_number() OVER (PARTITION BY uid, facility ORDER BY
   (CASE WHEN uniquekey IS NULL THEN 1 ELSE 0 END) + (CASE WHEN num_value IS NULL THEN 1 ELSE 0 END)
   + (CASE WHEN dt_value IS NULL THEN 1 ELSE 0 END), uniquekey DESC NULLS LAST,
   regexp_matches(uniquekey, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T'), _rid) AS rn FROM dt)
SELECT coalesce(price_class, 'empty') AS price_class, coalesce({DT_CLASS}, 'empty') AS odate_class, count(*) AS n
FROM r WHERE rn = 1 GROUP BY ALL""", ("dirty_orders",))
def typed_dedup_counts(spark, sf_dir):
    """Typing, most complete row per (uid, facility), class counts."""
    df = view(spark, sf_dir, "dirty_orders").select(
        "_rid", "uid", "facility", "uniquekey", numeric_shape(F.col("price_value")).alias("_n"),
        datetime_shape(F.col("odate_value")).alias("_d"))
    df = df.select("_rid", "uid", "facility", "uniquekey", F.col("_n.value").alias("price"),
                   F.col("_d.value").alias("odate"), F.col("_n.shape").alias("_price_class"),
                   datetime_class(F.col("_d")).alias("_odate_class"))
    kept = dedup_patients(df)
    return (kept.groupBy(F.coalesce("_price_class", F.lit("empty")).alias("price_class"),
                         F.coalesce("_odate_class", F.lit("empty")).alias("odate_class"))
            .agg(F.count(F.lit(1)).alias("n")))
