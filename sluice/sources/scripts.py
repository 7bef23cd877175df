"""Form scripts: nested screens, fields and options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.conditions import combine_col
from sluice.functions.text import trim

OPTION = "struct<value:string,valueLabel:string>"
FIELD = f"struct<key:string,label:string,condition:string,optional:boolean,options:array<{OPTION}>>"
SCREEN = f"struct<title:string,ref:string,condition:string,fields:array<{FIELD}>>"
SCRIPT = f"scriptId string, title string, hospitalName string, screens array<{SCREEN}>, _corrupt string"


def read_scripts(spark: SparkSession, folder: str, country: str) -> DataFrame:
    """One row per script of all ``*metadata.json`` files of a country folder; a
    file that does not parse keeps its row with ``_corrupt`` set."""
    return (spark.read.schema(SCRIPT).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").option("pathGlobFilter", "*metadata.json")
            .json(folder).withColumn("country", F.lit(country))
            .withColumn("file_name", F.col("_metadata.file_name")))


def encode_options(options: Column, inner: str = "|", outer: str = ";") -> Column:
    return F.coalesce(F.array_join(F.transform(options, lambda o: F.concat(
        F.coalesce(trim(o["value"]), F.lit("")), F.lit(inner), F.coalesce(trim(o["valueLabel"]), F.lit("")))),
        outer), F.lit(""))


def decode_options(text: Column, inner: str = "|", outer: str = ";") -> Column:
    """array<struct<value, label>> of an encoded option text."""
    parts = F.filter(F.split(text, outer), lambda p: trim(p) != "")
    return F.transform(parts, lambda p: F.struct(
        trim(F.substring_index(p, inner, 1)).alias("value"),
        trim(F.substring(p, F.length(F.substring_index(p, inner, 1)) + F.length(F.lit(inner)) + 1,
                         F.length(p))).alias("label")))


def shown_condition(screen: Column, field: Column) -> Column:
    """Screen and field condition for the dictionary; one of them when equal."""
    s, f = (F.coalesce(trim(x), F.lit("")) for x in (screen, field))
    return (F.when((f != "") & (s != "") & (f != s), F.concat(F.lit("("), s, F.lit(") AND ("), f, F.lit(")")))
            .when(f != "", f).otherwise(s))


def script_fields(scripts: DataFrame, keep: tuple[str, ...] = ("scriptId", "title", "country")) -> DataFrame:
    """One row per (script, screen, field), with its place and conditions."""
    screens = scripts.select(*keep, F.posexplode("screens").alias("screen_idx", "screen"))
    fields = screens.select(*keep, "screen_idx", "screen",
                            F.posexplode("screen.fields").alias("field_idx", "field"))
    key = F.coalesce("field.key", F.lit(""))
    return fields.select(
        F.col("scriptId").alias("script_id"), F.col("title").alias("script_title"),
        *[F.col(k) for k in keep if k not in ("scriptId", "title")], "screen_idx", "field_idx",
        F.coalesce(F.nullif(trim(F.col("screen.title")), F.lit("")), F.nullif(trim(F.col("screen.ref")), F.lit("")),
                   F.format_string("Screen %d", F.col("screen_idx") + 1)).alias("screen_title"),
        key.alias("field_key"), F.lower(trim(key)).alias("question_key"),
        F.lower(F.regexp_replace(key, "[^A-Za-z0-9]", "")).alias("field_key_lower"),
        F.coalesce(trim(F.col("screen.condition")), F.lit("")).alias("screen_condition"),
        F.coalesce(trim(F.col("field.condition")), F.lit("")).alias("field_condition"),
        combine_col(F.col("screen.condition"), F.col("field.condition")).alias("condition"),
        shown_condition(F.col("screen.condition"), F.col("field.condition")).alias("skip_condition"),
        F.coalesce(trim(F.col("field.label")), F.lit("")).alias("display_label"),
        F.col("field.optional").alias("optional"), F.col("field.options").alias("options"),
        encode_options(F.col("field.options")).alias("options_str"),
        encode_options(F.col("field.options"), "=", "; ").alias("options_text"))
