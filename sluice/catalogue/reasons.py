"""Reason codes of empty cells, with form conditions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalogue import query
from sluice.catalogue.personal import hit_sql
from sluice.catalogue.shapes import dt_sql, num_sql
from sluice.catalogue.views import table, view
from sluice.functions.conditions import combine_col
from sluice.functions.pii import redact
from sluice.functions.shapes import parse_boolean, parse_datetime, parse_number
from sluice.functions.text import c
from sluice.operators import dedup, lookups, reasons
from sluice.sources.scripts import FIELD, SCREEN, decode_options, script_fields

RAW_OF = {"price": "price_value", "odate": "odate_value", "flag": "flag_value", "note": "note_value",
          "prio": "prio_value"}
EVAL = {**RAW_OF, "status": "status_value", "mixed": "mixed_value"}


def cleaned(spark, sf_dir):
    """Typed, redacted cells next to the raw text they came from."""
    df = view(spark, sf_dir, "dirty_orders")
    return df.select("*", F.concat(F.lit("S"), F.coalesce(F.substring("facility", 2, 1), F.lit("4"))).alias("script_id"),
                     parse_number(F.col("price_value")).alias("price"), parse_datetime(F.col("odate_value")).alias("odate"),
                     parse_boolean(F.col("flag_value")).alias("flag"), redact(F.col("note_value")).alias("note"),
                     F.when(~F.col("prio_value").isin("None", "n/a", "to be deleted"), F.col("prio_value")).alias("prio"))


def conditions(spark, sf_dir):
    f = view(spark, sf_dir, "form_fields")
    f = f.select("script_id", "screen_idx", "field_idx", F.lower("field_key").alias("field_key_lower"),
                 combine_col(F.col("screen_condition"), F.col("field_condition")).alias("condition"))
    return reasons.first_conditions(f)


def shown(spark, sf_dir):
    by_name = {n: raw for n, raw in EVAL.items()}
    cols, failed = reasons.shown_columns(conditions(spark, sf_dir), list(EVAL), by_name)
    return cols, failed


_SCREENS = {"$Flag = 'y' or $Flag = 'Yes'": "(flag_value = 'y' OR flag_value = 'Yes')", "": None,
            "$Status != 'lost'": "(status_value <> 'lost')"}
_FLAG = ("CASE WHEN lower(trim(flag_value)) IN ('true','yes','y','1','t') THEN true "
         "WHEN lower(trim(flag_value)) IN ('false','no','n','0','f') THEN false END")
_FIELDS = {"!$Mixed = 'N'": "(NOT (mixed_value = 'N'))", "$Flag = true": f"(({_FLAG}) = true)",
           "$Price > 50000 and !($Status = 'both')":
               "(try_cast(trim(price_value) AS double) > 50000 AND NOT (status_value = 'both'))",
           "": None, "Status = 'F'": "CAST(NULL AS boolean)"}


def _shown_case() -> str:
    whens = []
    for s, s_sql in _SCREENS.items():
        for f, f_sql in _FIELDS.items():
            text = s if not f else f if not s else f"({s}) and ({f})"
            if not text:
                continue
            sql = (s_sql if not f else f_sql if not s
                   else "CAST(NULL AS boolean)" if f == "Status = 'F'" else f"({s_sql} AND {f_sql})")
            whens.append("WHEN '" + text.replace("'", "''") + f"' THEN {sql}")
    return "CASE cond " + " ".join(whens) + " END"


_COMBINED = """CASE WHEN screen_condition = '' THEN field_condition WHEN field_condition = '' THEN screen_condition
  ELSE concat('(', screen_condition, ') and (', field_condition, ')') END"""
_COND_SQL = f"""cnd AS (SELECT script_id, lower(field_key) AS fk, arg_min(cond, screen_idx) AS cond FROM
   (SELECT *, {_COMBINED} AS cond FROM form_fields) x WHERE cond <> '' GROUP BY ALL),
 o AS (SELECT *, concat('S', coalesce(substr(facility, 2, 1), '4')) AS script_id FROM dirty_orders),
 sh AS (SELECT _rid, max(CASE WHEN fk = 'price' THEN s END) AS s_price, max(CASE WHEN fk = 'prio' THEN s END) AS s_prio,
   max(CASE WHEN fk = 'odate' THEN s END) AS s_odate FROM (SELECT _rid, fk, {_shown_case()} AS s FROM o JOIN cnd USING (script_id)) y GROUP BY _rid)"""


@query("skip_conditions", f"WITH {_COND_SQL} SELECT _rid, s_price AS price, s_prio AS prio, s_odate AS odate FROM sh",
       ("dirty_orders", "form_fields"))
def skip_conditions(spark, sf_dir):
    """Whether the form showed a field (true, false, unknown)."""
    cols, _ = shown(spark, sf_dir)
    none = F.lit(None).cast("boolean")
    return cleaned(spark, sf_dir).select("_rid", *[cols.get(n, none).alias(n) for n in ("price", "prio", "odate")])


def _code_sql(clean: str, raw: str, shown_sql: str | None) -> str:
    skip = f"WHEN {shown_sql} = false THEN -7" if shown_sql else ""
    return f"""CASE WHEN {clean} IS NULL THEN CASE WHEN {hit_sql(raw)} IS NOT NULL THEN -6 {skip}
   WHEN {raw} IS NOT NULL AND trim({raw}) NOT IN ('nan','none','na','n/a','null','','NaN','None','NA','N/A','NULL') THEN -8 ELSE -9 END END"""


_CODES = {
    "price": _code_sql("num_value", "price_value", "s_price"), "odate": _code_sql("dt_value", "odate_value", "s_odate"),
    "flag": _code_sql(f"({_FLAG})", "flag_value", None),
    "note": _code_sql(f"(CASE WHEN {hit_sql('note_value')} IS NULL THEN note_value END)", "note_value", None),
    "prio": _code_sql("(CASE WHEN prio_value NOT IN ('None','n/a','to be deleted') THEN prio_value END)", "prio_value", "s_prio"),
}
_CODED_SQL = f"""{_COND_SQL}, {num_sql('price_value')}, src AS (SELECT * RENAME (shape AS num_class, s AS num_text) FROM num),
 {dt_sql('odate_value', 'src')},
 coded AS (SELECT dt._rid, uid, facility, {', '.join(f'{x} AS {n}' for n, x in _CODES.items())}, price_value, odate_value, flag_value,
   note_value, prio_value, num_value, dt_value FROM dt LEFT JOIN sh ON sh._rid = dt._rid)"""
_USES = ("dirty_orders", "form_fields")


def _codes(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    cols, _ = shown(spark, sf_dir)
    return df, {n: reasons.reason_code(c(n), c(raw), cols.get(n)) for n, raw in RAW_OF.items()}


@query("reason_codes", f"WITH {_CODED_SQL} SELECT _rid, price, odate, flag, note, prio FROM coded", _USES)
def reason_codes(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    cols, _ = shown(spark, sf_dir)
    return reasons.reason_wide(df, list(RAW_OF), RAW_OF, cols, keep=("_rid",))


@query("reason_summary", f"""WITH {_CODED_SQL}, u AS (SELECT unnest([{', '.join(f"{{'v': '{n}', 'code': {n}}}" for n in _CODES)}]) AS x FROM coded)
SELECT x.v AS variable, count(*) AS n_total, count(*) FILTER (x.code IS NULL) AS n_present, count(x.code) AS n_missing,
 count(*) FILTER (x.code = -7) AS n_not_applicable, count(*) FILTER (x.code = -8) AS n_invalid,
 count(*) FILTER (x.code = -9) AS n_unknown, count(*) FILTER (x.code = -6) AS n_redacted FROM u GROUP BY 1""", _USES)
def reason_summary(spark, sf_dir):
    return reasons.reason_summary(reason_codes(spark, sf_dir), list(RAW_OF)).drop("pct_missing")


@query("reason_long", f"""WITH {_CODED_SQL}, u AS (SELECT _rid, uid, facility, unnest([{', '.join(
    f"{{'v': '{n}', 'code': {n}, 'raw': {RAW_OF[n]}}}" for n in _CODES)}]) AS x FROM coded)
SELECT _rid, uid, facility, x.v AS variable, x.code AS na_reason, x.raw AS raw_value FROM u WHERE x.code IS NOT NULL""", _USES)
def reason_long(spark, sf_dir):
    df, codes = _codes(spark, sf_dir)
    return reasons.reason_long(df, codes, RAW_OF, keep=("_rid", "uid", "facility"))


@query("na_coded", f"""WITH {_CODED_SQL} SELECT _rid, coalesce(strftime(dt_value, '%Y-%m-%d %H:%M:%S'), cast(odate AS string)) AS odate,
 coalesce(upper(cast(({_FLAG}) AS string)), cast(flag AS string)) AS flag,
 coalesce(CASE WHEN prio_value NOT IN ('None','n/a','to be deleted') THEN prio_value END, cast(prio AS string)) AS prio FROM coded""", _USES)
def na_coded(spark, sf_dir):
    df, codes = _codes(spark, sf_dir)
    return reasons.reason_coded(df, {n: codes[n] for n in ("odate", "flag", "prio")}, keep=("_rid",))


_PICK = """row_number() OVER (PARTITION BY uid, facility ORDER BY (CASE WHEN price_value IS NULL THEN 1 ELSE 0 END)
 + (CASE WHEN uniquekey IS NULL THEN 1 ELSE 0 END), uniquekey DESC NULLS LAST, _rid)"""


@query("align_raw", f"""WITH k AS (SELECT _rid, uid, facility, CASE WHEN _rid % 4 = 0 THEN 'changed' ELSE uniquekey END AS uniquekey
  FROM (SELECT _rid, uid, facility, uniquekey, {_PICK} AS rn FROM dirty_orders) x WHERE rn = 1),
 k2 AS (SELECT _rid, uid, CASE WHEN _rid % 9 = 0 THEN 'F9' ELSE facility END AS facility, uniquekey FROM k),
 a3 AS (SELECT uid, facility, uniquekey, min(_rid) AS r FROM dirty_orders GROUP BY ALL),
 a2 AS (SELECT uid, facility, min(_rid) AS r FROM dirty_orders GROUP BY ALL), a1 AS (SELECT uid, min(_rid) AS r FROM dirty_orders GROUP BY ALL)
SELECT k2._rid, coalesce(a3.r, a2.r, a1.r) AS raw_row FROM k2 LEFT JOIN a3 ON a3.uid = k2.uid AND a3.facility = k2.facility AND a3.uniquekey = k2.uniquekey
 LEFT JOIN a2 ON a2.uid = k2.uid AND a2.facility = k2.facility LEFT JOIN a1 ON a1.uid = k2.uid""", ("dirty_orders",))
def align_raw(spark, sf_dir):
    """Source row of each kept row where the row id was lost."""
    raw = view(spark, sf_dir, "dirty_orders").select("_rid", "uid", "facility", "uniquekey", "price_value")
    kept = dedup.dedup_patients(raw)
    kept = kept.withColumn("uniquekey", F.when(F.col("_rid") % 4 == 0, "changed").otherwise(F.col("uniquekey")))
    kept = kept.withColumn("facility", F.when(F.col("_rid") % 9 == 0, "F9").otherwise(F.col("facility")))
    raw = raw.withColumn("raw_row", F.col("_rid"))
    out = lookups.align_raw(kept.drop("price_value"), raw, ["raw_row"])
    return out.select("_rid", F.col("_raw.raw_row").alias("raw_row"))


@query("resolve_script", """WITH m AS (SELECT concat('F', cast(n_nationkey % 6 AS string)) AS site, min(n_name) AS sid FROM nation
  WHERE n_regionkey < 3 GROUP BY 1), o AS (SELECT _rid, facility, CASE WHEN _rid % 10 = 0 THEN 'X1' WHEN _rid % 10 = 1 THEN 'old-1' ELSE 'other' END AS scriptid FROM dirty_orders)
SELECT _rid, CASE WHEN scriptid = 'X1' THEN 'X1' WHEN scriptid = 'old-1' THEN 'new-1' ELSE m.sid END AS script_id
FROM o LEFT JOIN m ON m.site = upper(trim(o.facility))""", ("dirty_orders",))
def resolve_script(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    script_map = nation.select(F.when(F.col("n_regionkey") < 3, "ZIM").otherwise("MWI").alias("country"),
                               F.lit("maternal_outcomes").alias("dataset"),
                               F.concat(F.lit("F"), (F.col("n_nationkey") % 6).cast("string")).alias("facility"),
                               F.col("n_name").alias("script_id"))
    own = F.when(F.col("_rid") % 10 == 0, "X1").when(F.col("_rid") % 10 == 1, "old-1").otherwise("other")
    df = view(spark, sf_dir, "dirty_orders").select("_rid", "facility", own.alias("scriptid"))
    out = lookups.resolve_script(df, script_map, "zim", "maternity_completeness", ("X1",), {"old-1": "new-1"})
    return out.select("_rid", "script_id")


@query("flatten_scripts", """WITH f AS (
 SELECT o_orderkey, sid, 0 AS si, 0 AS fi, 'Sta_tus' AS k, '$A = 1' AS sc, '' AS fc, concat(o_orderstatus, '|', o_orderpriority, ';U|Unknown') AS o FROM nested_orders
 UNION ALL SELECT o_orderkey, sid, 0, 1, o_orderpriority, '$A = 1', concat('$Q = ', cast(q AS string)), '' FROM nested_orders
 UNION ALL SELECT o_orderkey, sid, 1, 0, 'Last', '', CASE WHEN q = 0 THEN '' ELSE '$A = 1' END, 'only|' FROM nested_orders)
SELECT sid AS script_id, cast(si AS int) AS screen_idx, cast(fi AS int) AS field_idx, CASE si WHEN 0 THEN 'First' ELSE 'Screen 2' END AS screen_title,
 lower(k) AS question_key, lower(regexp_replace(k, '[^A-Za-z0-9]', '', 'g')) AS field_key_lower,
 CASE WHEN sc = '' THEN fc WHEN fc = '' THEN sc ELSE concat('(', sc, ') and (', fc, ')') END AS condition, o AS options_str,
 CASE WHEN o = '' THEN '' ELSE string_split(o, '|')[1] END AS first_code FROM f""", ("nested_orders",))
def flatten_scripts(spark, sf_dir):
    """Nested screens, fields and options as rows."""
    df = view(spark, sf_dir, "nested_orders")

    def opt(v, lab):
        return F.struct(v.alias("value"), lab.alias("valueLabel"))

    def field(key, cond, options):
        return F.struct(key.alias("key"), F.lit("").alias("label"), cond.alias("condition"),
                        F.lit(False).alias("optional"), options.alias("options")).cast(FIELD)

    def screen(title, cond, *fields):
        return F.struct(title.alias("title"), F.lit(None).cast("string").alias("ref"), cond.alias("condition"),
                        F.array(*fields).alias("fields")).cast(SCREEN)

    none = F.array().cast("array<struct<value:string,valueLabel:string>>")
    first = screen(F.lit(" First "), F.lit("$A = 1"),
                   field(F.lit("Sta_tus"), F.lit(None).cast("string"), F.array(
                       opt(F.col("o_orderstatus"), F.col("o_orderpriority")), opt(F.lit("U"), F.lit("Unknown")))),
                   field(F.col("o_orderpriority"), F.concat(F.lit("$Q = "), F.col("q").cast("string")), none))
    second = screen(F.lit(""), F.lit(None).cast("string"),
                    field(F.lit("Last"), F.when(F.col("q") != 0, F.lit("$A = 1")), F.array(opt(F.lit("only"), F.lit("")))))
    scripts = df.select(F.col("sid").alias("scriptId"), F.lit("t").alias("title"), F.lit("ZIM").alias("country"),
                        F.array(first, second).alias("screens"))
    out = script_fields(scripts)
    return out.select("script_id", "screen_idx", "field_idx", "screen_title", "question_key", "field_key_lower", "condition",
                      "options_str", F.coalesce(F.get(decode_options(F.col("options_str")), F.lit(0))["value"],
                                                F.lit("")).alias("first_code"))
