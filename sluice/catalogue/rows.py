"""Ids, coded values, labels, validation, deduplication and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalogue import query
from sluice.catalogue.shapes import dt_sql, num_sql
from sluice.catalogue.views import table, view
from sluice.functions import ranges
from sluice.functions.categories import clean_category
from sluice.functions.labels import fill_number_or_datetime, fill_placeholder, visit_category, visit_count
from sluice.functions.shapes import format_datetime
from sluice.functions.values import brace_list, build_value_map, map_value, recode, strip_score_label
from sluice.operators import dedup, ids, lookups
from sluice.session import bounded_rows

_EMPTY = "(uid IS NULL OR lower(trim(uid)) IN ('', 'na', 'null', 'nan', 'none', 'n/a', '<na>'))"
_REPAIRABLE = "coalesce(regexp_matches(trim(uid), '^[A-Za-z0-9]{3,6}[,/][A-Za-z0-9]+$'), false)"
_FIXED = f"CASE WHEN {_REPAIRABLE} THEN regexp_replace(trim(uid), '[,/]', '-') ELSE uid END"


@query("uid_null_filter", f"SELECT _rid, uid FROM dirty_orders WHERE NOT {_EMPTY}", ("dirty_orders",))
def uid_null_filter(spark, sf_dir):
    good, _ = ids.split_empty_ids(view(spark, sf_dir, "dirty_orders"))
    return good.select("_rid", "uid")


@query("uid_rejects", f"SELECT _rid, uid FROM dirty_orders WHERE {_EMPTY}", ("dirty_orders",))
def uid_rejects(spark, sf_dir):
    _, bad = ids.split_empty_ids(view(spark, sf_dir, "dirty_orders"))
    return bad.select("_rid", "uid")


@query("uid_repair", f"""SELECT uid AS uid_original, {_FIXED} AS uid_repaired, coalesce(facility, '') AS facility,
 count(*) AS n_rows FROM dirty_orders WHERE {_REPAIRABLE} GROUP BY ALL""", ("dirty_orders",))
def uid_repair(spark, sf_dir):
    rep = ids.repair_ids(view(spark, sf_dir, "dirty_orders"))
    return ids.repair_ledger(rep).select("uid_original", "uid_repaired", "facility", "n_rows")


@query("uid_classes", f"""WITH u AS (SELECT trim({_FIXED}) AS uid FROM dirty_orders WHERE NOT {_EMPTY})
SELECT CASE WHEN contains(uid, '-') THEN 'hyphenated' WHEN regexp_matches(uid, '^[A-Za-z0-9]{{8}}$') THEN 'eight_characters'
 ELSE 'other' END AS id_class, count(*) AS n_rows, count(DISTINCT uid) AS n_ids FROM u GROUP BY ALL""", ("dirty_orders",))
def uid_classes(spark, sf_dir):
    good, _ = ids.split_empty_ids(ids.repair_ids(view(spark, sf_dir, "dirty_orders")))
    return ids.id_classes(good)


_PAIRED = """p AS (SELECT DISTINCT concat(lpad(cast(c_custkey % 100000 AS string), 5, '0'), '-',
  cast(c_custkey % 7 AS string)) AS uid, concat('F', cast((c_custkey + c_custkey // 3 % 2) % 4 AS string)) AS facility
  FROM customer)"""


@query("uid_confirm", f"""WITH {_PAIRED}, r AS (SELECT *, {_FIXED} AS fixed, {_REPAIRABLE} AS rep, coalesce(facility, '') AS fac
  FROM dirty_orders), l AS (SELECT uid AS uid_original, fixed AS uid_repaired, fac AS facility, count(*) AS n_rows
  FROM r WHERE rep GROUP BY ALL)
SELECT l.*, CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.uid = l.uid_repaired AND p.facility = l.facility) THEN 'confirmed'
 WHEN EXISTS (SELECT 1 FROM p WHERE p.uid = l.uid_repaired) THEN 'confirmed (other facility)' ELSE 'unconfirmed' END AS status,
 EXISTS (SELECT 1 FROM r WHERE NOT r.rep AND r.fixed = l.uid_repaired AND r.fac = l.facility) AS duplicate_in_file FROM l""",
    ("dirty_orders",))
def uid_confirm(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    paired = cust.select(
        F.concat(F.lpad((key % 100000).cast("string"), 5, "0"), F.lit("-"), (key % 7).cast("string")).alias("uid"),
        F.concat(F.lit("F"), ((key + F.floor(key / 3) % 2) % 4).cast("string")).alias("facility"))
    return ids.repair_ledger(ids.repair_ids(view(spark, sf_dir, "dirty_orders")), paired)


def _status_rows(orders):
    """Value-map rows of the order status, taken from the statuses in use."""
    labels = {"F": "finished", "O": "open order", "P": "part done"}
    rows = [{"raw_code": r["o_orderstatus"], "option_label": labels.get(r["o_orderstatus"]),
             "canonical_code": r["o_orderstatus"]}
            for r in bounded_rows(orders.select("o_orderstatus").distinct().orderBy("o_orderstatus"), what="statuses")]
    return rows + [{"raw_code": "b", "option_label": "both", "canonical_code": "{F,O}"},
                   {"raw_code": "w", "option_label": "waits", "canonical_code": ""},
                   {"raw_code": "p", "option_label": "P", "canonical_code": "P"}]


_LOOKUP = """m AS (SELECT * FROM (VALUES ('f','F'),('o','O'),('p','P'),('finished','F'),('open order','O'),('part done','P'),
 ('b','{F,O}'),('both','{F,O}'),('{f,o}','{F,O}')) t(k, v))"""
_STATUS = r"""s0 AS (SELECT _rid, status_value AS raw, trim(status_value) AS t FROM dirty_orders),
 b AS (SELECT _rid, raw, CASE
   WHEN regexp_matches(t, '^\[".*"\]$') THEN concat('{', array_to_string([trim(x) for x in string_split(replace(t[2:-2], '"', ''), ',')], ','), '}')
   WHEN regexp_matches(t, '^\[[^"]*\]$') AND len([x for x in string_split(t[2:-2], ',') if lower(trim(x)) NOT IN ('f','o','p','b','w','{f,o}','')]) = 0
    THEN concat('{', array_to_string([trim(x) for x in string_split(t[2:-2], ',')], ','), '}') ELSE raw END AS v FROM s0)"""


@query("multiselect", f"WITH {_STATUS} SELECT _rid, raw, v AS listed FROM b", ("dirty_orders",))
def multiselect(spark, sf_dir):
    vm = build_value_map(_status_rows(table(spark, sf_dir, "orders")))
    return view(spark, sf_dir, "dirty_orders").select(
        "_rid", F.col("status_value").alias("raw"), brace_list(F.col("status_value"), vm).alias("listed"))


@query("value_map", rf"""WITH {_LOOKUP}, {_STATUS},
 items AS (SELECT _rid, unnest(string_split(v[2:-2], ',')) AS item, generate_subscripts(string_split(v[2:-2], ','), 1) AS i
  FROM b WHERE v LIKE '{{%}}' AND v <> '{{F,O}}'),
 hit AS (SELECT i.*, m.v AS code FROM items i LEFT JOIN m ON m.k = lower(trim(i.item))),
 part AS (SELECT _rid, i, unnest(CASE WHEN code LIKE '{{%}}' THEN string_split(code[2:-2], ',') ELSE [code] END) AS code FROM hit),
 firsts AS (SELECT _rid, code, min(i) AS i FROM part GROUP BY ALL),
 lists AS (SELECT _rid, bool_or(code IS NULL) AS bad, concat('{{', string_agg(code, ',' ORDER BY i), '}}') AS listed FROM firsts GROUP BY _rid)
SELECT b._rid, CASE WHEN b.v LIKE '{{%}}' AND b.v <> '{{F,O}}' THEN CASE WHEN bad THEN b.v ELSE listed END
   ELSE coalesce(m.v, b.v) END AS value,
  CASE WHEN b.v IS NULL THEN NULL WHEN b.v IN ('F','O','P','{{F,O}}') THEN 'canonical'
   WHEN b.v LIKE '{{%}}' THEN CASE WHEN bad THEN 'list_unresolved' WHEN listed = b.v THEN 'canonical' ELSE 'list_replaced' END
   WHEN m.v IS NULL THEN 'unresolved' ELSE 'replaced' END AS outcome
FROM b LEFT JOIN lists USING (_rid) LEFT JOIN m ON m.k = lower(trim(b.v))""", ("dirty_orders",))
def value_map(spark, sf_dir):
    vm = build_value_map(_status_rows(table(spark, sf_dir, "orders")))
    v = map_value(F.col("listed"), vm)
    return multiselect(spark, sf_dir).select("_rid", v.alias("x")).select("_rid", "x.value", "x.outcome")


@query("recode_strip", r"""SELECT p_partkey, CASE mode_value WHEN 'SVD' THEN '1' WHEN 'Vent' THEN '2' WHEN 'For' THEN '3'
 WHEN 'ElCS' THEN '4' WHEN 'ECS' THEN '5' WHEN 'CSPrLab' THEN '5' WHEN 'CSPoLab' THEN '5' WHEN 'IVD' THEN '7' WHEN 'ID' THEN '7'
 ELSE mode_value END AS mode, regexp_replace(score_value, '^([0-9]+)\s*=.*$', '\1') AS score FROM dirty_part""", ("dirty_part",))
def recode_strip(spark, sf_dir):
    return view(spark, sf_dir, "dirty_part").select(
        "p_partkey", recode(F.col("mode_value")).alias("mode"), strip_score_label(F.col("score_value")).alias("score"))


_RULE = r"""r0 AS (SELECT event_id, trim(visits_value) AS v, lower(coalesce(trim(visits_label), '')) AS t, try_cast(trim(visits_value) AS double) AS n FROM label_events),
 r1 AS (SELECT *, CASE WHEN n >= 0 AND n = floor(n) THEN n END AS vc, CASE WHEN t = 'none' THEN 0.0
  WHEN regexp_matches(t, '^[0-9]+\s+anc\s+visits?$') THEN cast(regexp_extract(t, '^[0-9]+') AS double)
  WHEN regexp_matches(t, '^[0-9]+(\.0+)?$') THEN cast(t AS double) END AS lc FROM r0)"""


@query("label_rule", rf"""WITH {_RULE}, r2 AS (SELECT *, coalesce(vc, lc) AS cnt, CASE WHEN vc IS NOT NULL THEN 'raw_numeric_value'
  WHEN lc IS NOT NULL THEN 'raw_exact_label' WHEN regexp_matches(t, '^more than (4|8)\s+anc\s+visits$') THEN 'raw_range_label'
  ELSE 'unresolved' END AS source FROM r1)
SELECT event_id, cast(cnt AS bigint) AS visit_count, source,
 CASE WHEN vc IS NOT NULL THEN 'valid_value' WHEN lc IS NOT NULL AND t = 'none' THEN 'label_none_as_zero'
  WHEN lc IS NOT NULL THEN 'label_exact_count' WHEN source = 'raw_range_label' THEN 'label_more_than_n'
  WHEN t = 'not sure' THEN 'unresolved_not_sure' WHEN t = 'anc visits' THEN 'unresolved_no_number'
  WHEN t LIKE '%?' THEN 'unresolved_question_text' WHEN t = '' THEN 'unresolved_no_answer' ELSE 'unresolved_other' END AS outcome,
 coalesce(v, '') <> '' AND vc IS NULL AS invalid, coalesce(vc <> lc, false) AS conflict,
 CASE WHEN cnt = 0 THEN 'none' WHEN cnt <= 3 THEN '1_3' WHEN cnt IS NOT NULL THEN 'ge4' WHEN source = 'raw_range_label' THEN 'ge4' END AS category
FROM r2""", ("label_events",))
def label_rule(spark, sf_dir):
    df = view(spark, sf_dir, "label_events").select(
        "event_id", visit_count(F.col("visits_value"), F.col("visits_label")).alias("r"))
    return df.select("event_id", F.col("r.count").cast("bigint").alias("visit_count"), "r.source", "r.outcome",
                     "r.invalid", "r.conflict", visit_category(F.col("r.count"), F.col("r.source")).alias("category"))


@query("label_fill", f"""WITH {num_sql('price_label')}, {dt_sql('price_label', 'src')}, src AS (SELECT * RENAME (shape AS num_class, s AS num_text) FROM num)
SELECT _rid, CASE WHEN nullif(price_value, '') IS NOT NULL THEN price_value
 WHEN price_label IN ('None','Normal','Norm','none','normal','norm','NONE','NORMAL','NORM','True','False','TRUE','FALSE','Yes','No','YES','NO','Y','N') THEN price_label
 WHEN num_class IS NOT NULL AND num_value IS NOT NULL AND NOT regexp_matches(price_label, '[^0-9.,+ -]') THEN
   CASE num_class WHEN 'thousands' THEN replace(num_text, ',', '') WHEN 'decimal_comma' THEN replace(num_text, ',', '.')
    WHEN 'fallback' THEN regexp_extract(num_text, '[0-9]+(\\.[0-9]+)?') ELSE num_text END
 ELSE strftime(dt_value, '%Y-%m-%d %H:%M:%S') END AS price FROM dt""".replace(
    f"{dt_sql('price_label', 'src')}, src AS (SELECT * RENAME (shape AS num_class, s AS num_text) FROM num)",
    f"src AS (SELECT * RENAME (shape AS num_class, s AS num_text) FROM num), {dt_sql('price_label', 'src')}"), ("dirty_orders",))
def label_fill(spark, sf_dir):
    value = F.nullif(F.col("price_value"), F.lit(""))
    label = F.col("price_label")
    return view(spark, sf_dir, "dirty_orders").select(
        "_rid", fill_number_or_datetime(fill_placeholder(value, label), label).alias("price"))


@query("numeric_validate", """WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, cast(round(l_extendedprice) AS double) AS w FROM lineitem),
 y AS (SELECT *, CASE WHEN q <= 20 THEN q * 1000 ELSE q END AS grams, CASE WHEN w > 200 THEN round_even(w / 8766, 1) ELSE w END AS years FROM x)
SELECT l_orderkey, l_linenumber, grams, coalesce(grams < 100 OR grams > 5000, false) AS implausible, years,
 CASE WHEN q >= 5 AND q <= 45 THEN q END AS closed_range, CASE WHEN q >= 10 THEN q END AS open_range,
 CASE WHEN round_even(w * 10 / 8766, 0) BETWEEN 9 AND 60 THEN round_even(w * 10 / 8766, 0) END AS age FROM y""")
def numeric_validate(spark, sf_dir):
    q, w = F.col("q"), F.col("w")
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"),
                                                 F.round("l_extendedprice").alias("w"))
    return df.select("l_orderkey", "l_linenumber", ranges.grams(q).alias("grams"),
                     ranges.implausible_grams(ranges.grams(q)).alias("implausible"),
                     ranges.years_from_hours_entry(w).alias("years"), ranges.in_range(q, 5, 45).alias("closed_range"),
                     ranges.in_range(q, 10, None).alias("open_range"), ranges.age_years(w * 10).alias("age"))


@query("categorical_validate", r"""WITH a AS (SELECT _rid, CASE WHEN prio_value IN ('urgent!') THEN '1-URGENT' ELSE prio_value END AS x FROM dirty_orders),
 d AS (SELECT _rid, CASE WHEN x IN ('to be deleted') THEN NULL ELSE x END AS x FROM a),
 h AS (SELECT _rid, CASE WHEN regexp_matches(x, '^[A-Z][a-z]+(\s[A-Z][a-z]+){2,}\??$') OR regexp_matches(x, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}')
   OR regexp_matches(x, '^(January|February|March|April|May|June|July|August|September|October|November|December)') THEN NULL ELSE x END AS x FROM d)
SELECT _rid, CASE WHEN trim(x) IN ('nan','none','na','n/a','null','','NaN','None','NA','N/A','NULL') THEN NULL ELSE x END AS prio FROM h""", ("dirty_orders",))
def categorical_validate(spark, sf_dir):
    return view(spark, sf_dir, "dirty_orders").select("_rid", clean_category(
        F.col("prio_value"), {"1-URGENT": ("urgent!",)}, ("to be deleted",)).alias("prio"))


@query("coalesce_priority", """WITH g AS (SELECT *, CASE WHEN w1 > 0 AND w1 <= 20 THEN w1 * 1000 ELSE w1 END AS g1,
  CASE WHEN w2 > 0 AND w2 <= 20 THEN w2 * 1000 ELSE w2 END AS g2, CASE WHEN w3 > 0 AND w3 <= 20 THEN w3 * 1000 ELSE w3 END AS g3,
  CASE WHEN round_even(age_hours / 8766, 0) BETWEEN 9 AND 60 THEN round_even(age_hours / 8766, 0) END AS derived FROM dup_customer)
SELECT c_custkey, coalesce(g1, g2, g3) AS weight_g, coalesce(greatest(g1, g2, g3) - least(g1, g2, g3), 0.0) > 1 AS weights_differ,
 coalesce(age_years, derived) AS age, CASE WHEN age_years IS NOT NULL THEN 'matageyrs' WHEN derived IS NOT NULL THEN 'matagedate_derived'
 ELSE 'none' END AS age_source, coalesce(abs(age_years - derived) > 1, false) AS ages_differ FROM g""", ("dup_customer",))
def coalesce_priority(spark, sf_dir):
    df = view(spark, sf_dir, "dup_customer").withColumn("derived", ranges.age_years(F.col("age_hours")))
    w = [F.col(n) for n in ("w1", "w2", "w3")]
    years, derived = F.col("age_years"), F.col("derived")
    return df.select("c_custkey", ranges.first_weight(*w).alias("weight_g"),
                     (ranges.spread(*[ranges.positive_grams(x) for x in w]) > 1).alias("weights_differ"),
                     F.coalesce(years, derived).alias("age"), ranges.age_source(years, derived).alias("age_source"),
                     F.coalesce(F.abs(years - derived) > 1, F.lit(False)).alias("ages_differ"))


@query("lookup_earliest", """WITH l AS (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY 1)
SELECT c_custkey, strftime(coalesce(d, first_date), '%Y-%m-%d %H:%M:%S') AS datebct_resolved,
 CASE WHEN d IS NOT NULL THEN 'original' WHEN first_date IS NOT NULL THEN 'from_admission' END AS datebct_source
FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2020-01-01 00:00:00' END AS d FROM customer) c
LEFT JOIN l ON l.o_custkey = c.c_custkey""")
def lookup_earliest(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("uid"), F.when(
        F.col("c_custkey") % 3 == 0, F.lit("2020-01-01").cast("timestamp_ntz")).alias("datebct.value"))
    adm = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), "o_orderdate")
    out = lookups.earliest_lookup(cust, adm, "datebct.value", "o_orderdate", keys=["uid"])
    return out.select("c_custkey", format_datetime(F.col("datebct_resolved")).alias("datebct_resolved"), "datebct_source")


_RES = ("uniquekey", "startedat", "sex", "weight", "weeks", "apgar", "mode", "outcome", "readm", "kind", "note")


def _nulls(columns) -> str:
    return " + ".join(f"(CASE WHEN {n} IS NULL THEN 1 ELSE 0 END)" for n in columns)


_IS_TS = "coalesce(regexp_matches(uniquekey, '^[0-9]{4}-[0-9]{2}-[0-9]{2}T'), false)"


@query("dedup_visit", f"""SELECT _rid, uid, facility, uniquekey FROM (SELECT *, row_number() OVER (PARTITION BY uid, facility, startedat
 ORDER BY {_nulls([n for n in _RES if n != 'startedat'])}, {_IS_TS}, _rid) AS rn FROM resent_events) WHERE rn = 1""", ("resent_events",))
def dedup_visit(spark, sf_dir):
    return dedup.dedup_visits(view(spark, sf_dir, "resent_events")).select("_rid", "uid", "facility", "uniquekey")


@query("dedup_patient", f"""SELECT _rid, uid, facility, uniquekey FROM (SELECT *, row_number() OVER (PARTITION BY uid, facility
 ORDER BY {_nulls(_RES)}, uniquekey DESC NULLS LAST, {_IS_TS}, _rid) AS rn FROM resent_events) WHERE rn = 1""", ("resent_events",))
def dedup_patient(spark, sf_dir):
    return dedup.dedup_patients(view(spark, sf_dir, "resent_events")).select("_rid", "uid", "facility", "uniquekey")


@query("shared_keys", """SELECT uid, facility, mode, count(*) AS n_rows FROM resent_events GROUP BY ALL HAVING count(*) > 1""", ("resent_events",))
def shared_keys(spark, sf_dir):
    return dedup.shared_key_rows(view(spark, sf_dir, "resent_events"), ("uid", "facility", "mode"))


@query("merge_column_groups", """SELECT uid, facility, arg_min({'w': weight, 'k': weeks}, _rid).w AS weight,
 arg_min({'w': weight, 'k': weeks}, _rid).k AS weeks,
 arg_min({'s': sex, 'o': outcome}, (CASE WHEN sex IS NULL THEN 1 ELSE 0 END + CASE WHEN outcome IS NULL THEN 1 ELSE 0 END) * 1000000000 + _rid).s AS sex,
 arg_min({'s': sex, 'o': outcome}, (CASE WHEN sex IS NULL THEN 1 ELSE 0 END + CASE WHEN outcome IS NULL THEN 1 ELSE 0 END) * 1000000000 + _rid).o AS outcome
FROM resent_events GROUP BY uid, facility""", ("resent_events",))
def merge_column_groups(spark, sf_dir):
    return dedup.merge_column_groups(
        view(spark, sf_dir, "resent_events"), ["uid", "facility"],
        {"numeric": ["weight", "weeks"], "category": ["sex", "outcome"]},
        {"numeric": F.struct(F.lit(0), F.col("_rid")),
         "category": F.struct(dedup.missing_cells(["sex", "outcome"]), F.col("_rid"))})


@query("first_wins_lookup", """WITH k AS (SELECT lower(trim(p_name)) AS key, p_partkey AS o, 0 AS r, p_brand, p_type FROM part
 UNION ALL SELECT lower(trim(concat(p_type, ' ', p_name))), p_partkey, 1, p_brand, p_type FROM part WHERE p_partkey % 5 = 0),
 f AS (SELECT key, arg_min(p_brand, o * 10 + r) AS brand, arg_min(p_type, o * 10 + r) AS type FROM k GROUP BY key)
SELECT p.p_partkey, a.brand AS by_name, coalesce(a.brand, b.brand) AS brand, coalesce(a.type, b.type) AS type
FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS n1, concat(p_type, ' ', p_name) AS n2 FROM part) p
LEFT JOIN f a ON a.key = lower(trim(p.n1)) LEFT JOIN f b ON b.key = lower(trim(p.n2))""")
def first_wins_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    entries = part.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 5 == 0, F.concat_ws(
        " ", "p_type", "p_name")).alias("old_name"), "p_brand", "p_type")
    index = lookups.first_wins(entries, ["p_name", "old_name"], "p_partkey", ["p_brand", "p_type"])
    names = part.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("n1"),
                        F.concat_ws(" ", "p_type", "p_name").alias("n2"))
    by_name = lookups.lookup_names(names, index, ["n1"]).select("p_partkey", F.col("entry.p_brand").alias("by_name"))
    both = lookups.lookup_names(names, index, ["n1", "n2"]).select(
        "p_partkey", F.col("entry.p_brand").alias("brand"), F.col("entry.p_type").alias("type"))
    return by_name.join(both, "p_partkey")


@query("set_append", f"""SELECT _rid, uid, 'kept' AS state, CASE WHEN contains(trim(uid), '-') THEN 'hyphenated' ELSE 'plain' END AS form
 FROM dirty_orders WHERE NOT {_EMPTY} UNION ALL SELECT _rid, uid, 'no_uid', NULL FROM dirty_orders WHERE {_EMPTY}""", ("dirty_orders",))
def set_append(spark, sf_dir):
    good, bad = ids.split_empty_ids(view(spark, sf_dir, "dirty_orders").select("_rid", "uid"))
    form = F.when(F.trim("uid").contains("-"), "hyphenated").otherwise("plain")
    return good.withColumn("state", F.lit("kept")).withColumn("form", form).unionByName(
        bad.withColumn("state", F.lit("no_uid")), allowMissingColumns=True)


@query("top_missing", """SELECT uid, facility, count(*) FILTER (weight IS NULL) AS n_missing FROM resent_events GROUP BY ALL
 ORDER BY n_missing DESC, uid, facility LIMIT 20""", ("resent_events",))
def top_missing(spark, sf_dir):
    return (view(spark, sf_dir, "resent_events").groupBy("uid", "facility")
            .agg(F.count_if(F.col("weight").isNull()).alias("n_missing"))
            .orderBy(F.desc("n_missing"), "uid", "facility").limit(20))
