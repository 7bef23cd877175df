"""Text views that put form-like dirt over the given tables.

One SQL text per view serves Spark and the comparison engine, so both sides read
the same cells.  Dirt depends on row keys; every row of the table is used.
Number text is built from whole cents, never from a printed double."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.session import spread

_MONTH = """CASE m WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April'
    WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September'
    WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END"""

VIEWS: dict[str, str] = {}

VIEWS["dirty_orders"] = f"""
SELECT k AS _rid,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'n/a' WHEN k % 83 = 0 THEN ' NULL '
       WHEN k % 11 = 0 THEN concat(pad, ',', tail) WHEN k % 11 = 1 THEN concat(pad, '/', tail)
       WHEN k % 11 = 2 THEN concat(pad, lpad(tail, 3, '0')) WHEN k % 11 = 3 THEN concat(pad, tail)
       ELSE concat(pad, '-', tail) END AS uid,
  CASE WHEN k % 53 = 0 THEN NULL ELSE concat('F', cast(cust % 4 AS string)) END AS facility,
  CASE WHEN k % 5 = 0 THEN concat(iso, 'T00:00:00.000Z') ELSE concat('U', cast(k AS string)) END AS uniquekey,
  CASE k % 8 WHEN 0 THEN concat(cast(whole AS string), '.', lpad(cast(frac AS string), 2, '0'))
       WHEN 1 THEN concat(cast(thou AS string), ',', lpad(cast(rest AS string), 3, '0'), '.',
                          lpad(cast(frac AS string), 2, '0'))
       WHEN 2 THEN concat(cast(whole AS string), ',', lpad(cast(frac AS string), 2, '0'))
       WHEN 3 THEN concat('about ', cast(whole AS string), ' units')
       WHEN 4 THEN concat(cast(whole AS string), '-', cast(frac AS string))
       WHEN 5 THEN CASE WHEN k % 3 = 0 THEN NULL ELSE '' END
       WHEN 6 THEN CASE WHEN k % 3 = 0 THEN 'unknown' ELSE 'not weighed' END
       ELSE concat('  ', cast(whole AS string), ' ') END AS price_value,
  CASE k % 6 WHEN 0 THEN concat(cast(thou AS string), ',', lpad(cast(rest AS string), 3, '0'))
       WHEN 1 THEN 'Price?' WHEN 2 THEN concat(lpad(cast(d AS string), 2, '0'), '/',
            lpad(cast(m AS string), 2, '0'), '/', cast(y AS string))
       WHEN 3 THEN NULL WHEN 4 THEN 'None' ELSE cast(whole AS string) END AS price_label,
  CASE k % 13 WHEN 0 THEN iso WHEN 1 THEN concat(iso, 'T', hm, ':09Z')
       WHEN 2 THEN concat(iso, ' ', hm, ':09+02:00')
       WHEN 3 THEN concat(cast(d AS string), '/', cast(m AS string), '/', cast(y AS string))
       WHEN 4 THEN concat(lpad(cast(d AS string), 2, '0'), '-', lpad(cast(m AS string), 2, '0'), '-',
                          cast(y AS string), ' ', hm)
       WHEN 5 THEN concat(cast(d AS string), '.', cast(m AS string), '.', lpad(cast(y % 100 AS string), 2, '0'))
       WHEN 6 THEN concat({_MONTH}, ' ', cast(d AS string), ', ', cast(y AS string), ', ',
                          cast(k % 12 + 1 AS string), ':05 ', CASE WHEN k % 2 = 0 THEN 'AM' ELSE 'PM' END)
       WHEN 7 THEN concat(cast(d AS string), ' ', {_MONTH}, ' ', cast(y AS string))
       WHEN 8 THEN concat(lpad(cast(m AS string), 2, '0'), '/', cast(d + 12 AS string), '/', cast(y AS string))
       WHEN 9 THEN concat('31/02/', cast(y AS string)) WHEN 10 THEN replace(iso, '-', '')
       WHEN 11 THEN concat('seen on ', iso) ELSE NULL END AS odate_value,
  CASE k % 14 WHEN 0 THEN o_orderstatus WHEN 1 THEN lower(o_orderstatus) WHEN 2 THEN 'Finished'
       WHEN 3 THEN 'open order' WHEN 4 THEN 'PART DONE' WHEN 5 THEN concat('{{{{', o_orderstatus, ',O}}}}')
       WHEN 6 THEN concat('["', o_orderstatus, '","finished"]') WHEN 7 THEN concat('[', o_orderstatus, ', p]')
       WHEN 8 THEN concat('[', o_orderstatus, ', zz]') WHEN 9 THEN '{{{{F,lost}}}}' WHEN 10 THEN 'lost'
       WHEN 11 THEN 'both' WHEN 12 THEN NULL ELSE 'waits' END AS status_value,
  CASE k % 9 WHEN 0 THEN 'Order Priority Of Customer' WHEN 1 THEN 'None' WHEN 2 THEN 'n/a'
       WHEN 3 THEN concat(iso, 'T', hm) WHEN 4 THEN concat({_MONTH}, ' ', cast(d AS string))
       WHEN 5 THEN 'urgent!' WHEN 6 THEN 'to be deleted' ELSE o_orderpriority END AS prio_value,
  CASE k % 12 WHEN 0 THEN 'true' WHEN 1 THEN 'Yes' WHEN 2 THEN 'y' WHEN 3 THEN '1' WHEN 4 THEN 'T'
       WHEN 5 THEN 'FALSE' WHEN 6 THEN 'no' WHEN 7 THEN 'N' WHEN 8 THEN '0' WHEN 9 THEN ' f '
       WHEN 10 THEN 'maybe' ELSE NULL END AS flag_value,
  CASE k % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN concat(iso, ' ', hm, ':00') ELSE NULL END AS mixed_value,
  CASE k % 7 WHEN 0 THEN concat('077', lpad(cast(k % 10000000 AS string), 7, '0'))
       WHEN 1 THEN concat('u', cast(k AS string), '@example.org') WHEN 2 THEN 'seen on ward'
       WHEN 3 THEN '' WHEN 4 THEN concat('63-', lpad(cast(k % 1000000 AS string), 6, '0'), '-A-42')
       WHEN 5 THEN concat('id ', 'MW12AB', lpad(cast(k % 100 AS string), 2, '0'), ' given')
       ELSE NULL END AS note_value
FROM (SELECT *, cast((whole - whole % 1000) / 1000 AS bigint) AS thou,
             whole % 1000 AS rest
      FROM (SELECT *, cast((cents - cents % 100) / 100 AS bigint) AS whole, cents % 100 AS frac,
                   concat(cast(y AS string), '-', lpad(cast(m AS string), 2, '0'), '-',
                          lpad(cast(d AS string), 2, '0')) AS iso,
                   concat(lpad(cast(k % 24 AS string), 2, '0'), ':', lpad(cast(k % 60 AS string), 2, '0')) AS hm
            FROM (SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus, o_orderpriority,
                         lpad(cast(o_custkey % 100000 AS string), 5, '0') AS pad,
                         cast(o_orderkey % 7 AS string) AS tail,
                         cast(round(o_totalprice * 100) AS bigint) AS cents,
                         cast(extract(year FROM o_orderdate) AS bigint) AS y,
                         cast(extract(month FROM o_orderdate) AS bigint) AS m,
                         cast(extract(day FROM o_orderdate) AS bigint) AS d
                  FROM {{orders}}) a) b) c
"""

VIEWS["dup_customer"] = """
SELECT c_custkey, c_nationkey,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE cast(cents AS string) END AS bal_a,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(cents + 1 AS string) END AS bal_b,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS seg,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE lower(c_mktsegment) END AS seg_value,
  'Segment?' AS seg_label,
  CASE WHEN c_custkey % 3 = 1 THEN NULL WHEN c_custkey % 11 = 0 THEN 2.5 ELSE grams END AS w1,
  CASE WHEN c_custkey % 4 = 1 THEN NULL WHEN c_custkey % 11 = 0 THEN grams + 40 ELSE grams END AS w2,
  CASE WHEN c_custkey % 5 = 1 THEN NULL ELSE grams END AS w3,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE cast(18 + c_custkey % 30 AS double) END AS age_years,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE cast((17 + c_custkey % 33) * 8766 + c_custkey % 5000 AS double) END AS age_hours
FROM (SELECT *, cast(round(c_acctbal * 100) AS bigint) AS cents,
             cast(1500 + c_custkey % 2500 AS double) AS grams FROM {customer}) a
"""

VIEWS["dirty_part"] = """
SELECT p_partkey, p_brand, p_type,
  CASE p_size % 10 WHEN 0 THEN 'SVD' WHEN 1 THEN 'Vent' WHEN 2 THEN 'For' WHEN 3 THEN 'ElCS' WHEN 4 THEN 'ECS'
       WHEN 5 THEN 'CSPrLab' WHEN 6 THEN 'IVD' WHEN 7 THEN '6' WHEN 8 THEN 'svd' ELSE NULL END AS mode_value,
  CASE p_size % 4 WHEN 0 THEN concat(cast(p_size AS string), ' = moderate')
       WHEN 1 THEN concat(cast(p_size AS string), '=mild') WHEN 2 THEN cast(p_size AS string)
       ELSE NULL END AS score_value
FROM {part}
"""

VIEWS["label_events"] = """
SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN cast(event_id % 9 AS string) WHEN 2 THEN '2.0' WHEN 3 THEN '0.5'
       WHEN 4 THEN '-1' WHEN 5 THEN NULL ELSE 'unknown' END AS visits_value,
  CASE event_id % 11 WHEN 0 THEN concat(cast(event_id % 12 AS string), ' ANC visits') WHEN 1 THEN '1 ANC visit '
       WHEN 2 THEN 'None' WHEN 3 THEN 'Not sure' WHEN 4 THEN 'ANC visits' WHEN 5 THEN 'More than 4 ANC visits'
       WHEN 6 THEN 'More than 8 ANC visits' WHEN 7 THEN 'Number of visits?' WHEN 8 THEN '3.0'
       WHEN 9 THEN NULL ELSE concat(cast(event_id % 3 AS string), ',', lpad(cast(event_id % 1000 AS string), 3, '0'))
       END AS visits_label
FROM {events}
"""

VIEWS["resent_events"] = """
SELECT 2 * e AS _rid, uid, facility, key1 AS uniquekey, ts AS startedat, sex, weight, weeks, apgar, mode,
       outcome, readm, kind, note FROM (
  SELECT event_id AS e, ts, event_type AS kind, concat('U', lpad(cast(user_id AS string), 6, '0')) AS uid,
    concat('F', cast(event_id % 3 AS string)) AS facility,
    CASE WHEN event_id % 4 = 0 THEN concat('2024-01-01T', lpad(cast(event_id AS string), 12, '0'))
         ELSE concat('K', lpad(cast(event_id AS string), 12, '0')) END AS key1,
    CASE WHEN event_id % 9 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast(2000 + (event_id % 4) * 60 + (user_id % 5) * 200 AS double) END AS weight,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE cast(30 + event_id % 3 + user_id % 7 AS double) END AS weeks,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(5 + event_id % 5 AS double) END AS apgar,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'SVD' ELSE 'CS' END AS mode,
    CASE event_id % 6 WHEN 0 THEN 'NND' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'DC' END AS outcome,
    CASE event_id % 8 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS readm,
    CASE WHEN event_id % 7 < 3 THEN NULL ELSE 'x' END AS note FROM {events}) a
UNION ALL
SELECT 2 * e + 1, uid, facility, concat('R', lpad(cast(e AS string), 12, '0')),
  CASE e % 4 WHEN 0 THEN ts + INTERVAL '5' MINUTE WHEN 1 THEN ts + INTERVAL '40' MINUTE
       WHEN 2 THEN ts + INTERVAL '60' MINUTE ELSE ts + INTERVAL '90' MINUTE END,
  CASE WHEN e % 30 = 3 THEN NULL WHEN e % 40 = 13 THEN 'F' ELSE sex END,
  CASE WHEN e % 20 = 3 THEN weight + 30 ELSE weight + 150 END, weeks, apgar, mode, outcome, readm, kind, note FROM (
  SELECT event_id AS e, ts, event_type AS kind, concat('U', lpad(cast(user_id AS string), 6, '0')) AS uid,
    concat('F', cast(event_id % 3 AS string)) AS facility,
    CASE WHEN event_id % 9 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast(2000 + (event_id % 4) * 60 + (user_id % 5) * 200 AS double) END AS weight,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE cast(30 + event_id % 3 + user_id % 7 AS double) END AS weeks,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(5 + event_id % 5 AS double) END AS apgar,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'SVD' ELSE 'CS' END AS mode,
    CASE event_id % 6 WHEN 0 THEN 'NND' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'DC' END AS outcome,
    CASE event_id % 8 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS readm,
    CAST(NULL AS string) AS note, event_id % 10 AS dice FROM {events}) b
WHERE dice = 3
"""

VIEWS["file_names"] = """
SELECT o_orderkey, concat(
  CASE o_custkey % 7 WHEN 0 THEN 'ken' WHEN 1 THEN 'ZIM' WHEN 2 THEN 'zim' ELSE 'mwi' END,
  CASE o_orderkey % 3 WHEN 0 THEN '_db' WHEN 1 THEN '_mb' ELSE '' END,
  CASE o_orderkey % 11 WHEN 0 THEN '_diagnoses' WHEN 1 THEN '_phc_admissions' WHEN 2 THEN '_phc_discharges'
       WHEN 3 THEN '_Maternal_Outcomes' WHEN 4 THEN '_baseline' WHEN 5 THEN '_discharges'
       WHEN 6 THEN '_discharges' WHEN 7 THEN '_infections' ELSE '_admissions' END, '_',
  CASE o_orderkey % 4 WHEN 0 THEN concat(y, '-', m, '-', d) WHEN 1 THEN concat(y, m, d)
       WHEN 2 THEN concat(y, m, d, '1230') ELSE CASE WHEN o_orderkey % 9 = 0 THEN concat(d, '-', m, '-', y)
       ELSE concat(y, '-', m, '-', d) END END,
  CASE WHEN o_orderkey % 23 = 0 THEN '.xlsx' ELSE '.csv' END) AS file_name
FROM (SELECT o_orderkey, o_custkey, cast(extract(year FROM o_orderdate) AS string) AS y,
             lpad(cast(extract(month FROM o_orderdate) AS string), 2, '0') AS m,
             lpad(cast(extract(day FROM o_orderdate) AS string), 2, '0') AS d FROM {orders}) a
"""

VIEWS["header_names"] = """
SELECT p_partkey, CASE p_size % 16 WHEN 0 THEN concat(' ', p_name, ' . Value') WHEN 1 THEN concat('Baby_', p_name, '_Name.value')
  WHEN 2 THEN concat(replace(p_name, ' ', '_'), '.label') WHEN 3 THEN 'Unique Key' WHEN 4 THEN 'motherDOB.value'
  WHEN 5 THEN 'MotherDOBYN.value' WHEN 6 THEN concat('MatHospNum', cast(p_size AS string), '.Label')
  WHEN 7 THEN concat(p_name, '.parentKey') WHEN 8 THEN 'Home Village.value' WHEN 9 THEN 'confirm.value'
  WHEN 10 THEN 'firm.value' WHEN 11 THEN concat(replace(p_name, ' ', ''), '.valuedischarge')
  WHEN 12 THEN 'HCWID_dis.label' WHEN 13 THEN concat('Part', cast(p_partkey AS string))
  WHEN 14 THEN 'religion.value' ELSE concat(p_name, '.labelDischarge') END AS raw
FROM {part}
"""

VIEWS["data_keys"] = """
SELECT 'ZIM' AS country, concat('K', lpad(cast(p_partkey AS string), 8, '0')) AS uniqueKey,
  CASE WHEN p_size % 10 = 0 THEN concat('O_', p_brand, cast(p_partkey % 40 AS string))
       ELSE concat(p_name, CASE WHEN p_size % 7 = 0 THEN ' Weight' WHEN p_size % 7 = 1 THEN ' Village' ELSE '' END) END AS name,
  concat(p_type, ' ', p_brand) AS label,
  CASE WHEN p_size % 10 = 0 THEN 'option' WHEN p_size % 6 = 0 THEN 'number' WHEN p_size % 6 = 1 THEN 'datetime'
       WHEN p_size % 6 = 2 THEN 'yesno' WHEN p_size % 6 = 3 THEN 'dropdown' WHEN p_size % 6 = 4 THEN 'text'
       ELSE 'gadget' END AS dataType,
  split(concat('K', lpad(cast(p_partkey - p_partkey % 10 AS string), 8, '0'), ',',
               'K', lpad(cast(p_partkey + 3 AS string), 8, '0'), ',',
               'K', lpad(cast(p_partkey * 2 AS string), 8, '0'), ',', 'none'), ',') AS options,
  p_size % 12 = 5 AS confidential, p_size % 25 = 3 AS isDeleted, p_size % 14 = 1 AS isDraft,
  CASE p_partkey % 5 WHEN 0 THEN TIMESTAMP '2023-01-01 00:00:00' WHEN 1 THEN TIMESTAMP '2024-05-01 00:00:00'
       WHEN 2 THEN TIMESTAMP '2022-03-04 00:00:00' WHEN 3 THEN TIMESTAMP '2024-05-01 00:00:00' ELSE NULL END AS publishDate
FROM {part}
"""

VIEWS["key_usage"] = """
SELECT 'ZIM' AS country, concat('K', lpad(cast(l_partkey AS string), 8, '0')) AS datakeyuniquekey,
  CASE l_suppkey % 6 WHEN 0 THEN 'Ward Admission Form' WHEN 1 THEN 'ward discharge' WHEN 2 THEN 'Admission (Dr Jane Roe)'
       WHEN 3 THEN 'Maternal Outcomes' WHEN 4 THEN 'PHC Admission' ELSE 'Register' END AS scripttitle
FROM {lineitem}
"""

VIEWS["form_fields"] = """
SELECT concat('S', cast(n_regionkey AS string)) AS script_id, n_nationkey AS screen_idx, 0 AS field_idx,
  CASE n_nationkey % 3 WHEN 0 THEN 'Price' WHEN 1 THEN 'Prio' ELSE 'Odate' END AS field_key,
  CASE n_nationkey % 4 WHEN 0 THEN '$Flag = ''y'' or $Flag = ''Yes''' WHEN 1 THEN '' ELSE '$Status != ''lost''' END AS screen_condition,
  CASE n_nationkey % 5 WHEN 0 THEN '!$Mixed = ''N''' WHEN 1 THEN '$Flag = true' WHEN 2 THEN '$Price > 50000 and !($Status = ''both'')'
       WHEN 3 THEN '' ELSE 'Status = ''F''' END AS field_condition
FROM {nation}
"""

VIEWS["nested_orders"] = """
SELECT o_orderkey, concat('S', cast(o_orderkey AS string)) AS sid, o_orderstatus, o_orderpriority,
       o_custkey % 4 AS q FROM {orders}
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def with_views(sql: str, uses: tuple[str, ...]) -> str:
    """Comparison SQL with its views as common table expressions."""
    if not uses:
        return sql
    own = {t: t for t in TABLES}
    ctes = ", ".join(f"{v} AS ({VIEWS[v].format(**own)})" for v in uses)
    text = sql.strip()
    return f"WITH {ctes}, {text[5:]}" if text[:5].upper() == "WITH " else f"WITH {ctes} {text}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    used = [t for t in TABLES if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})
