"""Record linkage over the resent events: admissions and discharges by kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.catalogue import query
from sluice.catalogue.views import table, view
from sluice.functions.shapes import format_datetime
from sluice.operators import episodes
from sluice.operators.ranking import nearest_times, running_number

_NAMES = {"sex": "gender.value", "weight": "birthweight.value", "weeks": "gestation.value",
          "apgar": "apgar5.value", "mode": "modedelivery.value", "outcome": "outcome.value",
          "readm": "readmission.value", "note": "other.value"}


def form_rows(spark, sf_dir, discharges: bool) -> DataFrame:
    """Admission forms (every kind but purchase) or discharge forms (purchases);
    one admission in six and three discharges in four lack the admission time."""
    df = view(spark, sf_dir, "resent_events")
    is_dis = F.col("kind") == "purchase"
    df = df.filter(is_dis if discharges else ~is_dis)
    lacking = (F.col("_rid") % 4 > 0) if discharges else (F.col("_rid") % 6 == 4)
    cells = ["_rid", "uid", "facility", "uniquekey", "startedat",
             F.when(~lacking, F.col("startedat")).alias("datetimeadmission.value"),
             *[F.col(n).alias(v) for n, v in _NAMES.items()]]
    if discharges:
        cells.append((F.col("startedat") + F.expr("INTERVAL 3 DAYS")).alias("datetimedischarge.value"))
    return df.select(*cells)


@query("episode_records")
def episode_records(spark, sf_dir):
    """Forms of one event as one record (greedy, complete-link)."""
    frame = episodes.comparison_frame(form_rows(spark, sf_dir, False), "admissions")
    r = episodes.collapse_records(frame)
    return r.select("uid", "facility", F.col("rec").alias("kept_row"), "n_rows", "no_id_ev", "sex", "bw", "ga",
                    "readm", "apgar5", "mode", "outcome")


@query("episode_babies")
def episode_babies(spark, sf_dir):
    kept, _ = episodes.dedup_episodes(form_rows(spark, sf_dir, False), "admissions")
    return kept.select("_rid", "uid", "uniquekey", "baby_id", "stay_no", "dedup_rows_merged", "dedup_basis",
                       "dedup_flag")


@query("episode_link")
def episode_link(spark, sf_dir):
    _, keys = episodes.dedup_episodes(form_rows(spark, sf_dir, False), "admissions")
    kept, _ = episodes.dedup_episodes(form_rows(spark, sf_dir, True), "discharges", keys)
    return kept.select("_rid", "uid", "uniquekey", "baby_id", "stay_no", "dedup_rows_merged", "dedup_basis",
                       "dedup_flag", "stay_form_primary")


@query("episode_summary")
def episode_summary(spark, sf_dir):
    """Counts report of an admissions run."""
    before = form_rows(spark, sf_dir, False)
    kept, _ = episodes.dedup_episodes(before, "admissions")
    return episodes.episode_summary(before, kept)


_DIFFER = """(coalesce(p.sex <> r.sex, false) OR coalesce(abs(p.weight - r.weight) > 100, false)
 OR coalesce(abs(p.weeks - r.weeks) > 1, false) OR coalesce(p.oc <> r.oc, false) OR coalesce(p.mode <> r.mode, false))"""


@query("episode_births", f"""WITH r AS (SELECT *, CASE WHEN outcome = 'DC' THEN 'live' WHEN outcome = 'NND' THEN 'still' END AS oc,
  row_number() OVER (PARTITION BY uid ORDER BY startedat, facility, _rid) AS k, count(*) OVER (PARTITION BY uid) AS u_n FROM resent_events),
 j AS (SELECT r._rid, count(*) FILTER (epoch_us(r.startedat) - epoch_us(p.startedat) <= 86400000000) AS day_n,
   count(*) FILTER (epoch_us(r.startedat) - epoch_us(p.startedat) <= 86400000000 AND NOT {_DIFFER}) AS day_same,
   count(*) FILTER (NOT {_DIFFER}) AS same_n FROM r JOIN r p ON p.uid = r.uid AND p.k < r.k GROUP BY 1)
SELECT r._rid AS rec, concat(uid, '.', CASE WHEN k <= 26 THEN chr(cast(64 + k AS int)) ELSE concat('Z', cast(k AS string)) END) AS baby_id,
 CASE WHEN u_n = 1 THEN 'only record under this UID' WHEN k = 1 THEN 'first record under this UID'
  WHEN day_n > 0 AND day_same = 0 THEN 'different baby: same day, baby details differ'
  WHEN day_n > 0 THEN 'unresolved: same day, nothing differs' WHEN same_n = 0 THEN 'different baby: another day'
  ELSE 'unresolved: another day, nothing differs' END AS basis
FROM r LEFT JOIN j USING (_rid)""", ("resent_events",))
def episode_births(spark, sf_dir):
    """Every row a record of its own, lettered in date order."""
    t = F.unix_micros(F.col("startedat").cast("timestamp"))
    records = view(spark, sf_dir, "resent_events").select(
        F.col("_rid").alias("rec"), "uid", "facility", t.alias("t_adm"), t.alias("t_start"), "sex",
        F.col("weight").alias("bw"), F.col("weeks").alias("ga"),
        F.when(F.col("outcome") == "DC", "live").when(F.col("outcome") == "NND", "still").alias("oc"),
        F.col("mode").alias("ord"),
        F.struct(t.alias("t"), F.lit(0).alias("m"), F.col("_rid").alias("r")).alias("place"))
    return episodes.assign_births(records).select("rec", "baby_id", "basis")


@query("nearest_match", """WITH d AS (SELECT *, CASE WHEN _rid % 4 > 0 THEN NULL ELSE startedat END AS t_adm FROM resent_events WHERE kind = 'purchase'),
 a AS (SELECT * FROM resent_events WHERE kind <> 'purchase'),
 p AS (SELECT d._rid AS rec, a._rid AS k, epoch_us(a.startedat) AS t, abs(epoch_us(d.t_adm) - epoch_us(a.startedat)) AS gap,
   cast(coalesce(d.sex <> a.sex, false) AS int) + cast(coalesce(abs(d.weight - a.weight) > 100, false) AS int)
   + cast(coalesce(abs(d.weeks - a.weeks) > 1, false) AS int) AS n_id,
   epoch_us(d.startedat) - epoch_us(a.startedat) < -86400000000 AS early FROM d JOIN a ON a.uid = d.uid AND a.facility = d.facility),
 q AS (SELECT *, coalesce(gap <= 3600000000 OR abs(gap - 7200000000) <= 72000000, false) AS conf,
   n_id = 0 AND NOT early AND NOT coalesce(gap > 86400000000, false) AS clean FROM p WHERE n_id < 2)
SELECT rec, count(*) FILTER (conf AND n_id = 0) AS conf_0, count(*) FILTER (conf AND n_id = 1) AS conf_1,
 count(*) FILTER (clean) AS clean_0, count(*) FILTER (n_id = 0) AS soft_0, count(*) FILTER (n_id = 1) AS soft_1,
 first(k ORDER BY n_id, coalesce(gap, 9e18), t, k) FILTER (conf) AS conf_row,
 first(k ORDER BY n_id, coalesce(gap, 9e18), t, k) FILTER (clean) AS clean_row,
 first(k ORDER BY n_id, coalesce(gap, 9e18), t, k) AS soft_row FROM q GROUP BY rec""", ("resent_events",))
def nearest_match(spark, sf_dir):
    """Candidates and best admission per discharge, by tier."""
    df = view(spark, sf_dir, "resent_events")
    t = F.unix_micros(F.col("startedat").cast("timestamp"))
    base = df.select(F.col("_rid").alias("rec"), "uid", "facility", "sex", F.col("weight").alias("bw"),
                     F.col("weeks").alias("ga"), t.alias("t"), "kind")
    dis = base.filter("kind = 'purchase'").withColumn(
        "t_adm", F.when(F.col("rec") % 4 == 0, F.col("t"))).withColumn("t_dis", F.col("t"))
    adm = base.filter("kind <> 'purchase'").select("*", F.col("t").alias("t_adm"), F.col("rec").alias("letter_k"),
                                                   F.lit(1).cast("bigint").alias("stay"))
    m = episodes.match_admissions(dis, adm)
    return m.select("rec", "conf_0", "conf_1", "clean_0", "soft_0", "soft_1", F.col("conf_best.k").alias("conf_row"),
                    F.col("clean_best.k").alias("clean_row"), F.col("soft_best.k").alias("soft_row"))


@query("nearest_times", """WITH v AS (SELECT user_id, ts FROM events WHERE event_type = 'view'),
 p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT event_id, strftime((SELECT max(ts) FROM v WHERE v.user_id = p.user_id AND v.ts <= p.ts), '%Y-%m-%d %H:%M:%S') AS earlier,
 strftime((SELECT min(ts) FROM v WHERE v.user_id = p.user_id AND v.ts > p.ts), '%Y-%m-%d %H:%M:%S') AS later FROM p""")
def nearest_times_query(spark, sf_dir):
    """Nearest view before and after each purchase of the same user."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    out = nearest_times(ev.filter("event_type = 'purchase'"), ev.filter("event_type = 'view'"), ["user_id"], "ts", "ts")
    return out.select("event_id", format_datetime(F.col("earlier")).alias("earlier"),
                      format_datetime(F.col("later")).alias("later"))


@query("running_numbers", """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit_no,
 count(*) OVER (PARTITION BY user_id) AS n_visits FROM events""")
def running_numbers(spark, sf_dir):
    """Sequence number in date order and group size."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    numbered = running_number(ev, ["user_id"], F.to_date("ts"), [F.col("ts"), F.col("event_id")], "visit_no")
    sizes = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_visits"))
    return numbered.join(sizes, "user_id").select("event_id", "user_id", "visit_no", "n_visits")


_MISS = " + ".join(f"(CASE WHEN {n} IS NULL THEN 1 ELSE 0 END)" for n in ("sex", "weight", "weeks", "outcome"))


@query("primary_form", f"""WITH s AS (SELECT *, {_MISS} AS miss, coalesce(outcome IN ('NND','NND<24','NND>24','BID','STB'), false) AS died,
  coalesce(outcome <> '' AND outcome NOT IN ('NND','NND<24','NND>24','BID','STB'), false) AS alive FROM resent_events),
 r AS (SELECT _rid AS rec, uid AS baby_id, _rid % 3 AS stay, row_number() OVER w AS rn, count(*) OVER g AS forms,
  bool_or(died) OVER g AND bool_or(alive) OVER g AS conflict FROM s
  WINDOW w AS (PARTITION BY uid, _rid % 3 ORDER BY startedat DESC, miss, facility, _rid), g AS (PARTITION BY uid, _rid % 3))
SELECT rec, baby_id, stay, forms, rn = 1 AS "primary", conflict AND forms > 1 AS conflict FROM r""", ("resent_events",))
def primary_form(spark, sf_dir):
    """Primary form and outcome conflict per (entity, stay)."""
    t = F.unix_micros(F.col("startedat").cast("timestamp"))
    miss = sum((F.col(n).isNull().cast("int") for n in ("sex", "weight", "weeks", "outcome")), F.lit(0))
    d = view(spark, sf_dir, "resent_events").select(
        F.col("_rid").alias("rec"), F.col("uid").alias("baby_id"), (F.col("_rid") % 3).alias("stay"), "facility",
        t.alias("t_start"), t.alias("t_dis"), miss.alias("miss"), "outcome", F.col("_rid").alias("place"))
    out = episodes.mark_primary_forms(d)
    return out.select("rec", "baby_id", "stay", "forms", "primary",
                      (F.col("died_any") & F.col("alive_any") & (F.col("forms") > 1)).alias("conflict"))
