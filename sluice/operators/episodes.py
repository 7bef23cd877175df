"""Record linkage: repeated forms collapse into records, records under one uid
become entities and stays, discharge records take the stay they fit.

Times are compared as microseconds of the wall clock.  Copies of one form are
aggregated before anything else, so the order-dependent part works on distinct
feature rows; runs of forms more than an hour apart are independent and are
separated from counts per (uid, facility, hour).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.identity import (birth_order, entity_letter, flag_text, outcome_class, plausible,
                                       sex_letter, yes_flag)
from sluice.functions.text import c, trim
from sluice.operators import folds
from sluice.operators.dedup import is_timestamp_key, missing_cells, shared_key_rows
from sluice.operators.folds import HOUR, BirthFold, CollapseFold, EntityFold
from sluice.operators.metrics import class_counts
from sluice.session import cut_lineage

# Fixed values.
DEATH_CODES = ("NND", "NND<24", "NND>24", "BID", "STB")
ROLES = ("admissions", "discharges", "births")
DAY = 24 * HOUR
MINUTE = HOUR // 60

IDENTITY = ("sex", "bw", "ga", "oc", "ord")
OTHER = ("apgar5", "mode", "birthf", "matage", "outcome")
CLOCKS = {"admission": ("t_adm", "t_start"), "form": ("t_start", "t_dis")}
KEY = ["uid", "facility"]
# Admissions with more partners than this per (uid, facility) are matched in blocks.
PAIR_LIMIT = 64
BLOCK_ROWS = 20_000


def _micros(df: DataFrame, *names: str) -> Column:
    """First non-null of the named clock columns, in microseconds."""
    def one(n: str) -> Column:
        if n not in df.columns:
            return F.lit(None).cast("bigint")
        x = c(n)
        if dict(df.dtypes)[n] == "string":
            x = F.regexp_replace(x, "Z$", "").try_cast("timestamp_ntz")
        return F.unix_micros(x.cast("timestamp"))

    return F.coalesce(*[one(n) for n in names])


def comparison_frame(df: DataFrame, role: str, outcome_column: str = "outcome.value",
                     rid: str = "_rid") -> DataFrame:
    """One comparable line per row; missing source columns count as null."""
    have = set(df.columns)

    def text(n: str) -> Column:
        return c(n).cast("string") if n in have else F.lit(None).cast("string")

    def first(make, *names: str) -> Column:
        return F.coalesce(*[make(text(n)) for n in names])

    def weight(x: Column) -> Column:
        return plausible(x, 300, 7000)

    def weeks(x: Column) -> Column:
        return plausible(x, 20, 46)

    births = role == "births"
    none = F.lit(None).cast("string")
    data = [n for n in df.columns if n not in ("uid", "facility") and not n.startswith("_")]
    return df.select(
        F.col(rid).cast("bigint").alias("rid"), "uid",
        F.coalesce("facility", F.lit("")).alias("facility"),
        text("uniquekey").alias("uniquekey"), missing_cells(data).alias("miss"),
        _micros(df, *(("dateadmission.value",) if births else ("datetimeadmission.value",))).alias("t_adm"),
        _micros(df, "startedat").alias("t_start"),
        _micros(df, "datetimedischarge.value", "datetimedeath.value", "datedischvitals.value",
                "datedischweight.value", "startedat").alias("t_dis"),
        (first(sex_letter, "sexdis.value", "sex.value") if births
         else first(sex_letter, "gender.value", "sexdis.value")).alias("sex"),
        (first(weight, "bwtdis.value", "birthweight.value", "bwt.value") if births
         else first(weight, "birthweight.value", "bw.value", "bwdc.value")).alias("bw"),
        (first(weeks, "gestation.value") if births
         else first(weeks, "gestation.value", "gestationdc.value")).alias("ga"),
        (F.lit(False) if births
         else F.coalesce(yes_flag(text("readmission.value")), F.lit(False))).alias("readm"),
        text("apgar5.value").try_cast("double").alias("apgar5"),
        text("modedelivery.value").alias("mode"), text("birthfacility.value").alias("birthf"),
        text("matageyrs.value").try_cast("double").alias("matage"),
        trim(text(outcome_column)).alias("outcome"),
        (outcome_class(text(outcome_column)) if births else none).alias("oc"),
        (birth_order(text("typebirth.value")) if births else none).alias("ord"))


def _feature_rows(frame: DataFrame, clock: str) -> DataFrame:
    """Copies with equal features as one row.

    Copies always end up in one record, because they are compatible with each
    other and with the same other rows.  Rows without any clock never collapse
    and keep their own row.  Every remaining field travels as (rank, value),
    where rank orders rows by completeness, so later merges need no row lookup."""
    p, q = CLOCKS[clock]
    t = F.coalesce(p, q)
    rank = F.struct((-F.col("miss")).alias("m"), (~is_timestamp_key(F.col("uniquekey"))).alias("k"),
                    F.col("uniquekey").alias("u"), (-F.coalesce(t, F.lit(0))).alias("t"),
                    (-F.col("rid")).alias("r"))
    loose = [n for n in ("t_adm", "t_start", "t_dis") if n not in (p, q)]
    features = [p, q, *IDENTITY, "readm"]

    def ranked(n: str) -> Column:
        return F.max(F.when(c(n).isNotNull(), F.struct(rank.alias("rank"), c(n).alias("v")))).alias(n)

    grouped = frame.withColumn("_lone", F.when(t.isNull(), F.col("rid"))).groupBy(
        *KEY, *features, "_lone").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.struct("miss", "rid")).alias("first"),
        F.max(rank).alias("rank"), *[ranked(n) for n in (*loose, *OTHER)])
    return (grouped.withColumn("fid", F.col("first.rid")).withColumn("clock", F.coalesce(p, q))
            .withColumn("p", F.col(p)).withColumn("q", F.col(q)).drop("_lone"))


def _segments(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Per (uid, facility, hour): independent segment, its size and chunk.

    Two forms can only meet when their clocks are within an hour, so a gap of
    more than an hour between filled hours separates them.  Where some forms of
    a key lack the first clock, the two clocks may disagree and the key stays
    one segment."""
    w = Window.partitionBy(*KEY)
    by_hour = w.orderBy("hour")
    hours = (rows.filter("clock IS NOT NULL").groupBy(*KEY, F.floor(F.col("clock") / HOUR).alias("hour"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("clock").alias("lo"), F.max("clock").alias("hi"),
                  F.max(F.col("p").isNull()).alias("second"), F.max(F.col("p").isNotNull()).alias("main")))
    gap = F.coalesce(F.col("lo") - F.lag("hi").over(by_hour) > HOUR, F.lit(True))
    hours = (hours.withColumn("mixed", F.max("second").over(w) & F.max("main").over(w))
             .withColumn("gap", gap))
    hours = hours.withColumn("seg", F.when(F.col("mixed"), F.lit(0))
                             .otherwise(F.sum(F.col("gap").cast("bigint")).over(by_hour)))
    s = Window.partitionBy(*KEY, "seg")
    return (hours.select(*KEY, "hour", "seg", F.sum("n").over(s).alias("seg_n"),
                         F.floor((F.sum("n").over(s.orderBy("hour")) - F.col("n")) / chunk_rows).alias("_part"))
            .withColumn("_chunk", F.dense_rank().over(s.orderBy("_part"))).drop("_part"))


def collapse_records(frame: DataFrame, clock: str = "admission",
                     chunk_rows: int = folds.CHUNK_ROWS) -> DataFrame:
    """Rows of one event as one record, identified by the row it keeps."""
    rows = cut_lineage(_feature_rows(frame, clock))
    seg = cut_lineage(_segments(rows, chunk_rows))
    placed = rows.withColumn("hour", F.floor(F.col("clock") / HOUR)).join(seg, [*KEY, "hour"], "left")
    keys, order = [*KEY, "seg"], [F.col("clock"), F.col("first.miss"), F.col("fid")]
    schema = "fid bigint, cluster bigint"
    multi = placed.filter("seg_n > 1")
    clusters = folds.fold_groups(multi.filter(F.col("seg_n") <= chunk_rows), keys, order,
                                 CollapseFold, schema)
    if not seg.filter(F.col("seg_n") > chunk_rows).isEmpty():
        clusters = clusters.unionByName(folds.fold_chunks(
            multi.filter(F.col("seg_n") > chunk_rows), keys, order, CollapseFold, schema))
    rows = (rows.join(clusters.filter("cluster <> fid"), "fid", "left")
            .withColumn("cluster", F.coalesce("cluster", "fid")))

    p, q = CLOCKS[clock]
    loose = [n for n in ("t_adm", "t_start", "t_dis") if n not in (p, q)]

    def same(n: str) -> Column:
        return F.max(F.when(c(n).isNotNull(), F.struct("rank", c(n).alias("v"))))["v"].alias(n)

    compared = F.greatest(*[F.sum(F.when(c(n).isNotNull(), F.col("n_rows"))) for n in IDENTITY])
    out = rows.groupBy(*KEY, "cluster").agg(
        F.max("rank").alias("rank"), F.sum("n_rows").alias("n_rows"),
        F.min(F.struct(F.coalesce("clock", F.lit(2**62)).alias("t"), F.col("first.miss").alias("m"),
                       F.col("fid").alias("r"))).alias("place"),
        F.coalesce(compared < 2, F.lit(True)).alias("no_id"),
        *[same(n) for n in (p, q, *IDENTITY)], *[F.max(n)["v"].alias(n) for n in (*loose, *OTHER)],
        F.max("readm").alias("readm"))
    return (out.withColumn("rec", -F.col("rank.r")).withColumn("miss", -F.col("rank.m"))
            .withColumn("uniquekey", F.col("rank.u"))
            .withColumn("no_id_ev", F.col("no_id") & (F.col("n_rows") > 1))
            .drop("rank", "cluster", "no_id"))


def _dated(records: DataFrame) -> DataFrame:
    return records.filter("uid IS NOT NULL").withColumn("t_event", F.coalesce("t_adm", "t_start"))


def _with_counts(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dated records with the number of records under their uid, those numbers); only what a fold reads of it is shuffled."""
    sizes = records.groupBy("uid").agg(F.count(F.lit(1)).alias("u_n"))
    return records.join(sizes, "uid"), sizes


def _event_order() -> list[Column]:
    """Date order of records; records without a date come last."""
    return [F.col("t_event"), F.col("facility"), F.col("place")]


def assign_entities(records: DataFrame, chunk_rows: int = folds.CHUNK_ROWS) -> DataFrame:
    """Entity letter, stay number and basis for admission records."""
    dated = _dated(records)
    a, sizes = _with_counts(dated)
    several = (a.filter("u_n > 1").withColumn("seed", F.lit(False))
               .withColumn("letter_k", F.lit(None).cast("bigint"))
               .withColumn("stay", F.lit(None).cast("bigint")))
    placed = folds.ordered_fold(
        several, ["uid"], F.col("t_event") / MINUTE, _event_order(), EntityFold,
        "rec bigint, letter_k bigint, stay bigint, basis string, joined boolean", chunk_rows, sizes)
    out = dated.join(placed.drop("joined"), "rec", "left").na.fill({"letter_k": 1, "stay": 1})
    return (out.withColumn("basis", F.coalesce("basis", F.lit("only record under this UID")))
            .withColumn("baby_id", _entity_id("letter_k")))


def assign_births(records: DataFrame, chunk_rows: int = folds.CHUNK_ROWS) -> DataFrame:
    """Every birth record is an entity of its own, lettered in date order."""
    dated = _dated(records)
    r, sizes = _with_counts(dated)
    placed = folds.ordered_fold(r.filter("u_n > 1"), ["uid"], F.col("t_event") / MINUTE, _event_order(),
                                BirthFold, "rec bigint, letter_k bigint, basis string", chunk_rows, sizes)
    out = dated.join(placed, "rec", "left").na.fill({"letter_k": 1})
    return (out.withColumn("basis", F.coalesce("basis", F.lit("only record under this UID")))
            .withColumn("baby_id", _entity_id("letter_k")))


def _entity_id(k: str) -> Column:
    return F.concat(F.col("uid"), F.lit("."), entity_letter(F.col(k)))


def _fit_columns(pairs: DataFrame) -> DataFrame:
    """Per discharge: candidates and best admission of each tier.

    Tiers: the admission time on the discharge agrees (within an hour, or two
    hours off); nothing speaks against the pair; at most one doubt."""
    def differs(n: str, tolerance: float | None = None) -> Column:
        a, b = F.col(f"{n}_d"), F.col(f"{n}_a")
        bad = a != b if tolerance is None else F.abs(a - b) > tolerance
        return F.coalesce(bad, F.lit(False)).cast("int")

    gap = F.abs(F.col("t_adm_d") - F.col("t_adm_a"))
    p = (pairs.withColumn("n_id", differs("sex") + differs("bw", 100) + differs("ga", 1))
         .filter("n_id < 2").withColumn("gap", gap))
    conf = F.coalesce((F.col("gap") <= HOUR) | (F.abs(F.col("gap") - 2 * HOUR) <= int(0.02 * HOUR)),
                      F.lit(False))
    doubt = ((F.col("n_id") == 1)
             | F.coalesce(F.col("t_dis_d") - F.col("t_adm_a") < -DAY, F.lit(False))
             | F.coalesce(F.col("gap") > DAY, F.lit(False)))
    best = F.struct("n_id", F.coalesce("gap", F.lit(2**62)).alias("g"),
                    F.coalesce("t_adm_a", F.lit(2**62)).alias("t"), F.col("letter_a").alias("k"),
                    F.col("stay_a").alias("s"))
    aggs = []
    for name, flag in (("conf", conf), ("clean", ~doubt), ("soft", F.lit(True))):
        aggs += [F.count_if(flag & (F.col("n_id") == 0)).alias(f"{name}_0"),
                 F.count_if(flag & (F.col("n_id") == 1)).alias(f"{name}_1"),
                 F.min(F.when(flag, best)).alias(f"{name}_best")]
    return p.groupBy("rec").agg(*aggs)


_TIERS = ("conf", "clean", "soft")
_BEST = "struct<n_id:int,g:bigint,t:bigint,k:bigint,s:bigint>"


def _block_matches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Discharges of one block against its admissions (which sort first)."""
    block, adm, arrays = None, [], None
    names = ["rec", *[f"{t}_{x}" for t in _TIERS for x in ("0", "1", "best")]]
    big = 2**62
    for batch in batches:
        rows = []
        for key, is_dis, rec, *v in zip(
                zip(*[batch[k].tolist() for k in ("uid", "facility", "_ab", "_db")]), batch["_dis"],
                batch["rec"], *[batch[n].tolist() for n in
                                ("sex", "bw", "ga", "t_adm", "t_dis", "letter_k", "stay")]):
            sex, bw, ga, t_adm, t_dis, k, s = v
            if key != block:
                block, adm, arrays = key, [], None
            if not is_dis:
                adm.append((sex or "", bw, ga, t_adm, k, s))
                continue
            if arrays is None:
                cols = list(zip(*adm)) if adm else [()] * 6
                arrays = [np.array(cols[0], dtype=object),
                          *[np.array(x, dtype="float64") for x in cols[1:4]],
                          *[np.array(x, dtype="int64") for x in cols[4:]]]
            sexes, bws, gas, times, ks, ss = arrays
            n_id = ((sexes != sex) & (sexes != "") if sex else np.zeros(len(sexes), bool)).astype(int)
            n_id = n_id + (np.abs(bws - bw) > 100) + (np.abs(gas - ga) > 1)
            gap = np.abs(times - t_adm)
            fits = n_id < 2
            conf = fits & ((gap <= HOUR) | (np.abs(gap - 2 * HOUR) <= int(0.02 * HOUR)))
            clean = (n_id == 0) & ~(t_dis - times < -DAY) & ~(gap > DAY)
            out = [int(rec)]
            for flag in (conf, clean, fits):
                at = np.flatnonzero(flag)
                out += [int((n_id[at] == 0).sum()), int((n_id[at] == 1).sum())]
                if not len(at):
                    out.append(None)
                    continue
                g = np.where(np.isnan(gap[at]), big, gap[at])
                t = np.where(np.isnan(times[at]), big, times[at])
                i = np.lexsort((ss[at], ks[at], t, g, n_id[at]))[0]
                out.append({"n_id": int(n_id[at][i]), "g": int(g[i]), "t": int(t[i]),
                            "k": int(ks[at][i]), "s": int(ss[at][i])})
            rows.append(out)
        yield pd.DataFrame(rows, columns=names, dtype=object)


def match_admissions(dis: DataFrame, adm: DataFrame, pair_limit: int = PAIR_LIMIT,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Tier counts and best admission per discharge record.

    A (uid, facility) with few admissions is an ordinary join (at most
    ``pair_limit`` partners per discharge).  Larger ones are cut into blocks of
    admissions x discharges; a block yields one partial line per discharge and
    the lines are merged, so no list of pairs is ever built and no task holds
    more than one block."""
    per_key = adm.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_a"))
    a = adm.join(per_key, KEY)
    few = a.filter(F.col("n_a") <= pair_limit).select(
        *KEY, *[F.col(n).alias(f"{n}_a") for n in ("sex", "bw", "ga", "t_adm")],
        F.col("letter_k").alias("letter_a"), F.col("stay").alias("stay_a"))
    d = dis.select("rec", *KEY, "sex", "bw", "ga", "t_adm", "t_dis")
    direct = _fit_columns(d.select("rec", *KEY, *[F.col(n).alias(f"{n}_d") for n in
                                                  ("sex", "bw", "ga", "t_adm", "t_dis")]).join(few, KEY))
    many = per_key.filter(F.col("n_a") > pair_limit)
    if many.isEmpty():
        return direct
    sizes = (many.join(d.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_d")), KEY)
             .select(*KEY, F.ceil(F.col("n_a") / block_rows).alias("a_blocks"),
                     F.ceil(F.col("n_d") / block_rows).alias("d_blocks")))
    shared = ["rec", *KEY, "sex", "bw", "ga", "t_adm"]
    left = (adm.join(sizes, KEY).withColumn("_ab", F.pmod(F.xxhash64("rec"), "a_blocks"))
            .withColumn("_db", F.explode(F.sequence(F.lit(0), F.col("d_blocks") - 1)))
            .select(*shared, F.lit(None).cast("bigint").alias("t_dis"), "letter_k", "stay", "_ab",
                    F.col("_db").cast("bigint"), F.lit(False).alias("_dis")))
    right = (d.join(sizes, KEY).withColumn("_db", F.pmod(F.xxhash64("rec"), "d_blocks"))
             .withColumn("_ab", F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1)))
             .select(*shared, "t_dis", F.lit(None).cast("bigint").alias("letter_k"),
                     F.lit(None).cast("bigint").alias("stay"), F.col("_ab").cast("bigint"), "_db",
                     F.lit(True).alias("_dis")))
    block = [*KEY, "_ab", "_db"]
    schema = "rec bigint, " + ", ".join(
        f"{t}_0 bigint, {t}_1 bigint, {t}_best {_BEST}" for t in _TIERS)
    partial = (left.unionByName(right).transform(folds.together, block).sortWithinPartitions(*block, "_dis")
               .mapInPandas(_block_matches, schema))
    merged = partial.groupBy("rec").agg(*[
        agg for t in _TIERS for agg in (F.sum(f"{t}_0").alias(f"{t}_0"), F.sum(f"{t}_1").alias(f"{t}_1"),
                                        F.min(f"{t}_best").alias(f"{t}_best"))])
    return direct.unionByName(merged)


def link_discharges(dis: DataFrame, adm: DataFrame, chunk_rows: int = folds.CHUNK_ROWS,
                    pair_limit: int = PAIR_LIMIT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Discharge records with the entity and stay they belong to."""
    m = match_admissions(dis, adm, pair_limit, block_rows)

    def ties(t: str) -> Column:
        return F.when(F.col(f"{t}_0") > 0, F.col(f"{t}_0")).otherwise(F.col(f"{t}_1"))

    ambiguous = "ambiguous: closest admission used (earlier on a tie)"
    basis = (F.when(ties("conf") == 1, "matched: admission date-time on the discharge form")
             .when(ties("conf") > 1, ambiguous)
             .when(ties("clean") == 1, "matched: only admission that fits")
             .when(ties("clean") > 1, ambiguous)
             .when(ties("soft") == 1, "matched with a doubt").when(ties("soft") > 1, ambiguous))
    chosen = F.coalesce("conf_best", "clean_best", "soft_best")
    m = m.select("rec", basis.alias("link_basis"), chosen["k"].alias("letter_k"), chosen["s"].alias("stay"))
    d = cut_lineage(dis.join(m, "rec", "left"))

    loose = d.filter("letter_k IS NULL")
    used = ["uid", "facility", "sex", "bw", "ga", "apgar5", "mode", "birthf", "matage"]
    seeds = (adm.join(loose.select("uid").distinct(), "uid", "left_semi")
             .select("rec", *used, F.col("letter_k").cast("bigint"), F.col("stay").cast("bigint"),
                     F.lit(True).alias("seed"), F.lit(None).cast("bigint").alias("t_event"),
                     F.struct(F.col("letter_k").cast("bigint").alias("t"), F.col("stay").cast("bigint").alias("m"),
                              F.col("rec").alias("r")).alias("place")))
    queue = loose.select("rec", *used, F.lit(None).cast("bigint").alias("letter_k"),
                         F.lit(None).cast("bigint").alias("stay"), F.lit(False).alias("seed"),
                         F.coalesce("t_dis", "t_start").alias("t_event"),
                         F.struct(F.col("place.t").alias("t"), F.col("place.m").cast("bigint").alias("m"),
                                  F.col("place.r").alias("r")).alias("place"))
    both = seeds.unionByName(queue).withColumn("readm", F.lit(False))
    bucket = (F.when(F.col("seed"), F.col("letter_k") - 2**40)
              .otherwise(F.coalesce(F.col("t_event") / MINUTE, F.lit(2**40))))
    order = [(~F.col("seed")).cast("int"), F.col("t_event"), F.when(~F.col("seed"), F.col("facility")),
             F.col("place")]
    placed = folds.ordered_fold(both, ["uid"], bucket, order, EntityFold,
                                "rec bigint, letter_k bigint, stay bigint, basis string, joined boolean",
                                chunk_rows)
    here = adm.select(*KEY).distinct().withColumn("_here", F.lit(True))
    loose_basis = (F.when(F.col("joined"), "discharge only: fits a baby already under this UID")
                   .when(F.col("_here"), "discharge only: does not fit the admissions under this UID")
                   .otherwise("discharge only: no admission under this UID at this site"))
    rest = (loose.drop("letter_k", "stay", "link_basis")
            .join(placed.select("rec", "letter_k", "stay", "joined"), "rec").join(here, KEY, "left")
            .withColumn("link_basis", loose_basis).drop("joined", "_here"))
    out = d.filter("letter_k IS NOT NULL").unionByName(rest)
    return out.withColumn("baby_id", _entity_id("letter_k"))


def mark_primary_forms(d: DataFrame) -> DataFrame:
    """Per (entity, stay): number of forms, whether outcomes conflict, and the
    primary form (latest clock, then most complete)."""
    clock = F.coalesce("t_start", "t_dis")
    died = F.coalesce(F.col("outcome").isin(*DEATH_CODES), F.lit(False))
    alive = F.coalesce((F.col("outcome") != "") & ~F.col("outcome").isin(*DEATH_CODES), F.lit(False))
    stays = d.groupBy("baby_id", "stay").agg(
        F.count(F.lit(1)).alias("forms"), F.max(died).alias("died_any"), F.max(alive).alias("alive_any"),
        F.min_by("rec", F.struct(F.coalesce(-clock, F.lit(2**62)), "miss", "facility", "place"))
        .alias("_primary"))
    return (d.join(stays, ["baby_id", "stay"]).withColumn("primary", F.col("rec") == F.col("_primary"))
            .drop("_primary"))


def _flag(cond: Column, name: str) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(name))


KEY_COLUMNS = ("rec", "uid", "facility", "uniquekey", "t_adm", "t_start", "sex", "bw", "ga", "readm",
               "apgar5", "mode", "birthf", "matage", "letter_k", "stay", "baby_id")


def dedup_episodes(df: DataFrame, role: str, adm_keys: DataFrame | None = None,
                   outcome_column: str = "outcome.value", rid: str = "_rid",
                   chunk_rows: int = folds.CHUNK_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Kept rows with baby_id, stay_no (not for births), dedup_rows_merged,
    dedup_basis, dedup_flag and (discharges) stay_form_primary; and, for
    admissions, the key table a discharges run needs.  Rows without an id are
    kept as they are."""
    if role not in ROLES:
        raise ValueError(f"unknown role '{role}'")
    if role == "discharges" and adm_keys is None:
        raise ValueError("discharges need the key table of the admissions run")
    no_uid = F.col("uid").isNull() | (trim(F.col("uid")) == "")
    frame = comparison_frame(df.filter(~no_uid), role, outcome_column, rid)
    records = cut_lineage(collapse_records(frame, "form" if role == "discharges" else "admission",
                                           chunk_rows))
    keys = None
    collapsed = _flag(F.col("no_id_ev"), "collapsed_no_identity")
    if role == "births":
        r = assign_births(records, chunk_rows)
        flags = [_flag(F.col("basis").startswith("unresolved"), "unresolved"),
                 _flag(F.col("basis").contains("same day, baby details differ"), "same_day_pair"), collapsed]
    elif role == "admissions":
        r = cut_lineage(assign_entities(records, chunk_rows))
        keys = r.select(*KEY_COLUMNS)
        flags = [_flag(F.col("basis").startswith("unresolved"), "unresolved"),
                 _flag(F.col("basis").contains("other fields"), "probable"), collapsed]
    else:
        r = mark_primary_forms(link_discharges(records, adm_keys, chunk_rows)).withColumn(
            "basis", F.col("link_basis"))
        flags = [_flag(F.col("basis").startswith("ambiguous"), "ambiguous_link"),
                 _flag(F.col("basis") == "matched with a doubt", "link_doubt"),
                 _flag(F.col("basis").startswith("discharge only"), "no_admission"),
                 _flag((F.col("forms") > 1) & F.col("died_any") & F.col("alive_any"), "outcome_conflict"),
                 collapsed]
    added = ["baby_id", *([] if role == "births" else ["stay_no"]), "dedup_rows_merged", "dedup_basis",
             "dedup_flag", *(["stay_form_primary"] if role == "discharges" else [])]
    new = r.withColumn("dedup_rows_merged", F.col("n_rows").cast("int")).withColumn(
        "dedup_basis", F.col("basis")).withColumn("dedup_flag", flag_text(*flags))
    if role != "births":
        new = new.withColumn("stay_no", F.col("stay").cast("int"))
    if role == "discharges":
        new = new.withColumn("stay_form_primary", F.col("primary"))
    kept = df.join(new.select(F.col("rec").alias("_rec"), *added), F.col(rid) == F.col("_rec")).drop("_rec")
    extra = (df.filter(no_uid).withColumn("dedup_rows_merged", F.lit(1))
             .withColumn("dedup_basis", F.lit("no uid: row kept as it is"))
             .withColumn("dedup_flag", F.lit("no_uid")))
    return kept.unionByName(extra, allowMissingColumns=True), keys


def _lines(row: DataFrame, **metrics: Column) -> DataFrame:
    """(metric, n) lines from a one-row aggregate."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), x.cast("bigint").alias("n")) for name, x in metrics.items()]))
        .alias("x")).select("x.*")


def episode_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts report of one linkage run: totals, bases and flags.

    Distinct ids, entities and stays come from one chain of groupings, each
    working on the result of the one before.  The few columns that are counted
    are stored first, since every report reads them."""
    stay = ["stay_no"] if "stay_no" in after.columns else []
    after = cut_lineage(after.select(*KEY, "uniquekey", "baby_id", *stay, "dedup_basis", "dedup_flag"))
    stays = after.groupBy("uid", "baby_id", *stay).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("dedup_flag").contains("no_uid")).alias("no_uid"),
        F.count_if(F.col("dedup_flag") != "none").alias("flagged"))
    ids = (stays.groupBy("uid", "baby_id").agg(F.count(F.lit(1)).alias("stays"), *[
        F.sum(n).alias(n) for n in ("rows", "no_uid", "flagged")])
           .groupBy("uid").agg(F.count("baby_id").alias("babies"), F.sum(
               F.when(F.col("baby_id").isNotNull(), F.col("stays"))).alias("stays"), *[
               F.sum(n).alias(n) for n in ("rows", "no_uid", "flagged")]))
    total = ids.agg(F.count("uid").alias("uids"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (
        "babies", "stays", "rows", "no_uid", "flagged")])
    found = {"rows_out": F.col("rows"), "rows_collapsed": -F.col("rows"), "distinct_uids": F.col("uids"),
             "distinct_babies": F.col("babies"), "rows_without_uid": F.col("no_uid"), "rows_flagged": F.col("flagged")}
    if stay:
        found["distinct_stays"] = F.col("stays")
    rows_in = before.agg(F.count(F.lit(1)).alias("n"))
    shared = (shared_key_rows(after).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")))
    lines = (_lines(total, **found).unionByName(_lines(rows_in, rows_in=F.col("n"), rows_collapsed=F.col("n")))
             .unionByName(_lines(shared, rows_sharing_uid_facility_uniquekey=F.col("n")))
             .groupBy("metric").agg(F.sum("n").alias("n"))
             .select(F.lit("episodes").alias("step"), F.lit("").alias("column"), "metric", "n"))
    bases = class_counts(after, "episodes", {"dedup_basis": F.col("dedup_basis")})
    flags = (after.filter(F.col("dedup_flag") != "none")
             .select(F.explode(F.split("dedup_flag", ";")).alias("metric")).groupBy("metric")
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit("episodes").alias("step"), F.lit("dedup_flag").alias("column"), "metric", "n"))
    return lines.unionByName(bases).unionByName(flags)
