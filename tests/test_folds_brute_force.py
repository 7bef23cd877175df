"""Folds against direct, quadratic statements of the rules on random rows."""

import random
from datetime import datetime, timedelta
from itertools import combinations

import pytest

from sluice.operators import episodes as ep

T0 = datetime(2024, 5, 1)
SCHEMA = ("_rid long, uid string, facility string, uniquekey string, `datetimeadmission.value` timestamp_ntz, "
          "startedat timestamp_ntz, `datetimedischarge.value` timestamp_ntz, `gender.value` string, `birthweight.value` double, "
          "`gestation.value` double, `readmission.value` string, `apgar5.value` double, `modedelivery.value` string, "
          "`matageyrs.value` double, `outcome.value` string")
HOUR = timedelta(hours=1)


def make_rows(seed, n, keys, minutes):
    rnd = random.Random(seed)

    def maybe(x, p=0.25):
        return None if rnd.random() < p else x

    rows = []
    for i in range(n):
        t = T0 + timedelta(minutes=rnd.randrange(minutes))
        start = maybe(t + timedelta(minutes=rnd.choice([0, 0, 10, 45, 200])), 0.15)
        rows.append((i, f"U{rnd.randrange(keys)}", rnd.choice(["H1", "H1", "H2"]), f"k{rnd.randrange(10**6):06d}",
                     maybe(t, 0.2), start, maybe(t + timedelta(days=rnd.randrange(3))),
                     maybe(rnd.choice("MF")), maybe(rnd.choice([2000.0, 2050.0, 2120.0, 2600.0])),
                     maybe(rnd.choice([37.0, 38.0, 39.0])), maybe(rnd.choice("YN"), 0.8),
                     maybe(rnd.choice([5.0, 9.0]), 0.5), maybe(rnd.choice(["SVD", "CS"]), 0.5),
                     maybe(rnd.choice([20.0, 21.0, 30.0]), 0.6), maybe(rnd.choice(["DC", "NND", ""]))))
        if rnd.random() < 0.2:
            rows.append((10**6 + i, *rows[-1][1:3], f"k{rnd.randrange(10**6):06d}", *rows[-1][4:]))
    return rows


def fields(row, clock):
    rid, uid, fac, key, adm, start, dis, sex, bw, ga, readm, apgar, mode, age, outcome = row
    t_dis = dis or start
    p, q = (adm, start) if clock == "admission" else (start, t_dis)
    miss = sum(x is None for x in row[3:])
    return dict(rid=rid, uid=uid, facility=fac, uniquekey=key, miss=miss, t_adm=adm, t_start=start, t_dis=t_dis, p=p, q=q,
                clock=p or q, sex=sex, bw=bw, ga=ga, readm=readm == "Y", apgar5=apgar, mode=mode, matage=age, birthf=None,
                outcome=outcome)


def id_diff(a, b):
    d = 0
    for f, tol in (("sex", None), ("bw", 100), ("ga", 1)):
        x, y = a[f], b[f]
        if x is not None and y is not None:
            d += x != y if tol is None else abs(x - y) > tol
    return d


def collapse(rows, clock):
    """kept row id -> list of member rows."""
    groups = {}
    for r in (fields(x, clock) for x in rows):
        groups.setdefault((r["uid"], r["facility"]), []).append(r)
    late = datetime.max
    out = []
    for members in groups.values():
        members.sort(key=lambda r: (r["clock"] or late, r["miss"], r["rid"]))
        comps = []
        for r in members:
            def fits(m):
                if r["p"] and m["p"]:
                    gap = abs(r["p"] - m["p"])
                elif r["q"] and m["q"]:
                    gap = abs(r["q"] - m["q"])
                else:
                    return False
                return gap <= HOUR and id_diff(r, m) == 0 and r["readm"] == m["readm"]
            for comp in comps:
                if all(fits(m) for m in comp):
                    comp.append(r)
                    break
            else:
                comps.append([r])
        for place, comp in enumerate(comps):
            ranked = sorted(comp, key=lambda r: r["uniquekey"], reverse=True)
            ranked.sort(key=lambda r: r["miss"])
            best = ranked[0]
            rec = {f: next((r[f] for r in ranked if r[f] is not None), None) for f in
                   ("t_adm", "t_start", "t_dis", "sex", "bw", "ga", "apgar5", "mode", "birthf", "matage", "outcome")}
            no_id = len(comp) > 1 and not any(any(a[f] is not None and b[f] is not None for f in ("sex", "bw", "ga"))
                                              for a, b in combinations(comp, 2))
            out.append({**rec, "rec": best["rid"], "uid": best["uid"], "facility": best["facility"], "n_rows": len(comp),
                        "miss": best["miss"], "readm": any(r["readm"] for r in comp), "no_id": no_id,
                        "first": (comp[0]["clock"] or late, comp[0]["miss"], comp[0]["rid"])})
    return out


def relation(r, members):
    if any(id_diff(m, r) for m in members):
        return "different: identity differs"
    if r["readm"]:
        return "same: flagged readmission"

    def both(m, fs):
        return sum(m[f] is not None and r[f] is not None for f in fs)

    if all(m["facility"] != r["facility"] for m in members) and any(both(m, ("sex", "bw", "ga")) >= 2 for m in members):
        return "same: same UID at another site"

    def other(m):
        return any(m[f] is not None and r[f] is not None and (abs(m[f] - r[f]) > tol if tol is not None else m[f] != r[f])
                   for f, tol in (("apgar5", 0), ("mode", None), ("birthf", None), ("matage", 1)))

    if any(other(m) for m in members):
        return "different: other fields differ"
    if any(both(m, ("apgar5", "mode", "birthf", "matage")) for m in members):
        return "same: other fields agree"
    return "unresolved"


def place(r, pool):
    if not pool:
        return 1, "first record under this UID", False
    ks = sorted({m["k"] for m in pool})
    rel = {k: relation(r, [m for m in pool if m["k"] == k]) for k in ks}
    same = [k for k in ks if rel[k].startswith("same")]
    if same:
        return same[0], rel[same[0]].replace("same: ", "same baby: "), True
    basis = ("unresolved: own letter" if "unresolved" in rel.values()
             else "different baby: other fields differ" if "different: other fields differ" in rel.values()
             else "different baby: identity differs")
    return ks[-1] + 1, basis, False


def entities(records):
    by_uid = {}
    for r in records:
        r["event"] = r["t_adm"] or r["t_start"]
        by_uid.setdefault(r["uid"], []).append(r)
    for rs in by_uid.values():
        rs.sort(key=lambda r: (r["event"] or datetime.max, r["facility"], r["first"]))
        pool = []
        for r in rs:
            k, basis, _ = place(r, pool)
            r["k"], r["basis"] = k, basis if len(rs) > 1 else "only record under this UID"
            r["stay"] = 1 + sum(m["k"] == k for m in pool)
            pool.append(r)
    return records


def link(dis, adm):
    far = timedelta(days=10**6)
    for d in dis:
        cands = []
        for a in adm:
            if (a["uid"], a["facility"]) != (d["uid"], d["facility"]) or id_diff(a, d) >= 2:
                continue
            gap = abs(d["t_adm"] - a["t_adm"]) if d["t_adm"] and a["t_adm"] else None
            conf = gap is not None and (gap <= HOUR or abs(gap - 2 * HOUR) <= 0.02 * HOUR)
            n = id_diff(a, d)
            doubt = n == 1 or (d["t_dis"] and a["t_adm"] and d["t_dis"] - a["t_adm"] < -24 * HOUR) or (
                gap is not None and gap > 24 * HOUR)
            cands.append(((n, gap if gap is not None else far, a["t_adm"] or datetime.max, a["k"], a["stay"]), conf, not doubt, n))
        d["k"] = None
        for tier, text in ((1, "matched: admission date-time on the discharge form"), (2, "matched: only admission that fits"),
                           (0, "matched with a doubt")):
            hits = [x for x in cands if tier == 0 or x[tier]]
            if hits:
                best = min(hits)
                ties = sum(x[3] == best[3] for x in hits)
                d["basis"] = text if ties == 1 else "ambiguous: closest admission used (earlier on a tie)"
                d["k"], d["stay"] = best[0][3], best[0][4]
                break
    loose = sorted((d for d in dis if d["k"] is None),
                   key=lambda d: (d["uid"], d["t_dis"] or d["t_start"] or datetime.max, d["facility"], d["first"]))
    pools = {}
    for a in adm:
        pools.setdefault(a["uid"], []).append(a)
    here = {(a["uid"], a["facility"]) for a in adm}
    for d in loose:
        pool = pools.setdefault(d["uid"], [])
        k, _, joined = place({**d, "readm": False}, pool)
        joined = joined and any(m["k"] == k for m in pool)
        d["stay"] = 1 + max((m["stay"] for m in pool if m["k"] == k), default=0)
        d["k"] = k
        d["basis"] = ("discharge only: fits a baby already under this UID" if joined
                      else "discharge only: does not fit the admissions under this UID"
                      if (d["uid"], d["facility"]) in here else "discharge only: no admission under this UID at this site")
        pool.append(d)
    return dis


@pytest.fixture(scope="module", params=[(1, 40, 3000), (2, 6, 1500)])
def data(request):
    seed, keys, minutes = request.param
    return make_rows(seed, 250, keys, minutes), make_rows(seed + 50, 120, keys + 1, minutes)


def frame(spark, rows, role):
    return ep.comparison_frame(spark.createDataFrame(rows, SCHEMA), role)


@pytest.mark.parametrize("chunk_rows", [100_000, 7])
def test_records(spark, data, chunk_rows):
    for rows, role, clock in ((data[0], "admissions", "admission"), (data[1], "discharges", "form")):
        want = {r["rec"]: (r["n_rows"], r["no_id"], r["sex"], r["bw"], r["ga"], r["readm"], r["apgar5"], r["mode"], r["outcome"])
                for r in collapse(rows, clock)}
        got = {r["rec"]: (r["n_rows"], r["no_id_ev"], r["sex"], r["bw"], r["ga"], r["readm"], r["apgar5"], r["mode"], r["outcome"])
               for r in ep.collapse_records(frame(spark, rows, role), clock, chunk_rows).collect()}
        assert got == want


@pytest.mark.parametrize("chunk_rows,pair_limit", [(100_000, 64), (9, 0)])
def test_entities_and_links(spark, data, chunk_rows, pair_limit):
    adm = entities(collapse(data[0], "admission"))
    records = ep.collapse_records(frame(spark, data[0], "admissions"), "admission")
    a = ep.assign_entities(records, chunk_rows).cache()
    got = {r["rec"]: (r["letter_k"], r["stay"], r["basis"]) for r in a.collect()}
    assert got == {r["rec"]: (r["k"], r["stay"], r["basis"]) for r in adm}

    dis = link(collapse(data[1], "form"), adm)
    d_records = ep.collapse_records(frame(spark, data[1], "discharges"), "form")
    linked = ep.link_discharges(d_records, a, chunk_rows, pair_limit, block_rows=5)
    got = {r["rec"]: (r["letter_k"], r["stay"], r["link_basis"]) for r in linked.collect()}
    assert got == {r["rec"]: (r["k"], r["stay"], r["basis"]) for r in dis}


def test_a_key_with_a_third_of_all_rows(spark):
    """One pass over many partitions, chunks, and the fold in plain order agree."""
    from pyspark.sql import functions as F

    from sluice.operators.folds import EntityFold

    n = 6000
    i = F.col("id")
    hour = 3_600_000_000
    records = (spark.range(0, n, 1, 7).select(
        i.alias("rec"), F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("U"), (i % 700).cast("string"))).alias("uid"),
        F.when(i % 5 == 0, "H2").otherwise("H1").alias("facility"), (F.pmod(i * 7919, F.lit(n)) * hour).alias("t_adm"),
        F.lit(None).cast("bigint").alias("t_start"), F.when(i % 4 > 0, F.when(i % 2 == 0, "M").otherwise("F")).alias("sex"),
        F.when(i % 7 > 0, (2000 + (i % 40) * 40).cast("double")).alias("bw"), (36 + i % 5).cast("double").alias("ga"),
        (i % 11 == 0).alias("readm"), F.when(i % 6 == 0, (i % 4).cast("double")).alias("apgar5"),
        F.lit(None).cast("string").alias("mode"), F.lit(None).cast("string").alias("birthf"),
        F.lit(None).cast("double").alias("matage"), F.struct(F.lit(0).cast("bigint").alias("t"), F.lit(0).alias("m"), i.alias("r")).alias("place")))
    rows = sorted(records.collect(), key=lambda r: (r["uid"], r["t_adm"], r["facility"], r["rec"]))
    want, current, fold = {}, None, None
    for r in rows:
        if r["uid"] != current:
            current, fold = r["uid"], EntityFold()
        got = fold.step([r["rec"], False, *[r[f] for f in EntityFold.columns[2:11]], None, None])
        want[got[0]] = tuple(got[1:3])
    for chunk_rows in (100_000, 300):
        out = ep.assign_entities(records, chunk_rows).collect()
        assert {r["rec"]: (r["letter_k"], r["stay"]) for r in out} == want


def test_entity_index_equals_a_look_at_every_kind():
    """Random records of one id; each is placed as by a comparison with all kinds there are."""
    from sluice.operators.folds import EntityFold

    class Plain(EntityFold):
        def _candidates(self, r):
            return sorted(((self._first(kind), kind) for kind in self.kinds), key=lambda x: x[0])

    for seed in range(12):
        rnd = random.Random(seed)

        def maybe(x):
            return None if rnd.random() < 0.15 else x

        indexed, plain = EntityFold(), Plain()
        for i in range(400):
            row = (i, False, rnd.choice(["H1", "H2"]), maybe(rnd.choice("MF")), maybe(float(rnd.randrange(1000, 2200, 30))),
                   maybe(float(rnd.randrange(30, 42))), rnd.random() < 0.05, maybe(float(rnd.randrange(4))), maybe(rnd.choice(["SVD", "CS"])),
                   None, maybe(float(rnd.randrange(18, 30))), None, None)
            assert indexed.step(row) == plain.step(row)
            if i == 200:  # the index is made again from a stored state
                indexed, plain = EntityFold(indexed.state()), Plain(plain.state())
        assert indexed.state() == plain.state()


def test_index_leaves_few_comparisons():
    """Comparisons, not seconds: of the pairs of a record and a kind before it, under one in a hundred is compared.  They
    still grow with the kinds of one weight and gestation band."""
    from sluice.operators.folds import EntityFold

    def comparisons(n):
        rnd, seen = random.Random(1), 0

        class Counting(EntityFold):
            def _relation(self, r, e):
                nonlocal seen
                seen += 1
                return super()._relation(r, e)

        fold = Counting()
        for i in range(n):
            fold.step((i, False, "H1", rnd.choice("MF"), float(rnd.randrange(300, 7001)), float(rnd.randrange(20, 47)), False,
                       float(rnd.randrange(11)), rnd.choice(["SVD", "CS"]), None, float(rnd.randrange(15, 45)), None, None))
        return seen

    assert comparisons(8000) < 8000 * 8000 / 2 / 100


def test_only_changed_chunks_run_again(spark, monkeypatch):
    """Chunks whose true start state was known from the first round on run once."""
    from pyspark.sql import functions as F

    from sluice.operators import folds

    fed = []
    true = folds.together

    def counting(df, keys):
        if "_chunk" in keys:
            fed.append(df.filter("_state IS NULL").select(*keys).distinct().count())
        return true(df, keys)

    monkeypatch.setattr(folds, "together", counting)
    # Births far apart: the set of identities is complete after the first chunk, but the number of births goes through all.
    rows = [(f"u{u}", i, i * 10**12, None, None, None, None, None) for u in range(2) for i in range(120)]
    df = spark.createDataFrame(rows, "uid string, rec bigint, t_event bigint, sex string, bw double, ga double, oc string, ord string")
    out = folds.ordered_fold(df, ["uid"], F.col("t_event") / 10**12, [F.col("t_event")], folds.BirthFold,
                             "rec bigint, letter_k bigint, basis string", chunk_rows=20)
    got = sorted((r.rec, r.letter_k) for r in out.collect())
    assert got == sorted((i, i + 1) for u in range(2) for i in range(120))
    assert fed[0] == 12 and fed == sorted(fed, reverse=True) and fed[-1] < fed[0]


def test_unchanged_summary_stays_in_place():
    """A record that adds nothing to its entity's summary leaves the index as it is."""
    from sluice.operators.folds import EntityFold

    put = []

    class Counting(EntityFold):
        def _put(self, *x):
            put.append(x)
            super()._put(*x)

    fold = Counting()
    got = [fold.step((i, False, "H1", "M", 2000.0, 38.0, False, 8.0, "SVD", None, None, None, None)) for i in range(50)]
    assert [(r[1], r[2]) for r in got] == [(1, i + 1) for i in range(50)] and len(put) == 1
    assert fold.state()["entities"][0][:2] == [1, 50] and EntityFold(fold.state()).step(
        (50, False, "H1", "M", 2000.0, 38.0, False, 8.0, "SVD", None, None, None, None))[1:3] == (1, 51)
