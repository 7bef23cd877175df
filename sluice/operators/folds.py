"""Order-dependent decisions: small state machines fed in sorted order.

Some rules depend on what was decided for earlier rows of the same key.  Spark
partitions and sorts the rows; a fold walks them batch by batch and keeps only
its state in memory.  A key too large for one task is cut into chunks along its
order.  Chunks run in parallel from a guessed start state; those whose true start
state, the end state of the chunk before, turns out different run again, until no start state changes; the first chunk is
right after one round, so the outcome equals one sequential pass.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import cut_lineage, ship

CHUNK_ROWS = 100_000
HOUR = 3_600_000_000  # microseconds
WEIGHT_TOLERANCE = 100
WEEKS_TOLERANCE = 1
_SEVERAL = [x.bit_count() >= 2 for x in range(8)]


def _clean(values: pd.Series) -> list:
    """Plain values or None (Arrow hands nulls over as NaN or None)."""
    return values.tolist() if values.dtype.kind in "ib" else [None if v != v else v for v in values.tolist()]


def _differs(a, b, tolerance=None) -> bool:
    if a is None or b is None:
        return False
    return abs(a - b) > tolerance if tolerance is not None else a != b


class CollapseFold:
    """Greedy complete-link grouping of the rows of one (uid, facility).

    A row joins the first group all of whose members it is compatible with:
    clocks within an hour, no identity field disagreeing, same readmission flag.
    Clocks compare on ``p``, or on ``q`` where either ``p`` is missing."""

    columns = ("fid", "clock", "p", "q", "sex", "bw", "ga", "oc", "ord", "readm")
    out = ("fid", "cluster")

    def __init__(self, state: list | None = None):
        self.open: dict[int, list] = {}              # group number -> [cluster id, [member, ...]]
        self.near: dict[tuple, set[int]] = {}        # (clock, hour) -> groups with a member there
        self.n, self.steps, self.clock = 0, 0, None
        for cluster, members in state or []:
            self.n += 1
            self.open[self.n] = [cluster, []]
            for m in members:
                self._add(self.n, m)

    def state(self) -> list:
        self._close()
        return [g for _, g in sorted(self.open.items())]

    def _add(self, number: int, member) -> None:
        p, q = member[0], member[1]
        self.open[number][1].append(member)
        for name, t in (("p", p), ("q", q), ("q only", q if p is None else None)):
            if t is not None:
                self.near.setdefault((name, t // HOUR), set()).add(number)

    def _close(self) -> None:
        """Forget the groups no later row can join."""
        if self.clock is not None:
            self.open = {i: g for i, g in self.open.items() if not self._closed(g[1], self.clock)}
            self.near = {k: left for k, v in self.near.items() if (left := {i for i in v if i in self.open})}

    def _candidates(self, member) -> list[int]:
        """Groups with a member within reach, oldest first."""
        p, q = member[0], member[1]
        places = []
        if p is not None:
            places += [("p", p // HOUR + i) for i in (-1, 0, 1)]
        if q is not None:
            places += [("q only" if p is not None else "q", q // HOUR + i) for i in (-1, 0, 1)]
        near = [self.near[k] for k in places if k in self.near]
        return sorted(near[0].union(*near[1:])) if near else []

    @staticmethod
    def compatible(a, b) -> bool:
        pa, qa, *ida, ra = a
        pb, qb, *idb, rb = b
        if pa is not None and pb is not None:
            gap = abs(pa - pb)
        elif qa is not None and qb is not None:
            gap = abs(qa - qb)
        else:
            return False
        return (gap <= HOUR and ra == rb and not _differs(ida[0], idb[0])
                and not _differs(ida[1], idb[1], WEIGHT_TOLERANCE)
                and not _differs(ida[2], idb[2], WEEKS_TOLERANCE)
                and not _differs(ida[3], idb[3]) and not _differs(ida[4], idb[4]))

    def _closed(self, members, clock) -> bool:
        """No row at or after ``clock`` can still join."""
        limit = clock - HOUR
        return (any(m[0] is not None and m[0] < limit for m in members)
                and any(m[1] is None or m[1] < limit for m in members))

    def step(self, row):
        fid, self.clock, *member = row
        self.steps += 1
        if self.steps % 1024 == 0:
            self._close()
        for number in self._candidates(member):
            cluster, members = self.open[number]
            if all(self.compatible(m, member) for m in members):
                self._add(number, member)
                return fid, cluster
        self.n += 1
        self.open[self.n] = [fid, []]
        self._add(self.n, member)
        return fid, fid


class EntityFold:
    """Entity number and stay of each record of one uid, in date order.

    Entities are kept as summaries (value ranges and value sets of their
    members), grouped by equal summary, so a record is compared with each kind
    of entity once.  Kinds are found through an index over sexes, weight band and
    gestation band: a kind elsewhere differs in identity and decides nothing.
    A record takes the earliest entity it belongs to, so kinds are looked at by their
    earliest entity and no further than to the first one that fits.  ``seed`` rows carry known entities (admissions) that later
    records are placed among."""

    columns = ("rec", "seed", "facility", "sex", "bw", "ga", "readm", "apgar5", "mode", "birthf",
               "matage", "letter_k", "stay")
    out = ("rec", "letter_k", "stay", "basis", "joined")

    def __init__(self, state: dict | None = None):
        self.stays: dict[int, int] = {}
        self.kind_of: dict[int, tuple] = {}
        self.kinds: dict[tuple, list[int]] = {}     # kind -> heap of entity numbers
        self.live: dict[tuple, int] = {}             # kind -> entities of that kind
        self.sexes: dict[tuple, dict] = {}           # sexes -> weight band -> gestation band -> kinds
        self.top = 0
        for k, stay, *kind in (state or {"entities": []})["entities"]:
            self._put(k, stay, tuple(tuple(x) if isinstance(x, list) else x for x in kind))

    def state(self) -> dict:
        return {"entities": [[k, self.stays[k], *self.kind_of[k]] for k in sorted(self.stays)]}

    def _put(self, k: int, stay: int, kind: tuple) -> None:
        self.stays[k], self.kind_of[k], self.top = stay, kind, max(self.top, k)
        self.live[kind] = self.live.get(kind, 0) + 1
        if kind not in self.kinds:
            sexes, bw, ga = self._cell(kind)
            self.sexes.setdefault(sexes, {}).setdefault(bw, {}).setdefault(ga, {})[kind] = None
        heapq.heappush(self.kinds.setdefault(kind, []), k)

    def _drop(self, k: int) -> None:
        """Entity ``k`` leaves its kind; its heap entry goes when it surfaces."""
        kind = self.kind_of.pop(k)
        self.live[kind] -= 1
        if not self.live[kind]:
            sexes, bw, ga = self._cell(kind)
            bands = self.sexes[sexes]
            del self.live[kind], self.kinds[kind], bands[bw][ga][kind]
            if not bands[bw][ga]:
                del bands[bw][ga]
            if not bands[bw]:
                del bands[bw]

    @staticmethod
    def _cell(kind: tuple) -> tuple:
        """Place of a kind in the index: its sexes and the bands of its least weight and gestation."""
        sexes, bw, ga = kind[:3]
        return sexes, None if bw is None else bw[0] // WEIGHT_TOLERANCE, None if ga is None else ga[0] // WEEKS_TOLERANCE

    @staticmethod
    def _near(bands: dict, x, tolerance) -> list:
        """Bands whose ranges may lie within ``tolerance`` of x: a fitting range begins at most that far from it."""
        if x is None:
            return list(bands)
        low, high = (x - tolerance) // tolerance, (x + tolerance) // tolerance
        if high - low + 2 < len(bands):
            return [b for b in (None, *range(int(low), int(high) + 1)) if b in bands]
        return [b for b in bands if b is None or low <= b <= high]

    def _candidates(self, r) -> list[tuple]:
        """Kinds whose identity may agree with the record's, as (earliest entity, kind) by that entity."""
        sex, bw, ga = r[3:6]
        kinds, kind_of, found = self.kinds, self.kind_of, []
        for sexes, weights in self.sexes.items():
            if sex is not None and sexes and (len(sexes) > 1 or sexes[0] != sex):
                continue
            for weeks in [weights[x] for x in self._near(weights, bw, WEIGHT_TOLERANCE)]:
                for x in self._near(weeks, ga, WEEKS_TOLERANCE):
                    for kind in weeks[x]:
                        first = kinds[kind][0]
                        found.append((first if kind_of.get(first) is kind else self._first(kind), kind))
        found.sort(key=itemgetter(0))
        return found

    def _first(self, kind: tuple) -> int:
        heap = self.kinds[kind]
        while self.kind_of.get(heap[0]) != kind:
            heapq.heappop(heap)
        return heap[0]

    @staticmethod
    def _masks(row) -> tuple[int, int]:
        """Which identity fields and which other fields the record has."""
        _, _, _, sex, bw, ga, _, apgar5, mode, birthf, matage, *_ = row
        return ((sex is not None) + 2 * (bw is not None) + 4 * (ga is not None),
                (apgar5 is not None) + 2 * (mode is not None) + 4 * (birthf is not None) + 8 * (matage is not None))

    @staticmethod
    def _relation(r, e) -> str:
        """How a record (its columns and masks) stands to a kind of entity."""
        _, _, facility, sex, bw, ga, readm, apgar5, mode, birthf, matage, _, _, mine, others = r
        sexes, bws, gas, masks, apgars, modes, births, ages, other, sites = e
        if (sex is not None and sexes and (len(sexes) > 1 or sexes[0] != sex)
                or bw is not None and bws is not None and (bw - bws[0] > WEIGHT_TOLERANCE or bws[1] - bw > WEIGHT_TOLERANCE)
                or ga is not None and gas is not None and (ga - gas[0] > WEEKS_TOLERANCE or gas[1] - ga > WEEKS_TOLERANCE)):
            return "different: identity differs"
        if readm:
            return "same: flagged readmission"
        if facility not in sites and any([_SEVERAL[m & mine] for m in masks]):
            return "same: same UID at another site"
        if (apgar5 is not None and apgars is not None and (apgar5 > apgars[0] or apgars[1] > apgar5)
                or matage is not None and ages is not None and (matage - ages[0] > 1 or ages[1] - matage > 1)
                or mode is not None and modes and (len(modes) > 1 or modes[0] != mode)
                or birthf is not None and births and (len(births) > 1 or births[0] != birthf)):
            return "different: other fields differ"
        return "same: other fields agree" if other & others else "unresolved"

    def _add(self, k: int, row, stay: int) -> None:
        def add(values, x):
            return values if x is None or x in values else tuple(sorted((*values, x)))

        def widen(span, x):
            return (span if x is None or span is not None and span[0] <= x <= span[1]
                    else (x, x) if span is None else (min(span[0], x), max(span[1], x)))

        _, _, facility, sex, bw, ga, _, apgar5, mode, birthf, matage, _, _ = row
        mine, others = self._masks(row)
        kind = self.kind_of.get(k)
        sexes, bws, gas, masks, apgars, modes, births, ages, other, sites = kind or ((), None, None, (), None, (), (), None, 0, ())
        new = (add(sexes, sex), widen(bws, bw), widen(gas, ga), add(masks, mine), widen(apgars, apgar5), add(modes, mode),
               add(births, birthf), widen(ages, matage), other | others, add(sites, facility))
        if new == kind:
            self.stays[k] = max(self.stays[k], stay)
            return
        if kind is not None:
            self._drop(k)
        self._put(k, max(self.stays.get(k, 0), stay), new)

    def step(self, row):
        rec, seed, letter_k, stay = row[0], row[1], row[11], row[12]
        if seed:
            self._add(int(letter_k), row, int(stay))
            return None
        if not self.stays:
            k, basis, joined = 1, "first record under this UID", False
        else:
            r = (*row, *self._masks(row))
            same: tuple[int, str] | None = None
            unresolved = other_differs = False
            for first, kind in self._candidates(r):
                rel = self._relation(r, kind)
                if rel[0] == "s":
                    same = (first, rel)
                    break
                unresolved |= rel == "unresolved"
                other_differs |= rel == "different: other fields differ"
            if same is not None:
                k, basis, joined = same[0], same[1].replace("same: ", "same baby: ", 1), True
            else:
                k, joined = self.top + 1, False
                basis = ("unresolved: own letter" if unresolved
                         else "different baby: other fields differ" if other_differs
                         else "different baby: identity differs")
        stay = self.stays[k] + 1 if joined else 1
        self._add(k, row, stay)
        return rec, k, stay, basis, joined


class BirthFold:
    """Births of one uid in date order: every record is an entity of its own;
    the basis tells whether an earlier record could be the same child."""

    columns = ("rec", "t_event", "sex", "bw", "ga", "oc", "ord")
    out = ("rec", "letter_k", "basis")

    def __init__(self, state: dict | None = None):
        state = state or {"n": 0, "seen": [], "day": []}
        self.n, self.day = state["n"], state["day"]
        self.seen = {tuple(x) for x in state["seen"]}

    def state(self) -> dict:
        return {"n": self.n, "day": self.day,
                "seen": sorted((list(x) for x in self.seen), key=json.dumps)}

    @staticmethod
    def differ(a, b) -> bool:
        return (_differs(a[0], b[0]) or _differs(a[1], b[1], WEIGHT_TOLERANCE)
                or _differs(a[2], b[2], WEEKS_TOLERANCE) or _differs(a[3], b[3])
                or _differs(a[4], b[4]))

    def step(self, row):
        rec, t, *identity = row
        self.day = [] if t is None else [x for x in self.day if t - x[0] <= 24 * HOUR]
        if self.n == 0:
            basis = "first record under this UID"
        elif self.day:
            basis = ("different baby: same day, baby details differ"
                     if all(self.differ(x[1], identity) for x in self.day)
                     else "unresolved: same day, nothing differs")
        else:
            basis = ("different baby: another day"
                     if all(self.differ(x, identity) for x in self.seen)
                     else "unresolved: another day, nothing differs")
        self.n += 1
        self.seen.add(tuple(identity))
        if t is not None:
            self.day.append([t, identity])
        return rec, self.n, basis


def _walk(fold: type, keys: Sequence[str], chunked: bool) -> Callable:
    """mapInPandas function that runs one fold per key over sorted batches."""
    group = [*keys, "_chunk"] if chunked else list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, machine = None, None

        def end_state():
            return (*[None] * len(fold.out), *current, json.dumps(machine.state()))

        for batch in batches:
            rows = []
            key_cols = list(zip(*[batch[k].tolist() for k in group]))
            states = _clean(batch["_state"]) if chunked else None
            for i, values in enumerate(zip(*[_clean(batch[n]) for n in fold.columns])):
                if key_cols[i] != current:
                    if chunked and current is not None:
                        rows.append(end_state())
                    current, machine = key_cols[i], fold()
                if chunked and states[i] is not None:
                    machine = fold(json.loads(states[i]))
                    continue
                got = machine.step(values)
                if got is not None:
                    rows.append((*got, *current, None) if chunked else got)
            columns = [*fold.out, *group, "_state"] if chunked else list(fold.out)
            yield pd.DataFrame(rows, columns=columns, dtype=object)
        if chunked and current is not None:
            yield pd.DataFrame([end_state()], columns=[*fold.out, *group, "_state"], dtype=object)

    return run


def fold_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column], fold: type,
                schema: str) -> DataFrame:
    """One sequential pass per key; rows of a key arrive in ``order``."""
    return (df.select(*keys, *[n for n in fold.columns if n not in keys], *_order_columns(order))
            .transform(together, keys).sortWithinPartitions(*keys, *_order_names(order))
            .mapInPandas(_walk(fold, keys, False), schema))


def together(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of a key in one partition, for a function over whole partitions.

    The rows are placed by a hash computed here, not by the keys themselves: a
    join on the same keys underneath would make Spark drop the exchange, and
    adaptive execution may later spread that join's rows again.  A stated number
    of partitions keeps few bytes with much Python work from being packed into
    few tasks."""
    ship(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*keys))


def _order_columns(order: Sequence[Column]) -> list[Column]:
    return [x.alias(f"_o{i}") for i, x in enumerate(order)]


def _order_names(order: Sequence[Column]) -> list[Column]:
    return [F.col(f"_o{i}").asc_nulls_last() for i in range(len(order))]


def fold_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], fold: type,
                schema: str) -> DataFrame:
    """Like ``fold_groups`` for keys cut into ``_chunk`` 1, 2, 3, ... without gaps."""
    group = [*keys, "_chunk"]
    rows = cut_lineage(df.select(*group, *[n for n in fold.columns if n not in keys],
                                 *_order_columns(order))
                       .withColumn("_state", F.lit(None).cast("string")))
    types = dict(df.select(*group).dtypes)
    out_schema = ", ".join([schema, *[f"{k} {types[k]}" for k in group], "_state string"])
    chunks = rows.select(*group).distinct()
    feed, done, states = rows, None, None
    while True:
        out = cut_lineage(feed.transform(together, group)
                          .sortWithinPartitions(*group, F.col("_state").asc_nulls_last(),
                                                *_order_names(order))
                          .mapInPandas(_walk(fold, keys, True), out_schema))
        # Chunks that did not run again keep what they gave before.
        again = out.select(*group).distinct()
        found = out.filter("_state IS NULL")
        done = found if done is None else done.join(again, group, "left_anti").unionByName(found)
        ends = (out.filter("_state IS NOT NULL")
                .select(*keys, (F.col("_chunk") + 1).cast(types["_chunk"]).alias("_chunk"), "_state")
                .join(chunks, group, "left_semi"))
        changed = ends
        if states is not None:
            changed = ends.join(states.select(*group, F.col("_state").alias("_old")), group, "left").filter(
                ~F.col("_state").eqNullSafe(F.col("_old"))).drop("_old")
        changed = cut_lineage(changed)
        if changed.isEmpty():
            return done.select(*fold.out)
        states = cut_lineage(changed if states is None else states.join(changed.select(*group), group, "left_anti").unionByName(changed))
        feed = rows.join(changed.select(*group), group, "left_semi").unionByName(changed, allowMissingColumns=True)


def cut_keys(df: DataFrame, keys: Sequence[str], bucket: Column, chunk_rows: int = CHUNK_ROWS,
             sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of large keys with ``_chunk``).  Chunks follow
    ``bucket``, a coarse non-decreasing function of the fold order; sizes come
    from counts per (key, bucket), never from the rows of a key in one place.
    ``sizes`` are row counts per key where they are known already."""
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)))
    large = sizes.toDF(*keys, "_n").filter(F.col("_n") > chunk_rows).select(*keys)
    if large.isEmpty():
        return df, None
    large = cut_lineage(large)
    b = F.coalesce(bucket.cast("bigint"), F.lit(2**62)).alias("_bucket")
    hot = df.join(large, list(keys), "left_semi").withColumn("_bucket", b)
    w = Window.partitionBy(*keys).orderBy("_bucket")
    chunks = (hot.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_part", F.floor((F.sum("_n").over(w) - F.col("_n")) / chunk_rows))
              .withColumn("_chunk", F.dense_rank().over(Window.partitionBy(*keys).orderBy("_part")))
              .select(*keys, "_bucket", "_chunk"))
    return (df.join(large, list(keys), "left_anti"),
            hot.join(chunks, [*keys, "_bucket"]).drop("_bucket"))


def ordered_fold(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column],
                 fold: type, schema: str, chunk_rows: int = CHUNK_ROWS,
                 sizes: DataFrame | None = None) -> DataFrame:
    """Fold over all keys, large ones in chunks."""
    plain, hot = cut_keys(df, keys, bucket, chunk_rows, sizes)
    out = fold_groups(plain, keys, order, fold, schema)
    return out if hot is None else out.unionByName(fold_chunks(hot, keys, order, fold, schema))
