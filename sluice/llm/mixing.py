"""Mixing sources to target word counts by subset-sum budget fitting.

Size of a document: its words (runs of anything but ASCII white space); null and empty texts
have size 0.  Sources in code-point order, null last, get the weights in turn and share
``share`` of all words; a target stops at ``most`` times its source's words and the rest
goes to the others by weight.  A source's target is met by whole passes over it and, for
the remaining budget, by a subset: every length is taken in proportion first, then a
bounded knapsack over (length, documents left) closes the remainder to the word.  Which
documents of a length are taken is decided by a seeded hash of doc_id, so reruns agree; rows
that share doc_id, source and size share their hash and are taken or left together.  An empty
table gives an empty result; sources without words have target 0."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch
from sluice.llm.texts import WORD
from sluice.session import ship

WEIGHTS = (5, 2, 1)


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size) to (sid, source, source_size, target).  One row per source:
    sources are sorted by the level at which they are full, and the level that spends the budget
    is the first one below a source's own."""
    every = Window.partitionBy()
    cycle = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    by_level = Window.orderBy("full_at", "sid")
    ranked = (sources.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("w", cycle.cast("double"))
              .withColumn("cap", F.col("source_size").cast("double") * most)
              .withColumn("full_at", F.col("cap") / F.col("w"))
              .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
              .withColumn("spent", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("open", F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("level", (F.col("budget") - F.col("spent")) / F.col("open"))
              .withColumn("is_open", F.col("full_at") > F.col("level"))
              .withColumn("water", F.min_by("level", F.when(F.col("is_open"), F.struct("full_at", "sid"))).over(every)))
    return ranked.select("sid", "source", "source_size", F.least(
        "cap", F.coalesce(F.col("water"), F.lit(float("inf"))) * F.col("w")).alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size add up to ``budget`` words or come closest below."""
    total = int(np.dot(sizes, counts))
    take = np.array([int(n) * budget // total if total else 0 for n in counts], dtype=np.int64)
    left = budget - int(np.dot(sizes, take))
    window = int(max(1000, 2 * sizes.max(initial=0)))
    order = np.argsort(-sizes)
    for i in order:
        if left <= window:
            break
        if sizes[i]:
            n = min(int(counts[i] - take[i]), max(0, (left - window) // int(sizes[i])))
            take[i] += n
            left -= n * int(sizes[i])
    return take + _knapsack(sizes, counts - take, left)


def _knapsack(sizes: np.ndarray, spare: np.ndarray, left: int) -> np.ndarray:
    """Bounded knapsack over reachable sums; counts are split into powers of two, and
    each sum remembers the piece that reached it first."""
    more = np.zeros(len(sizes), np.int64)
    if left <= 0:
        return more
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    by = np.full(left + 1, -1, np.int32)
    pieces: list[tuple[int, int]] = []
    for i in np.argsort(-sizes):
        n, size = int(spare[i]), int(sizes[i])
        n = min(n, left // size) if size else 0
        part = 1
        while n > 0 and not reached[left]:
            part = min(part, n)
            weight = part * size
            new = reached[:left + 1 - weight] & ~reached[weight:]
            by[weight:][new] = len(pieces)
            reached[weight:] |= new
            pieces.append((int(i), part))
            n, part = n - part, part * 2
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, part = pieces[by[at]]
        more[i] += part
        at -= part * int(sizes[i])
    return more


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    take = fit(rows["size"].to_numpy(), rows["n"].to_numpy(), int(rows["budget"].iloc[0]))
    return pd.DataFrame({"sid": rows["sid"].to_numpy(), "size": rows["size"].to_numpy(), "n": rows["n"].to_numpy(),
                         "passes": rows["passes"].to_numpy(), "take": take})


def plan(docs: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sources, cells): rows are (doc_id, size, sid, pick); cells say for each (sid, size)
    how often all its documents are taken and up to which ``pick`` once more."""
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                     size_of(F.col("text")).alias("size")), "sizes")
    sources = scratch.keep(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources")
    names = sources.select("sid", F.col("source").alias("s"))
    rows = (sized.join(names, sized.source.eqNullSafe(F.col("s")))
            .select("doc_id", "size", "sid", F.xxhash64(F.lit(seed), "doc_id").alias("pick")))
    lengths = rows.groupBy("sid", "size").agg(F.count("*").alias("n"))
    budgets = sources.select("sid", "source_size", F.expr("CASE WHEN source_size = 0 THEN 0 ELSE least(cast(floor(target / source_size) AS bigint), 2) END").alias("passes"), "target")
    budgets = budgets.select("sid", "passes", F.greatest(F.lit(0), F.round(F.col("target") - F.col("passes") * F.col("source_size"))).cast("long").alias("budget"))
    # One group holds the length histogram of a source, never its documents.
    fitted = scratch.keep(lengths.join(budgets, "sid").groupBy("sid").applyInPandas(
        _fit_source, "sid int, size long, n long, passes long, take long"), "fitted")
    # The pick of the take-th document: counts by leading bits first, then only the bucket where it lies.
    some = fitted.where("take > 0 AND take < n").select("sid", "size", "take")
    picks = rows.join(some, ["sid", "size"]).withColumn("b", F.shiftright("pick", 52))
    upto = Window.partitionBy("sid", "size").orderBy("b")
    edge = (picks.groupBy("sid", "size", "take", "b").agg(F.count("*").alias("m"))
            .withColumn("upto", F.sum("m").over(upto))
            .where("upto >= take AND upto - m < take")
            .select("sid", "size", "b", (F.col("take") - F.col("upto") + F.col("m")).alias("nth")))
    last = (picks.join(edge, ["sid", "size", "b"])
            .withColumn("at", F.row_number().over(Window.partitionBy("sid", "size").orderBy("pick")))
            .where("at = nth").select("sid", "size", F.col("pick").alias("last")))
    cells = fitted.join(last, ["sid", "size"], "left").select(
        "sid", "size", "passes", F.when(F.col("take") > 0, F.coalesce("last", F.lit(2**63 - 1))).alias("last"))
    return rows, sources, scratch.keep(cells, "cells")


def _times() -> Column:
    return F.col("passes") + F.coalesce((F.col("pick") <= F.col("last")).cast("long"), F.lit(0))


def mix(docs: DataFrame, seed: int = 17) -> DataFrame:
    """(doc_id, size, source_size, target, taken, times) for every row of ``docs``."""
    rows, sources, cells = plan(docs, seed)
    return (rows.join(cells, ["sid", "size"]).join(sources.select("sid", "source_size", "target"), "sid")
            .select("doc_id", "size", "source_size", "target", (_times() * F.col("size")).alias("taken"), _times().alias("times")))


def mixture(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mixed documents with the columns of ``docs``: a document taken twice is there
    twice, one that is not taken is gone.  Documents without words stay as they are."""
    _, sources, cells = plan(docs, seed)
    names = sources.select("sid", F.col("source").alias("s"))
    rows = docs.select(F.struct("*").alias("row"), size_of(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")).alias("pick"),
                       F.col("source").cast("string").alias("source"))
    rows = rows.join(names, F.col("source").eqNullSafe(F.col("s"))).join(cells, ["sid", "size"])
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(_times())
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("i")).select("row.*")
