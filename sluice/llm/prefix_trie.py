"""Prefix trie of conversations over minimal-perfect-hash node tables.

Every prefix of a conversation has a digest: the XOR of one 128-bit hash per (position, turn), so that the prefix before it
is known without a look back.  Distinct digests are the nodes; a node's members must agree on a further hash of
their last turn and on the digest of the prefix before it, else everything is hashed again with other seeds.  By
induction nodes are equal exactly where turn contents (by SHA-256) are.

Nodes are spread over shards of whole subtrees.  A shard gives each of its digests a slot by a minimal perfect hash, keeps
the digest there to verify look-ups, scatters counts into flat arrays and adds them up through the array of parent
slots, deepest first.  ``limit`` bounds what a subtree may hold to stay whole: nodes with more turns below
them (counted without collapsing copies) form the trunk, one last table, to which the subtrees' tops bring their sums.  ``limit``
grows with the square root of the turns, and so do the shards; at most turns / limit nodes of a depth are in the trunk.

Conversations are numbered and hashed in chunks of ``CHUNK`` turns, so a conversation with most of the turns is spread.
The list of members that end at a node is hashed from pieces of bounded size by one streaming reader.

Null roles and texts are empty; turns of a conversation with the same turn number are ordered by the SHA-256 of role
and text, null numbers first; equal rows are turns of their own.  Rows without a conversation are left out.  Texts are hashed
whole.  An empty table has no node.  Other columns are not read."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch
from sluice.llm.texts import mixed
from sluice.session import ship

#: Turns of a conversation in one window, and ids of ended members in one piece.
CHUNK = 4096
#: Turns below a node from which on it may belong to the trunk.
LIMIT = 4096


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos, n, digest, points): the turns in order, from 1, with the length of their conversation."""
    role, text = (F.coalesce(F.col(k).cast("string"), F.lit("")) for k in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"), F.char_length(text).cast("long").alias("points"))
    rows = scratch.keep(rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62)))), "turns")
    own = Window.partitionBy("conv_id", "chunk")
    return _shifted(rows, scratch, F.row_number().over(own.orderBy(F.col("turn").asc_nulls_first(), "digest")), F.count("*").over(own)).select(
        "conv_id", "pos", "n", "digest", "points")


def _shifted(rows: DataFrame, scratch: Scratch, place: Column, size: Column) -> DataFrame:
    """``rows`` with ``pos`` and ``n`` from places and sizes within a chunk; only conversations of several chunks are joined."""
    whole = Window.partitionBy("conv_id")
    parts = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("m"))
    parts = (parts.withColumn("total", F.sum("m").over(whole)).withColumn("shift", F.sum("m").over(whole.orderBy("chunk")) - F.col("m"))
             .where("total > m").drop("m"))
    parts = scratch.keep(parts, "parts")
    return (rows.withColumn("place", place).withColumn("size", size).join(parts, ["conv_id", "chunk"], "left")
            .withColumn("pos", (F.col("place") + F.coalesce("shift", F.lit(0))).cast("long")).withColumn("n", F.coalesce("total", "size").cast("long")))


def prefixes(found: DataFrame, scratch: Scratch, seed: int = 0) -> DataFrame:
    """(conv_id, pos, n, x1, x2, y1, y2, mark, points): digests of the prefix that ends with each turn and of the one before
    it, and a further hash of the turn; position 0 is the empty prefix."""
    rows = found.withColumn("chunk", F.floor((F.col("pos") - 1) / CHUNK))
    for i in (1, 2):
        rows = rows.withColumn(f"z{i}", F.xxhash64(F.lit(10 * seed + i), "pos", "digest"))
    partial = rows.where(F.col("n") > CHUNK).groupBy("conv_id", "chunk").agg(F.bit_xor("z1").alias("c1"), F.bit_xor("z2").alias("c2"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = scratch.keep(partial.select("conv_id", "chunk", *(F.bit_xor(f"c{i}").over(before).alias(f"c{i}") for i in (1, 2))).where("c1 IS NOT NULL"), f"carry{seed}")
    upto = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("conv_id", "chunk", "pos", "n", "points", "z1", "z2", F.xxhash64(F.lit(10 * seed + 3), "digest").alias("mark"),
                       *(F.bit_xor(f"z{i}").over(upto).alias(f"w{i}") for i in (1, 2))).join(carry, ["conv_id", "chunk"], "left")
    for i in (1, 2):
        rows = rows.withColumn(f"x{i}", F.col(f"w{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0)))).withColumn(f"y{i}", F.col(f"x{i}").bitwiseXOR(F.col(f"z{i}")))
    return rows.select("conv_id", "pos", "n", "x1", "x2", "y1", "y2", "mark", "points")


class SlotTable:
    """Minimal perfect hash of distinct 128-bit digests.  In each level, digests that alone hit a place keep it; the others go
    on to the next one.  The slot is the number of kept places before; the digest kept there verifies a look-up."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.a, self.b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        left, slots = np.arange(len(a)), 0
        while len(left):
            places = 2 * len(left)
            at = self._place(a[left], b[left], len(self.levels), places)
            alone = np.bincount(at, minlength=places) == 1
            rank = slots + np.cumsum(alone) - 1
            self.levels.append((alone, rank, places))
            kept = alone[at]
            self.a[rank[at[kept]]], self.b[rank[at[kept]]] = a[left[kept]], b[left[kept]]
            slots += int(kept.sum())
            left = left[~kept]

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, places: int) -> np.ndarray:
        turn = mixed(np.array([level + 1], np.uint64))[0]
        return (mixed(a.view(np.uint64) ^ mixed(b.view(np.uint64) + turn)) % np.uint64(places)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of digests; -1 for those that are not in the table."""
        slot, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (alone, rank, places) in enumerate(self.levels):
            at = self._place(a[left], b[left], level, places)
            slot[left[alone[at]]] = rank[at[alone[at]]]
            left = left[~alone[at]]
        found = slot >= 0
        found[found] = (self.a[slot[found]] == a[found]) & (self.b[slot[found]] == b[found])
        return np.where(found, slot, -1)


_NODE = ("depth", "x1", "x2", "y1", "y2", "conv_id", "n_convs", "points")
_SUMS = ("n_children", "n_leaves", "saved")


def _summed(shard: pa.Table) -> pa.Table:
    """Adds up one shard; the sums that come in are those of subtrees that hang below its nodes."""
    col = {c: shard[c].to_numpy() for c in (*_NODE, *_SUMS)}
    table = SlotTable(col["x1"], col["x2"])
    slot = table.find(col["x1"], col["x2"])
    order = np.argsort(slot)
    row = {c: v[order] for c, v in col.items()}  # from here on in the order of the slots
    up = table.find(row["y1"], row["y2"])
    up[(up >= 0) & (row["depth"][up] != row["depth"] - 1)] = -1
    children, leaves, saved = (row[c].copy() for c in _SUMS)
    saved += (row["n_convs"] - 1) * row["points"]
    by_depth = np.argsort(-row["depth"], kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(row["depth"][by_depth])) + 1):
        leaves[level[children[level] == 0]] = 1
        inner = level[up[level] >= 0]
        np.add.at(children, up[inner], 1)
        np.add.at(leaves, up[inner], leaves[inner])
        np.add.at(saved, up[inner], saved[inner])
    row |= {"n_children": children, "n_leaves": leaves, "saved": saved}
    parent = pa.array(row["conv_id"][up], pa.int64(), mask=up < 0)
    return pa.table([*(pa.array(row[c], pa.int64()) for c in (*_NODE, *_SUMS)), parent], [*_NODE, *_SUMS, "parent_conv_id"])


_SUMMED = ", ".join(f"{c} long" for c in (*_NODE, *_SUMS, "parent_conv_id"))


def _hashed(keys: tuple[str, ...]) -> Callable:
    """SHA-256 of each key's pieces, which arrive one after another in order, joined by commas."""
    def run(batches):
        current, digest = None, None
        for batch in batches:
            done = []
            names = list(zip(*(batch[k].to_pylist() for k in keys)))
            for name, ids in zip(names, batch["ids"]):
                if name != current:
                    if current is not None:
                        done.append((*current, digest.hexdigest()))
                    current, digest = name, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield _batch(done, keys)
        if current is not None:
            yield _batch([(*current, digest.hexdigest())], keys)

    return run


def _batch(rows: list[tuple], keys: tuple[str, ...]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * (len(keys) + 1)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], [*keys, "ends_sha256"])


def endings(paths: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of the nodes at which conversations end."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    keys = ("depth", "x1", "x2")
    pieces = (paths.where("pos = n").select(F.col("pos").alias("depth"), "x1", "x2", "conv_id").withColumn("piece", F.floor(F.col("conv_id") / CHUNK))
              .groupBy(*keys, "piece").agg(ids.alias("ids")))
    spread = pieces.repartition(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*keys))
    return spread.sortWithinPartitions(*keys, "piece").mapInArrow(_hashed(keys), "depth long, x1 long, x2 long, ends_sha256 string")


def trie(found: DataFrame, ids: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of the
    conversations with turns ``found`` (conv_id, pos from 1 without gaps, n, digest, points).  ``ids`` (conv_id, n) has every
    conversation once, those without turns too."""
    spark = found.sparkSession
    ship(spark)
    scratch = Scratch(spark, "prefix-trie")
    found = scratch.keep(found.select("conv_id", "pos", "n", "digest", "points"), "found")
    zero = F.lit(0).cast("long")
    for seed in range(8):
        top = ids.select("conv_id", zero.alias("pos"), "n", *(zero.alias(c) for c in ("x1", "x2", "y1", "y2", "mark", "points")))
        paths = scratch.keep(prefixes(found, scratch, seed).unionByName(top), f"paths{seed}")
        nodes = paths.groupBy(F.col("pos").alias("depth"), "x1", "x2").agg(
            F.min("y1").alias("y1"), F.min("y2").alias("y2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("points").alias("points"),
            F.sum(F.col("n") - F.col("pos") + 1).alias("below"),
            ((F.min("mark") != F.max("mark")) | (F.min("y1") != F.max("y1")) | (F.min("y2") != F.max("y2"))).alias("clash"))
        nodes = scratch.keep(nodes, f"nodes{seed}")
        if nodes.where("clash").isEmpty():
            break
    else:
        raise RuntimeError("prefix digests clash with every seed")
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    limit = max(limit, math.isqrt(total))
    shards = max(1, -(-total // limit))

    # The trunk, and for every conversation the subtree its path leaves it by.
    trunk = scratch.keep(nodes.where(F.col("below") > limit).select(*_NODE), "heavy")
    key = ["depth", "x1", "x2"]
    left = paths.select("conv_id", F.col("pos").alias("depth"), "x1", "x2").join(trunk.select(*key), key, "left_anti")
    subtree = left.groupBy("conv_id").agg(F.min_by(F.xxhash64(*key), "depth").alias("subtree"))
    light = (nodes.where(F.col("below") <= limit).select(*_NODE).join(subtree, "conv_id")
             .withColumn("shard", F.pmod("subtree", F.lit(shards))).drop("subtree"))
    light = light.select("shard", *_NODE, *(zero.alias(c) for c in _SUMS))
    light = scratch.keep(light.groupBy("shard").applyInArrow(_summed, _SUMMED), "light")
    above = light.where("parent_conv_id IS NULL AND depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("y1").alias("x1"), F.col("y2").alias("x2")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    trunk = trunk.join(above, key, "left").na.fill(0, list(_SUMS)).select(*_NODE, *_SUMS)
    trunk = scratch.keep(trunk.withColumn("shard", zero).groupBy("shard").applyInArrow(_summed, _SUMMED), "trunk")
    hung = trunk.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("y1"), F.col("x2").alias("y2"), F.col("conv_id").alias("over"))
    light = light.join(hung, ["depth", "y1", "y2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "over")).select(trunk.columns)

    return (light.unionByName(trunk).join(endings(paths), key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def lengths(found: DataFrame) -> DataFrame:
    """(conv_id, n) of conversations that have turns."""
    return found.groupBy("conv_id").agg(F.max("n").alias("n"))


def conversation_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text)."""
    scratch = Scratch(conversations.sparkSession, "turns")
    found = scratch.keep(turns(conversations, scratch), "ordered")
    return trie(found, lengths(found), limit)


def grafted(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of the conversations rebuilt on that of their hundred: conversation c takes the first h turns of
    c - c % 100, h = crc32(c) % 6, and its own turns after its first h."""
    found = scratch.keep(turns(conversations, scratch), "ordered")
    c = F.col("conv_id")
    base, heads = c - c % 100, (F.crc32(c.cast("string")) % 6).cast("long")
    first = found.where((c % 100 == 0) & (F.col("pos") <= 5))
    lead = first.select(c.alias("base"), "pos", "digest", "points")
    bases = first.groupBy(c.alias("base")).agg(F.count("*").alias("have"))
    taken = F.least("h", F.coalesce("have", F.lit(0)))
    ids = lengths(found).withColumn("base", base).withColumn("h", heads).join(bases, "base", "left").select(
        "conv_id", "base", "h", (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    ids = scratch.keep(ids, "ids")
    own = found.withColumn("base", base).withColumn("h", heads).where("pos > h").join(bases, "base", "left").select(
        "conv_id", (F.col("pos") - F.col("h") + taken).alias("pos"), (taken + F.col("n") - F.col("h")).alias("n"), "digest", "points")
    led = ids.join(lead, "base").where("pos <= h").select("conv_id", "pos", "n", "digest", "points")
    return own.unionByName(led), ids.select("conv_id", "n")
