"""Merkle manifest of a dataset, with proofs by nested-interval labels.

Rows become leaves, ordered by (part, key); every ``fan`` neighbours of a part become a node, until one is left, and the same is
done with the parts' tops.  A node carries the interval [lo, hi] of the leaf ranks it covers.  Its parent is the node of the next
level whose interval contains its own, found by a join on part and bucket lo div fan**level with the containment as condition;
within a parent the children left and right of a node's interval are its siblings.  Paths go from the top down, so
the largest join is between the leaves and the nodes above them.

Ranks come from a range sort by (part, key) and from counts per task, so a part with most of the rows is spread like
any other.  Levels are written; only the largest leaf count reaches the driver.

Null fields count as ``-``.  A null key comes first, rows of one key are ordered by their leaf (equal rows are interchangeable: each is a leaf
of its own).  A null part is a part and comes first.  Texts are hashed whole.  An empty table gives an empty result, and
further columns are not read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch

#: Fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
_PART = ["filled", "part"]  # false for the null part, which comes first


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def ranked(rows: DataFrame, part: list[str], order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``lo``, the rank within the part from 0, and ``n``, the rows of the part.  Equal rows are told apart by
    their place in the input, so that even they can be spread."""
    keys = [*part, *order, "_tie"]
    placed = scratch.keep(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
                          .withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.expr("shiftright(_at, 33)")).drop("_tie"), name)
    runs = placed.groupBy(*part, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*part)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*part, "_task", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("n"))
    return (placed.join(runs, [*part, "_task"]).withColumn("lo", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift"))


def levels(leaves: DataFrame, scratch: Scratch, name: str, fan: int = FAN) -> list[DataFrame]:
    """Nodes (filled, part, n, lo, hi, digest, kids) by level; those of level k are the runs of ``fan`` nodes of level k - 1 in parts that had several."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out, width = [leaves.select(*_PART, "n", "lo", F.col("lo").alias("hi"), "digest")], 1
    while most > width:
        runs = (out[-1].where(F.col("n") > width).groupBy(*_PART, "n", F.expr(f"lo div {width * fan}").alias("bucket"))
                .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids")))
        digest = F.unhex(F.sha2(F.array_join(F.transform("kids", lambda x: _hex(x["digest"])), ""), 256))
        out.append(scratch.keep(runs.withColumn("digest", digest), f"{name}{len(out)}"))
        width *= fan
    return out


def attach(tree: list[DataFrame], leaves: DataFrame, tops: DataFrame, scratch: Scratch, name: str, fan: int = FAN) -> DataFrame:
    """``leaves`` with ``path`` (digests left and right of the node, level by level up to the root) and the columns
    of ``tops`` (filled, part, path, ...), which holds them for the one node each part ends in."""
    extra = [c for c in tops.columns if c not in (*_PART, "path")]
    above = None
    for level in range(len(tree) - 1, -1, -1):
        width = fan ** level
        nodes = tree[level] if level else leaves.withColumn("hi", F.col("lo"))
        top = nodes.where(F.col("n") <= width).join(tops, _PART)
        if above is None:
            found = top
        else:
            below = nodes.where(F.col("n") > width).withColumn("_up", F.expr(f"lo div {width * fan}"))
            up = above.select(*_PART, F.col("bucket").alias("_up"), F.col("lo").alias("_from"), F.col("hi").alias("_to"), F.col("kids").alias("_kids"), "path", *extra)
            joined = below.join(up, [*_PART, "_up"]).where("_from <= lo AND hi <= _to")

            def beside(test) -> Column:
                return F.unhex(F.array_join(F.transform(F.filter("_kids", test), lambda x: F.hex(x["digest"])), ""))

            here = F.struct(beside(lambda x: x["hi"] < F.col("lo")).alias("left"), beside(lambda x: x["lo"] > F.col("hi")).alias("right"))
            found = top.unionByName(joined.withColumn("path", F.concat(F.array(here), F.col("path"))).select(top.columns))
        if level == 0:
            return found.drop("hi")
        above = scratch.keep(found, f"{name}-paths{level}")


def proof(path: Column) -> Column:
    """SHA-256 of the siblings' digests, as hex text, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: _hex(F.concat(x["left"], x["right"]))), ""), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, _hex(start), lambda have, x: F.sha2(F.concat(_hex(x["left"]), have, _hex(x["right"])), 256))


def manifest(docs: DataFrame, part: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS,
             changed: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """(key, leaf, subroot, root, path, other) for every row; digests are binary.  ``other`` is the leaf with the columns in
    ``changed`` put in place of the row's own: null where it is the same."""
    scratch = Scratch(docs.sparkSession, "merkle")
    own = leaf([F.col(f) for f in fields])
    other = leaf([(changed or {}).get(f, F.col(f)) for f in fields]) if changed else own
    name = F.col(part).cast("string")
    rows = docs.select(name.isNotNull().alias("filled"), F.coalesce(name, F.lit("")).alias("part"), F.col(key).alias("key"), own.alias("digest"),
                       F.nullif(other, own).alias("other") if changed else F.lit(None).cast("binary").alias("other"))
    leaves = scratch.keep(ranked(rows, _PART, ["key", "digest"], scratch, "rows"), "leaves")
    tree = levels(leaves, scratch, "nodes", fan)
    tops = None
    for level, nodes in enumerate(tree):
        ends = nodes.where((F.col("n") <= fan ** level) & ((F.col("n") > fan ** (level - 1)) if level else F.lit(True))).select(*_PART, "digest")
        tops = ends if tops is None else tops.union(ends)
    # The parts' tops are the leaves of one more tree.
    crowns = ranked(tops.select(F.lit(True).alias("filled"), F.lit("").alias("part"), F.col("filled").alias("f"), F.col("part").alias("p"), "digest"),
                    _PART, ["f", "p"], scratch, "tops")
    crowns = scratch.keep(crowns, "crowns")
    crown = levels(crowns, scratch, "crown", fan)
    root = crown[-1].select(*_PART, F.array().cast("array<struct<left:binary,right:binary>>").alias("path"), F.col("digest").alias("root"))
    reached = attach(crown, crowns, root, scratch, "crown", fan)
    reached = scratch.keep(reached.select(F.col("f").alias("filled"), F.col("p").alias("part"), "path", "root", F.col("digest").alias("subroot")), "reached")
    return attach(tree, leaves, reached, scratch, "nodes", fan).select("key", F.col("digest").alias("leaf"), "subroot", "root", "path", "other")


def verified(docs: DataFrame, changed: dict[str, Column] | None = None, **options) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) as hex text: the proof of every row, and whether its
    leaf, with the columns in ``changed`` put in place, still leads to the root."""
    rows = manifest(docs, changed=changed, **options)
    folded = fold(F.coalesce("other", "leaf"), F.col("path"))
    out = rows.select("key", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
                      proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
