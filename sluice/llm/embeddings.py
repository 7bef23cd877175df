"""Near-duplicate embeddings: random-hyperplane signs in several tables, exact verification, components.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different length never meet.  Two vectors link when their cosine, in double precision, is ``threshold``
or more.  Equal vectors are one point with a count, so copies cost one row.  The number of signs per table
follows the number of points, so that a bucket of unrelated vectors holds a few; the number of tables follows from
the wanted recall at the threshold.  A pair that meets in several tables is counted in the first.
Buckets beyond ``block`` points are cut into blocks, and every pair of blocks is one cell of work; nothing is dropped.
Rows that share a vec_id are vectors of their own; an empty table gives an empty result."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.graph import components
from sluice.llm.scratch import Scratch
from sluice.session import ship


def tables_for(points: int, threshold: float, recall: float, per_bucket: int = 8) -> tuple[int, int]:
    """(signs per table, tables)."""
    signs = max(4, round(math.log2(max(points, 1) / per_bucket)))
    same = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def _signatures(signs: int, tables: int, dtype: str, seed: int):
    def batches(found):
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(signs, dtype=np.int64)
        for batch in found:
            keys = np.empty((len(batch), tables), np.int64)
            dims = np.empty(len(batch), np.int32)
            for i, data in enumerate(batch["vec"]):
                v = np.frombuffer(data.as_buffer(), dtype).astype(np.float64)
                dims[i] = len(v)
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng([seed, len(v)]).standard_normal((len(v), signs * tables))
                keys[i] = ((v @ planes[len(v)]).reshape(tables, signs) >= 0) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["vec"], batch["copies"], pa.array(dims),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * tables, pa.int32()), pa.array(keys.ravel()))],
                ["node", "vec", "copies", "dim", "keys"])

    return batches


def _cells(found, names):
    """Rows of one cell after another out of sorted batches; a cell may span batches."""
    rest = None
    for batch in found:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not len(table):
            continue
        columns = [table[n].to_numpy() for n in names]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *new.tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None and len(rest):
        yield rest


def _verify(threshold: float, dtype: str):
    def unit(column) -> np.ndarray:
        x = np.stack([np.frombuffer(v.as_buffer(), dtype) for v in column]).astype(np.float64)
        x /= np.abs(x).max(1, keepdims=True)  # no overflow in the norm
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def batches(found):
        nodes, links, roots, waiting = [], [], [], 0
        for cell in _cells(found, ["t", "dim", "key", "i", "j"]):
            t, i, j = (cell[n][0].as_py() for n in ("t", "i", "j"))
            part = cell["part"].to_numpy()
            left = np.flatnonzero(part == i)
            right = left if i == j else np.flatnonzero(part == j)
            if not len(left) or not len(right) or (i == j and len(left) < 2):
                continue
            x = unit(cell["vec"])
            node, copies = cell["node"].to_numpy(), cell["copies"].to_numpy()
            keys = np.stack(cell["keys"].to_numpy())
            a, b = np.nonzero(x[left] @ x[right].T >= threshold)
            a, b = left[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            fresh = ~(keys[a, :t] == keys[b, :t]).any(1)
            a, b = a[fresh], b[fresh]
            if not len(a):
                continue
            n = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
            root = node.copy()
            while True:
                low = root.copy()
                np.minimum.at(low, a, root[b])
                np.minimum.at(low, b, low[a])
                if (low == root).all():
                    break
                root = low
            hit = np.flatnonzero(n)
            nodes.append(node[hit])
            links.append(n[hit].astype(np.int64))
            roots.append(root[hit])
            waiting += len(hit)
            if waiting > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (nodes, links, roots)], ["node", "links", "root"])
                nodes, links, roots, waiting = [], [], [], 0
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (nodes, links, roots)], ["node", "links", "root"])

    return batches


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.97, block: int = 512, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding)."""
    spark = vectors.sparkSession
    ship(spark)
    single = "float" in vectors.schema["embedding"].dataType.elementType.simpleString()
    kind, dtype = ("float", "<f4") if single else ("double", "<f8")
    vector = F.col("embedding").cast(f"array<{kind}>")
    valid = F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
                       & F.exists(vector, lambda v: v != 0), F.lit(False))
    scratch = Scratch(spark, "embeddings")
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(valid, vector).alias("embedding"))

    def packed(found):
        for batch in found:
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(
                [None if v is None else np.asarray(v, dtype).tobytes() for v in batch["embedding"].to_pylist()], pa.binary())], ["vec_id", "vec"])

    rows = scratch.keep(raw.mapInArrow(packed, "vec_id long, vec binary"), "rows")
    points = scratch.keep(rows.where("vec IS NOT NULL").groupBy("vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
                          .withColumn("node", F.monotonically_increasing_id()), "points")
    signs, tables = tables_for(points.count(), threshold, recall)
    signed = scratch.keep(points.select("node", "vec", "copies").mapInArrow(
        _signatures(signs, tables, dtype, seed), "node long, vec binary, copies long, dim int, keys array<long>"), "signed")
    spots = signed.select("dim", F.posexplode("keys").alias("t", "key"))
    sizes = spots.groupBy("t", "dim", "key").agg(F.count("*").alias("n")).where("n > 1")
    placed = (signed.select("*", F.posexplode("keys").alias("t", "key")).join(sizes, ["t", "dim", "key"])
              .withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
              .withColumn("part", F.pmod(F.xxhash64("node", "t"), "parts").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")))
    cell = ["t", "dim", "key", "i", "j"]
    found = (placed.select(*cell, "part", "node", "copies", "vec", "keys")
             .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*cell)).sortWithinPartitions(*cell)
             .mapInArrow(_verify(threshold, dtype), "node long, links long, root long"))
    found = scratch.keep(found.groupBy("node", "root").agg(F.sum("links").alias("links")), "found")
    linked = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")), "embedding-links").withColumnRenamed("id", "node")
    per_node = points.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(linked, "node", "left").select(
        "vec", "low", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    lowest = per_node.groupBy("component").agg(F.min("low").alias("component_id"))
    per_point = per_node.join(lowest, "component").select("vec", "n_links", "component_id")
    out = rows.where("vec IS NOT NULL").join(per_point, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.where("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
