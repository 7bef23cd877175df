"""Running numbers within a key that may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_number(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column],
                   out: str = "number") -> DataFrame:
    """1, 2, 3, ... within ``keys`` by (bucket, order).

    Rows are numbered inside (keys, bucket), so a frequent key is spread over
    its buckets; the numbers before a bucket come from counts per (keys,
    bucket).  Rows without a key count as one key."""
    b = df.withColumn("_b", bucket)
    by_key = Window.partitionBy(*keys).orderBy(F.col("_b").asc_nulls_last())
    before = (b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
              .select(*keys, F.col("_b").alias("_b2"), (F.sum("_n").over(by_key) - F.col("_n")).alias("_before")))
    inside = Window.partitionBy(*keys, "_b").orderBy(*order)
    numbered = b.withColumn("_in", F.row_number().over(inside))
    return (numbered.alias("l").join(before.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
                                     + [F.col("l._b").eqNullSafe(F.col("r._b2"))])
            .select("l.*", (F.col("_in") + F.col("_before")).cast("bigint").alias(out)).drop("_b", "_in"))


def nearest_times(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
                  bucket: str = "DAY") -> DataFrame:
    """Adds to each left row the last right time at or before it and the first
    one after it (``earlier``, ``later``), per key.

    Both sides are laid on one time line per (keys, bucket); what lies outside
    a bucket comes from its first and last time, carried over the buckets of
    the key.  No pair of rows is ever formed.  Left rows without a time or
    without one of the keys stay and find nothing."""
    keys = list(keys)
    line = (left.select(*keys, F.col(left_time).alias("_t"), F.struct(*left.columns).alias("_row"))
            .unionByName(right.select(*keys, F.col(right_time).alias("_t")), allowMissingColumns=True)
            .withColumn("_b", F.date_trunc(bucket, F.col("_t").cast("timestamp"))))
    other = F.when(F.col("_row").isNull(), F.col("_t"))
    w = Window.partitionBy(*keys, "_b").orderBy("_t", F.col("_row").isNotNull())
    near = line.select("*", F.max(other).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_e"),
                       F.min(other).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_l"))
    edges = line.groupBy(*keys, "_b").agg(F.min(other).alias("lo"), F.max(other).alias("hi"))
    by_key = Window.partitionBy(*keys).orderBy("_b")
    edges = edges.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_b2"),
        F.max("hi").over(by_key.rowsBetween(Window.unboundedPreceding, -1)).alias("_pe"),
        F.min("lo").over(by_key.rowsBetween(1, Window.unboundedFollowing)).alias("_nl"))
    rows = near.filter(F.col("_row").isNotNull())
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_b").eqNullSafe(F.col("_b2"))]
    known = F.col("_t").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    return rows.join(edges, on).select(
        F.col("_row"), F.when(known, F.coalesce("_e", "_pe")).alias("earlier"),
        F.when(known, F.coalesce("_l", "_nl")).alias("later")).select("_row.*", "earlier", "later")
