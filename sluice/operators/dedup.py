"""Row deduplication that keeps the most complete row of each group.

Every pick is ``row_number() == 1``: Spark limits each group inside the map
tasks (window group limit) before the shuffle, so a frequent key sends one row
per task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.text import c

# Columns that tell visits apart, where present.
VISIT_COLUMNS = ("startedat", "startedatdischarge", "datetimeadmission.value", "dateadmission.value",
                 "datebct.value", "completedat", "completedatdischarge")
TIMESTAMP_KEY = r"^\d{4}-\d{2}-\d{2}T"


def missing_cells(columns: Sequence[str]) -> Column:
    """Number of null cells among the columns."""
    total = F.lit(0)
    for n in columns:
        total = total + c(n).isNull().cast("int")
    return total


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group."""
    w = Window.partitionBy(*[c(k) for k in keys]).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(w)).filter("_pick = 1").drop("_pick")


def is_timestamp_key(col: Column) -> Column:
    return F.coalesce(col.rlike(TIMESTAMP_KEY), F.lit(False))


def _data_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [n for n in df.columns if n not in keys and not n.startswith("_")]


def dedup_visits(df: DataFrame, rid: str = "_rid") -> DataFrame:
    """Most complete row per (uid, facility, visit dates); ties: a uniquekey
    that is not a timestamp first, then input order."""
    keys = ["uid", "facility", *[n for n in VISIT_COLUMNS if n in df.columns]]
    order = [missing_cells(_data_columns(df, keys)).asc()]
    if "uniquekey" in df.columns:
        order.append(is_timestamp_key(F.col("uniquekey")).asc())
    return first_row(df, keys, [*order, F.col(rid).asc()])


def dedup_patients(df: DataFrame, rid: str = "_rid") -> DataFrame:
    """Most complete row per (uid, facility); ties: highest uniquekey, then as
    in ``dedup_visits``."""
    keys = ["uid", "facility"]
    order = [missing_cells(_data_columns(df, keys)).asc()]
    if "uniquekey" in df.columns:
        order += [F.col("uniquekey").desc_nulls_last(), is_timestamp_key(F.col("uniquekey")).asc()]
    return first_row(df, keys, [*order, F.col(rid).asc()])


def keep_most_complete(df: DataFrame, keys: Sequence[str], rid: str = "_rid") -> DataFrame:
    return first_row(df, keys, [missing_cells(_data_columns(df, keys)).asc(), F.col(rid).asc()])


def shared_key_rows(df: DataFrame, keys: Sequence[str] = ("uid", "facility", "uniquekey")) -> DataFrame:
    """Row count of each key that more than one row has."""
    return (df.groupBy(*[c(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter("n_rows > 1"))


def assert_unique(df: DataFrame, keys: Sequence[str] = ("uid", "facility", "uniquekey")) -> None:
    """Stops when kept rows share the record key; later steps would merge them."""
    n = shared_key_rows(df, keys).agg(F.sum("n_rows").alias("n")).first()["n"]
    if n:
        raise ValueError(f"{n} kept row(s) share {', '.join(keys)} with another row")


def merge_column_groups(df: DataFrame, keys: Sequence[str], groups: dict[str, Sequence[str]],
                        orders: dict[str, Column]) -> DataFrame:
    """One row per key; each column group comes whole from the row that is first
    in that group's order.  One aggregation replaces a join per group."""
    picked = df.groupBy(*[c(k) for k in keys]).agg(
        *[F.min_by(F.struct(*[c(n) for n in cols]), orders[g]).alias(f"_g{i}")
          for i, (g, cols) in enumerate(groups.items())])
    return picked.select(*[c(k) for k in keys],
                         *[F.col(f"_g{i}").getField(n).alias(n)
                           for i, cols in enumerate(groups.values()) for n in cols])
