"""Counts-only reports: one narrow table (step, column, metric, n)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "step string, column string, metric string, n bigint"


def class_counts(df: DataFrame, step: str, classes: Mapping[str, Column]) -> DataFrame:
    """Counts of each column's class values (null classes are left out).

    The cells are unfolded inside one array per row and only classified cells
    leave it, so the shuffle carries one partial count per (column, class)."""
    cells = F.filter(F.array(*[F.struct(F.lit(name).alias("column"), cls.alias("metric"))
                               for name, cls in classes.items()]),
                     lambda x: x["metric"].isNotNull())
    return (df.select(F.explode(cells).alias("cell")).select("cell.*")
            .groupBy("column", "metric").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(step).alias("step"), "column", "metric", "n"))


def flag_counts(df: DataFrame, step: str, flags: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Counts of rows for which each (column, metric) flag holds, zeros included."""
    names = list(flags)
    row = df.agg(*[F.count_if(flags[k]).alias(f"c{i}") for i, k in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(step).alias("step"), F.lit(col).alias("column"),
                               F.lit(metric).alias("metric"), F.col(f"c{i}").alias("n"))
                      for i, (col, metric) in enumerate(names)])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def fixed(spark: SparkSession, step: str, counts: Mapping[tuple[str, str], int]) -> DataFrame:
    return spark.createDataFrame([(step, c, m, int(n)) for (c, m), n in counts.items()], SCHEMA)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
