"""Exports of the form editor: data keys and where they are used."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.dictionary_build import replace_titles

DATA_KEYS = ("uniqueKey string, name string, label string, dataType string, options array<string>, "
             "confidential boolean, isDeleted boolean, isDraft boolean, publishDate timestamp_ntz")


def read_data_keys(spark: SparkSession, path: str, country: str) -> DataFrame:
    return (spark.read.schema(DATA_KEYS).option("multiLine", True).json(path)
            .withColumn("country", F.lit(country))
            .withColumn("isDeleted", F.coalesce("isDeleted", F.lit(False))))


def read_key_usage(spark: SparkSession, path: str, country: str,
                   replacements: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(country, datakeyuniquekey, scripttitle) from a usage export whose header
    may be spelled in any way."""
    df = spark.read.option("header", True).csv(path)
    df = df.toDF(*[re.sub("[^a-z0-9]", "", n.lower()) for n in df.columns])
    df = df.select("datakeyuniquekey", "scripttitle").withColumn("country", F.lit(country))
    return replace_titles(df, replacements) if replacements else df
