"""Manifests: what a stored table was made from, checked before it is used."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import episodes, folds


class StaleInput(RuntimeError):
    """A stored result does not belong to the current input, rules or dictionary."""


def file_stamp(spark: SparkSession, path: str) -> str:
    """Checksum over name, size and modification time of every input file."""
    files = (spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
             .orderBy("path").select(F.sha2(F.concat_ws(
                 "|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")),
                 256).alias("h")))
    return hashlib.sha256("".join(r["h"] for r in files.toLocalIterator()).encode()).hexdigest()


def rule_stamp() -> str:
    """Checksum of the linkage rule settings."""
    rules = [folds.HOUR, folds.WEIGHT_TOLERANCE, folds.WEEKS_TOLERANCE, sorted(episodes.DEATH_CODES)]
    return hashlib.sha256(json.dumps(rules).encode()).hexdigest()


def describe(spark: SparkSession, source: str, dictionary_checksum: str) -> dict[str, str]:
    return {"source": source.rstrip("/").rsplit("/", 1)[-1], "input": file_stamp(spark, source),
            "rules": rule_stamp(), "dictionary": dictionary_checksum}


def _write_manifest(spark: SparkSession, path: str, content: Mapping[str, str]) -> None:
    """Written after the data, so a half-written store has no manifest."""
    (spark.createDataFrame([(json.dumps(dict(content), sort_keys=True),)], "value string").coalesce(1)
     .write.mode("overwrite").text(path + "_manifest"))


def read_manifest(spark: SparkSession, path: str) -> dict[str, str] | None:
    try:
        row = spark.read.text(path + "_manifest").first()
    except Exception as e:  # the reader raises an analysis error for a missing path
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return json.loads(row[0]) if row else None


def _matching(spark: SparkSession, path: str, wanted: Mapping[str, str], what: str) -> None:
    have = read_manifest(spark, path)
    if have is None:
        raise StaleInput(f"{what} not found at {path}; run the step that writes it first")
    off = sorted(k for k in wanted if have.get(k) != wanted[k])
    if off:
        raise StaleInput(f"{what} at {path} was made from another {', '.join(off)}; run it again")


def write_keys(keys: DataFrame, path: str, source: str, dictionary_checksum: str,
               checksum_at_start: str | None = None) -> None:
    """Key table of an admissions run with its fingerprint."""
    if checksum_at_start is not None and checksum_at_start != dictionary_checksum:
        raise StaleInput("the dictionary changed during the run; key table not written")
    keys.write.mode("overwrite").parquet(path)
    _write_manifest(keys.sparkSession, path, describe(keys.sparkSession, source, dictionary_checksum))


def read_keys(spark: SparkSession, path: str, source: str, dictionary_checksum: str) -> DataFrame:
    """Key table, refused when input, rules or dictionary differ."""
    _matching(spark, path, describe(spark, source, dictionary_checksum), "key table")
    return spark.read.parquet(path)


def mark_deidentified(spark: SparkSession, path: str, source: str, dictionary_checksum: str) -> None:
    _write_manifest(spark, path, describe(spark, source, dictionary_checksum))


def assert_deidentified(spark: SparkSession, path: str, source: str, dictionary_checksum: str) -> None:
    """Stops unless personal data was removed from exactly this input."""
    _matching(spark, path, describe(spark, source, dictionary_checksum), "de-identification marker")
