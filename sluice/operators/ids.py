"""Record ids: empty ids, mistyped separators, confirmation, id classes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import NULL_WORDS, is_in, trim


def separator_class(separators: Sequence[str]) -> str | None:
    """Character class of the separators, escaped for a Java regex."""
    seps = [s for s in dict.fromkeys(separators) if s]
    return "[" + "".join("\\" + s if re.match(r"[^\w\s]", s) else s for s in seps) + "]" if seps else None


def is_empty_id(uid: Column) -> Column:
    return uid.isNull() | is_in(F.lower(trim(uid)), NULL_WORDS)


def needs_repair(uid: Column, separators: Sequence[str] = (",", "/")) -> Column:
    cls = separator_class(separators)
    if cls is None:
        return F.lit(False)
    return F.coalesce(trim(uid).rlike(f"^[A-Za-z0-9]{{3,6}}{cls}[A-Za-z0-9]+$"), F.lit(False))


def repair_id(uid: Column, separators: Sequence[str] = (",", "/")) -> Column:
    """``ABCD,0001`` as ``ABCD-0001``; other ids unchanged."""
    cls = separator_class(separators)
    if cls is None:
        return uid
    return F.when(needs_repair(uid, separators), F.regexp_replace(trim(uid), cls, "-")).otherwise(uid)


def repair_ids(df: DataFrame, separators: Sequence[str] = (",", "/")) -> DataFrame:
    """Adds ``uid_original`` and ``uid_repaired_flag`` and repairs ``uid``."""
    return (df.withColumn("uid_original", F.col("uid"))
            .withColumn("uid_repaired_flag", needs_repair(F.col("uid"), separators))
            .withColumn("uid", repair_id(F.col("uid"), separators)))


def split_empty_ids(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with an id, rejected rows)."""
    bad = is_empty_id(F.col("uid"))
    return df.filter(~bad), df.filter(bad)


def id_class(uid: Column) -> Column:
    """hyphenated, eight_characters (eight letters and digits, no hyphen), other."""
    t = trim(uid)
    return (F.when(t.contains("-"), "hyphenated")
            .when(t.rlike("^[A-Za-z0-9]{8}$"), "eight_characters").otherwise("other"))


def id_classes(df: DataFrame) -> DataFrame:
    """Rows and distinct ids per class.  Ids are counted once per (class, id)
    first, so a frequent id is one partial row per task."""
    per_id = (df.groupBy(id_class(F.col("uid")).alias("id_class"), trim(F.col("uid")).alias("uid"))
              .agg(F.count(F.lit(1)).alias("n")))
    return per_id.groupBy("id_class").agg(F.sum("n").alias("n_rows"), F.count("uid").alias("n_ids"))


def nonstandard_ids(df: DataFrame) -> DataFrame:
    """Sorted distinct ids without a hyphen, with their class and row count."""
    cls = id_class(F.col("uid"))
    return (df.filter(cls != "hyphenated")
            .groupBy(cls.alias("id_class"), trim(F.col("uid")).alias("uid"))
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy("id_class", "uid"))


def repair_ledger(repaired: DataFrame, paired: DataFrame | None = None) -> DataFrame:
    """One line per distinct repaired (id, facility): row count, confirmation
    against the paired file, and whether an unrepaired row has the same id.

    Every side is reduced to distinct keys before it is joined."""
    keys = [F.col("uid"), F.coalesce(trim(F.col("facility")), F.lit("")).alias("facility")]
    lines = (repaired.filter("uid_repaired_flag")
             .groupBy(F.col("uid_original"), *keys).agg(F.count(F.lit(1)).alias("n_rows")))
    same_file = (repaired.filter("NOT uid_repaired_flag").select(*keys).distinct()
                 .withColumn("duplicate_in_file", F.lit(True)))
    out = lines.join(same_file, ["uid", "facility"], "left")
    if paired is None:
        status = F.lit("unchecked")
    else:
        p = paired.select(trim(F.col("uid")).alias("uid"),
                          F.coalesce(trim(F.col("facility")), F.lit("")).alias("facility"))
        here = p.distinct().withColumn("_here", F.lit(True))
        anywhere = p.select("uid").distinct().withColumn("_anywhere", F.lit(True))
        out = out.join(here, ["uid", "facility"], "left").join(anywhere, ["uid"], "left")
        status = (F.when(F.col("_here"), "confirmed")
                  .when(F.col("_anywhere"), "confirmed (other facility)").otherwise("unconfirmed"))
    return out.select("uid_original", F.col("uid").alias("uid_repaired"), "facility", "n_rows",
                      status.alias("status"),
                      F.coalesce("duplicate_in_file", F.lit(False)).alias("duplicate_in_file"))
