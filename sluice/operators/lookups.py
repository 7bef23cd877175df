"""Lookups against a second table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import c


def earliest_lookup(df: DataFrame, lookup: DataFrame, date: str, lookup_date: str,
                    keys: Sequence[str] = ("uid", "facility")) -> DataFrame:
    """Fills a missing ``date`` from the earliest ``lookup_date`` per key; adds
    ``<base>_resolved`` and ``<base>_source`` (original, from_admission).

    The lookup shrinks to one row per key before the join, and nulls match
    nulls as they do in the source data."""
    base = date.split(".")[0]
    right = lookup.groupBy(*[c(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min(c(lookup_date)).alias("_found"))
    on = [c(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    out = df.join(right, on, "left")
    source = (F.when(c(date).isNotNull(), "original")
              .when(F.col("_found").isNotNull(), "from_admission"))
    return (out.withColumn(f"{base}_resolved", F.coalesce(c(date), F.col("_found")))
            .withColumn(f"{base}_source", source)
            .drop("_found", *[f"_k{i}" for i in range(len(keys))]))


def mirror_lookup(df: DataFrame, date: str) -> DataFrame:
    """Result of ``earliest_lookup`` when there is no second table."""
    base = date.split(".")[0]
    return (df.withColumn(f"{base}_resolved", c(date))
            .withColumn(f"{base}_source", F.when(c(date).isNotNull(), "original")))


def first_wins(entries: DataFrame, names: Sequence[str], order: str, payload: Sequence[str]) -> DataFrame:
    """One entry per lower-case name over several name columns; the entry that
    comes first (then the first name column) wins."""
    keyed = entries.select(
        F.explode(F.array(*[F.struct(F.lower(F.trim(c(n))).alias("key"), F.lit(i).alias("rank"))
                            for i, n in enumerate(names)])).alias("k"),
        F.col(order).alias("_o"), F.struct(*[c(p) for p in payload]).alias("entry"))
    return (keyed.filter(F.coalesce(F.col("k.key"), F.lit("")) != "")
            .groupBy(F.col("k.key").alias("key"))
            .agg(F.min_by("entry", F.struct("_o", "k.rank")).alias("entry")))


def lookup_names(df: DataFrame, index: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds ``entry`` from the first of the name columns that is in the index."""
    out = df
    for i, n in enumerate(names):
        out = out.join(index.select(F.col("key").alias(f"_key{i}"), F.col("entry").alias(f"_e{i}")),
                       F.lower(F.trim(c(n))) == F.col(f"_key{i}"), "left")
    return (out.withColumn("entry", F.coalesce(*[F.col(f"_e{i}") for i in range(len(names))]))
            .drop(*[f"_e{i}" for i in range(len(names))], *[f"_key{i}" for i in range(len(names))]))


def align_raw(clean: DataFrame, raw: DataFrame, columns: Sequence[str], by_row_key: bool = True,
              rid: str = "_rid") -> DataFrame:
    """Clean rows with the raw values of their source row (struct ``_raw``),
    found by (uid, facility, uniquekey), then (uid, facility), then uid; of
    several raw rows the first one counts.  Use this where the row id was not
    carried along; otherwise join on the row id."""
    raw_row = F.struct(*[c(n) for n in columns])
    levels = [["uid", "facility", "uniquekey"], ["uid", "facility"], ["uid"]] if by_row_key else [["uid"]]
    out = clean
    for i, keys in enumerate(levels):
        first = raw.groupBy(*[c(k).alias(f"_k{j}") for j, k in enumerate(keys)]).agg(
            F.min_by(raw_row, F.col(rid)).alias(f"_r{i}"))
        out = out.join(first, [c(k) == F.col(f"_k{j}") for j, k in enumerate(keys)], "left")
        out = out.drop(*[f"_k{j}" for j in range(len(keys))])
    return (out.withColumn("_raw", F.coalesce(*[F.col(f"_r{i}") for i in range(len(levels))]))
            .drop(*[f"_r{i}" for i in range(len(levels))]))


def resolve_script(df: DataFrame, script_map: DataFrame, country: str, dataset: str,
                   exact_ids: Sequence[str] = (), aliases: dict[str, str] | None = None) -> DataFrame:
    """Adds ``script_id``: the row's own id when it is one of ``exact_ids``, an
    alias, else the map entry of (country, dataset, facility)."""
    rows = script_map.filter((F.upper("country") == country.upper())
                             & (F.lower("dataset") == script_dataset(dataset)))
    by_site = rows.groupBy(F.upper(F.trim("facility")).alias("_site")).agg(F.min("script_id").alias("_sid"))
    own = F.col("scriptid") if "scriptid" in df.columns else F.lit(None).cast("string")
    found: list[Column] = []
    if exact_ids:
        found.append(F.when(own.isin(*exact_ids), own))
    if aliases:
        found.append(F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), own))
    out = df.join(by_site, F.upper(F.trim(F.col("facility"))) == F.col("_site"), "left")
    return out.withColumn("script_id", F.coalesce(*found, F.col("_sid"))).drop("_site", "_sid")


def script_dataset(dataset: str) -> str:
    """Datasets whose rows come from the maternal outcomes scripts."""
    d = dataset.strip().lower()
    return "maternal_outcomes" if d in ("combined_maternity_outcomes", "dhis2_maternal_outcomes",
                                        "maternity_completeness") else d
