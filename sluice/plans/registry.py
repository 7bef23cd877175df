"""Dataset catalogue and the run plan made from input file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.shapes import bind
from sluice.session import cut_lineage

# Country tokens of file names.
COUNTRIES = ("MWI", "ZIM")

# Datasets, the dataset whose dictionary stands in for a missing
# one, the paired dataset, the linkage role (with the one country it is limited
# to), whether rows stay one per visit.  More datasets are added as rows.
DATASET_FIELDS = ("dataset", "fallback", "pair", "role", "role_country", "keep_visits")
DATASETS = (
    ("admissions", None, "discharges", "admissions", None, False),
    ("discharges", None, "admissions", "discharges", None, False),
    ("maternal_outcomes", None, None, "births", "ZIM", False),
    ("phc_admissions", "admissions", "phc_discharges", "admissions", None, False),
    ("phc_discharges", "discharges", "phc_admissions", "discharges", None, False),
    ("combined_maternity_outcomes", None, None, "births", "MWI", False),
    ("dhis2_maternal_outcomes", "combined_maternity_outcomes", None, None, None, False),
    ("maternity_completeness", "maternal_outcomes", None, None, None, False),
    ("joined_admissions_discharges", "admissions", None, None, None, False),
    ("baseline", "admissions", None, None, None, False),
    ("infections", None, None, None, None, True),
    ("twenty_8_day_follow_up", None, None, None, None, False),
)

_STAMP = r"([0-9]{12}|[0-9]{8}|[0-9]{4}-[0-9]{2}-[0-9]{2})"
FILE_NAME = r"(?i)^(mwi|zim)_((db|mb)_)?(.+)_" + _STAMP + r"\.csv$"


def registry(spark: SparkSession, rows: Sequence[tuple] = DATASETS) -> DataFrame:
    return spark.createDataFrame(list(rows), "dataset string, fallback string, pair string, "
                                             "role string, role_country string, keep_visits boolean")


def episode_role(dataset: str, country: str | None = None,
                 rows: Sequence[tuple] = DATASETS) -> str | None:
    """Linkage role of a dataset in a country, None when it has none."""
    for name, _, _, role, limit, _ in rows:
        if name == dataset:
            return role if limit is None or country is None or country.upper() == limit else None
    return None


def parse_file_name(name: Column) -> Column:
    """struct(prefix, country, source, dataset, stamp); null when the name has
    neither ``country_source_dataset_date.csv`` nor ``country_dataset_date.csv``."""
    def parsed(p: Column) -> Column:
        source = F.lower(F.get(p, F.lit(2)))
        return F.struct(
            F.lower(F.concat(F.get(p, F.lit(0)), F.lit("_"), F.get(p, F.lit(1)))).alias("prefix"),
            F.upper(F.get(p, F.lit(0))).alias("country"),
            F.when(source == "db", "database").when(source == "mb", "metabase").otherwise("auto").alias("source"),
            F.lower(F.get(p, F.lit(3))).alias("dataset"), F.get(p, F.lit(4)).alias("stamp"))

    parts = F.split(F.regexp_replace(name, FILE_NAME, "$1|$2|$3|$4|$5"), r"\|", -1)
    return F.when(name.rlike(FILE_NAME), bind(parts, parsed))


def file_plan(files: DataFrame, datasets: DataFrame, name: str = "file_name",
              keep: str | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """One row per input file: country, source, dataset, run or skip with the
    reason, in file-name order by construction of ``file_name``."""
    out = files
    if keep is not None:
        out = out.filter(F.col(name).rlike(keep))
    if skip:
        out = out.filter(~F.col(name).isin(*skip))
    known = datasets.select(F.col("dataset").alias("_known"), "fallback", "pair")
    p = F.col("_p")
    out = (out.withColumn("_p", parse_file_name(F.col(name)))
           .select("*", *[p[f].alias(f) for f in ("prefix", "country", "source", "dataset", "stamp")])
           .drop("_p").join(known, F.col("dataset") == F.col("_known"), "left"))
    reason = (F.when(F.col("country").isNull(), "filename does not match expected pattern")
              .when(F.col("_known").isNull(),
                    F.concat(F.lit("unrecognised dataset type '"), F.col("dataset"), F.lit("'"))))
    return out.withColumn("reason", reason).withColumn("run", F.col("reason").isNull()).drop("_known")


def pair_files(plan: DataFrame, name: str = "file_name") -> DataFrame:
    """Adds ``paired_file``: the paired dataset's file of the same stamp, else
    the last one by name with the same prefix."""
    plan = cut_lineage(plan)
    runs = plan.filter(F.col("run"))
    others = runs.select("prefix", F.col("dataset").alias("pair"), "stamp", F.col(name).alias("_f"))
    same = others.groupBy("prefix", "pair", "stamp").agg(F.max("_f").alias("_same"))
    last = others.groupBy("prefix", "pair").agg(F.max("_f").alias("_last"))
    return (plan.join(same, ["prefix", "pair", "stamp"], "left").join(last, ["prefix", "pair"], "left")
            .withColumn("paired_file", F.coalesce("_same", "_last")).drop("_same", "_last"))


def resolve_dictionaries(plan: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """Adds ``dictionary``: the dataset's own, else that of its fallback dataset;
    a runnable file without either is marked as failed."""
    own = dictionaries.select("country", "dataset", F.col("path").alias("_own"))
    alt = dictionaries.select("country", F.col("dataset").alias("fallback"), F.col("path").alias("_alt"))
    out = (plan.join(own, ["country", "dataset"], "left").join(alt, ["country", "fallback"], "left")
           .withColumn("dictionary", F.coalesce("_own", "_alt")).drop("_own", "_alt"))
    missing = F.col("run") & F.col("dictionary").isNull()
    return (out.withColumn("reason", F.when(missing, "dictionary not found").otherwise(F.col("reason")))
            .withColumn("run", F.col("run") & F.col("dictionary").isNotNull()))
