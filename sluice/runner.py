"""Whole runs: one file, and a batch of files."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.shapes import parse_datetime
from sluice.functions.text import c
from sluice.operators import clean, dedup, ids, lookups, pii, reasons
from sluice.operators.columns import merge_duplicates, resolve_twins
from sluice.operators.episodes import dedup_episodes, episode_summary
from sluice.operators.metrics import fixed, union_all
from sluice.plans.columns import column_types, output_names, plan_header, undocumented
from sluice.plans.config import KEY_COLUMNS, RunConfig
from sluice.plans.dictionary import Dictionary
from sluice.plans.registry import DATASETS, episode_role, file_plan, pair_files, registry
from sluice.session import bounded_rows, cut_lineage
from sluice.sources import csv_text, manifest, sinks
from sluice.sources import scripts as form_scripts

# Datasets whose specimen date may come from the admissions file.
LOOKUP_DATE = "datebct.value"
ADMISSION_DATE = "datetimeadmission.value"


@dataclass(frozen=True)
class CleanResult:
    table: DataFrame
    metrics: DataFrame
    raw: DataFrame
    keys: DataFrame | None
    rejected: DataFrame


def prepare(raw: DataFrame, header: list[str], dictionary: Dictionary, cfg: RunConfig,
            ) -> tuple[DataFrame, DataFrame]:
    """Scanned cells as named, merged and de-identified columns."""
    plan = plan_header(header, cfg)
    named = merge_duplicates(raw.select(*[F.col(f"c{i}") for i, _ in plan], F.col("_rid").alias("_rid")),
                             [*[n for _, n in plan], "_rid"])
    unknown = undocumented(header, dictionary, cfg)
    metrics = fixed(raw.sparkSession, "columns", {("", "undocumented"): len(unknown),
                                                  **{(n, "undocumented_column"): 1 for n in unknown}})
    out, pii_metrics = pii.deidentify(named, dictionary, cfg)
    return out, union_all([metrics, pii_metrics])


def clean_table(raw: DataFrame, header: list[str], dictionary: Dictionary, cfg: RunConfig,
                paired: DataFrame | None = None, adm_keys: DataFrame | None = None,
                lookup: DataFrame | None = None) -> CleanResult:
    """The cleaning steps in order; every step reports counts."""
    base, m_columns = prepare(raw, header, dictionary, cfg)
    base = cut_lineage(base)
    reports = [m_columns]

    repaired = ids.repair_ids(base, cfg.uid_separators)
    good, rejected = ids.split_empty_ids(repaired)
    ledger = ids.repair_ledger(repaired, paired)
    reports.append(ledger.groupBy("status").agg(F.sum("n_rows").alias("n")).select(
        F.lit("ids").alias("step"), F.lit("uid").alias("column"), F.col("status").alias("metric"), "n"))
    reports.append(ids.id_classes(good).select(
        F.lit("ids").alias("step"), F.lit("uid").alias("column"), F.col("id_class").alias("metric"),
        F.col("n_rows").alias("n")))
    df = good.drop("uid_original", "uid_repaired_flag")

    df, m = clean.clean_values(df, dictionary)
    reports.append(m)
    df, m = clean.fill_from_labels(df, cfg)
    reports.append(m)
    df = cut_lineage(df)
    df = resolve_twins(df, protect=("_rid", *KEY_COLUMNS, *[f + "_source" for f in cfg.label_rules]))
    df, m = clean.assign_types(df, dictionary, cfg)
    reports.append(m)
    df = cut_lineage(df)

    keys = None
    if cfg.episodes:
        before = df
        df, keys = dedup_episodes(df, cfg.episode_role, adm_keys, cfg.outcome_column)
        df = cut_lineage(df)
        dedup.assert_unique(df)
        reports.append(episode_summary(before, df))
    else:
        df = dedup.dedup_visits(df)
        if not cfg.skip_patient_dedup:
            df = dedup.dedup_patients(df)
        df = cut_lineage(df)
        if cfg.skip_patient_dedup and "uniquekey" in df.columns:
            shared = dedup.shared_key_rows(df).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
            reports.append(shared.select(F.lit("dedup").alias("step"), F.lit("uniquekey").alias("column"),
                                         F.lit("rows_sharing_key").alias("metric"), "n"))

    types = column_types(df.columns, dictionary, cfg)
    df, m = clean.validate(df, dictionary, cfg)
    reports.append(m)
    if LOOKUP_DATE in df.columns and types.get(LOOKUP_DATE) == "datetime":
        df = (lookups.mirror_lookup(df, LOOKUP_DATE) if lookup is None
              else lookups.earliest_lookup(df, lookup, LOOKUP_DATE, ADMISSION_DATE))
    if cfg.skip_patient_dedup:
        groups = clean.stage_groups(df.columns, types)
        orders = {g: (F.struct(dedup.missing_cells(cols), F.col("_rid")) if g in ("category", "pass")
                      else F.struct(F.lit(0), F.col("_rid"))) for g, cols in groups.items()}
        groups["_rid"], orders["_rid"] = ["_rid"], F.struct(F.lit(0), F.col("_rid"))
        df = dedup.merge_column_groups(df, [k for k in cfg.record_keys if k in df.columns], groups, orders)
    names = output_names(df.columns)
    df, m = clean.derive(df.select(*[c(n).alias(names[n]) for n in df.columns]))
    reports.append(m)
    return CleanResult(df, union_all([r.select("step", "column", "metric", "n") for r in reports]),
                       base, keys, rejected.drop("uid_original", "uid_repaired_flag"))


def with_raw(result: CleanResult, raw_text: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Cleaned rows next to the raw text of their source row (``_raw_<name>``)."""
    raw_of: dict[str, str] = {}
    names = output_names([n for n in dict.fromkeys(raw_text.columns) if not n.startswith("_")
                          and "label" not in n.split(".")[-1]])
    for source, target in names.items():
        raw_of.setdefault(target, f"_raw_{target}")
    raw = raw_text.select(F.col("_rid"), *[c(s).alias(raw_of[t]) for s, t in names.items()])
    return result.table.join(raw, "_rid", "left"), {
        t: r for t, r in raw_of.items() if t in result.table.columns and t not in KEY_COLUMNS}


@dataclass(frozen=True)
class ReasonResult:
    wide: DataFrame
    long: DataFrame
    coded: DataFrame
    summary: DataFrame
    untranslated: list[str]


def code_reasons(result: CleanResult, raw_text: DataFrame, cfg: RunConfig,
                 conditions: DataFrame | None = None, script_map: DataFrame | None = None,
                 exact_ids: tuple[str, ...] = (), aliases: dict[str, str] | None = None) -> ReasonResult:
    """Reason tables of a cleaned run; ``raw_text`` is the named table before
    personal data was removed (its text never leaves this step except for the
    cells that are no match of a personal-data pattern)."""
    df, raw_of = with_raw(result, raw_text)
    columns = reasons.data_columns(result.table.columns)
    shown, failed = {}, []
    if conditions is not None and script_map is not None:
        own = df.withColumn("scriptid", F.col("_raw_scriptid")) if "_raw_scriptid" in df.columns else df
        df = lookups.resolve_script(own, script_map, cfg.country, cfg.dataset, exact_ids, aliases)
        shown, failed = reasons.shown_columns(conditions, columns, raw_of)
    keep = [k for k in KEY_COLUMNS if k in df.columns]
    none = F.lit(None).cast("string")
    codes = {n: reasons.reason_code(c(n), c(raw_of[n]) if n in raw_of else none, shown.get(n), cfg.value_patterns)
             for n in columns}
    flat = cut_lineage(df.select(*[c(k) for k in keep], *[c(n) for n in columns],
                                 *[x.cast("int").alias(f"_code_{n}") for n, x in codes.items()],
                                 *[pii.redact(c(raw_of[n]), cfg.value_patterns).alias(raw_of[n])
                                   for n in columns if n in raw_of]))
    code_of = {n: c(f"_code_{n}") for n in columns}
    wide = flat.select(*[c(k) for k in keep], *[x.alias(n) for n, x in code_of.items()])
    return ReasonResult(wide, reasons.reason_long(flat, code_of, raw_of),
                        reasons.reason_coded(flat, code_of, keep), reasons.reason_summary(wide, columns), failed)


def raw_names(raw: DataFrame, header: list[str], cfg: RunConfig) -> DataFrame:
    """Scanned cells under their normalised names, before any removal."""
    plan = plan_header(header, cfg)
    return merge_duplicates(raw.select(*[F.col(f"c{i}") for i, _ in plan], "_rid"), [*[n for _, n in plan], "_rid"])


def clean_file(spark: SparkSession, path: str, out_dir: str, dictionary: Dictionary, cfg: RunConfig,
               paired_path: str | None = None, conditions: DataFrame | None = None,
               script_map: DataFrame | None = None, exact_ids: tuple[str, ...] = (),
               aliases: dict[str, str] | None = None) -> dict[str, object]:
    """Reads one export, cleans it and writes every output below ``out_dir``."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        raise RuntimeError("set spark.sql.session.timeZone to UTC")
    scan = csv_text.scan(spark, path)
    raw, header = scan.rows, scan.header
    paired = csv_text.scan_columns(spark, paired_path, ["uid", "facility"]) if paired_path else None
    adm_keys = None
    if cfg.episodes and cfg.episode_role == "discharges":
        if not paired_path:
            raise manifest.StaleInput("no admissions file to take the key table from")
        stem = paired_path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")
        adm_keys = manifest.read_keys(spark, f"{out_dir.rsplit('/', 1)[0]}/{stem}/episode_keys",
                                      paired_path, dictionary.checksum)
    lookup = None
    if paired_path and not cfg.episodes:
        found = csv_text.scan_columns(spark, paired_path, ["uid", "facility", ADMISSION_DATE])
        if found is not None:
            lookup = found.withColumn(ADMISSION_DATE, parse_datetime(c(ADMISSION_DATE)))
    result = clean_table(raw, header, dictionary, cfg, paired, adm_keys, lookup)
    table = cut_lineage(result.table)
    broken = scan.problems.groupBy("problem").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("scan").alias("step"), F.lit("").alias("column"), F.col("problem").alias("metric"), "n")
    result = replace(result, table=table, metrics=result.metrics.unionByName(broken))
    manifest.mark_deidentified(spark, f"{out_dir}/deidentified", path, dictionary.checksum)

    manifest.assert_deidentified(spark, f"{out_dir}/deidentified", path, dictionary.checksum)
    n_rejected = sinks.write_rejects(result.rejected, f"{out_dir}/rejected", dictionary, cfg)
    scan.problems.write.mode("overwrite").parquet(f"{out_dir}/unreadable")
    sinks.write_cleaned(table, f"{out_dir}/cleaned_csv", f"{out_dir}/cleaned", dictionary, cfg)
    if cfg.save_deidentified:
        sinks.write_table(result.raw, f"{out_dir}/deidentified_raw", "deidentified", dictionary, cfg)
    if cfg.save_harmonised:
        sinks.write_harmonised(table, f"{out_dir}/harmonised", dictionary, cfg)
    if result.keys is not None:
        manifest.write_keys(result.keys, f"{out_dir}/episode_keys", path, dictionary.checksum)
    coded = code_reasons(result, raw_names(raw, header, cfg), cfg, conditions, script_map, exact_ids, aliases)
    sinks.write_csv(coded.wide, f"{out_dir}/na_reasons", "na_reasons", dictionary, cfg, compressed=True)
    if cfg.save_na_long:
        sinks.write_csv(coded.long, f"{out_dir}/na_reasons_long", "na_reasons_long", dictionary, cfg,
                        value_exempt=("variable",), compressed=True)
    if cfg.save_na_coded:
        sinks.write_csv(coded.coded, f"{out_dir}/na_coded", "na_coded", dictionary, cfg)
    sinks.write_csv(coded.summary, f"{out_dir}/na_summary", "na_summary", dictionary, cfg, value_exempt=("variable",))
    result.metrics.write.mode("overwrite").parquet(f"{out_dir}/metrics")
    style = csv_text.detect_style(raw, header)
    return {"rows": table.count(), "columns": len(table.columns), "rejected": n_rejected, "style": style,
            "untranslated": coded.untranslated}


def plan_batch(spark: SparkSession, input_dir: str, datasets=DATASETS, keep: str | None = None,
               skip: tuple[str, ...] = ()) -> DataFrame:
    """Run plan of the CSV files of a folder."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(input_dir)
             .select("path", F.regexp_extract("path", "[^/]+$", 0).alias("file_name")))
    return pair_files(file_plan(files, registry(spark, datasets), keep=keep, skip=skip))


def form_conditions(spark: SparkSession, scripts: str, country: str) -> DataFrame | None:
    """Conditions of a country's form scripts, read once per batch; None where it has no scripts."""
    try:
        found = form_scripts.read_scripts(spark, f"{scripts.rstrip('/')}/{country}", country)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return cut_lineage(reasons.first_conditions(form_scripts.script_fields(found.filter("scriptId IS NOT NULL"))))


def run_batch(spark: SparkSession, input_dir: str, out_dir: str, dictionaries: dict[tuple[str, str], Dictionary],
              base: RunConfig | None = None, datasets=DATASETS, keep: str | None = None,
              skip: tuple[str, ...] = (), label_rules: dict[tuple[str, str], dict[str, str]] | None = None,
              scripts: str | None = None, script_map: DataFrame | None = None, exact_ids: tuple[str, ...] = (),
              aliases: dict[str, str] | None = None) -> list[dict]:
    """Every runnable file in name order (admissions come before discharges); a
    failing file is recorded and the batch goes on.  ``scripts`` holds a folder of form scripts per country; with
    ``script_map`` (country, dataset, facility, script_id) their conditions tell which empty cells the form did not show."""
    plan = bounded_rows(plan_batch(spark, input_dir, datasets, keep, skip).orderBy("file_name"), what="input files")
    visits = {d[0]: d[5] for d in datasets}
    conditions: dict[str, DataFrame | None] = {}
    out = []
    for p in plan:
        line = {k: p[k] for k in ("file_name", "country", "dataset", "source")}
        if not p["run"]:
            out.append({**line, "status": "skipped", "detail": p["reason"]})
            continue
        try:
            key = (p["country"], p["dataset"])
            dictionary = dictionaries.get(key) or dictionaries.get((p["country"], p["fallback"]))
            if dictionary is None:
                raise FileNotFoundError(f"no dictionary for {key[0]} {key[1]}")
            cfg = replace(base or RunConfig(), country=p["country"], dataset=p["dataset"],
                          episode_role=episode_role(p["dataset"], p["country"], datasets),
                          skip_patient_dedup=bool(visits.get(p["dataset"])),
                          label_rules=(label_rules or {}).get(key, {}))
            stem = p["file_name"].removesuffix(".csv")
            folder = input_dir.rstrip("/")
            paired = f"{folder}/{p['paired_file']}" if p["paired_file"] else None
            if scripts is not None and key[0] not in conditions:
                conditions[key[0]] = form_conditions(spark, scripts, key[0])
            got = clean_file(spark, f"{folder}/{p['file_name']}", f"{out_dir.rstrip('/')}/{stem}", dictionary, cfg, paired,
                             conditions.get(key[0]), script_map, exact_ids, aliases)
            out.append({**line, "source": got["style"], "status": "ok", "detail": f"{got['rows']} rows"})
        except Exception as e:  # one bad file must not end the batch
            out.append({**line, "status": "failed", "detail": str(e).split("\n")[0]})
    return out


