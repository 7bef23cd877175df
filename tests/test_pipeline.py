"""Whole runs on small invented files, gates and manifests."""

import csv
import os
import time

import pytest
from pyspark.sql import functions as F

from sluice import runner
from sluice.functions.text import c
from sluice.operators import pii, reasons
from sluice.operators.columns import merge_duplicates, non_null_counts, resolve_twins, twin_choice
from sluice.operators.ids import repair_id, separator_class
from sluice.plans.columns import column_type, harmonised_names, output_names, plan_header, undocumented
from sluice.plans.config import RunConfig
from sluice.plans.dictionary import Dictionary
from sluice.plans.registry import episode_role, parse_file_name, registry, resolve_dictionaries
from sluice.sources import csv_text, manifest, sinks
from sluice.sources.scripts import read_scripts, script_fields


def variable(key, r_type, **more):
    return {"question_key": key, "raw_value_column": key + ".value", "raw_label_column": key + ".label", "r_type": r_type,
            "use_in_analysis": True, "confidential": False, "weight_unit": None, "harmonised_variable_name": None,
            "suggested_plausible_min": None, "suggested_plausible_max": None, **more}


VARIABLES = (
    variable("birthweight", "numeric", weight_unit="grams", harmonised_variable_name="birth_weight"),
    variable("gestation", "numeric", suggested_plausible_min=20.0, suggested_plausible_max=46.0),
    variable("gender", "categorical"), variable("readmission", "categorical"), variable("twin", "boolean"),
    variable("datetimeadmission", "datetime"), variable("datetimedischarge", "datetime"),
    variable("antenatalcare", "numeric"), variable("notes", "object"), variable("secret", "object", confidential=True),
    variable("outcome", "categorical"),
)
MAPS = tuple({"question_key": "gender", "raw_code": a, "option_label": b, "canonical_code": c_} for a, b, c_ in
             (("M", "Male", "M"), ("F", "Female", "F"))) + tuple(
    {"question_key": "readmission", "raw_code": a, "option_label": b, "canonical_code": a} for a, b in (("Y", "Yes"), ("N", "No")))
DICTIONARY = Dictionary(VARIABLES, MAPS, ("^patientno",))
HEADER = ["UID", "Facility", "Unique Key", "Started At", "DateTimeAdmission.value", "BirthWeight. Value", "gestation.value",
          "Gender.value", "Gender.label", "readmission.value", "Twin.value", "antenatalcare.value", "antenatalcare.label",
          "notes.value", "secret.value", "MotherDOB.value", "PatientNo.value", "Extra.value", "x.parentKey", "gender.value"]


def admission(uid, key, when="2024-03-01 08:00:00", bw="2900", ga="39", sex="Male", lab="", readm="", twin="yes", anc="",
              anc_label="", note="seen on ward", extra="", again=""):
    return [uid, "H1", key, when, when, bw, ga, sex, lab, readm, twin, anc, anc_label, note, "hidden", "2000-01-01", "77", extra, "p", again]


ADMISSIONS = [
    admission("AAAA-0001", "k1", bw="2,900", anc_label="3 ANC visits"),
    admission("AAAA,0002", "k2", bw="2.9", sex="F", note="0771234567"),
    admission("AAAA-0003", "k3", when="March 1, 2024, 8:00 AM", sex="", lab="x", again="Female", ga="60"),
    admission("AAAA-0003", "k4", when="01/03/2024 08:20", sex="F", ga="38", extra="more"),
    admission("ABCD1234", "k5", twin="maybe", note="none", anc_label="More than 4 ANC visits"),
    admission("", "k6"), admission("n/a", "k7"),
    admission("AAAA-0004", "k8", note="mail a@b.org", extra="NA"),
]
D_HEADER = ["uid", "facility", "unique_key", "started_at", "datetimeadmission.value", "datetimedischarge.value", "gender.value",
            "birthweight.value", "gestation.value", "outcome.value"]
DISCHARGES = [
    ["AAAA-0001", "H1", "d1", "2024-03-05 10:00:00", "2024-03-01 08:00:00", "2024-03-05 10:00:00", "M", "2900", "39", "DC"],
    ["ZZZZ-0009", "H1", "d2", "2024-03-06 10:00:00", "", "2024-03-06 10:00:00", "F", "2500", "37", "NND"],
]


def write(path, header, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])
    return str(path)


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    inputs, out = folder / "input", str(folder / "out")
    inputs.mkdir()
    write(inputs / "mwi_admissions_2026-10-08.csv", HEADER, ADMISSIONS)
    write(inputs / "mwi_db_discharges_2026-10-08.csv", D_HEADER, DISCHARGES)
    write(inputs / "mwi_discharges_2026-10-08.csv", D_HEADER, DISCHARGES)
    write(inputs / "mwi_diagnoses_2026-10-08.csv", ["a"], [["1"]])
    write(inputs / "mwi_infections_2026-10-08.csv", ["a"], [["1"]])
    dictionaries = {("MWI", "admissions"): DICTIONARY, ("MWI", "discharges"): DICTIONARY}
    report = runner.run_batch(spark, str(inputs), out, dictionaries, RunConfig(save_na_long=True, save_harmonised=True),
                              label_rules={("MWI", "admissions"): {"antenatalcare": "anc_visit_count"}})
    return inputs, out, {r["file_name"]: r for r in report}


def test_batch_report(batch):
    _, _, report = batch
    status = {k: r["status"] for k, r in report.items()}
    assert status == {"mwi_admissions_2026-10-08.csv": "ok", "mwi_discharges_2026-10-08.csv": "ok",
                      "mwi_db_discharges_2026-10-08.csv": "failed", "mwi_diagnoses_2026-10-08.csv": "skipped",
                      "mwi_infections_2026-10-08.csv": "failed"}, report
    assert "diagnoses" in report["mwi_diagnoses_2026-10-08.csv"]["detail"]
    assert report["mwi_admissions_2026-10-08.csv"]["source"] == "mixed"
    assert report["mwi_discharges_2026-10-08.csv"]["source"] == "database"


@pytest.fixture(scope="module")
def cleaned(spark, batch):
    df = spark.read.parquet(f"{batch[1]}/mwi_admissions_2026-10-08/cleaned")
    return df, {r["uniquekey"]: r.asDict() for r in df.collect()}


def test_cleaned_values(cleaned):
    df, rows = cleaned
    assert set(rows) == {"k1", "k2", "k4", "k5", "k8"}
    assert not {"secret", "motherdob", "patientno", "gender.label", "x.parentkey"} & set(df.columns)
    assert rows["k1"]["birthweight"] == 2900.0 and rows["k2"]["birthweight"] == 2900.0
    assert rows["k1"]["gender"] == "M" and rows["k1"]["twin"] is True and rows["k5"]["twin"] is None
    assert rows["k2"]["uid"] == "AAAA-0002" and rows["k2"]["notes"] is None and rows["k5"]["notes"] is None
    assert rows["k5"]["uid"] == "ABCD1234"
    assert (rows["k1"]["antenatalcare"], rows["k1"]["antenatalcare_source"], rows["k1"]["antenatalcare_category"]) == (
        3.0, "raw_exact_label", "1_3")
    assert rows["k5"]["antenatalcare"] is None and rows["k5"]["antenatalcare_category"] == "ge4"
    assert rows["k4"]["dedup_rows_merged"] == 2 and rows["k4"]["baby_id"] == "AAAA-0003.A"
    assert str(rows["k4"]["datetimeadmission"]) == "2024-03-01 08:20:00" and rows["k1"]["birthweight_g"] == 2900.0
    assert rows["k4"]["extra"] == "more"


def test_reasons(spark, batch, cleaned):
    folder = f"{batch[1]}/mwi_admissions_2026-10-08"
    wide = {r["uniquekey"]: r for r in spark.read.option("header", True).csv(f"{folder}/na_reasons").collect()}
    assert wide["k2"]["notes"] == "-6" and wide["k8"]["notes"] == "-6" and wide["k5"]["notes"] == "-9"
    assert wide["k5"]["twin"] == "-8" and wide["k1"]["gender"] is None and wide["k8"]["extra"] == "-9"
    df, rows = cleaned
    empty = sum(v is None for r in rows.values() for k, v in r.items() if k not in ("uid", "facility", "uniquekey"))
    long = spark.read.option("header", True).csv(f"{folder}/na_reasons_long")
    assert long.count() == empty
    assert not long.filter("raw_value LIKE '%@%' OR raw_value LIKE '077%'").count()
    summary = spark.read.option("header", True).csv(f"{folder}/na_summary").collect()
    assert all(int(r["n_present"]) + int(r["n_missing"]) == len(rows) for r in summary)
    assert sum(int(r["n_missing"]) for r in summary) == empty
    coded = spark.read.option("header", True).csv(f"{folder}/na_coded")
    text = {r["uniquekey"]: r for r in coded.collect()}
    assert text["k5"]["twin"] == "-8" and text["k1"]["twin"] == "TRUE" and text["k1"]["birthweight"] == "2900"
    assert set(coded.columns) == set(df.columns)


def test_discharge_link_and_sinks(spark, batch):
    folder = f"{batch[1]}/mwi_discharges_2026-10-08"
    rows = {r["uniquekey"]: r for r in spark.read.parquet(f"{folder}/cleaned").collect()}
    assert rows["d1"]["baby_id"] == "AAAA-0001.A" and rows["d1"]["stay_form_primary"]
    assert rows["d2"]["dedup_flag"] == "no_admission"
    csv_rows = spark.read.option("header", True).csv(f"{folder}/cleaned_csv").collect()
    assert {r["datetimedischarge"] for r in csv_rows} == {"2024-03-05 10:00:00", "2024-03-06 10:00:00"}
    adm = f"{batch[1]}/mwi_admissions_2026-10-08"
    assert "birth_weight" in spark.read.parquet(f"{adm}/harmonised").columns
    assert spark.read.option("header", True).csv(f"{adm}/rejected").count() == 2
    metrics = {(r["step"], r["column"], r["metric"]): r["n"] for r in spark.read.parquet(f"{adm}/metrics").collect()}
    assert metrics[("pii", "motherdob.value", "removed_tier_2")] == 1
    assert metrics[("pii", "secret.value", "removed_tier_1")] == 1
    assert metrics[("pii_redacted", "notes.value", "phone_local_zw")] == 1
    assert metrics[("ids", "uid", "unconfirmed")] == 1 and metrics[("ids", "uid", "eight_characters")] == 1
    assert metrics[("types", "birthweight.value", "thousands")] == 1
    assert metrics[("label_rule", "antenatalcare.value", "label_exact_count")] == 1
    assert metrics[("columns", "extra.value", "undocumented_column")] == 1


def test_rerun_gives_the_same_table(spark, batch, cleaned):
    inputs, out, _ = batch
    raw, header = csv_text.scan_csv(spark, str(inputs / "mwi_admissions_2026-10-08.csv"))
    cfg = RunConfig(country="MWI", dataset="admissions", episode_role="admissions",
                    label_rules={"antenatalcare": "anc_visit_count"})
    again = runner.clean_table(raw, header, DICTIONARY, cfg).table.drop("_rid")
    assert sorted(map(str, again.collect())) == sorted(map(str, cleaned[0].select(*[c(n) for n in again.columns]).collect()))


@pytest.mark.parametrize("skip", [False, True])
def test_row_dedup_modes(spark, tmp_path, skip):
    path = write(tmp_path / "x.csv", HEADER, [*ADMISSIONS, admission("AAAA-0001", "k9", when="2024-04-01 08:00:00", ga="")])
    raw, header = csv_text.scan_csv(spark, path)
    cfg = RunConfig(dedup_mode="current", skip_patient_dedup=skip)
    rows = [r["uniquekey"] for r in runner.clean_table(raw, header, DICTIONARY, cfg).table.collect()]
    assert sorted(rows) == (["k1", "k2", "k3", "k4", "k5", "k8", "k9"] if skip else ["k1", "k2", "k4", "k5", "k8"])


def test_gate(spark):
    cfg = RunConfig()
    ok = spark.createDataFrame([("AAAA-0001", "fine")], "uid string, notes string")
    pii.assert_no_pii(ok, "t", DICTIONARY, cfg)
    for df in (ok.withColumn("motherdob.value", F.lit("x")), ok.withColumn("secret", F.lit("x")),
               ok.withColumn("notes", F.lit("id MW12AB34")), ok.withColumn("babyname", F.lit("x"))):
        with pytest.raises(pii.PersonalDataFound, match="Nothing has been written"):
            pii.assert_no_pii(df, "t", DICTIONARY, cfg)
    ids = ok.withColumn("uid", F.lit("ABCD1234"))
    pii.assert_no_pii(ids, "t", DICTIONARY, cfg)
    with pytest.raises(pii.PersonalDataFound):
        sinks.write_table(ok.withColumn("notes", F.lit("a@b.org")), "/nonexistent/x", "t", DICTIONARY, cfg)


def test_manifests_refuse_other_input(spark, tmp_path):
    source = write(tmp_path / "adm.csv", ["a"], [["1"]])
    keys = spark.range(3).toDF("rec")
    store = str(tmp_path / "keys")
    with pytest.raises(manifest.StaleInput, match="not found"):
        manifest.read_keys(spark, store, source, "d0")
    manifest.write_keys(keys, store, source, "d0", "d0")
    assert manifest.read_keys(spark, store, source, "d0").count() == 3
    with pytest.raises(manifest.StaleInput, match="dictionary"):
        manifest.read_keys(spark, store, source, "d1")
    with pytest.raises(manifest.StaleInput, match="changed during the run"):
        manifest.write_keys(keys, store, source, "d1", "d0")
    write(source, ["a"], [["1"], ["2"]])
    os.utime(source, (time.time() + 5, time.time() + 5))
    with pytest.raises(manifest.StaleInput, match="input"):
        manifest.read_keys(spark, store, source, "d0")
    with pytest.raises(manifest.StaleInput):
        manifest.assert_deidentified(spark, str(tmp_path / "marker"), source, "d0")


def test_duplicate_headers_and_twins(spark, tmp_path):
    path = write(tmp_path / "d.csv", ["a", "A", "a", "b", "b.value", "b.label"],
                 [["1", "", "9", "x", "", "l"], ["", "2", "3", "", "y", "l"], ["4", "5", "", "", "z", "l"]])
    raw, header = csv_text.scan_csv(spark, path)
    assert header == ["a", "A", "a", "b", "b.value", "b.label"]
    cfg = RunConfig()
    plan = plan_header(header, cfg)
    df = merge_duplicates(raw.select(*[F.col(f"c{i}") for i, _ in plan]), [n for _, n in plan])
    assert df.columns == ["a", "b", "b.value", "b.label"]
    assert [r["a"] for r in df.collect()] == ["1", "2", "4"]
    assert resolve_twins(df).columns == ["a", "b.value"]
    assert non_null_counts(df)["b.value"] == 2
    assert twin_choice(["b", "b.value", "c.value", "d.x", "d.y"], {"b": 2, "b.value": 2}) == ["b", "c.value", "d.x"]


def test_header_plan():
    cfg = RunConfig(reserved_renames={"facility.value": "facilityname.value"}, metadata_columns=("scriptid",))
    assert plan_header(["Facility", "Facility.value", "ScriptID", "X.parentKey"], cfg) == [(0, "facility"), (1, "facilityname.value")]
    assert undocumented(["uid", "Gender.value", "New.value"], DICTIONARY, cfg) == ["new.value"]
    lists = DICTIONARY.type_lists(cfg)
    assert [column_type(n, lists) for n in ("birthweight", "gender.valuedischarge", "startedat", "uid", "other")] == [
        "numeric", "categorical", "datetime", "unchanged", "unchanged"]
    with pytest.raises(ValueError, match="would both be named"):
        output_names(["x.value", "x.valuedischarge"])
    with pytest.raises(ValueError, match="would both be named"):
        harmonised_names(["a", "b"], {"a": "c", "b": "c"})


NAMES = {
    "mwi_admissions_2026-10-08.csv": ("MWI", "auto", "admissions"), "mwi_db_admissions_20260501.csv": ("MWI", "database", "admissions"),
    "zim_mb_maternal_outcomes_2026-05-01.csv": ("ZIM", "metabase", "maternal_outcomes"),
    "mwi_db_dhis2_maternal_outcomes_202608041252.csv": ("MWI", "database", "dhis2_maternal_outcomes"),
    "zim_db_twenty_8_day_follow_up_20260501.csv": ("ZIM", "database", "twenty_8_day_follow_up"),
    "ZIM_MB_PHC_Discharges_2026-05-01.csv": ("ZIM", "metabase", "phc_discharges"),
    "notes.csv": None, "zim_admissions.csv": None, "ken_admissions_2026-10-08.csv": None,
    "zim_admissions_2026-10-08.xlsx": None, "zim_admissions_08-10-2026.csv": None,
}


def test_file_names(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string").select("n", parse_file_name(F.col("n")).alias("p"))
    assert {r["n"]: r["p"] and (r["p"]["country"], r["p"]["source"], r["p"]["dataset"]) for r in df.collect()} == NAMES


def test_pairs_roles_and_dictionaries(spark, tmp_path):
    for n in ("zim_admissions_2026-10-08.csv", "zim_discharges_2026-10-08.csv", "mwi_admissions_2026-10-08.csv",
              "mwi_discharges_2026-10-09.csv", "mwi_phc_admissions_2026-10-08.csv", "mwi_phc_discharges_2026-10-08.csv",
              "zim_db_admissions_20261008.csv", "zim_db_discharges_202610081201.csv", "zim_baseline_2026-10-08.csv"):
        write(tmp_path / n, ["a"], [["1"]])
    plan = runner.plan_batch(spark, str(tmp_path))
    pairs = {r["file_name"]: r["paired_file"] for r in plan.collect()}
    assert pairs["zim_admissions_2026-10-08.csv"] == "zim_discharges_2026-10-08.csv"
    assert pairs["mwi_admissions_2026-10-08.csv"] == "mwi_discharges_2026-10-09.csv"
    assert pairs["mwi_phc_admissions_2026-10-08.csv"] == "mwi_phc_discharges_2026-10-08.csv"
    assert pairs["zim_db_admissions_20261008.csv"] == "zim_db_discharges_202610081201.csv"
    assert pairs["zim_baseline_2026-10-08.csv"] is None
    have = spark.createDataFrame([("ZIM", "admissions", "p1")], "country string, dataset string, path string")
    found = {r["file_name"]: (r["dictionary"], r["run"]) for r in resolve_dictionaries(plan, have).collect()}
    assert found["zim_baseline_2026-10-08.csv"] == ("p1", True) and found["mwi_admissions_2026-10-08.csv"] == (None, False)
    assert episode_role("phc_admissions") == "admissions" and episode_role("baseline") is None
    assert episode_role("maternal_outcomes", "ZIM") == "births" and episode_role("maternal_outcomes", "MWI") is None
    assert registry(spark).count() == 12


def test_separators(spark):
    assert separator_class([",", "^", "]", "-"]) == "[\\,\\^\\]\\-]" and separator_class([]) is None
    df = spark.createDataFrame([("AB12^77",), ("AB12-77",), ("A^B^C",)], "uid string")
    assert [r[0] for r in df.select(repair_id(F.col("uid"), ["^"])).collect()] == ["AB12-77", "AB12-77", "A^B^C"]


def test_styles(spark, tmp_path):
    def style(header, rows):
        return csv_text.detect_style(*csv_text.scan_csv(spark, write(tmp_path / "s.csv", header, rows)))

    snake, title = ["uid", "unique_key", "started_at", "BW.value"], ["UID", "Unique Key", "Started At", "BW.value"]
    iso, month = ["A1", "k1", "2026-03-02 00:33:10", "3500"], ["A1", "k1", "2 March 2026, 12:33 AM", "3500"]
    assert style(snake, [iso]) == "database" and style(title, [month]) == "metabase"
    assert style(title, [iso]) == "mixed" and style(snake, [month]) == "mixed"
    assert style(snake, [[*iso[:3], "3,500"]]) == "mixed" and style(["a"], [["b"]]) == "unknown"


def test_scripts(spark, tmp_path):
    (tmp_path / "one-metadata.json").write_text("""{"scriptId": "S1", "title": "Form", "screens": [
      {"title": "A", "condition": "$X = 1", "fields": [{"key": "Sex_a", "label": "Sex", "condition": "$Y = 2", "optional": true,
        "options": [{"value": "M", "valueLabel": "Male"}]}, {"key": "Age"}]}, {"title": "B", "fields": [{"key": "Sex_a", "condition": "$Z = 3"}]}]}""")
    (tmp_path / "two-metadata.json").write_text("""[{"scriptId": "S2", "screens": [{"fields": [{"key": "K"}]}]}]""")
    (tmp_path / "bad-metadata.json").write_text("{ not json")
    scripts = read_scripts(spark, str(tmp_path), "ZIM")
    assert [r["file_name"] for r in scripts.filter("_corrupt IS NOT NULL").collect()] == ["bad-metadata.json"]
    fields = script_fields(scripts.filter("scriptId IS NOT NULL"))
    got = {(r["script_id"], r["field_key_lower"]): r["condition"] for r in reasons.first_conditions(fields).collect()}
    assert got == {("S1", "sexa"): "($X = 1) and ($Y = 2)", ("S1", "age"): "$X = 1"}
    first = fields.filter("field_key = 'Sex_a'").orderBy("screen_idx").first()
    assert first["options_str"] == "M|Male" and first["options_text"] == "M=Male" and first["screen_title"] == "A"


def test_reason_priority(spark):
    df = spark.createDataFrame([(None, "a@b.org", True), (None, "a@b.org", False), (None, "x", False), (None, "x", None),
                                (None, " NA ", True), (None, None, True), ("v", "v", False)], "clean string, raw string, shown boolean")
    got = [r[0] for r in df.select(reasons.reason_code(F.col("clean"), F.col("raw"), F.col("shown"))).collect()]
    assert got == [-6, -6, -7, -8, -9, -9, None]


def test_batch_reads_scripts(spark, tmp_path):
    """A batch with form scripts gives -7 where the form did not show a field, and reports broken rows."""
    inputs = tmp_path / "in"
    inputs.mkdir()
    path = write(inputs / "zim_admissions_2026-10-08.csv", ["uid", "facility", "unique_key", "gender.value", "twin.value"],
                 [["AAAA-0001", "H1", "k1", "M", ""], ["AAAA-0002", "H1", "k2", "F", ""], ["AAAA-0003", "H2", "k3", "F", ""]])
    with open(path, "a") as out:
        out.write("AAAA-0004,H1\n")
    folder = tmp_path / "scripts" / "ZIM"
    folder.mkdir(parents=True)
    (folder / "one-metadata.json").write_text("""{"scriptId": "S1", "title": "Form", "screens": [
      {"title": "A", "fields": [{"key": "Gender"}, {"key": "Twin", "condition": "$Gender = 'M'"}]}]}""")
    scripts = spark.createDataFrame([("ZIM", "admissions", "h1", "S1")], "country string, dataset string, facility string, script_id string")
    lines = runner.run_batch(spark, str(inputs), str(tmp_path / "out"), {("ZIM", "admissions"): DICTIONARY},
                             RunConfig(dedup_mode="current"), scripts=str(tmp_path / "scripts"), script_map=scripts)
    assert [x["status"] for x in lines] == ["ok"], lines
    done = f"{tmp_path}/out/zim_admissions_2026-10-08"
    codes = spark.read.option("header", True).csv(f"{done}/na_reasons").collect()
    assert {r["uid"]: r["twin"] for r in codes} == {"AAAA-0001": "-9", "AAAA-0002": "-7", "AAAA-0003": "-9"}
    assert [(r.problem, r.n_cells) for r in spark.read.parquet(f"{done}/unreadable").collect()] == [("short", 2)]
    broken = spark.read.parquet(f"{done}/metrics").filter("step = 'scan'").collect()
    assert [(r["metric"], r["n"]) for r in broken] == [("short", 1)]
    assert runner.form_conditions(spark, str(tmp_path / "scripts"), "MWI") is None


def test_skip_logic_in_a_run(spark, tmp_path):
    path = write(tmp_path / "s.csv", ["uid", "facility", "unique_key", "gender.value", "twin.value"],
                 [["AAAA-0001", "H1", "k1", "M", ""], ["AAAA-0002", "H1", "k2", "F", ""], ["AAAA-0003", "H2", "k3", "F", ""]])
    raw, header = csv_text.scan_csv(spark, path)
    cfg = RunConfig(country="ZIM", dataset="admissions", dedup_mode="current")
    result = runner.clean_table(raw, header, DICTIONARY, cfg)
    conditions = spark.createDataFrame([("S1", "twin", "$Gender = 'M'"), ("S1", "gender", "Gender = 'M'")],
                                       "script_id string, field_key_lower string, condition string")
    scripts = spark.createDataFrame([("ZIM", "admissions", "h1", "S1")], "country string, dataset string, facility string, script_id string")
    out = runner.code_reasons(result, runner.raw_names(raw, header, cfg), cfg, conditions, scripts)
    assert {r["uid"]: r["twin"] for r in out.wide.collect()} == {"AAAA-0001": -9, "AAAA-0002": -7, "AAAA-0003": -9}
    assert out.untranslated == ["Gender = 'M'"]
