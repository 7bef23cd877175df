"""Dictionary build, patches, enrichment and checks on a tiny invented key set."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.operators import dictionary_build as build
from sluice.operators import pii
from sluice.operators.dictionary_checks import REQUIRED, assert_dictionary, check_dictionary, missing_columns
from sluice.operators.pii import (PersonalDataFound, assert_terms_gone, scrub_term_table, scrub_terms, term_patterns,
                                  term_rows_left, terms_left)
from sluice.sources.keys import DATA_KEYS

SCOPE = ["ZIM", "admissions"]


@pytest.fixture(scope="module")
def keys(spark):
    def key(uid, name, kind, options=(), when=1, **more):
        return (uid, name, more.get("label", name), kind, list(options), more.get("confidential", False),
                more.get("deleted", False), more.get("draft", False), datetime(2024, when, 1))

    rows = [key("K1", "Gender", "dropdown", ["O1", "O2"], 1), key("K2", "gender", "dropdown", ["O2", "O3", "none"], 2),
            key("K3", "BirthWeight", "number"), key("K4", "Apgar5", "number"), key("K5", "MotherName", "text", confidential=True),
            key("K6", "HomeVillage", "text"), key("K7", "Twin", "yesno", draft=True), key("K8", "HospNum", "gadget"),
            key("K9", "Gone", "text", deleted=True), key("uid", "uid", "text"),
            key("O1", " M ", "option", label="Male"), key("O2", "F", "option", label="Female"),
            key("O3", "U", "option", label="Unsure"), key("O4", "m", "option", label="Male")]
    usage = [(k, t) for k in ("K1", "K2", "K3", "K4", "K5", "K6", "K7", "K8", "K9", "uid") for t in ("Ward Admission", "Night admission")]
    usage += [("K3", "Discharge form"), ("K4", "Register")]
    return (spark.createDataFrame(rows, DATA_KEYS).withColumn("country", F.lit("ZIM")),
            spark.createDataFrame([("ZIM", *u) for u in usage], "country string, datakeyuniquekey string, scripttitle string"))


@pytest.fixture(scope="module")
def variables(keys):
    return build.assign_pii_tiers(build.apply_ranges(build.build_variables(*keys))).cache()


def by_key(df, dataset="admissions"):
    return {r["question_key"]: r for r in df.filter(F.col("dataset") == dataset).collect()}


def test_variables(variables):
    v = by_key(variables)
    assert set(v) == {"gender", "birthweight", "apgar5", "mothername", "homevillage", "twin", "hospnum", "uid"}
    assert v["gender"]["key_unique_key"] == "K2" and v["gender"]["r_type"] == "categorical"
    assert v["gender"]["section"] == "Night admission; Ward Admission"
    assert v["birthweight"]["weight_unit"] == "grams" and v["birthweight"]["harmonised_variable_name"] == "birth_weight"
    assert (v["apgar5"]["suggested_plausible_min"], v["apgar5"]["suggested_plausible_max"]) == (0.0, 10.0)
    assert v["hospnum"]["r_type"] is None and v["hospnum"]["pii_tier"] == "2"
    assert v["mothername"]["pii_tier"] == "1" and v["homevillage"]["pii_tier"] == "quasi"
    assert not v["twin"]["use_in_analysis"] and not v["homevillage"]["use_in_analysis"] and v["gender"]["use_in_analysis"]
    assert v["uid"]["record_id_role"] == "record_uid" and v["uid"]["linkage_role"] == "primary_linkage_key"
    assert set(by_key(variables, "discharges")) == {"birthweight"}


def test_override_picks_the_listed_key(spark, keys):
    o = spark.createDataFrame([("ZIM", "admissions", "gender", "K1")], "country string, dataset string, question_key string, uniqueKey string")
    assert by_key(build.build_variables(*keys, overrides=o))["gender"]["key_unique_key"] == "K1"


def test_value_maps(keys, variables):
    maps = build.build_value_maps(variables, keys[0]).filter("dataset = 'admissions'").orderBy("option_order").collect()
    assert [(r["raw_code"], r["option_label"], r["option_order"]) for r in maps] == [
        ("F", "Female", 1), ("U", "Unsure", 2), ("M", "Male", 3)]


def test_ranges_and_appended_rows(spark, variables):
    user = spark.createDataFrame([("apgar5", 1.0, None), (" birthweight ", None, None)],
                                 "question_key string, suggested_plausible_min double, suggested_plausible_max double")
    v = by_key(build.apply_ranges(variables, user))
    assert (v["apgar5"]["suggested_plausible_min"], v["apgar5"]["suggested_plausible_max"]) == (1.0, None)
    extra = spark.createDataFrame([(*SCOPE, "aw", "numeric"), (*SCOPE, "gender", "object")],
                                  "country string, dataset string, question_key string, r_type string")
    v = by_key(build.append_variables(variables, extra))
    assert v["aw"]["r_type"] == "numeric" and v["gender"]["r_type"] == "categorical"
    patch = spark.createDataFrame([(*SCOPE, "twin", "boolean", True)],
                                  "country string, dataset string, question_key string, r_type string, use_in_analysis boolean")
    v = by_key(build.patch_variables(variables, patch))
    assert v["twin"]["use_in_analysis"] and v["gender"]["r_type"] == "categorical"


def test_value_map_patches(spark, keys, variables):
    maps = build.build_value_maps(variables, keys[0]).filter("dataset = 'admissions'")
    schema = "country string, dataset string, question_key string, raw_code string, option_label string, option_order int, canonical_code string"
    add = spark.createDataFrame([(*SCOPE, "gender", "F", "Fem.", 1, "F"), (*SCOPE, "gender", "Z", "Male", 2, "Z")], schema)
    canonical = spark.createDataFrame([(*SCOPE, "gender", "U", "NK")], "country string, dataset string, question_key string, raw_code string, canonical_code string")
    keep = spark.createDataFrame([(*SCOPE, "gender", "F", "Fem.")], "country string, dataset string, question_key string, raw_code string, option_label string")
    out = build.patch_value_maps(maps, add, canonical, keep).orderBy("option_order").collect()
    assert [(r["raw_code"], r["option_label"], r["option_order"], r["canonical_code"]) for r in out] == [
        ("U", "Unsure", 2, "NK"), ("M", "Male", 3, "M"), ("F", "Fem.", 4, "F")]


def test_review_and_checks(spark, keys, variables):
    maps = build.build_value_maps(variables, keys[0])
    review = {(r["dataset"], r["question_key"]): r["review_reason"] for r in build.review_needed(variables, maps).collect()}
    assert review == {("admissions", "birthweight"): "Numeric without plausible range", ("discharges", "birthweight"): "Numeric without plausible range",
                      ("admissions", "hospnum"): "Unknown dataType (not in PIPELINE_TYPE_MAP)"}
    patterns = spark.createDataFrame([("a",), ("a",), (" ",)], "pattern string")
    expected = spark.createDataFrame([("apgar5", 0.0, 9.0)], "question_key string, suggested_plausible_min double, suggested_plausible_max double")
    checks = check_dictionary(variables, maps.unionByName(maps.limit(1).withColumn("question_key", F.lit("ghost"))), patterns, expected)
    bad = {(r["table"], r["check"]): r["n_bad"] for r in checks.collect() if r["n_bad"]}
    assert bad == {("variables", "analysis rows without r_type"): 1, ("value_maps", "keys not in variables"): 1,
                   ("pii_patterns", "blank pattern"): 1, ("pii_patterns", "duplicate pattern"): 1,
                   ("variables", "range differs from the expected one"): 1}
    with pytest.raises(ValueError, match="blank pattern"):
        assert_dictionary(checks)
    assert "cleaning_note" not in missing_columns({"variables": variables})["variables"]
    assert missing_columns({"value_maps": maps}) == {} and len(REQUIRED["variables"]) == 22


FIELDS = [
    ("gender", 0, 2, 1, "Sex", "", "M|Male;F|Female", "M=Male", True, "A"), ("gender", 1, 0, 0, "Sex", "$X = 1", "F|Female", "F=F", True, "A"),
    ("gender", 2, 5, 3, "Gender", "$X = 1", "F|Female", "", True, "B"), ("apgar5", 0, 1, 4, "", "", "", "", True, ""),
    ("apgar5", 1, 1, 2, "Apgar", "", "", "", False, "Vitals"),
]


@pytest.fixture(scope="module")
def fields(spark):
    return spark.createDataFrame([(*SCOPE, *f) for f in FIELDS],
                                 "country string, dataset string, question_key string, form_order int, screen_idx int, field_idx int, "
                                 "display_label string, skip_condition string, options_str string, options_text string, optional boolean, screen_title string")


def test_enrichment(keys, variables, fields):
    maps = build.build_value_maps(variables, keys[0])
    v = by_key(build.enrich_variables(variables, fields, maps))
    assert (v["gender"]["display_label"], v["gender"]["skip_condition"], v["gender"]["optional"], v["gender"]["valuemap_check"]) == (
        "Sex", "$X = 1", True, True)
    assert v["apgar5"]["optional"] is None and v["apgar5"]["valuemap_check"] is None and v["twin"]["display_label"] is None


def test_user_dictionary(keys, variables, fields):
    maps = build.build_value_maps(variables, keys[0])
    order = build.consensus_order(fields, ["country", "dataset", "question_key"])
    place = {r["question_key"]: (r["screen_title"], r["screen_idx"], r["field_idx"], r["json_label"], r["options_text"]) for r in order.collect()}
    assert place == {"gender": ("A", 0, 0, "Sex", "M=Male"), "apgar5": ("Other", 1, 2, "Apgar", "")}
    rows = {r["question_key"]: r for r in build.user_dictionary(variables, order, maps).collect()}
    assert rows["gender"]["values_and_codes"] == "F = Female\nU = Unsure\nM = Male" and rows["gender"]["type"] == "Categorical"
    assert rows["gender"]["na_codes"].split("\n") == ["-9 (unknown / missing)", "-8 (invalid / out of range)", "-7 (not applicable, skip logic)"]
    assert rows["apgar5"]["values_and_codes"] == "Range: 0 to 10" and rows["apgar5"]["description"] == "Apgar"
    master = build.master_rows(build.user_dictionary(variables, order, maps), ["discharges", "admissions"])
    assert master.count() == 2


def test_carry_over(variables, fields):
    enriched = variables.withColumn("display_label", F.lit("x"))
    assert "display_label" in build.carry_over(variables, enriched, ["display_label"], 1.0, 2.0).columns
    assert "display_label" not in build.carry_over(variables, enriched, ["display_label"], 2.0, 1.0).columns
    fewer = enriched.filter("question_key <> 'twin'")
    assert "display_label" not in build.carry_over(variables, fewer, ["display_label"], 1.0, 2.0).columns


def test_titles(spark):
    df = spark.createDataFrame([("Form of Dr Roe (Dr Roe)",)], "scripttitle string")
    assert build.replace_titles(df, [("Dr Roe", "A"), ("(Dr Roe)", "B")]).first()[0] == "Form of A B"


def test_scrubbing(spark):
    patterns = term_patterns(["Jane Roe", "Roe", "a.b"])
    df = spark.createDataFrame([("jane roe and Roe, roe Roe_1 aXb a.b",)], "t string")
    out = df.select(scrub_terms(F.col("t"), patterns).alias("t"))
    assert out.first()[0] == "[staff] and [staff], roe Roe_1 aXb [staff]"
    assert_terms_gone(out, ["t"], patterns)
    with pytest.raises(PersonalDataFound):
        assert_terms_gone(df, ["t"], patterns)


def test_term_table_equals_patterns(spark):
    draw = random.Random(11)
    words = ["Ada", "ada", "Roe", "van", "Dr.", "x_1", "a.b", "(Li)", "Ünal", "李", "明", "it", "is", "C++"]
    terms = {" ".join(draw.choices(words, k=draw.choice((1, 1, 2, 3, 5, 6)))) for _ in range(60)} | {"李明", "Ada\tRoe", "a|b", "\\E"}
    texts = [draw.choice(("", " ")).join(draw.choices([*words, ",", " ", "\n", "ROE", "VAN"], k=draw.randrange(30))) for _ in range(300)]
    texts += [None, "", " ", "李明", "我李明说", "ada  roe", "Ada\tRoe", "it is Ada Roe, Ada Roe", "Ada " * 20_000, *texts[:9]]
    rows = [(t, f"note {i % 3}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "`t.value` string, term string")
    listed = spark.createDataFrame([(t, 1) for t in [*terms, *terms, None, "", "  ", " Roe "]], "term string, _key int")
    patterns = term_patterns([*terms, "Roe"])
    want = df.select(scrub_terms(F.col("`t.value`"), patterns).alias("t"), "term").collect()
    got = scrub_term_table(df, "t.value", listed)
    assert got.columns == df.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want)))
    left = sum(r["n"] for r in df.select(terms_left(F.col("`t.value`"), patterns).cast("int").alias("n")).collect() if r["n"])
    assert left > 100 and term_rows_left(df, "t.value", listed).count() == left
    # "C++Ada": the first term stands free only once the second is replaced; such rows are reported.
    freed = got.filter(terms_left(F.col("`t.value`"), patterns)).count()
    assert 0 < freed < left and term_rows_left(got, "t.value", listed).count() == freed
    assert scrub_term_table(df.limit(0), "t.value", listed).isEmpty()
    assert scrub_term_table(df, "t.value", listed.limit(0)).count() == len(rows)


def test_many_terms(spark):
    listed = spark.range(100_000).selectExpr("concat('Name', id, ' of ', id % 7) AS term")
    df = spark.range(2_000).selectExpr("id", "concat('seen by name', id * 50, ' OF ', (id * 50) % 7, ', not by Name', id, ' of 9') AS t")
    got = {r["id"]: r["t"] for r in scrub_term_table(df, "t", listed).collect()}
    assert all(t == f"seen by [staff], not by Name{i} of 9" for i, t in got.items()) and len(got) == 2_000


@pytest.mark.parametrize("room", [1 << 24, 900, 0])
def test_term_table_near_and_far(spark, monkeypatch, room):
    """The same texts whether all, some or no terms are sent to every task; small tables shuffle no words of a text."""
    monkeypatch.setattr(pii, "BROADCAST_BYTES", room)
    draw = random.Random(5)
    words = ["Ada", "ada", "Roe", "van", "x_1", "a.b", "(Li)", "李", "it", "C++", "staff"]
    terms = sorted({" ".join(draw.choices(words, k=draw.choice((1, 1, 2, 3, 4, 6)))) for _ in range(50)} | {"staff", "ada roe", "x van"})
    texts = [" ".join(draw.choices([*words, ",", "-", "VAN", "Staff"], k=draw.randrange(25))) for _ in range(200)] + [None, "", "ada van"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(3)
    listed = pii.TermTable(spark.createDataFrame([(t,) for t in terms], "term string"))
    assert bool(listed.far_sizes) == (room < 1 << 24) and (listed.near is None) == (room == 0)
    patterns = term_patterns(terms)
    # "staff" is looked for only where the text itself holds it, not where the placeholder alone does.
    out = scrub_term_table(df, "t", listed)
    want = {r["id"]: (r["t"], r["n"]) for r in df.select("id", *[
        F.when(F.col("t").rlike(r"(?i)(?<![A-Za-z0-9_])staff(?![A-Za-z0-9_])"), scrub_terms(F.col("t"), patterns))
        .otherwise(scrub_terms(F.col("t"), term_patterns([x for x in terms if x != "staff"]))).alias("t"),
        F.coalesce(terms_left(F.col("t"), patterns), F.lit(False)).alias("n")]).collect()}
    got = {r["id"]: (r["t"], r["n"]) for r in pii.with_terms_left(df, "t", listed, "n").withColumnRenamed("t", "raw")
           .join(out, "id").select("id", "t", "n").collect()}
    assert got == want and sum(n for _, n in got.values()) > 50
    if room == 1 << 24:
        plan = scrub_term_table(df.filter("id >= 0"), "t", listed)._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "Join" not in plan
