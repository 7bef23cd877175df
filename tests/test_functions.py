"""Known answers of the column functions."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.functions import categories, conditions, identity, labels, pii, ranges, text, values
from sluice.functions.shapes import datetime_class, datetime_shape, numeric_shape, parse_boolean


def column(spark, cells, expr):
    """Results of ``expr`` over one text column, in order."""
    df = spark.createDataFrame(list(enumerate(cells)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x")).alias("y")).collect()]


MONTHS = "January February March April May June July August September October November December".split()
BLANK = ["", None]


def clock(t, rnd):
    """Text of a time of day, by 24 or by twice 12 hours."""
    return rnd.choice([f"{t.hour:02}:{t.minute:02}", f"{(t.hour - 1) % 12 + 1}:{t.minute:02}{rnd.choice(['', ' '])}{'AM' if t.hour < 12 else 'PM'}"])


def dated(rnd):
    """(cell, value, class) for each rule of dates, from one drawn moment."""
    t = datetime(rnd.randrange(2001, 2060), rnd.randrange(1, 13), rnd.randrange(1, 29), rnd.randrange(24), rnd.randrange(60), rnd.randrange(60))
    day, minute = t.replace(hour=0, minute=0, second=0), t.replace(second=0)
    iso, sep, month = f"{t:%Y-%m-%d}", rnd.choice("/.-"), MONTHS[t.month - 1][:rnd.choice([3, 9])]
    part = rnd.randrange(1, 1000)
    yield from ((iso, day, "iso"), (f"{iso} {t:%H:%M}", minute, "iso"), (f"{iso}{rnd.choice(' T')}{t:%H:%M:%S}", t, "iso"),
                (f"{iso}T{t:%H:%M:%S}.{part:03}", t.replace(microsecond=part * 1000), "iso"))
    # An offset is dropped, not applied.
    yield f"{iso}T{t:%H:%M:%S}{rnd.choice(['Z', f'{rnd.choice("+-")}{rnd.randrange(13):02}:30'])}", t, "iso"
    first = f"{t.day:02}{sep}{t.month:02}{sep}"
    yield from ((f"{first}{t.year}", day, "day_first"), (f"{first}{t.year % 100:02}", day, "day_first"), (f"{first}{t.year} {clock(t, rnd)}", minute, "day_first"))
    yield from ((f"{t.day} {month} {t.year}", day, "month_name"), (f"{t.day}-{month}-{t.year}", day, "month_name"),
                (f"{month} {t.day}, {t.year}, {clock(t, rnd)}", minute, "month_name"), (f"{t.day} {month} {t.year}, {clock(t, rnd)}", minute, "month_name"))
    # Only readable with the month in front, days that no month has, hours that no half day has, and what is no date as a whole.
    yield f"{t.month}{sep}{rnd.randrange(13, 32)}{sep}{t.year}", None, "month_first"
    short = rnd.choice([4, 6, 9, 11])
    for cell in (f"31{sep}{short}{sep}{t.year}", f"{t.year}-{short:02}-31", f"31 {MONTHS[short - 1]} {t.year}", f"{t.day} {month} {t.year}, {rnd.randrange(13, 24)}:00 PM",
                 f"on {t.day} {month} {t.year} or so", f"{t:%Y%m%d}", rnd.choice(["later", "next week"])):
        yield cell, None, "unparsed"


def test_datetimes(spark):
    rnd = random.Random(21)
    want = [row for _ in range(40) for row in dated(rnd)] + [(x, None, None) for x in BLANK]
    got = column(spark, [w[0] for w in want], lambda x: F.struct(datetime_shape(x)["value"], datetime_class(datetime_shape(x)), datetime_shape(x)["offset_dropped"]))
    assert [(w[0], *g[:2]) for w, g in zip(want, got)] == want
    assert [g[2] for g in got] == [w[2] == "iso" and bool(re.search("T.*(Z|[+-])", w[0])) for w in want]


def numbered(rnd):
    """(cell, value, shape) for each rule of numbers, from drawn digits."""
    a, b, big, sign = rnd.randrange(1, 1000), rnd.randrange(1, 100), rnd.randrange(1000, 10 ** 9), rnd.choice(["", "-"])
    word = "".join(rnd.choice("ghkmpqxz") for _ in range(rnd.randrange(1, 6)))
    rule = {"plain": [f"{sign}{a}", f"{sign}{a}.{b}", f" {a} ", f"{sign}.{b}"], "thousands": [f"{sign}{big:,}", f"{sign}{big:,}.{b}"],
            "decimal_comma": [f"{sign}{a},{b}"], "fallback": [f"{word}{a}", f"{a}.{b} {word}"],
            "multi_number": [f"{a}-{b}", f"{a}/{b}/{big}", f"{a}e{b}", f"{a},{b},{b}", f"{a}:{b}", f"{a} {word} {b}"], "non_numeric": [word, f"{word} {word}"]}
    for shape, cells in rule.items():
        for cell in cells:
            plain = cell.strip().strip(word + " ") if shape == "fallback" else cell.replace(",", "." if shape == "decimal_comma" else "")
            yield cell, None if shape in ("multi_number", "non_numeric") else float(plain), shape


def test_numbers(spark):
    rnd = random.Random(22)
    want = [row for _ in range(60) for row in numbered(rnd)] + [(x, None, None) for x in BLANK]
    got = column(spark, [w[0] for w in want], numeric_shape)
    assert [(w[0], g["value"], g["shape"]) for w, g in zip(want, got)] == want


def test_booleans(spark):
    cells = ["true", "YES", " y ", "1", "T", "false", "No", "n", "0", "f", "maybe", "", None]
    assert column(spark, cells, parse_boolean) == [True] * 5 + [False] * 5 + [None] * 3


def whole(cell):
    """A whole number that is not negative, else None."""
    return float(cell) if re.fullmatch(r"[0-9]+(\.0+)?", cell) else None


def plain_visits(value, label):
    """(count, source, category, conflict, cell afterwards) by the rule: the value counts, else a label that says a number."""
    text = label.strip().lower()
    said = re.fullmatch(r"([0-9]+) anc visits?", text)
    own, told = whole(value), 0.0 if text == "none" else float(said[1]) if said else whole(text)
    count = told if own is None else own
    many = re.fullmatch("more than [48] anc visits", text) is not None
    source = "raw_numeric_value" if own is not None else "raw_exact_label" if told is not None else "raw_range_label" if many else "unresolved"
    category = ("none" if count == 0 else "1_3" if count <= 3 else "ge4") if count is not None else "ge4" if many else None
    out = value if own is not None else str(int(told)) if told is not None else value if value == "" else None
    return count, source, category, None not in (own, told) and own != told, out


def test_visit_counts(spark):
    rnd = random.Random(23)
    pairs = []
    for _ in range(12):
        n, m = rnd.randrange(0, 12), rnd.randrange(0, 12)
        values_ = ["", str(n), f"{n}.0", f"{n}.25", f"-{n + 1}", "some"]
        labels_ = ["", str(m), f"{m}.5", f"-{m + 1}", f"{m} ANC visits", f" {m} anc visit", "None", "ANC visits", f"More than {rnd.choice([4, 8])} ANC visits",
                   "More than 6 ANC visits", "How many?", "Unsure"]
        pairs += [(v, lab) for v in values_ for lab in labels_]
    df = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, v string, l string")
    r = labels.visit_count(F.col("v"), F.col("l"))
    rows = df.select("i", "v", "l", r.alias("r")).withColumn("cat", labels.visit_category(F.col("r.count"), F.col("r.source"))) \
        .withColumn("out", labels.rule_value(F.col("v"), F.col("r"))).orderBy("i").collect()
    assert [(x["r"]["count"], x["r"]["source"], x["cat"], x["r"]["conflict"], x["out"]) for x in rows] == [plain_visits(*pair) for pair in pairs]
    assert all(x["r"]["invalid"] == (x["v"] != "" and whole(x["v"]) is None) for x in rows)


def test_unknown_label_rule():
    with pytest.raises(ValueError, match="unknown label-to-value rule"):
        labels.label_rule("nothing")


def test_label_fill(spark):
    cells = ["3,500", "3,5", "1000000", "4 visits", "25/12/2023", "Price?", "12", None]
    got = column(spark, cells, lambda x: labels.fill_number_or_datetime(F.lit(None).cast("string"), x))
    assert got == ["3500", "3.5", "1000000", None, "2023-12-25 00:00:00", None, "12", None]
    assert column(spark, ["Yes", "yes", "Normal"], lambda x: labels.fill_placeholder(F.lit(None).cast("string"), x)) == [
        "Yes", None, "Normal"]


def rows(*triples):
    return [dict(zip(("raw_code", "option_label", "canonical_code"), t)) for t in triples]


def test_value_map_precedence_and_ambiguity(spark):
    vm = values.build_value_map(rows(("Ab", "First", "Ab"), ("AB", "Second", "AB"), ("o", "old name", "New"),
                                     ("x", "gone", ""), ("c", "pair", "{Ab,New}")))
    cells = ["Ab", "AB", "ab", "O", "OLD NAME", "gone", "pair", "{o,pair}", "{o,zzz}", "what", "", None]
    got = column(spark, cells, lambda x: values.map_value(x, vm))
    assert [(g["value"], g["outcome"]) for g in got] == [
        ("Ab", "canonical"), ("AB", "canonical"), ("ab", "unresolved"), ("New", "replaced"), ("New", "replaced"),
        ("gone", "unresolved"), ("{Ab,New}", "replaced"), ("{New,Ab}", "list_replaced"), ("{o,zzz}", "list_unresolved"),
        ("what", "unresolved"), ("", None), (None, None)]


def test_yes_no_words_need_a_yes_no_field(spark):
    yes_no = values.build_value_map(rows(("Y", "Affirmative", "Y"), ("N", "Negative", "N"), ("U", "Unknown", "U")))
    other = values.build_value_map(rows(("Y", "Yellow", "Y"), ("G", "Green", "G")))
    assert column(spark, ["true", "F", "yes"], lambda x: values.map_value(x, yes_no)["value"]) == ["Y", "N", "Y"]
    assert column(spark, ["true"], lambda x: values.map_value(x, other)["outcome"]) == ["unresolved"]


def test_list_encodings(spark):
    """A list in brackets becomes one in braces if it is quoted, or if all its items are codes in any case."""
    rnd = random.Random(24)
    codes = ["Ox", "Wren", "HEN", "Elk", "Yak"]
    vm = values.build_value_map(rows(*((c, f"label {i}", c) for i, c in enumerate(codes))))
    cells, want, bare = [], [], []
    for _ in range(60):
        items = [rnd.choice([str.upper, str.lower, str])(rnd.choice(codes)) for _ in range(rnd.randrange(1, 5))]
        if rnd.random() < 0.4:
            items[rnd.randrange(len(items))] = rnd.choice(["emu", "two words"])
        gap, known = rnd.choice([",", ", "]), not {"emu", "two words"} & set(items)
        braces = "{" + ",".join(items) + "}"
        plain = f"[{gap.join(items)}]"
        for cell, result, without in ((plain, braces if known else plain, plain), ("[" + ",".join(f'"{x}"' for x in items) + "]", braces, braces), (braces, braces, braces), (items[0], items[0], items[0])):
            cells.append(cell), want.append(result), bare.append(without)
    assert column(spark, [*cells, None], lambda x: values.brace_list(x, vm)) == [*want, None]
    assert column(spark, cells, lambda x: values.brace_list(x, None)) == bare


def test_recodes(spark):
    assert column(spark, ["SVD", "CSPrLab", "7", "svd", None], values.recode) == ["1", "5", "7", "svd", None]
    assert column(spark, ["0 = Normal", "12=x", "2", "a = b"], values.strip_score_label) == ["0", "12", "2", "a = b"]


def test_ranges(spark):
    df = spark.createDataFrame([(2.5,), (20.0,), (0.0,), (3000.0,)], "x double")
    assert [r[0] for r in df.select(ranges.grams(F.col("x"))).collect()] == [2500.0, 20000.0, 0.0, 3000.0]
    assert [r[0] for r in df.select(ranges.positive_grams(F.col("x"))).collect()] == [2500.0, 20000.0, 0.0, 3000.0]
    one = spark.range(1)
    assert one.select(ranges.years_from_hours_entry(F.lit(219150.0))).first()[0] == 25.0
    assert [one.select(ranges.age_years(F.lit(h))).first()[0] for h in (219150.0, 8766.0, 876600.0)] == [25.0, None, None]
    assert [one.select(ranges.in_range(F.lit(5.0), a, b)).first()[0] for a, b in ((5, 5), (6, None), (None, 4))] == [5.0, None, None]


def test_categories(spark):
    cells = ["Name Of Birth Facility", "2024-01-01 10:00", "January 3", "None", " n/a ", "B", "bad", "ok"]
    assert column(spark, cells, lambda x: categories.clean_category(x, {"beta": ("B",)}, ("bad",))) == [
        None, None, None, None, None, "beta", None, "ok"]
    assert column(spark, cells[:1], lambda x: categories.clean_category(x, categorical=False)) == cells[:1]


def test_identity(spark):
    assert column(spark, ["male", " F", "x", None], identity.sex_letter) == ["M", "F", None, None]
    assert column(spark, ["Y", "true", "0", "", None], identity.yes_flag) == [True, True, False, None, None]
    assert column(spark, ["Live Birth", "STBM", "Stillbirth fresh", "misc", "DC"], identity.outcome_class) == [
        "live", "still", "still", "misc", None]
    assert column(spark, ["Tw1", "Tr3", "S"], identity.birth_order) == ["Tw1", "Tr3", None]
    assert column(spark, ["1", "26", "27"], lambda x: identity.entity_letter(x.cast("int"))) == ["A", "Z", "Z27"]


def drawn(rnd, letters, least, most=None):
    return "".join(rnd.choice(letters) for _ in range(rnd.randrange(least, (most or least) + 1)))


def shaped(rnd):
    """Pattern name, a cell of its shape and cells that miss it in one respect."""
    digits, capitals = "0123456789", "ABCDEFGHJKLMNPQRSTUVWXYZ"
    two, six, letter, end = drawn(rnd, digits, 2), drawn(rnd, digits, 6, 7), drawn(rnd, capitals, 1), drawn(rnd, digits, 2)
    a, b, c = (drawn(rnd, "- ", 0, 2) for _ in range(3))
    around = rnd.choice(["{}", "no. {} it is"])
    yield "zw_national_id", around.format(two + a + six + b + letter + c + end), [
        two + a + six[:5] + "-" + letter + c + end, two + a + six + b + letter + letter + c + end, letter + two + a + six + b + letter + c + end,
        two + a + six + b + letter + c + end + "0", two + a + six + b + c + end, two + "---" + six[:3] + "---" + letter + end]
    mixed = list(drawn(rnd, digits, 2) + drawn(rnd, capitals + capitals.lower(), 2) + drawn(rnd, digits + capitals, 4))
    rnd.shuffle(mixed)
    mixed = "".join(mixed)
    yield "mw_national_id", around.format(mixed), [mixed[:7], mixed + letter, mixed + "-1", drawn(rnd, capitals, 8), drawn(rnd, digits, 8), letter + drawn(rnd, digits, 7), drawn(rnd, capitals, 7) + end[:1]]
    tail, plus = drawn(rnd, digits, 9), rnd.choice(["", "+"])
    yield "phone_international", plus + rnd.choice(["263" + tail, "265" + tail[rnd.randrange(3):]]), [
        plus + "263" + tail[1:], plus + "263" + tail + "1", plus + "264" + tail, "++263" + tail, plus + "265" + tail[:6], tail, f"call {plus}263{tail}"]
    for name, second, other in (("phone_local_zw", "67", "12345089"), ("phone_local_mwi", "89", "12345067")):
        start = "0" + rnd.choice(second)
        yield name, rnd.choice(["", " "]) + start + tail[1:], [start + tail[2:], start + tail, "0" + rnd.choice(other) + tail[1:], "1" + start[1:] + tail[1:]]


def test_value_patterns(spark):
    rnd = random.Random(25)
    drawn_rows = [row for _ in range(60) for row in shaped(rnd)]
    for name in sorted({r[0] for r in drawn_rows}):
        yes, no = [r[1] for r in drawn_rows if r[0] == name], [x for r in drawn_rows if r[0] == name for x in r[2]]
        one = {name: pii.VALUE_PATTERNS[name]}
        assert column(spark, yes, lambda x: pii.value_pattern(x, one)) == [name] * len(yes)
        assert [x for x, hit in zip(no, column(spark, no, lambda x: pii.value_pattern(x, one))) if hit] == []
        assert column(spark, yes, pii.redact) == [None] * len(yes)


def test_name_patterns():
    yes = ["motherdob.label", "mothersdob.label", "matdob.value", "mumdob.value", "mathospnum.label", "firm.label", "concall.value"]
    no = ["motherdobest.value", "timeofbirth.value", "birthdob.value", "mumdob", "reaffirm.value", "firmly.value", "concall", "dataentrytime.value"]
    assert all(pii.matching_pattern(n, pii.NAME_PATTERNS) for n in yes)
    assert not [n for n in no if pii.matching_pattern(n, pii.NAME_PATTERNS)]


def test_candidate_names():
    assert pii.candidate_names("facilityname", {"facility.value": "facilityname.value"}) == ["facilityname", "facility.value"]
    assert pii.candidate_names("x.label") == ["x.label"]
    assert "motherdob.value" in pii.candidate_names("mother_dob", harmonised={"motherdob": "mother_dob"})


@pytest.mark.parametrize("condition,row,want", [
    ("$Sex = 'M'", {"sex": "M"}, True), ("$Sex = 'M'", {"sex": "F"}, False), ("$Sex = 'M'", {}, None),
    ("$Sex != 'M' or $Age > 3", {"age": "4"}, True), ("$Sex = 'M' and $Age > 3", {"sex": "F"}, False),
    ("!$Twin = 'Y'", {"twin": "N"}, True), ("!($Twin = 'Y' or $Age < 2)", {"twin": "N", "age": "1"}, False),
    ("$Twin_A = true", {"twina": "Yes"}, True), ('$Sex = "F"', {"sex": "F"}, True), ("$A = $B", {"sex": "x"}, None),
    ("$Age >= 2.6 and\n$Age <= 37", {"age": "10"}, True), ("$Sex = 'NND<24'", {"sex": "NND<24"}, True),
])
def test_conditions(spark, condition, row, want):
    columns = {k: k for k in ("sex", "age", "twin", "twina")}
    df = spark.createDataFrame([[row.get(k) for k in columns]], ", ".join(f"{k} string" for k in columns))
    assert df.select(F.expr(conditions.to_sql(condition, columns))).first()[0] == want


@pytest.mark.parametrize("text", ["$A ! = 'x'", "A = 'x'", "$A = 'x' $B = 'y'", "($A = 'x'", "$A = 'x' or", ""])
def test_malformed_conditions_are_reported(text):
    done, failed = conditions.compile_conditions([text], {"a": "a"})
    assert not done and failed == ([text] if text else [])


def test_combined_condition():
    assert conditions.combine("$A = 1", "$B = 2") == "($A = 1) and ($B = 2)"
    assert conditions.combine("", "$B\n= 2") == "$B = 2" and conditions.combine(None, "") == ""


def test_names(spark):
    assert text.header_name(" Baby Cry Tria Ge. Value") == "babycrytriage.value"
    assert text.header_name("unique_key") == "uniquekey" and text.lookup_key("Ga_x.valuedischarge") == "gax"
    assert text.snake_name("BabyCryTriage 2") == "baby_cry_triage_2"
    assert column(spark, ["BabyCryTriage 2"], text.snake_name_col) == ["baby_cry_triage_2"]
    assert column(spark, [" Ab_C-1 "], text.db_name_col) == ["abc1"]
    assert column(spark, [" a ", "", "NA", None], text.normalise_cell) == ["a", None, None, None]


# The three shapes that look anywhere in a text, spelled out with lookarounds only.
SPELLED = {
    "email": r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}",
    "zw_national_id": r"(?<![A-Za-z0-9])[0-9]{2}[- ]{0,2}[0-9]{6,7}[- ]{0,2}[A-Za-z][- ]{0,2}[0-9]{2}(?![A-Za-z0-9])",
    "mw_national_id": (r"(?<![A-Za-z0-9-])(?=(?:[A-Za-z0-9]*[A-Za-z]){2})(?=(?:[A-Za-z0-9]*[0-9]){2})"
                       r"[A-Za-z0-9]{8}(?![A-Za-z0-9-])"),
}


def test_text_patterns_equal_their_spelled_form(spark):
    rnd = random.Random(7)
    cells = ["".join(rnd.choice("aB1 2-3Z9é@.x0_") for _ in range(rnd.randrange(1, 40))) for _ in range(30_000)]
    cells += ["".join(rnd.choice("0123456789-  aB") for _ in range(rnd.randrange(10, 22))) for _ in range(30_000)]
    cells += ["".join(rnd.choice("01aB") for _ in range(rnd.randrange(7, 10))) + rnd.choice(["", "-", " x"]) for _ in range(10_000)]
    x = F.col("x")
    row = spark.createDataFrame([(v,) for v in cells], "x string").agg(
        *[F.count_if(x.rlike(p) != x.rlike(pii.VALUE_PATTERNS[n])).alias(n) for n, p in SPELLED.items()],
        *[F.count_if(x.rlike(p)).alias(n + "_hits") for n, p in SPELLED.items()]).first().asDict()
    assert all(row[n] == 0 and row[n + "_hits"] > 50 for n in SPELLED)
