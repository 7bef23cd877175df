"""Personal data replaced by keyed surrogates.

Found are e-mail addresses, phone numbers (international, and national with separators), card, account (IBAN) and
identity numbers, IP addresses of both versions, access keys, passwords, tokens, and names of up to three parts
after a title.  Where a document holds such a name, each part of it is replaced in all of its text, titled or not, by the same
surrogate.  A surrogate is made from a keyed hash of (kind, value): digits stay digits, letters stay letters of
their case and script, everything else stays as it is; octets stay octets, card numbers that pass the Luhn test pass it
again, account numbers keep their country and get its check digits, mail domains have surrogates of their own, and given names get the gender of the title (after
a title without one, the gender the name has elsewhere in the table, if it is one).  The same value gets the
same surrogate in every document.  All surrogates of a table are checked: one that equals another of its kind
or a value that really occurs is made again with the next attempt, until none does.

Null texts stay null and hold nothing; empty ones stay empty.  Rows are independent, so repeated rows, null ids and further
columns change nothing; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch

# Titles by gender.
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Señorita", "Sra", "Doña", "Madame", "Mme", "Mademoiselle", "Mlle", "Госпожа", "г-жа")
MALE = ("Mr", "Mister", "Sir", "Herr", "Señor", "Sr", "Don", "Monsieur", "Господин", "г-н")
NEUTRAL = ("Dr", "Doctor", "Doktor", "Prof", "Professor", "Mx", "Доктор", "Профессор")

_TITLES = "|".join((*FEMALE, *MALE, *NEUTRAL))
_NAME = f"(?!(?:{_TITLES})\\b)\\p{{Lu}}(?:\\p{{L}}|['-](?=\\p{{L}}{{2}})){{1,30}}"
# What may stand before a further part of a name; look-behinds take no repeated group.
_PART = "\\p{Lu}[\\p{L}'-]{1,30}"
#: Words and what is between them; a word is what a name can be.
TOKEN = "\\p{L}+(?:['-]\\p{L}{2,})*|\\P{L}+"
NAMES = ("given-f", "given-m", "given", "family")
_CARD = "\\d{4}(?:[ -]?\\d{4}){2}[ -]?\\d{1,7}|\\d{4}[ -]\\d{6}[ -]\\d{5}"
# The one-character tests in front decide at nearly every place, before any long look-behind is tried.
PATTERN = "|".join((
    "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}",
    "\\bAKIA[0-9A-Z]{16}\\b",
    "(?<=[=:] ?)(?<=\\b(?:password|passwd|pwd)(?:=|: ))[^\\s\"]+",
    "(?<=[=:] ?\"?)(?<=\\b(?:token|secret|api_key|apikey)(?: = \"|=\"|: \"|=))[A-Za-z0-9_-]{16,}",
    "(?=[+\\d])(?<![\\w+])(?:\\+?\\d{1,3}[ .-]?\\(\\d{2,4}\\)[ .-]?\\d{3,4}[ .-]?\\d{3,4}\\b"
    "|\\+\\d{1,3}(?:[ .-]?\\d{2,4}){2,4}\\b)",
    "(?=\\d)(?:(?<![\\w.])\\d{1,3}(?:\\.\\d{1,3}){3}(?![\\w]|\\.\\d)"
    "|(?<![\\w-])\\d{3}-\\d{2}-\\d{4}(?![\\w-])"
    f"|(?<![\\w-])(?:{_CARD})(?![\\w-])"
    # National numbers: the same separator twice, or a leading zero and nine digits at least.
    "|(?<![\\w.+/-])(?:\\d{3}([ .-])\\d{3}\\1\\d{4}|00[1-9]\\d{0,2}[ ./-](?:\\(0\\))?\\d{2,5}(?:[ ./-]?\\d{2,8}){1,4}"
    "|(?=0(?:[ /-]{0,3}\\d){8})0\\d{1,4}(?: ?/ ?|[ -])\\d{2,8}(?:[ -]\\d{2,8}){0,4})(?![\\w/-]|\\.\\d))",
    "(?=\\()(?<!\\w)\\(\\d{2,5}\\)[ .-]?\\d{3,4}[ .-]?\\d{3,5}\\b",
    "(?<![\\w:])(?=[0-9A-Fa-f]{0,4}:)(?=[A-Fa-f:]*\\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    "|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\\w:]|\\.\\d)",
    "(?=[A-Z]{2}\\d{2})(?<![\\w-])(?:[A-Z]{2}\\d{2}[A-Z0-9]{11,30}"
    "|[A-Z]{2}\\d{2} [A-Z0-9]{4}(?: (?=[A-Z]{0,3}\\d)[A-Z0-9]{4}){2,6}(?: (?=[A-Z]{0,2}\\d)[A-Z0-9]{1,3})?)(?![\\w-])",
    f"(?=\\p{{Lu}})(?<= )(?:(?<=\\b(?:{_TITLES})\\.? )|(?<=\\b(?:{_TITLES})\\.? {_PART} )|(?<=\\p{{Lu}}\\. )(?<=\\b(?:{_TITLES})\\.? {_PART} \\p{{Lu}}\\. )"
    f"|(?<={_PART} )(?<=\\b(?:{_TITLES})\\.? {_PART} {_PART} )){_NAME}",
))


def _kind(value: Column, gap: Column, gap_after: Column, next_value: Column) -> Column:
    capital = F.lit("^\\p{Lu}\\p{L}")
    given = (gap_after == " ") & F.coalesce(F.rlike(next_value, capital), F.lit(False))
    after_title = lambda titles: F.rlike(gap, F.lit(f"\\b(?:{'|'.join(titles)})\\.? $"))
    return (F.when(F.contains(value, F.lit("@")), "email")
            .when(F.rlike(gap, F.lit("(?:password|passwd|pwd)(?:=|: )$")), "password")
            .when(F.rlike(gap, F.lit("(?:token|secret|api_key|apikey)(?: = \"|=\"|: \"|=)$")), "token")
            .when(F.startswith(value, F.lit("AKIA")), "key")
            .when(F.rlike(value, F.lit("^\\d{1,3}(\\.\\d{1,3}){3}$")), "ip")
            .when(F.rlike(value, F.lit("^\\d{3}-\\d{2}-\\d{4}$")), "identity")
            .when(F.rlike(value, F.lit("^\\+|\\(")), "phone")
            .when(F.rlike(value, F.lit(f"^(?:{_CARD})$")), "card")
            .when(F.rlike(value, F.lit("^[0-9A-Fa-f]*:")), "ip6")
            .when(F.rlike(value, F.lit("^[A-Z]{2}\\d{2}")), "iban")
            .when(F.rlike(value, F.lit("^\\d")), "phone")
            .when(given & after_title(FEMALE), "given-f").when(given & after_title(MALE), "given-m").when(given & after_title(NEUTRAL), "given").otherwise("family"))


def _digits(parts: str) -> str:
    """SQL: keyed hash in hex, long enough for every character of ``value``."""
    return (f"array_join(transform(sequence(0, cast(length({parts}) / 64 AS int)), b -> "
            f"sha2(concat_ws('\\u0001', secret, kind, {parts}, cast(attempt AS string), cast(b AS string)), 512)), '')")


_SETS = (("[0-9]", "0123456789"), ("[a-f]", None), ("[A-F]", None), ("[a-z]", "abcdefghijklmnopqrstuvwxyz"), ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
         ("[\\\\u0430-\\\\u044f\\\\u0451]", "абвгдежзиклмнопрстуфхцчшэюя"), ("[\\\\u0410-\\\\u042f\\\\u0401]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
         ("\\\\p{Ll}", "àáâäçèéêëìíîïñòóôöùúûü"), ("\\\\p{Lu}", "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"))


def _same_classes(value: str, stream: str, keep: str = "0") -> str:
    """SQL: every letter and digit after the first ``keep`` replaced within its class.  Letters of a value that is
    hexadecimal stay hexadecimal."""
    cases = ""
    for pattern, letters in _SETS:
        if letters is None:
            whole = "^[0-9a-f]+$|^[0-9A-Fa-f]*:[0-9A-Fa-f:]*$" if pattern == "[a-f]" else "^[0-9A-Fa-f]*:[0-9A-Fa-f:]*$"
            cases += f"WHEN {value} RLIKE '{whole}' AND c RLIKE '{pattern}' THEN substring('{'abcdef' if pattern == '[a-f]' else 'ABCDEF'}', d % 6 + 1, 1) "
        else:
            cases += f"WHEN c RLIKE '{pattern}' THEN substring('{letters}', d % {len(letters)} + 1, 1) "
    one = (f"aggregate(array(named_struct('c', substring({value}, i, 1), 'd', cast(conv(substring({stream}, 2 * i - 1, 2), 16, 10) AS int))), '', "
           f"(a, x) -> CASE WHEN i <= {keep} THEN x.c {cases.replace('WHEN c ', 'WHEN x.c ').replace('AND c ', 'AND x.c ').replace('d %', 'x.d %')} ELSE x.c END)")
    return f"array_join(transform(sequence(1, greatest(length({value}), 1)), i -> {one}), '')"


_LUHN = ("pmod(aggregate(sequence(1, length({0})), 0, (s, i) -> s + CASE WHEN pmod(length({0}) - i, 2) = {1} THEN "
         "CASE WHEN cast(substring({0}, i, 1) AS int) > 4 THEN 2 * cast(substring({0}, i, 1) AS int) - 9 ELSE 2 * cast(substring({0}, i, 1) AS int) END "
         "ELSE cast(substring({0}, i, 1) AS int) END), 10)")


def _made(entities: DataFrame, key: str) -> DataFrame:
    """Adds ``surrogate`` to (kind, value, attempt)."""
    rows = entities.withColumn("secret", F.lit(key)).withColumn("stream", F.expr(_digits("value")))
    rows = rows.withColumn("plain", F.expr(_same_classes("value", "stream", "CASE kind WHEN 'key' THEN 4 WHEN 'iban' THEN 4 WHEN 'phone' THEN greatest(locate('(', value) - 1, length(regexp_extract(value, '^0*', 0)), 0) ELSE 0 END")))
    octets = ("array_join(transform(split(value, '[.]'), (o, i) -> cast(CASE length(o) WHEN 1 THEN 1 + d(i) % 9 WHEN 2 THEN 10 + d(i) % 90 ELSE 100 + d(i) % 155 END AS string)), '.')"
              .replace("d(i)", "cast(conv(substring(stream, 4 * i + 1, 4), 16, 10) AS int)"))
    # The check digit that makes the number pass: of what stands before the last digit.
    body = "regexp_replace(substring(plain, 1, length(plain) - 1), '[^0-9]', '')"
    check = f"CASE WHEN {_LUHN.format('regexp_replace(value, \"[^0-9]\", \"\")', 1)} = 0 THEN concat(substring(plain, 1, length(plain) - 1), pmod(10 - {_LUHN.format(body, 0)}, 10)) ELSE plain END"
    # The number's letters count from 10 on, its country and check digits last; the remainder by 97 is 1.
    account = "regexp_replace(concat(substring(plain, 5), substring(plain, 1, 2), '00'), ' ', '')"
    rest = (f"aggregate(transform(sequence(1, length({account})), i -> ascii(substring({account}, i, 1))), 0, "
            "(a, c) -> CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END)")
    account = f"concat(substring(plain, 1, 2), lpad(cast(98 - {rest} AS string), 2, '0'), substring(plain, 5))"
    latin = ("ba be bo da de do fa ga ha ja ka la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi".split(), "a", "n")
    cyrillic = ("ба бе бо да де до га ка ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то ва ве ви".split(), "а", "н")
    greek = ("βα δε δο γα κα λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split(), "α", "ς")

    def name(script) -> str:
        syllables, female, male = script
        array = "array(" + ", ".join(f"'{s}'" for s in syllables) + ")"
        word = (f"array_join(transform(sequence(1, 2 + greatest(1, least(5, cast(length(value) / 2 AS int)))), i -> "
                f"element_at({array}, cast(conv(substring(stream, 4 * i - 3, 4), 16, 10) AS int) % {len(syllables)} + 1)), '')")
        full = f"initcap(concat({word}, CASE kind WHEN 'given-f' THEN 's{female}' WHEN 'given-m' THEN '{male}' ELSE '' END))"
        if script is not latin:
            full = full.replace(f"'s{female}'", f"'{syllables[-1][0]}{female}'")
        return f"CASE WHEN length(value) > 1 AND value = upper(value) THEN upper({full}) ELSE {full} END"

    rows = rows.withColumn("surrogate", F.expr(f"""CASE
        WHEN kind = 'ip' THEN {octets}
        WHEN kind = 'card' THEN {check}
        WHEN kind = 'iban' THEN {account}
        WHEN kind IN ('given-f', 'given-m', 'given', 'family') AND value RLIKE '[\\\\u0400-\\\\u04ff]' THEN {name(cyrillic)}
        WHEN kind IN ('given-f', 'given-m', 'given', 'family') AND value RLIKE '[\\\\u0370-\\\\u03ff]' THEN {name(greek)}
        WHEN kind IN ('given-f', 'given-m', 'given', 'family') THEN {name(latin)}
        ELSE plain END"""))
    # Where a format has too few values, later attempts are longer.
    longer = F.concat("surrogate", F.substring("stream", 1, 8))
    return rows.withColumn("surrogate", F.when(F.col("attempt") >= 16, longer).otherwise(F.col("surrogate"))).select("kind", "value", "attempt", "surrogate")


def surrogates(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value) rows, without collisions."""
    made = scratch.keep(_made(entities.withColumn("attempt", F.lit(0)), key), "made0")
    turn = 0
    while True:
        same = Window.partitionBy("kind", "surrogate").orderBy("attempt", "value")
        real = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        judged = made.withColumn("place", F.row_number().over(same)).join(real, ["kind", "surrogate"], "left")
        clash = judged.where((F.col("place") > 1) | F.col("real").isNotNull()).select("kind", "value", "attempt")
        clash = scratch.keep(clash, f"clash{turn}")
        if clash.isEmpty():
            return made.select("kind", "value", "surrogate")
        turn += 1
        again = _made(clash.withColumn("attempt", F.col("attempt") + 1), key)
        made = scratch.keep(made.join(clash.select("kind", "value"), ["kind", "value"], "left_anti").unionByName(again), f"made{turn}")


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_entities) for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "surrogates")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    holds = F.coalesce(F.rlike("text", F.lit(PATTERN)), F.lit(False))
    found = rows.where(holds).select(
        "doc_id", F.split("text", PATTERN, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("values"))
    found = scratch.keep(found.withColumn("uid", F.monotonically_increasing_id()), "found")
    at = lambda c, i: F.get(F.col(c), i)
    units = F.transform("values", lambda v, i: F.struct(
        _kind(v, at("gaps", i), at("gaps", i + 1), at("values", i + 1)).alias("kind"), v.alias("value")))
    entities = scratch.keep(found.select("uid", F.posexplode(units).alias("i", "e")).select("uid", "i", "e.kind", "e.value"), "entities")
    known_given = (entities.where("kind IN ('given-f', 'given-m')").groupBy("value")
                   .agg(F.min("kind").alias("one"), F.max("kind").alias("other")).where("one = other").select("value", "one"))
    neutral = entities.where("kind = 'given'").join(known_given, "value", "left").select("uid", "i", F.coalesce("one", "kind").alias("kind"), "value")
    entities = scratch.keep(entities.where("kind != 'given'").unionByName(neutral), "gendered")
    # A mail address is its local part and its domain.
    mail = F.col("kind") == "email"
    parts = entities.select("kind", "value").distinct()
    known = (parts.where(~mail)
             .unionByName(parts.where(mail).select(F.lit("mail-user").alias("kind"), "value"))
             .unionByName(parts.where(mail).select(F.lit("mail-domain").alias("kind"), F.lower(F.substring_index("value", "@", -1)).alias("value")).distinct()))
    known = scratch.keep(known, "known")
    table = surrogates(known.where("kind NOT IN ('mail-user', 'mail-domain')")
                       .unionByName(known.where("kind = 'mail-user'").select(F.lit("mail-user").alias("kind"), F.substring_index("value", "@", 1).alias("value")).distinct())
                       .unionByName(known.where("kind = 'mail-domain'").select("kind", F.expr("substring(value, 1, length(value) - locate('.', reverse(value)))").alias("value")).distinct()),
                       key, scratch)
    table = scratch.keep(table, "table")
    whole = table.where("kind NOT IN ('mail-user', 'mail-domain')")
    user = table.where("kind = 'mail-user'").select(F.col("value").alias("u"), F.col("surrogate").alias("us"))
    domain = table.where("kind = 'mail-domain'").select(F.col("value").alias("d"), F.col("surrogate").alias("ds"))
    mails = (parts.where(mail).withColumn("u", F.substring_index("value", "@", 1)).withColumn("full", F.lower(F.substring_index("value", "@", -1)))
             .withColumn("d", F.expr("substring(full, 1, length(full) - locate('.', reverse(full)))"))
             .join(user, "u").join(domain, "d")
             .select("kind", "value", F.expr("concat(us, '@', ds, substring(full, length(d) + 1))").alias("surrogate")))
    made = entities.join(whole.unionByName(mails), ["kind", "value"]).groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("i", "surrogate"))).alias("new"))
    # Untitled mentions: words of a document that are parts of a name found in it.
    parts_of = entities.where(F.col("kind").isin(*NAMES)).groupBy("uid", "value").agg(F.min_by("kind", "i").alias("kind"))
    parts_of = scratch.keep(parts_of.join(whole, ["kind", "value"]).select("uid", F.col("value").alias("word"), F.col("surrogate").alias("name")), "names")
    words = (found.join(parts_of.select("uid").distinct(), "uid", "left_semi").select("uid", F.posexplode("gaps").alias("g", "gap"))
             .select("uid", "g", F.posexplode_outer(F.regexp_extract_all("gap", F.lit(TOKEN), F.lit(0))).alias("t", "word")))
    gaps = (words.join(parts_of, ["uid", "word"], "left").groupBy("uid", "g")
            .agg(F.array_sort(F.collect_list(F.struct("t", F.coalesce("name", "word", F.lit("")).alias("word")))).alias("line"), F.count("name").alias("n"))
            .select("uid", F.struct("g", F.array_join(F.col("line")["word"], "").alias("gap"), "n").alias("gap"))
            .groupBy("uid").agg(F.array_sort(F.collect_list("gap")).alias("fresh")))
    done = (found.join(made, "uid").join(gaps, "uid", "left")
            .withColumn("gaps", F.coalesce(F.col("fresh")["gap"], F.col("gaps")))
            .withColumn("mentions", F.coalesce(F.aggregate(F.col("fresh")["n"], F.lit(0).cast("long"), lambda a, n: a + n), F.lit(0)).cast("int")))
    text = F.array_join(F.zip_with("gaps", "new", lambda gap, s: F.concat(gap, F.coalesce(s["surrogate"], F.lit("")))), "")
    return (rows.where(~holds).select("doc_id", "text", F.lit(0).alias("n_entities"))
            .unionByName(done.select("doc_id", text.alias("text"), (F.size("new") + F.col("mentions")).alias("n_entities"))))
