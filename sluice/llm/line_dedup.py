"""Line dedup by a deletion-neighbourhood join.

A line is the words between two line feeds; lines with the same words are equal, and two lines of
at least ``least`` words are near when one word replaced, added or left out turns one into the other (an edit distance of one,
in words).  In the order of (doc_id, line number), a line stays unless an earlier line of the
table is equal or near to it.  Lines without words are layout: they stay and match nothing.

The variants of a line are the line with one word left out.  Two lines are near when they share a variant at the same
place, or when a variant of one is the other.  Variants are XORs of hashes of (word, place), made by running
XORs in linear time.  Only lines that share one half with another line emit them: one edit leaves a half as it is.
Every group of equal keys is reduced to its earliest line, so a frequent key costs its rows.  Pairs are
verified on their words.

Null texts have no lines; an empty text has one line without words.  Rows that share a doc_id are one document, null
ids too, and come last; equal lines at the same place of it are one line.  An empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch


def lines(docs: DataFrame) -> DataFrame:
    """(at, line): ``at`` orders the lines of the table."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return rows.select(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "no").alias("at"), "line")


def _keyed(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("words", F.array_remove(F.split("line", "[ \\t-\\r]+"), ""))
            .withColumn("key", F.unhex(F.md5(F.concat_ws(" ", "words")))))


#: Bits of the bitmap that says which lines are wanted; its size does not depend on the data.
BITMAP_BITS = 20


def _halves(least: int) -> list[Column]:
    """Hashes of the first and the last half, once as the shorter line of a pair and once as
    the longer one, whose halves are those of one word less."""
    out = []
    for a in ("size(words)", "(size(words) - 1)"):
        half = f"cast(floor({a} / 2) AS int)"
        for name, part in (("first", f"slice(words, 1, {half})"), ("last", f"slice(words, size(words) - ({a} - {half}) + 1, {a} - {half})")):
            out.append(F.expr(f"CASE WHEN {a} >= {least} THEN xxhash64('{name}', {a}, {part}) END").alias(f"h{len(out)}"))
    return out


def _slot(raw: Column) -> Column:
    return F.shiftrightunsigned(raw, 64 - BITMAP_BITS)


def _wanted(lines: DataFrame, raw: Column) -> Column:
    """True where the hash ``raw`` is one of the table's, and for some others.  Spark ORs the bits; its bytes at most reach the driver."""
    rows = lines.select(_slot(F.col("raw")).alias("s")).groupBy(F.shiftright("s", 3).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(s & 7 AS int))")).alias("bits")).collect()
    bits = bytearray(1 << (BITMAP_BITS - 3))
    for row in rows:
        bits[row["at"]] = row["bits"]
    byte = F.conv(F.hex(F.substring(F.lit(bytes(bits)), F.shiftright(_slot(raw), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (_slot(raw) % 8 + 1).cast("int"))) != 0


def _suspects(distinct: DataFrame) -> DataFrame:
    """Lines that share a half with a line they may be near to, and the half in which the edit
    must then be: as one of two equally long lines, as the longer or as the shorter one."""
    spots = distinct.select("key", F.explode(F.array(*(
        F.struct(F.col(f"h{i}").alias("h"), F.lit(i % 2 == 0).alias("first"), F.lit(i > 1).alias("longer")) for i in range(4)))).alias("s")).select("key", "s.*").where("h IS NOT NULL")
    groups = spots.groupBy("h").agg(F.count_if(~F.col("longer")).alias("short"), F.count_if("longer").alias("long")).where("short > 1 OR (short > 0 AND long > 0)")
    met = spots.join(groups, "h")
    return met.groupBy("key").agg(
        F.max(F.expr("NOT longer AND short > 1 AND first")).alias("swap_last"), F.max(F.expr("NOT longer AND short > 1 AND NOT first")).alias("swap_first"),
        F.max(F.expr("longer AND short > 0 AND first")).alias("drop_last"), F.max(F.expr("longer AND short > 0 AND NOT first")).alias("drop_first"),
        F.max(F.expr("NOT longer AND long > 0")).alias("whole")).where("swap_last OR swap_first OR drop_last OR drop_first OR whole")


def _codes(words: DataFrame) -> DataFrame:
    """(code, id, role): role 0 is a variant at its place, 1 a variant of a longer line, 2 a whole line.  Rows of
    one line stay in the task that holds its words."""
    letters = words.repartition("id").select("id", "n", "swap_last", "swap_first", "drop_last", "drop_first", "whole", F.posexplode("words").alias("i", "word"))
    letters = letters.withColumn("here", F.xxhash64("word", "i")).withColumn("moved", F.xxhash64("word", F.col("i") - 1))
    line = Window.partitionBy("id").orderBy("i")
    running, whole = line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # What stands before a word is the running XOR without it, what stands after it the whole XOR without the running one.
    before = F.bit_xor("here").over(running).bitwiseXOR(F.col("here"))
    after = F.bit_xor("moved").over(whole).bitwiseXOR(F.bit_xor("moved").over(running))
    letters = letters.withColumn("v", before.bitwiseXOR(after)).withColumn("x", F.bit_xor("here").over(whole))
    swap = F.expr("swap_last AND i >= floor(n / 2) OR swap_first AND i < floor(n / 2)")
    drop = F.expr("drop_last AND i >= floor((n - 1) / 2) OR drop_first AND i <= floor((n - 1) / 2)")
    return letters.select("id", F.explode(F.array_compact(F.array(
        F.when(swap, F.struct(F.xxhash64(F.lit("place"), "n", "i", "v").alias("code"), F.lit(0).alias("role"))),
        F.when(drop, F.struct(F.xxhash64(F.lit("whole"), F.col("n") - 1, "v").alias("code"), F.lit(1).alias("role"))),
        F.when(F.expr("whole AND i = 0"), F.struct(F.xxhash64(F.lit("whole"), "n", "x").alias("code"), F.lit(2).alias("role"))))))).select("col.code", "id", "col.role")


def _near(words: DataFrame, scratch: Scratch) -> DataFrame:
    """Ids of lines that are near to an earlier one; ids follow the order of the lines."""
    codes = scratch.keep(_codes(words), "codes")
    groups = codes.groupBy("code").agg(F.count("*").alias("m"), F.min(F.expr("CASE WHEN role < 2 THEN id END")).alias("variant"),
                                       F.min(F.expr("CASE WHEN role = 2 THEN id END")).alias("line")).where("m > 1")
    earlier = F.when(F.col("role") == 1, F.col("line")).otherwise(F.col("variant"))
    pairs = codes.join(groups, "code").withColumn("earlier", earlier).where("earlier < id").select("id", "earlier").distinct()
    pairs = scratch.keep(pairs, "pairs")
    a, b = words.select("id", F.col("words").alias("a")), words.select(F.col("id").alias("earlier"), F.col("words").alias("b"))

    def run(x: Column, y: Column) -> Column:
        at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(at > 0, at - 1).otherwise(F.least(F.size("a"), F.size("b")))

    # One edit: what agrees from the start and from the end leaves at most one word.
    agreed = run(F.col("a"), F.col("b")) + run(F.reverse("a"), F.reverse("b"))
    near = pairs.join(a, "id").join(b, "earlier").where(agreed >= F.greatest(F.size("a"), F.size("b")) - 1)
    return scratch.keep(near.select("id").distinct(), "near")


def decide(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, no, kept) for every line; ``no`` counts from 0 within the document."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    every, raw = lines(docs), F.xxhash64("line")
    rows = scratch.keep(_keyed(every).select("at", F.size("words").alias("n"), "key", raw.alias("raw"), *_halves(least)), "lines")
    distinct = scratch.keep(rows.where("n > 0").groupBy("key").agg(
        F.min("at").alias("first"), F.min_by("raw", "at").alias("raw"), F.max("n").alias("n"), *(F.max(f"h{i}").alias(f"h{i}") for i in range(4))), "distinct")
    # A sorted table numbered in its order: ids compare as the lines do.
    suspects = scratch.keep(_suspects(distinct).join(distinct.select("key", "first", "raw", "n"), "key").orderBy("first")
                            .withColumn("id", F.monotonically_increasing_id()), "suspects")
    wanted = suspects.withColumnRenamed("key", "k").drop("raw")
    words = (_keyed(every.where(_wanted(suspects, raw))).join(wanted, (F.col("key") == F.col("k")) & (F.col("at") == F.col("first")))
             .select("id", "n", "swap_last", "swap_first", "drop_last", "drop_first", "whole", "words").dropDuplicates(["id"]))
    near = _near(scratch.keep(words, "words"), scratch).join(suspects.select("id", "key"), "id").select("key", F.lit(True).alias("near"))
    fate = distinct.select("key", "first").join(near, "key", "left")
    return (rows.select("at", "n", "key").join(fate, "key", "left")
            .select("at.doc_id", "at.no", ((F.col("n") == 0) | ((F.col("at") == F.col("first")) & F.col("near").isNull())).alias("kept")).distinct())


def summary(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_kept, dropped) for every document: ``dropped`` are its line numbers, comma-joined."""
    fates = decide(docs, least).groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if("kept").alias("n_kept"),
        F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("no")))).alias("gone"))
    ids = docs.select(F.col("doc_id").cast("long").alias("d")).distinct()
    return ids.join(fates, ids.d.eqNullSafe(fates.doc_id), "left").select(
        F.col("d").alias("doc_id"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
        F.coalesce(F.concat_ws(",", F.col("gone").cast("array<string>")), F.lit("")).alias("dropped"))


def deduplicated(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, text) for every row of ``docs``: its kept lines."""
    gone = decide(docs, least).where("NOT kept").groupBy("doc_id").agg(F.collect_set("no").alias("gone")).withColumnRenamed("doc_id", "d")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kept = F.filter(F.transform(F.split("text", "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i"))), lambda x: ~F.array_contains("gone", x["i"]))
    return rows.join(gone, rows.doc_id.eqNullSafe(gone.d), "left").select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n")).alias("text"))
