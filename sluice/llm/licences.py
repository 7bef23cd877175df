"""Licence scan with a positional index of rare licence words.

Templates are short notices; a licence has several of them where it is worded in several ways (a line of its name, the long
header of its files, an identifier line).  The index has, for every template, the places of its words.
The scan counts in how many documents each index word occurs, looks up in each file the two
rarest words (highest IDF) of every template's key phrase, follows the postings of templates of which the file holds both, turns each hit into the place where
the phrase would start, intersects these places over the two words, and verifies the whole phrase
there.  A place of the phrase always holds both words, so no place is missed; a file that holds the phrase holds all of
its words, so the rarest two are the same in each such file and are found once.  Further words of the notice count
in the score.

Words are runs of bytes other than ASCII punctuation, symbols, white space and controls, after A-Z
became a-z.  Null and empty texts have no words, no places, empty labels and score 0, very long ones are read whole, and an
empty table gives an empty result.  Rows are independent: repeated rows, null ids and further columns change nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Anything between two words.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    key: str
    base: bool = False

    @property
    def name(self) -> str:
        """Tells the templates of one label apart."""
        return f"{self.label} {self.key}".replace("-", " ").replace(" ", "_")

    @property
    def at(self) -> int:
        """Where the key phrase starts in the notice."""
        return self.notice[:f" {self.notice} ".index(f" {self.key} ")].count(" ")


TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license", True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", True),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    Template("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2"),
    # Headers that name the version apart from the licence.
    *(Template(label, f"under the terms of the gnu {kind}general public license as published by the free software foundation either version {version} of the license",
               f"gnu {kind}general public license as published by the free software foundation either version {version}")
      for label, kind, version in (("gpl-2", "", "2"), ("gpl-3", "", "3"), ("agpl-3", "affero ", "3"), ("lgpl", "lesser ", "2"), ("lgpl", "lesser ", "3"))),
    # The same with one version only.
    *(Template(label, f"under the terms of the gnu general public license version {version} as published by the free software foundation",
               f"gnu general public license version {version} as published by the free software foundation") for label, version in (("gpl-2", "2"), ("gpl-3", "3"))),
    # Identifier lines.
    *(Template(label, f"spdx license identifier {name}", f"spdx license identifier {name}")
      for label, name in (("mit", "mit"), ("apache-2", "apache 2"), ("cc-by-nc", "cc by nc"), ("cc-by-sa", "cc by sa"), ("agpl-3", "agpl 3"), ("bsd", "bsd"),
                          ("gpl-2", "gpl 2"), ("gpl-3", "gpl 3"), ("lgpl", "lgpl"), ("mpl-2", "mpl 2"))),
)


def words_of(text: Column) -> Column:
    """The words as an array.  ``lower`` also folds letters beyond A-Z; none of them
    becomes an ASCII word but the Kelvin sign, which is put aside first."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("å")))
    return F.array_remove(F.split(lowered, GAP), "")


def _strings(words) -> Column:
    return F.array(*map(F.lit, words))


def rarest(docs: DataFrame, templates=TEMPLATES, look_up: int = 2) -> dict[str, list[str]]:
    """Per template the ``look_up`` words of the key phrase that the fewest documents hold.  What
    reaches the driver is one count per index word, whatever the input."""
    index = sorted({w for t in templates for w in t.key.split()})
    held = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), _strings(index))).alias("word"))
    counts = {r.word: r.n for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {t.name: sorted(dict.fromkeys(t.key.split()), key=lambda w: (counts.get(w, 0), w))[:look_up] for t in templates}


def _index(templates, rare: dict[str, list[str]]) -> Column:
    """Postings, one per template: its two look-up words with their places in the key phrase, and what is verified."""
    rows = []
    for t in templates:
        key = t.key.split()
        first, last = rare[t.name][0], rare[t.name][-1]
        rows.append(F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(first).alias("first"), F.lit(key.index(first)).alias("first_at"),
            F.lit(last).alias("last"), F.lit(key.index(last)).alias("last_at"), _strings(key).alias("key"),
            _strings(t.notice.split()).alias("notice"), F.lit(t.at).alias("key_at")))
    return F.array(*rows)


def _starts(word: Column, at: Column) -> Column:
    return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"] - at)


def _word(i: Column) -> Column:
    return F.try_element_at("words", F.when(i >= 0, i + 1))


def _places(t: Column) -> Column:
    """Where a key phrase stands: hits of its rare words as starts, intersected by place, verified; with the share of the
    notice's words at their places."""
    starts = F.array_intersect(_starts(t["first"], t["first_at"]), _starts(t["last"], t["last_at"]))
    verified = F.filter(starts, lambda p: (p >= 0) & (F.slice("words", F.greatest(p, F.lit(0)) + 1, F.size(t["key"])) == t["key"]))

    def share(p: Column) -> Column:
        held = F.filter(F.transform(t["notice"], lambda w, j: F.coalesce(_word(p + j - t["key_at"]) == w, F.lit(False))), lambda x: x)
        return F.size(held) / F.size(t["notice"])

    return F.transform(verified, lambda p: F.struct(t["label"].alias("label"), p.alias("at"), t["base"].alias("base"), share(p).alias("share")))


def scan(docs: DataFrame, templates=TEMPLATES, look_up: int = 2) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places) for
    every row; ``places`` is an array of (label, at)."""
    rare = rarest(docs, templates, look_up)
    anchors = _strings(sorted({w for words in rare.values() for w in (words[0], words[-1])}))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    rows = rows.withColumn("held", F.array_intersect(anchors, F.col("words")))
    rows = rows.withColumn("live", F.filter(_index(templates, rare), lambda t: F.array_contains("held", t["first"]) & F.array_contains("held", t["last"])))
    rows = rows.withColumn("asked", F.array_distinct(F.concat("live.first", "live.last")))
    rows = rows.withColumn("hits", F.when(F.size("live") > 0, F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda h: F.array_contains("asked", h["word"]))))
    rows = rows.withColumn("places", F.flatten(F.transform("live", _places)))
    rows = rows.withColumn("base", F.filter("places", lambda p: p["base"]))

    def labels(places: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.col(f"{places}.label"))), ",")

    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size("base").cast("long").alias("n_base"),
        F.array_min("base.at").cast("long").alias("first_word"), F.array_max("base.at").cast("long").alias("last_word"),
        labels("base").alias("base_labels"), labels("places").alias("labels"),
        F.coalesce(F.array_max("places.share"), F.lit(0.0)).alias("score"),
        F.transform("places", lambda p: F.struct(p["label"].alias("label"), p["at"].alias("at"))).alias("places"))
