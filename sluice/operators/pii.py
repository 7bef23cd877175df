"""Removal of personal data, the audit counts, and the gate before each write."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.pii import (EXEMPT_COLUMNS, VALUE_PATTERNS, candidate_names, is_staff_key_col,
                                  matching_pattern, redact, value_pattern)
from sluice.functions.text import any_base, c, trim
from sluice.functions.word_runs import joined, openings, runs
from sluice.operators.metrics import class_counts, fixed
from sluice.plans.config import RunConfig
from sluice.plans.dictionary import Dictionary
from sluice.session import cut_lineage, ship


class PersonalDataFound(RuntimeError):
    """A table about to be written still holds personal data (counts only)."""


def removed_columns(names: Sequence[str], dictionary: Dictionary, cfg: RunConfig) -> dict[str, int]:
    """Column -> tier: 1 confidential in the dictionary, 2 name pattern."""
    patterns = dictionary.name_patterns(cfg)
    tiers = {n: 1 for n in names if n in dictionary.confidential_columns}
    tiers.update({n: 2 for n in names if n not in tiers and matching_pattern(n, patterns)})
    return tiers


def quasi_columns(names: Sequence[str], cfg: RunConfig) -> list[str]:
    return [n for n in names if matching_pattern(n, cfg.quasi_patterns)]


def text_columns(df: DataFrame, exempt: Sequence[str] = EXEMPT_COLUMNS) -> list[str]:
    return [f for f, t in df.dtypes if t == "string" and f not in exempt]


def pattern_hits(df: DataFrame, columns: Sequence[str],
                 patterns: Mapping[str, str] = VALUE_PATTERNS, step: str = "pii") -> DataFrame:
    """Matching cells per column and pattern."""
    return class_counts(df, step, {n: value_pattern(c(n), patterns) for n in columns})


def deidentify(df: DataFrame, dictionary: Dictionary, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Drops tier 1 and 2 columns and nulls matching cells; keys are only counted."""
    tiers = removed_columns(df.columns, dictionary, cfg)
    kept = df.drop(*tiers)
    cells = text_columns(kept)
    keys = [n for n in kept.columns if n in EXEMPT_COLUMNS and dict(kept.dtypes)[n] == "string"]
    clean = kept.select(*[redact(c(n), cfg.value_patterns).alias(n) if n in cells else c(n)
                          for n in kept.columns])
    quasi = quasi_columns(clean.columns, cfg)
    counts = {(n, f"removed_tier_{t}"): 1 for n, t in tiers.items()}
    counts.update({(n, "quasi_identifier_kept"): 1 for n in quasi})
    metrics = fixed(df.sparkSession, "pii", counts or {("", "removed_tier_1"): 0})
    if cells:
        metrics = metrics.unionByName(pattern_hits(kept, cells, cfg.value_patterns, "pii_redacted"))
    if keys:
        metrics = metrics.unionByName(pattern_hits(kept, keys, cfg.value_patterns, "pii_key_kept"))
    return clean, metrics


def forbidden_names(names: Sequence[str], dictionary: Dictionary, cfg: RunConfig) -> list[str]:
    patterns = dictionary.name_patterns(cfg)
    bad = []
    for n in names:
        forms = candidate_names(n, cfg.reserved_renames, dictionary.harmonised)
        if any(any_base(f) in dictionary.confidential_keys for f in forms) or any(
                matching_pattern(f, patterns) for f in forms):
            bad.append(n)
    return bad


def assert_no_pii(df: DataFrame, stage: str, dictionary: Dictionary, cfg: RunConfig,
                  value_exempt: Sequence[str] = ()) -> None:
    """Raises when a column name or any cell of ``df`` matches a personal-data
    rule.  One aggregation; at most columns x patterns rows reach the driver."""
    bad = forbidden_names(df.columns, dictionary, cfg)
    if bad:
        raise PersonalDataFound(f"[{stage}] {len(bad)} column(s) match a personal-data rule: "
                                f"{', '.join(bad)}. Nothing has been written.")
    exempt = (*EXEMPT_COLUMNS, *[dictionary.harmonised[x] for x in EXEMPT_COLUMNS
                                 if x in dictionary.harmonised], *value_exempt)
    cells = text_columns(df, exempt)
    hits = pattern_hits(df, cells, cfg.value_patterns, stage).collect() if cells else []
    if hits:
        counts = "; ".join(f"{r['column']}: {r['n']} cell(s) match '{r['metric']}'" for r in hits)
        raise PersonalDataFound(f"[{stage}] {counts}. Nothing has been written.")


def term_patterns(terms: Sequence[str], block: int = 200) -> list[str]:
    """Whole-word patterns for a term list: terms of several words match in any
    case, single words in their own case.  Longer terms come first."""
    def escape(t: str) -> str:
        return "".join("\\" + ch if not (ch.isalnum() or ch in "_ ") else ch for ch in t)

    out = []
    ordered = sorted(dict.fromkeys(t.strip() for t in terms if t and t.strip()),
                     key=lambda t: (-len(t), t))
    for flag, group in (("(?i)", [t for t in ordered if any(ch.isspace() for ch in t)]),
                        ("", [t for t in ordered if not any(ch.isspace() for ch in t)])):
        for i in range(0, len(group), block):
            alternatives = "|".join(escape(t) for t in group[i:i + block])
            out.append(f"{flag}(?<![A-Za-z0-9_])({alternatives})(?![A-Za-z0-9_])")
    return out


def scrub_terms(col: Column, patterns: Sequence[str], placeholder: str = "[staff]") -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, p, placeholder), patterns, col)


def terms_left(col: Column, patterns: Sequence[str]) -> Column:
    """True where any pattern still matches."""
    return reduce(lambda a, b: a | b, [F.coalesce(col.rlike(p), F.lit(False)) for p in patterns])


def assert_terms_gone(df: DataFrame, columns: Sequence[str], patterns: Sequence[str]) -> None:
    if not patterns or not columns:
        return
    left = df.agg(*[F.count_if(terms_left(c(n), patterns)).alias(f"n{i}")
                    for i, n in enumerate(columns)]).first()
    found = {n: left[f"n{i}"] for i, n in enumerate(columns) if left[f"n{i}"]}
    if found:
        raise PersonalDataFound(f"terms left after scrubbing: {found}")


#: Leading words of a term that are looked up; the whole term is compared afterwards.
LOOKED_UP = 4
#: Terms up to this size, which is measured, go to every task, those of the fewest words first; the others meet the texts in a shuffle.
BROADCAST_BYTES = 16 << 20
#: Logarithm of the bits of the filter that runs of words pass before that shuffle, whatever the number of terms.
FILTER_BITS = 27
#: Bytes of texts whose words are looked up at once.
LOOKUP_BYTES = 1 << 20
_BLANK = re.compile(rb"\s")
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")] = True


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class TermIndex:
    """Terms by the hash of their first words.  Folded ones match in any case of A-Z.  The terms of a key are a stretch of
    one text, so that many terms take little more room than their bytes."""

    def __init__(self, terms: Sequence[bytes], fold: bool):
        terms = list(dict.fromkeys(t.lower() if fold else t for t in terms))  # bytes fold A-Z only
        sizes, keys, lead = openings(terms, LOOKED_UP, fold)
        order = np.argsort(keys, kind="stable")
        self.fold, self.sizes = fold, np.unique(sizes).tolist()
        self.keys, first = np.unique(keys[order], return_index=True)
        self.groups = np.append(first, len(keys))
        self.lead = lead[order]
        self.text = b"".join(terms[i] for i in order)
        self.ends = np.cumsum([0, *(len(terms[i]) for i in order)])
        self.shift = np.uint64(64 - min(24, max(10, len(keys).bit_length() + 4)))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[self.keys >> self.shift] = True

    def candidates(self, data: bytes, ends: np.ndarray) -> np.ndarray:
        """Places where the first words of a term stand and it could stand free within its text: first word's start,
        bytes before it (negative), length (negative), start of the place, its text, start of the term in ``text``."""
        chars, found = np.frombuffer(data, "uint8"), []
        for hashes, starts, owner in runs(data, ends, self.sizes, self.fold):
            at = np.flatnonzero(self.seen[hashes >> self.shift])
            key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
            hit = self.keys[key] == hashes[at]
            at, key = at[hit], key[hit]
            many = self.groups[key + 1] - self.groups[key]
            at = np.repeat(at, many)
            term = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.groups[key], many)
            word, own, lead, size = starts[at], owner[at], self.lead[term], self.ends[term + 1] - self.ends[term]
            start = word - lead
            free = (start >= np.where(own > 0, ends[own - 1] + 1, 0)) & (start + size <= ends[own])
            free &= ~((start > 0) & _WORD_BYTE[chars[start - 1]]) & ~_WORD_BYTE[chars[np.minimum(start + size, len(chars) - 1)]]
            found.append(np.stack([word, -lead, -size, start, own, self.ends[term]])[:, free])
        return np.concatenate(found, axis=1)


def _stands(text: bytes, term: bytes) -> bool:
    """Whether the first words of the term stand in the text in any case."""
    (n,), (key,), _ = openings([term], LOOKED_UP, True)
    return any((hashes == key).any() for hashes, _, _ in runs(*joined([text]), [n], True))


def _places(texts: Sequence[bytes], indexes: Sequence[TermIndex], marks: Sequence[Sequence[tuple[int, int]]] = (),
            before: Sequence[bytes] = ()) -> list[list[tuple[int, int]]]:
    """Per text: places of whole terms from left to right, the longest at each place, none overlapping.  ``marks`` are
    the places of placeholders in each text: a term may touch them only if its first words stand in the text ``before``."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not indexes:
        return out
    data, ends = joined(texts)
    data = data.lower() if indexes[0].fold else data
    found = [x.candidates(data, ends) for x in indexes]
    which = np.repeat(np.arange(len(found)), [x.shape[1] for x in found])
    rows = np.concatenate(found, axis=1)
    order = np.lexsort((rows[2], rows[1], rows[0]))
    _, _, size, start, owner, term = rows[:, order]
    offset = np.concatenate(([0], ends[:-1] + 1))
    touching = np.zeros(len(order), bool)
    if any(marks):
        lows, highs = (np.array([offset[i] + m[side] for i, listed in enumerate(marks) for m in listed]) for side in (0, 1))
        touching = np.searchsorted(lows, start - size) > np.searchsorted(highs, start, "right")
    done, stands = 0, {}
    for begin, length, own, at, x, near_mark in zip(*(v.tolist() for v in (start, -size, owner, term, which[order], touching))):
        if begin < done:
            continue
        listed = indexes[x].text[at:at + length]
        if data[begin:begin + length] != listed:
            continue
        if near_mark:
            if (own, listed) not in stands:
                stands[own, listed] = _stands(before[own], listed)
            if not stands[own, listed]:
                continue
        done = begin + length
        out[own].append((begin, done))
    return [[(a - low, b - low) for a, b in listed] if listed else listed for listed, low in zip(out, offset.tolist())]


def _replaced(text: bytes, places: Sequence[tuple[int, int]], placeholder: bytes) -> tuple[bytes, list[tuple[int, int]]]:
    """(text, places of its placeholders)."""
    if not places:
        return text, []
    parts, marks, at, size = [], [], 0, 0
    for start, end in places:
        size += start - at
        marks.append((size, size + len(placeholder)))
        parts += [text[at:start], placeholder]
        at, size = end, size + len(placeholder)
    return b"".join([*parts, text[at:]]), marks


def _scrubbed(texts: Sequence[bytes], several: Sequence[TermIndex], single: Sequence[TermIndex], placeholder: bytes) -> list[bytes]:
    """Terms of several words match in any case of A-Z and go first, single words in their own case."""
    once = [_replaced(t, p, placeholder) for t, p in zip(texts, _places(texts, several))]
    between = [t for t, _ in once]
    return [_replaced(t, p, placeholder)[0] for t, p in zip(between, _places(between, single, [m for _, m in once], texts))]


def _holding(texts: Sequence[bytes], several: Sequence[TermIndex], single: Sequence[TermIndex]) -> list[bool]:
    return [bool(a or b) for a, b in zip(_places(texts, several), _places(texts, single))]


def _indexes(terms: Sequence[bytes]) -> tuple[list[TermIndex], list[TermIndex]]:
    """(terms of several words, single words), each as one index or none."""
    kinds: tuple[list[bytes], list[bytes]] = ([], [])
    for t in terms:
        kinds[_BLANK.search(t) is None].append(t)
    return tuple([TermIndex(x, fold)] if x else [] for x, fold in zip(kinds, (True, False)))


class TermTable:
    """A table of terms (column ``term``, any number of rows) made ready for one or several look-ups.

    Terms that are null, blank or ASCII punctuation alone are no terms.  ``near`` holds the terms that every task gets,
    ``far_sizes`` the numbers of words of the others, ``bits`` which of their keys occur, as a filter of fixed size."""

    def __init__(self, terms: DataFrame):
        spark = terms.sparkSession
        ship(spark)

        @F.pandas_udf("n int, key bigint")
        def opening(listed: pd.Series) -> pd.DataFrame:
            n, key, _ = openings([_bytes(t) for t in listed], LOOKED_UP, True)
            return pd.DataFrame({"n": n.astype("int32"), "key": key.view("int64")})

        listed = (terms.select(trim(F.col("term").cast("string")).alias("_term")).filter("_term IS NOT NULL").distinct()
                  .withColumn("_o", opening("_term")).select("_term", F.col("_o.n").alias("_n"), F.col("_o.key").alias("_key")))
        self.listed = cut_lineage(listed).filter("_n > 0")
        by_size = self.listed.groupBy("_n").agg(F.sum(F.octet_length("_term") + 16).alias("bytes")).collect()  # at most LOOKED_UP rows
        near_sizes, self.far_sizes, room = [], [], BROADCAST_BYTES
        for n, size in sorted((r["_n"], r["bytes"]) for r in by_size):
            near = size <= room
            (near_sizes if near else self.far_sizes).append(n)
            room -= size if near else 0
        self.near = self.bits = None
        if near_sizes:
            rows = self.listed.filter(F.col("_n").isin(near_sizes)).select(F.col("_term").cast("binary").alias("_term")).toArrow()
            self.near = spark.sparkContext.broadcast(_indexes(rows["_term"].to_pylist()))
        if self.far_sizes:
            at = F.shiftrightunsigned("_key", 64 - FILTER_BITS) + 1
            bits = np.zeros(1 << (FILTER_BITS - 3), "uint8")
            for r in (self.far().groupBy(F.bitmap_bucket_number(at).alias("k"))
                      .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()):
                part = np.frombuffer(r["bits"], "uint8")[:len(bits)]
                bits[(r["k"] - 1) * len(part):r["k"] * len(part)] = part
            self.bits = spark.sparkContext.broadcast(bits)

    def far(self) -> DataFrame:
        return self.listed.filter(F.col("_n").isin(self.far_sizes))

    def __bool__(self) -> bool:
        return self.near is not None or bool(self.far_sizes)


def _prepared(terms: DataFrame | TermTable) -> TermTable:
    return terms if isinstance(terms, TermTable) else TermTable(terms)


def _groups(texts: pd.Series) -> Iterator[list[bytes | None]]:
    """The texts of an Arrow batch, some ``LOOKUP_BYTES`` at a time."""
    group, size = [], 0
    for text in texts:
        group.append(None if text is None else _bytes(text))
        size += len(group[-1] or b"")
        if size >= LOOKUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def terms_met(df: DataFrame, column: str, terms: TermTable) -> DataFrame:
    """``df`` with ``_met``: the far terms that may stand in the column's text; null where there are none.

    Texts and terms meet in a join on the hash of a term's first words, which only runs of words that pass the filter
    enter, once per text; so work grows with the words of the texts and not with texts x terms.  Texts are told apart by
    a hash, so rows need no id.  Equal hashes of different words or texts only add terms that the comparison of whole
    terms rejects.  ``df`` is read twice."""
    text = c(column)
    if not terms.far_sizes:
        return df.withColumn("_met", F.lit(None).cast("array<string>"))
    sizes, bits, shift = terms.far_sizes, terms.bits, np.uint64(64 - FILTER_BITS)

    @F.pandas_udf("array<bigint>")
    def keys(texts: pd.Series) -> pd.Series:
        out = []
        for group in _groups(texts):
            owners, hashes = [], []
            for h, _, owner in runs(*joined([t or b"" for t in group]), sizes, True):
                at = h >> shift
                hit = (bits.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype("uint8")) & 1 == 1
                owners.append(owner[hit])
                hashes.append(h[hit].view("int64"))
            owners, hashes = np.concatenate(owners), np.concatenate(hashes)
            order = np.argsort(owners, kind="stable")
            ends = np.searchsorted(owners[order], np.arange(1, len(group)))
            out += [np.unique(x) for x in np.split(hashes[order], ends)]
        return pd.Series(out, dtype=object)

    met = (df.filter(text.isNotNull()).select(F.xxhash64(text).alias("_text"), F.explode(keys(text)).alias("_key"))
           .join(terms.far().select("_key", "_term"), "_key")
           .groupBy("_text").agg(F.collect_set("_term").alias("_met")))
    return (df.withColumn("_text", F.when(text.isNotNull(), F.xxhash64(text)))
            .join(met, "_text", "left").drop("_text"))


def _with_met(column: str, terms: TermTable, fn, result: str) -> Column:
    """``fn(texts, terms of several words, single words)`` over the texts of Arrow batches; null texts stay null."""
    near = terms.near

    @F.pandas_udf(result)
    def run(texts: pd.Series, far: pd.Series) -> pd.Series:
        out, at = [], 0
        for group in _groups(texts):
            kinds = near.value if near is not None else ([], [])
            met = {t for listed in far.iloc[at:at + len(group)] if listed is not None for t in listed}
            if met:
                kinds = tuple(a + b for a, b in zip(kinds, _indexes([_bytes(t) for t in sorted(met)])))
            done = iter(fn([t for t in group if t is not None], *kinds))
            out += [None if t is None else next(done) for t in group]
            at += len(group)
        return pd.Series(out, dtype=object)

    return run(c(column), F.col("_met"))


def scrub_term_table(df: DataFrame, column: str, terms: DataFrame | TermTable, placeholder: str = "[staff]") -> DataFrame:
    """``scrub_terms`` for a table of terms of any size: at each place the longest term goes.  All other columns, rows
    without a text and rows without a term stay as they are; an empty table or term list changes nothing.  A term that
    only the placeholder itself holds is not looked for.  One that ends in punctuation may come to stand free when its
    neighbour is replaced: ``term_rows_left`` reports such rows."""
    terms = _prepared(terms)
    if not terms:
        return df
    mark = placeholder.encode()
    out = terms_met(df, column, terms)
    scrubbed = _with_met(column, terms, lambda *x: [t.decode("utf-8", "surrogatepass") for t in _scrubbed(*x, mark)], "string")
    return out.withColumn(column, scrubbed).select(*[c(n) for n in df.columns])


def with_terms_left(df: DataFrame, column: str, terms: DataFrame | TermTable, name: str) -> DataFrame:
    """``df`` with column ``name``: whether the text still holds a term (a null text does not)."""
    terms = _prepared(terms)
    if not terms:
        return df.withColumn(name, F.lit(False))
    out = terms_met(df, column, terms)
    held = _with_met(column, terms, _holding, "boolean")
    return out.withColumn(name, F.coalesce(held, F.lit(False))).select(*[c(n) for n in df.columns], c(name))


def term_rows_left(df: DataFrame, column: str, terms: DataFrame | TermTable) -> DataFrame:
    """Rows whose text still holds a term."""
    return with_terms_left(df, column, terms, "_left").filter("_left").drop("_left")


def drop_staff_options(value_maps: DataFrame, key: str = "question_key") -> DataFrame:
    """Value-map rows without the options of staff fields."""
    return value_maps.filter(~is_staff_key_col(F.col(key)))


def staff_terms(options: DataFrame, generic: Sequence[str] = ()) -> DataFrame:
    """Terms to scrub from (question_key, text) rows: the option texts of staff
    fields that are not used outside staff fields.  A single word that occurs
    anywhere outside staff fields is an ordinary word and is left alone."""
    t = options.select(is_staff_key_col(F.col("question_key")).alias("staff"),
                       trim(F.col("text")).alias("term"))
    staff = (t.filter("staff").filter((F.length("term") >= 3) & F.col("term").rlike("[A-Za-z]"))
             .select("term").distinct())
    other = t.filter("NOT staff")
    whole = other.select(F.lower("term").alias("_t")).distinct()
    words = (other.select(F.explode(F.split("term", "[^A-Za-z0-9_]+")).alias("_w")).distinct())
    out = staff.join(whole, F.lower("term") == F.col("_t"), "left_anti")
    if generic:
        out = out.filter(~F.lower("term").isin(*[g.lower() for g in generic]))
    single = out.filter(~F.col("term").rlike(r"\s")).join(words, F.col("term") == F.col("_w"), "left_anti")
    return out.filter(F.col("term").rlike(r"\s")).unionByName(single)
