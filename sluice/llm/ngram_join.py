"""Near-duplicate documents by an n-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the hashes of its distinct word n-grams, A-Z lower-cased; a text of fewer words has its whole sequence
as the only one.  Documents link when 100 * common >= percent * union.  All counts are exact; n-grams are compared
by 64-bit hashes.

Tokens are ordered by an estimate of their frequency over all documents, rare ones first.  Sets that overlap
enough share a token within their first n - ceil(t * n) + 1 tokens, and share l tokens within l - 1 more.  Each
document takes the l for which the estimated postings it scans plus the candidates it verifies cost least, and a pair
is a candidate when it shares as many prefix tokens as the smaller l of the two asks for.  The sizes of a pair say how large
its overlap must be, so that its prefixes are shorter than those of one document alone: a posting at place p only
meets partners up to a size that follows from p.  Postings of frequent tokens are joined by bands of such sizes as well.

Equal sets are one set.  Before the join, every frequent token links the documents of small random buckets to one of them, where
they verify, and again in a few rounds to documents of the components found; this leaves only pairs across components to
the join, so that a large group of copies costs its rows, not its pairs.  Of the other pairs, those whose parity signatures prove too many differences are no
candidates; all others are looked at, and no cap is set.

Null and empty texts have no words, an empty set and no links.  Rows that share a doc_id are one document with
several sets; rows without a doc_id link with nothing and have a null component.  An empty table gives an empty result."""

from __future__ import annotations

import math
import zlib
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.graph import components
from sluice.llm.scratch import Scratch
from sluice.llm.texts import NOT_SPACE, bounded_batches, mixed, words
from sluice.session import ship

#: Cells of the frequency sketch: its size does not depend on the data.
CELL_BITS = 22
PART_BITS = 16
#: 64-bit words of a set's parity signature.
PARITY = 4
SIGNS = [f"p{i}" for i in range(PARITY)]


def shingle_sets(texts, n: int):
    """For groups of texts: (first index, sizes of their sets, the sets one after another, each sorted)."""
    turn = [mixed(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(n)]
    for first, counts, hashes, _ in words(texts, NOT_SPACE):
        grams = np.maximum(counts - n + 1, (counts > 0).astype(counts.dtype))
        ends = np.cumsum(counts)
        of = np.repeat(np.arange(len(counts)), grams)
        start = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams) + np.repeat(ends - counts, grams)
        mix = np.zeros(len(start), np.uint64)
        length = counts[of]
        for i in range(n):
            there = i < length
            mix[there] += hashes[start[there] + i] * turn[i]
        mix = mixed(mix + np.minimum(length, n).astype(np.uint64))
        order = np.lexsort((mix, of))
        of, mix = of[order], mix[order]
        new = np.ones(len(mix), bool)
        new[1:] = (of[1:] != of[:-1]) | (mix[1:] != mix[:-1])
        of, mix = of[new], mix[new]
        yield first, np.bincount(of, minlength=len(counts)), mix


def _parities(counts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A row of ``PARITY`` words for each set: bit b tells whether an odd number of its tokens hash to b.  Two
    sets differ in at least as many tokens as their signatures differ in bits."""
    bits = 64 * PARITY
    spot = np.repeat(np.arange(len(counts)), counts) * bits + (tokens % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(spot, minlength=len(counts) * bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(counts), PARITY)


def _texts(batch):
    return (t.as_py() for t in batch["text"])


def _sketch(n: int):
    """Per task, how often tokens fall into each cell, in compressed parts."""
    def batches(found):
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        waiting, held = [], 0

        def settle():
            at, often = np.unique(np.concatenate(waiting), return_counts=True)
            cells[at] += often.astype(np.uint32)

        for batch in found:
            for _, _, tokens in shingle_sets(_texts(batch), n):
                waiting.append((tokens >> np.uint64(64 - CELL_BITS)).astype(np.int32))
                held += len(tokens)
                if held > 1 << 20:
                    settle()
                    waiting, held = [], 0
        if waiting:
            settle()
        parts = [zlib.compress(p.astype(np.int64).tobytes(), 1) for p in cells.reshape(-1, 1 << PART_BITS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "cells"])

    return batches


def _added(found):
    sums: dict[int, np.ndarray] = {}
    for batch in found:
        for part, cells in zip(batch["part"].to_pylist(), batch["cells"]):
            counts = np.frombuffer(zlib.decompress(cells.as_py()), np.int64)
            sums[part] = sums[part] + counts if part in sums else counts
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(s.tobytes(), 1) for s in sums.values()], pa.binary())], ["part", "cells"])


def frequencies(texts: DataFrame, n: int) -> np.ndarray:
    """Token frequencies by cell, over all documents.  Tasks send a sketch of fixed size each, parts are
    added in a stream, in two steps, and the driver receives the sketch once."""
    once = texts.mapInArrow(_sketch(n), "part int, cells binary")
    spread = once.repartition(256, "part", F.pmod(F.xxhash64("cells"), F.lit(16))).mapInArrow(_added, "part int, cells binary")
    rows = spread.repartition(1 << (CELL_BITS - PART_BITS), "part").mapInArrow(_added, "part int, cells binary").collect()
    cells = np.zeros(1 << CELL_BITS, np.int64)
    for row in rows:
        part = np.frombuffer(zlib.decompress(bytes(row.cells)), np.int64)
        cells[row.part << PART_BITS:(row.part + 1) << PART_BITS] += part
    # What unrelated tokens leave in every cell is no sign of a frequent token.
    noise = cells.mean() + 4 * np.sqrt(cells.mean())
    return np.clip(cells - noise, 0, 2**30).astype(np.int32) + np.int32(1)


def _listed_arrays(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)))


def _prefixes(n: int, percent: int, most: int, held):
    def lasting(size: int) -> int:
        """Tokens that an overlap must leave: ceil(percent / 100 * size)."""
        return -(-percent * size // 100)

    def batches(found):
        often = held.value
        for batch in found:
            for first, counts, tokens in shingle_sets(_texts(batch), n):
                sizes, depth, lists = [], [], []
                weight = often[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                of = np.repeat(np.arange(len(counts)), counts)
                order = np.lexsort((tokens, weight, of))
                ranked, weight = tokens[order], weight[order]
                marks = np.add.reduceat(np.append(np.stack([mixed(tokens), mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))]), np.zeros((2, 1), np.uint64), 1),
                                        np.cumsum(counts) - counts, axis=1)
                marks[:, counts == 0] = 0
                at = 0
                for i, size in enumerate(counts.tolist()):
                    base = size - lasting(size) + 1
                    chosen = 1
                    if size:
                        # Postings scanned plus, for l matches, candidates verified: at most the postings over l.
                        seen = np.cumsum(weight[at:at + min(size, base + most - 1)].astype(np.int64))
                        cost = [seen[base + l - 2] * (1 + size / 16 / l) for l in range(1, most + 1) if base + l - 1 <= size]
                        chosen = int(np.argmin(cost)) + 1 if cost else 1
                    sizes.append(size)
                    depth.append(chosen)
                    lists.append(ranked[at:at + (base + chosen - 1 if size else 0)].view(np.int64))
                    at += size
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(sizes)), pa.array(sizes, pa.int64()), *map(pa.array, marks[:, :len(sizes)].view(np.int64)),
                     pa.array(depth, pa.int32()), _listed_arrays(lists), *map(pa.array, _parities(counts, tokens).T.copy())],
                    ["doc_id", "n", "s1", "s2", "l", "tokens", *SIGNS])

    return batches


def _wanted(n: int, held):
    """Sets of the documents whose id is in a bitmap of fixed size; the joins that follow are exact."""
    def batches(found):
        bits = held.value
        for batch in found:
            batch = batch.filter(pa.array(_in_bitmap(bits, batch["doc_id"].to_numpy())))
            for first, counts, tokens in shingle_sets(_texts(batch), n):
                lists = np.split(tokens.view(np.int64), np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, len(counts)), _listed_arrays(lists)], ["doc_id", "grams"])

    return batches


BITMAP_BITS = 22


def _slots(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _in_bitmap(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    slot = _slots(ids)
    return (bits[slot >> 6].view(np.uint64) >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of hashed ids: built by OR in Spark, 512 KiB on the driver whatever the input."""
    def batches(found):
        bits = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
        for batch in found:
            slot = _slots(batch["id"].to_numpy())
            np.bitwise_or.at(bits, slot >> 6, np.uint64(1) << (slot & 63).astype(np.uint64))
        words_set = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(words_set.astype(np.int64)), pa.array(bits[words_set].view(np.int64))], ["at", "bits"])

    rows = ids.select("id").mapInArrow(batches, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def _possible(percent: int, held):
    """Pairs whose prefixes allow enough overlap.  Up to the smaller of the two last tokens, both prefixes
    hold all tokens of their sets: there the common ones are known, beyond it the rest may be common at most."""
    def batches(found):
        often = held.value
        for batch in found:
            xs, ys, good = [np.asarray(batch[c]) for c in ("xn", "yn")], [batch["xt"], batch["yt"]], np.zeros(len(batch), bool)
            for k in range(len(batch)):
                sides, limits = [], []
                for side in (0, 1):
                    tokens = ys[side][k].values.to_numpy().view(np.uint64)
                    weight = often[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    sides.append((tokens, weight))
                    if len(tokens) < xs[side][k]:
                        limits.append((weight[-1], tokens[-1]))
                if limits:
                    w, t = min(limits)
                    sides = [(tokens[at], at) for tokens, weight in sides for at in [(weight < w) | ((weight == w) & (tokens <= t))]]
                common = len(np.intersect1d(sides[0][0], sides[1][0], assume_unique=True))
                most = common + min(int(xs[0][k]) - len(sides[0][0]), int(xs[1][k]) - len(sides[1][0]))
                good[k] = 100 * most >= percent * (int(xs[0][k]) + int(xs[1][k]) - most)
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch["x"].filter(mask), batch["y"].filter(mask)], ["x", "y"])

    return batches


def _listed(held):
    def batches(found):
        bits = held.value
        for batch in found:
            yield batch.filter(pa.array(_in_bitmap(bits, batch["doc_id"].to_numpy())))

    return batches


def _bounded(pairs: DataFrame, rows: DataFrame, percent: int, often, scratch: Scratch, name: str) -> DataFrame:
    """The pairs that the bound by prefixes leaves."""
    spark = pairs.sparkSession
    ids = pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct()
    lists = (rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "tokens")
             .mapInArrow(_listed(spark.sparkContext.broadcast(_bitmap(ids))), "doc_id long, n long, tokens array<long>"))
    lists = lists.dropDuplicates(["doc_id", "tokens"])
    both = pairs.select("x", "y").join(lists.toDF("x", "xn", "xt"), "x").join(lists.toDF("y", "yn", "yt"), "y")
    return scratch.keep(both.mapInArrow(_possible(percent, often), "x long, y long").distinct(), name)


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (x, y) that link.  Only the sets of documents in a pair are made again and moved."""
    spark = pairs.sparkSession
    ids = pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct()
    held = spark.sparkContext.broadcast(_bitmap(ids))
    # A document that is in the bitmap by chance finds no pair below.
    sets = scratch.keep(texts.where("doc_id IS NOT NULL").mapInArrow(_wanted(n, held), "doc_id long, grams array<long>"), f"{name}-sets")
    x, y = sets.toDF("x", "xs"), sets.toDF("y", "ys")
    both = F.size(F.array_intersect("xs", "ys")).cast("long")
    links = (pairs.select("x", "y").join(x, "x").join(y, "y").withColumn("both", both)
             .where(100 * F.col("both") >= percent * (F.size("xs") + F.size("ys") - F.col("both"))).select("x", "y").distinct())
    links = scratch.keep(links, name)
    scratch.drop(f"{name}-sets")
    return links


def _parted(often: DataFrame, joined: DataFrame | None) -> tuple[DataFrame, int]:
    """Postings of tokens that are not yet within one component, with the component c of each and the largest
    one of its token; and how many pairs a join across components would look at."""
    found = often.withColumn("c", F.col("rid")) if joined is None else (
        often.join(joined.toDF("rid", "c"), "rid", "left").withColumn("c", F.coalesce("c", "rid")))
    main = (found.groupBy("token", "c").agg(F.count("*").alias("m"), F.max("df").alias("size"))
            .groupBy("token").agg(F.max_by("c", F.struct("m", "c")).alias("main"), (F.max("size") - F.max("m")).alias("out"), F.max("size").alias("size")))
    left = main.agg(F.sum(F.col("out") * F.col("size"))).first()[0]
    return found.join(main.where("out > 0").select("token", "main"), "token"), left or 0


#: Ratio of the sizes in which a band begins and ends.
BAND = 1.08


def _band(size) -> Column:
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.lit(math.log(BAND)))


def _partners(percent: int) -> tuple[Column, Column]:
    """Least and largest size of a document that a posting (n, l, p) may meet: size m asks for an overlap of
    percent * (n + m) / (100 + percent), of which at most n - p + l can be left from place p on."""
    least = F.expr(f"({percent} * n + 99) div 100")
    return least, F.least(F.expr(f"100 * n div {percent}"), F.expr(f"(n - p + l) * {100 + percent} div {percent} - n"))


def _alike(percent: int):
    """Whether sizes and signatures of x and y allow the similarity."""
    apart = F.expr(" + ".join(f"bit_count(x_{p} ^ y_{p})" for p in SIGNS))
    # What two sets have in common at most.
    together = F.shiftright(F.col("x_n") + F.col("y_n") - apart, 1)
    return ((100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
            & (100 * together >= percent * (F.col("x_n") + F.col("y_n") - together)))


def _met(hot: DataFrame, percent: int, bucket: int, heads: int, tries: int, turn: int) -> DataFrame:
    """Pairs (x, y) of a few documents per bucket, of the token's largest component where there are some, with
    the others of the bucket."""
    seed = F.lit(turn)
    # Documents of a group prefer the same tokens, so a few of each are enough to meet.
    few = Window.partitionBy("rid").orderBy(F.xxhash64("token", seed))
    spot = F.pmod(F.xxhash64("rid", "token", seed), F.ceil(F.col("df") / bucket))
    first = Window.partitionBy("token", "b").orderBy(F.col("c") != F.col("main"), F.xxhash64("token", "rid", seed))
    hot = (hot.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= tries)
           .withColumn("b", spot).withColumn("place", F.row_number().over(first)))
    x, y = ([F.col(k).alias(f"{side}_{k}") for k in ("rid", "n", "c", *SIGNS)] for side in "xy")
    return (hot.where(F.col("place") <= heads).select("token", "b", *x).join(hot.select("token", "b", *y), ["token", "b"])
            .where((F.col("x_c") != F.col("y_c")) & _alike(percent))
            .select(F.least("x_rid", "y_rid").alias("x"), F.greatest("x_rid", "y_rid").alias("y")).distinct())


def near_duplicates(docs: DataFrame, n: int = 4, percent: int = 85, most: int = 4, frequent: int = 16, bucket: int = 16, tries: int = 4,
                    gain: float = 0.25) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.  ``most`` is the largest number of
    matches a document may ask for, ``frequent`` the posting length from which buckets of about ``bucket``
    documents are linked beforehand, each document in up to ``tries`` of them a round; rounds after the first take
    larger buckets and compare with several documents of each.  Rounds end when one takes less than the share ``gain`` off
    the pairs across components; the join after them looks at whatever remains."""
    if not 0 < Fraction(percent, 100) <= 1:
        raise ValueError("percent must be above 0 and at most 100")
    if not 0 < gain < 1:
        raise ValueError("gain must be between 0 and 1")
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    scratch = Scratch(spark, "ngram-join")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = spark.sparkContext.broadcast(frequencies(texts, n))
    rows = scratch.keep(texts.mapInArrow(_prefixes(n, percent, most, held), "doc_id long, n long, s1 long, s2 long, l int, tokens array<long>, " + ", ".join(f"{p} long" for p in SIGNS)), "rows")
    linked = rows.where("n > 0 AND doc_id IS NOT NULL")
    same = scratch.keep(linked.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rid")), "same")
    reps = linked.join(same, ["n", "s1", "s2"]).where("doc_id = rid").select("rid", "n", "l", "tokens")
    posts = reps.select("rid", "n", "l", F.posexplode("tokens").alias("p", "token")).select("token", "rid", "n", "l", (F.col("p") + 1).alias("p"))
    shared = posts.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    posts = scratch.keep(posts.join(shared, "token"), "posts")

    # Buckets of frequent tokens, in rounds: each joins more documents to the largest component of their tokens.
    signs = linked.join(same, ["n", "s1", "s2"]).where("doc_id = rid").select("rid", *SIGNS).distinct()
    often = scratch.keep(posts.where(F.col("df") > frequent).select("token", "rid", "n", "df").join(signs, "rid"), "frequent")
    links, joined, before = None, None, math.inf
    for turn in count():
        hot, left = _parted(often, joined)
        if left > (1 - gain) * before:
            break
        before = left
        wide, heads = (4 * bucket, max(1, bucket // 2)) if turn else (bucket, 1)
        met = scratch.keep(_met(hot, percent, wide, heads, tries, turn), f"met{turn}")
        met = _bounded(met, rows, percent, held, scratch, f"first-pairs{turn}")
        new = _verified(met, texts, n, percent, scratch, f"first-links{turn}")
        links = new if links is None else links.union(new)
        if new.isEmpty():
            break
        joined = components(links.select(F.col("x").alias("src"), F.col("y").alias("dst")), "ngram-first")
    if joined is None:
        joined = links.toDF("id", "component")
    posts = posts.join(joined.toDF("rid", "c"), "rid", "left").withColumn("c", F.coalesce("c", "rid"))

    # Pairs across components: a token's postings outside its largest component against all of them.
    by_part = posts.groupBy("token", "c").agg(F.count("*").alias("m"))
    main = by_part.groupBy("token").agg(F.max_by("c", F.struct("m", "c")).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    across = scratch.keep(posts.join(main, "token").join(signs, "rid"), "across")
    scratch.drop("posts")
    sides = ("rid", "n", "l", "p", "c", *SIGNS)
    least, largest = _partners(percent)
    hot = F.col("df") > frequent
    outside = (across.where("c != main").withColumn("least", least).withColumn("largest", largest).where("least <= largest")
               .select("token", F.explode(F.when(hot, F.sequence(_band(F.col("least")), _band(F.col("largest")))).otherwise(F.array(F.lit(0).cast("long")))).alias("band"),
                       *(F.col(k).alias(f"x_{k}") for k in sides)))
    inside = across.select("token", F.when(hot, _band(F.col("n"))).otherwise(F.lit(0).cast("long")).alias("band"), "main", *(F.col(k).alias(f"y_{k}") for k in sides))
    asked = F.least("x_l", "y_l")
    overlap = F.expr(f"({percent} * (x_n + y_n) + {99 + percent}) div {100 + percent}")
    pairs = (outside.join(inside, ["token", "band"])
             .where((F.col("x_c") != F.col("y_c")) & ((F.col("y_c") == F.col("main")) | (F.col("x_rid") < F.col("y_rid"))) & _alike(percent)
                    & (F.col("x_p") <= F.col("x_n") - overlap + asked) & (F.col("y_p") <= F.col("y_n") - overlap + asked))
             .groupBy(F.least("x_rid", "y_rid").alias("x"), F.greatest("x_rid", "y_rid").alias("y"))
             .agg(F.count("*").alias("m"), F.min(asked).alias("asked")).where("m >= asked").select("x", "y"))
    pairs = scratch.keep(pairs, "candidates")
    pairs = _bounded(pairs, rows, percent, held, scratch, "pairs")
    more = _verified(pairs, texts, n, percent, scratch, "links")
    edges = links.union(more)
    # Rows that share a doc_id are one document: its sets meet in it.
    own = linked.join(same, ["n", "s1", "s2"]).where("doc_id != rid").select(F.col("doc_id").alias("x"), F.col("rid").alias("y"))
    final = components(edges.union(own).select(F.col("x").alias("src"), F.col("y").alias("dst")), "ngram-last")
    return (rows.select("doc_id", F.col("n").alias("n_shingles")).join(final.toDF("doc_id", "c"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component, with their columns."""
    parts = near_duplicates(docs, n, percent)
    gone = parts.where("doc_id != component_id").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.join(gone, rows.doc_id == gone.gone, "left_anti").select("row.*")
