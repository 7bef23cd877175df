"""Records of CSV files whose cells may hold line ends.

Spark reads physical lines in parallel splits; a quoted cell may run over several of them.  Whether a line starts
inside such a cell follows from the number of quotes before it in its file: odd means inside.  A first reading counts
quotes and bytes per split; their running sums per file (one row per split) tell every split with which state and
at which byte it begins.  A second reading stitches lines to records within each split, as a stream, and stores them;
nothing reads the files again.  Only the pieces of records that cross a split are brought together by key.

A record is identified by its file and the byte offset of its first line, so the identity does not depend on splits, cores
or the number of times the file is read.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.text import BLANKS, normalise_cell
from sluice.session import cut_lineage, ship

#: Bits of a record id that hold the byte offset; the bits above number the files.
OFFSET_BITS = 44
#: A quote that opens or closes a cell, once doubled quotes are gone: at the front or the end of a cell.
_EDGE = r'(?<![^,])"|"(?![^,\r])'
_SPLIT = ["path", "start"]
_RECORDS = "path string, start bigint, rid bigint, text string, piece string"


@dataclass(frozen=True)
class Scan:
    """``rows`` (``_rid`` and cells c0..cN as text, trimmed, empty and ``NA`` null), the header as written, and the
    ``problems`` (rid, problem, n_cells, n_chars) of records left out of the rows."""

    rows: DataFrame
    header: list[str]
    problems: DataFrame


def edge_quotes(line: Column) -> Column:
    """How many quotes of a line open or close a cell."""
    return F.regexp_count(F.replace(line, F.lit('""'), F.lit("")), F.lit(_EDGE))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their split; line feeds alone end a line, so that lengths add up to offsets."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"), edge_quotes(F.col("value")).cast("bigint").alias("quotes"),
        (F.octet_length("value").cast("bigint") + 1).alias("bytes"))


def split_starts(lines: DataFrame) -> DataFrame:
    """Per split: whether an odd number of quotes comes before it, and the id of a record that begins with it."""
    sums = lines.groupBy(*_SPLIT).agg(F.sum("quotes").alias("quotes"), F.sum("bytes").alias("bytes"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    files = sums.select("path").distinct().select(
        "path", (F.row_number().over(Window.orderBy("path")) - 1).cast("bigint").alias("file"))
    return (sums.select(*_SPLIT, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("odd"),
                        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset")).join(files, "path")
            .select(*_SPLIT, "odd", (F.shiftleft("file", OFFSET_BITS) + F.col("offset")).alias("base")))


def _batch(columns: list) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns, types)],
                                      ["path", "start", "rid", "text", "piece"])


class _Split:
    """The lines of one split, in file order; the last record that began is held until it ends."""

    def __init__(self, name: tuple, odd: int | None, base: int | None):
        if odd is None:
            raise RuntimeError("the input changed between two readings")
        self.name, self.quotes, self.at = name, odd, base
        self.held: list[str] = []
        self.rid: int | None = None

    def held_row(self) -> list[tuple]:
        """What is held, as one row.  ``piece`` tells parts of records that cross a split: ``tail`` goes on in the next
        split, ``head`` ends one of a split before, ``through`` does neither."""
        if not self.held:
            return []
        ended = self.quotes % 2 == 0
        piece = (None if ended else "tail") if self.rid is not None else "head" if ended else "through"
        return [(*self.name, self.rid, "\n".join(self.held), piece)]

    def add(self, lines: pa.Array, count: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        before = self.quotes + np.cumsum(count) - count
        ids = self.at + np.cumsum(size) - size
        first = np.flatnonzero(before % 2 == 0)  # lines that begin a record
        end, self.at = self.quotes + int(count.sum()), self.at + int(size.sum())
        if len(first):
            self.held += lines.slice(0, int(first[0])).to_pylist()
            self.quotes = 0  # what is held ends here
            done = self.held_row()
            if done:
                yield _batch(list(zip(*done)))
            if len(first) > 1:  # all but the last one that begins here end here
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), lines), "\n")
                n = len(joined)
                yield _batch([[self.name[0]] * n, np.full(n, self.name[1]), ids[first[:-1]], joined, pa.nulls(n, pa.string())])
            self.held, self.rid = lines.slice(int(first[-1])).to_pylist(), int(ids[first[-1]])
        else:
            self.held += lines.to_pylist()
        self.quotes = end


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, each in file order, as records."""
    split: _Split | None = None
    for batch in batches:
        col = {k: batch.column(k) for k in batch.schema.names}
        codes, starts = col["path"].dictionary_encode().indices.to_numpy(), col["start"].to_numpy()
        count, size = col["quotes"].to_numpy(), col["bytes"].to_numpy()
        cuts = (np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, len(batch)]):
            if low == high:
                continue
            name = (col["path"][low].as_py(), int(starts[low]))
            if split is None or name != split.name:
                if split is not None and (done := split.held_row()):
                    yield _batch(list(zip(*done)))
                split = _Split(name, col["odd"][low].as_py(), col["base"][low].as_py())
            yield from split.add(col["line"].slice(low, high - low).cast(pa.string()), count[low:high], size[low:high])
    if split is not None and (done := split.held_row()):
        yield _batch(list(zip(*done)))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(rid, text, open): every record of the files at ``path``, headers too, without the line feed at its end.  ``open``
    marks a record whose last quoted cell is never closed.  The split table that is broadcast has one row for each split of the
    input, about a millionth of its size."""
    ship(spark)
    lines = _lines(spark, path)
    starts = cut_lineage(split_starts(lines))
    # Lines must stay in the order of the scan, so the split table goes to them.
    found = cut_lineage(lines.join(F.broadcast(starts), _SPLIT, "left").mapInArrow(_stitched, _RECORDS))
    # A piece without an id belongs to the record that a split before it left open.
    upto = Window.partitionBy("path").orderBy("start", F.col("rid").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    pieces = found.filter("piece IS NOT NULL").withColumn("rid", F.last("rid", ignorenulls=True).over(upto))
    crossing = pieces.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "text", "piece"))).alias("parts")).select(
        "rid", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
        (F.element_at("parts", -1)["piece"] != "head").alias("open"))
    return found.filter("piece IS NULL").select("rid", "text", F.lit(False).alias("open")).unionByName(crossing)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Cells of the first record, as written."""
    k = 1
    while True:
        lines = [r[0] for r in spark.read.option("lineSep", "\n").text(path).limit(k).collect()]
        text = "\n".join(lines).removesuffix("\r")
        if text.count('"') % 2 == 0 or len(lines) < k:
            return next(csv.reader([text.lstrip("﻿")]), []) if lines else []
        k *= 2


def cell_count(text: Column) -> Column:
    """Cells of a record: commas outside quoted cells, plus one."""
    bare = F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), r'(?<![^,])"[^"]*"', "")
    return F.regexp_count(bare, F.lit(",")) + 1


def scan(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> Scan:
    """All cells of the files at ``path`` as text.

    The first record of each file is its header.  Blank lines are no records.  Records with fewer or more cells than the header, or
    with a cell that is never closed, are not among the rows: they are reported by identity and size, without their text."""
    header = list(header or read_header(spark, path))
    width = len(header)
    body = (records(spark, path).filter(F.col("rid").bitwiseAND(F.lit(2**OFFSET_BITS - 1)) > 0)
            .select("rid", "open", F.regexp_replace("text", r"\r\z", "").alias("text"))
            .filter(F.btrim("text", F.lit(BLANKS)) != "").withColumn("n_cells", cell_count(F.col("text"))))
    body = body.withColumn("problem", F.when(F.col("open"), "unclosed").when(F.col("n_cells") < width, "short")
                           .when(F.col("n_cells") > width, "long"))
    schema = ", ".join(f"c{i} string" for i in range(width)) or "c0 string"
    options = {"escape": '"', "multiLine": "true", "maxColumns": str(width + 1)}
    good = body.filter("problem IS NULL").select("rid", F.from_csv("text", schema, options).alias("cells"))
    rows = good.select(F.col("rid").alias("_rid"), *[normalise_cell(F.col(f"cells.c{i}")).alias(f"c{i}") for i in range(width)])
    problems = body.filter("problem IS NOT NULL").select("rid", "problem", "n_cells", F.char_length("text").alias("n_chars"))
    return Scan(rows, header, problems)
