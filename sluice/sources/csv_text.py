"""All-text CSV scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.shapes import THOUSANDS
from sluice.functions.text import c, header_name
from sluice.sources.csv_records import read_header, scan

# Header spellings of the two export styles.
TITLE_HEADERS = ("Unique Key", "Started At", "Completed At", "Ingested At")
SNAKE_HEADERS = ("unique_key", "started_at", "completed_at", "ingested_at")
_MONTHS = ("(January|February|March|April|May|June|July|August|September|October|November|"
           "December)")
MONTH_NAME = rf"^\s*({_MONTHS}\s+[0-9]{{1,2}},\s*[0-9]{{4}}|[0-9]{{1,2}}\s+{_MONTHS}\s+[0-9]{{4}})"
ISO_LIKE = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}|\s*$)"


def scan_csv(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """(cells as text under positional names c0..cN plus ``_rid``, header).

    Positional names keep repeated headers apart.  Cells are trimmed; empty and
    ``NA`` cells are null.  ``_rid`` follows the input order."""
    found = scan(spark, path, header)
    return found.rows, found.header


def scan_columns(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame | None:
    """Columns of a second export by normalised header name; None when one is missing."""
    header = read_header(spark, path)
    at = {header_name(h): i for i, h in reversed(list(enumerate(header)))}
    if any(n not in at for n in names):
        return None
    return scan(spark, path, header).rows.select(*[F.col(f"c{at[n]}").alias(n) for n in names])


def style_counts(df: DataFrame, columns: Sequence[str], rows: int | None = None) -> DataFrame:
    """Cells with ISO datetimes, month-name datetimes and thousands separators.
    ``rows`` limits the look to a sample; without it the whole table counts."""
    sample = df if rows is None else df.limit(rows)

    def total(pattern: str) -> Column:
        cells = F.lit(0)
        for n in columns:
            cells = cells + F.coalesce(c(n).rlike(pattern), F.lit(False)).cast("int")
        return F.coalesce(F.sum(cells), F.lit(0))

    return sample.agg(total(ISO_LIKE).alias("n_iso"), total(MONTH_NAME).alias("n_month"),
                      total(THOUSANDS).alias("n_thousands"))


def header_style(header: Sequence[str]) -> str:
    names = {h.strip() for h in header}
    title, snake = bool(names & set(TITLE_HEADERS)), bool(names & set(SNAKE_HEADERS))
    return "unknown" if title == snake else "metabase" if title else "database"


def combined_style(header: str, n_iso: Column, n_month: Column, n_thousands: Column) -> Column:
    """database, metabase, mixed or unknown, from the header and the values."""
    values = (F.when((n_iso > 0) & ((n_month > 0) | (n_thousands > 0)), "mixed")
              .when(n_iso > 0, "database").when(n_month > 0, "metabase").otherwise("unknown"))
    if header == "unknown":
        return values
    return F.when(values.isin("unknown", header), F.lit(header)).otherwise("mixed")


def detect_style(df: DataFrame, header: Sequence[str], rows: int | None = None) -> str:
    """Export style of a scanned file, from all its rows; informational, parsing does not use it."""
    counts = style_counts(df, [n for n in df.columns if n != "_rid"], rows)
    return counts.select(combined_style(header_style(header), F.col("n_iso"), F.col("n_month"),
                                        F.col("n_thousands"))).first()[0]
