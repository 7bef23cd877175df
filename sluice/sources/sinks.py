"""Writers.  Every row-level writer runs the personal-data gate first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sluice.functions.text import c
from sluice.operators.pii import assert_no_pii
from sluice.operators.reasons import cell_text
from sluice.plans.columns import harmonised_names
from sluice.plans.config import RunConfig
from sluice.plans.dictionary import Dictionary


def as_text(df: DataFrame) -> DataFrame:
    """Cells as the CSV output shows them."""
    types = dict(df.dtypes)
    return df.select(*[cell_text(c(n), types[n]).alias(n) for n in df.columns])


def _own(df: DataFrame) -> DataFrame:
    return df.select(*[c(n) for n in df.columns if not n.startswith("_")])


def _save_csv(text: DataFrame, path: str, compressed: bool = False) -> None:
    writer = text.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "")
    if compressed:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def write_csv(df: DataFrame, path: str, stage: str, dictionary: Dictionary, cfg: RunConfig,
              value_exempt: Sequence[str] = (), compressed: bool = False) -> None:
    text = as_text(_own(df))
    assert_no_pii(text, stage, dictionary, cfg, value_exempt)
    _save_csv(text, path, compressed)


def write_table(df: DataFrame, path: str, stage: str, dictionary: Dictionary, cfg: RunConfig,
                value_exempt: Sequence[str] = ()) -> None:
    """Typed Parquet output."""
    out = _own(df)
    assert_no_pii(out, stage, dictionary, cfg, value_exempt)
    out.write.mode("overwrite").parquet(path)


def write_cleaned(df: DataFrame, csv_path: str, table_path: str, dictionary: Dictionary, cfg: RunConfig) -> None:
    """The cleaned table as text and typed; both hold the same cells, so the
    gate reads them once."""
    text = as_text(_own(df))
    assert_no_pii(text, "cleaned", dictionary, cfg)
    _save_csv(text, csv_path)
    _own(df).write.mode("overwrite").parquet(table_path)


def write_harmonised(df: DataFrame, path: str, dictionary: Dictionary, cfg: RunConfig) -> DataFrame:
    names = harmonised_names(df.columns, dictionary.harmonised)
    out = df.select(*[c(n).alias(names[n]) for n in df.columns if not n.startswith("_")])
    write_table(out, path, "harmonised", dictionary, cfg)
    return out


def write_rejects(df: DataFrame, path: str, dictionary: Dictionary, cfg: RunConfig) -> int:
    """Rows without an id, kept apart; returns how many."""
    n = df.count()
    if n:
        write_csv(df, path, "rejected_rows", dictionary, cfg)
    return n
