"""Streaming use of the row-wise steps (an addition; the rules are batch rules).

Id repair, redaction and the shape parsers are plain column expressions, so they
run on a stream as they are.  The one stateful rule that carries over is "the
same record sent again within an hour"."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.pii import VALUE_PATTERNS, redact
from sluice.functions.shapes import parse_boolean, parse_datetime, parse_number
from sluice.functions.text import c
from sluice.operators.ids import is_empty_id, repair_id

PARSERS = {"numeric": parse_number, "datetime": parse_datetime, "boolean": parse_boolean}


def clean_stream(stream: DataFrame, types: Mapping[str, str], separators: Sequence[str] = (",", "/"),
                 exempt: Sequence[str] = ("uid", "facility", "uniquekey")) -> DataFrame:
    """Rows with an id, the id repaired, cells redacted and typed."""
    dtypes = dict(stream.dtypes)
    out = stream.filter(~is_empty_id(F.col("uid"))).withColumn("uid", repair_id(F.col("uid"), separators))
    cells = []
    for n in out.columns:
        x = redact(c(n), VALUE_PATTERNS) if dtypes[n] == "string" and n not in exempt else c(n)
        cells.append(PARSERS[types[n]](x).alias(n) if n in types else x.alias(n))
    return out.select(*cells)


def drop_resent(stream: DataFrame, time: str, keys: Sequence[str], window: str = "1 hour") -> DataFrame:
    """Drops copies with equal keys that arrive within the window."""
    return stream.withWatermark(time, window).dropDuplicatesWithinWatermark(list(keys))
