"""Values typed by their own shape: numbers, datetimes, yes/no words.

Each parser returns one struct column (value plus the shape that was
recognised), so typing and the counts report share one evaluation.
Timestamps are wall-clock times (``TIMESTAMP_NTZ``): an offset in the text is
dropped, never applied, and the session time zone plays no part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import is_in, trim

# yes/no words, compared in lower case.
TRUE_TOKENS = ("true", "yes", "y", "1", "t")
FALSE_TOKENS = ("false", "no", "n", "0", "f")

PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
THOUSANDS = r"^[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$"
DECIMAL_COMMA = r"^[+-]?[0-9]+,[0-9]{1,2}$"
NUMBER_RUN = r"[0-9]+(?:\.[0-9]+)?"

ISO = (r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}"
       r"([ T][0-9]{1,2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?\s*(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?)?$")
ISO_OFFSET = r"(:[0-9]{2}(?:\.[0-9]+)?)\s*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"
_TIME = r"(?:[ T,]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}(?:\.[0-9]+)?))?\s*([AaPp][Mm])?)?"
_MONTH_NAMES = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
_MONTH = _MONTH_NAMES + r"[a-z]*\.?"
DAY_FIRST = r"^([0-9]{1,2})([/.-])([0-9]{1,2})\2([0-9]{4}|[0-9]{2})" + _TIME + "$"
MONTH_FIRST = (r"^(0?[0-9]|1[0-2])([/.-])(1[3-9]|[2-9][0-9])\2([0-9]{4}|[0-9]{2})" + _TIME + "$")
MONTH_DAY = r"(?i)^" + _MONTH + r"\s+([0-9]{1,2}),?\s+([0-9]{4})" + _TIME + "$"
DAY_MONTH = r"(?i)^([0-9]{1,2})[ -]" + _MONTH + r"[ ,-]+([0-9]{4})" + _TIME + "$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def numeric_shape(col: Column) -> Column:
    """struct(value double, shape string): plain, thousands, decimal_comma,
    fallback (text holding exactly one number), multi_number, non_numeric;
    shape is null for an empty cell."""
    s = trim(col)

    def out(text: Column | None, shape: str) -> Column:
        value = F.lit(None).cast("double") if text is None else text.try_cast("double")
        return F.struct(value.alias("value"), F.lit(shape).alias("shape"))

    runs = F.regexp_count(s, F.lit(NUMBER_RUN))
    return (F.when(s.isNull() | (s == ""), F.struct(F.lit(None).cast("double").alias("value"),
                                                     F.lit(None).cast("string").alias("shape")))
            .when(s.rlike(PLAIN_NUMBER), out(s, "plain"))
            .when(s.rlike(THOUSANDS), out(F.replace(s, F.lit(","), F.lit("")), "thousands"))
            .when(s.rlike(DECIMAL_COMMA), out(F.replace(s, F.lit(","), F.lit(".")), "decimal_comma"))
            .when(runs == 1, out(F.regexp_extract(s, NUMBER_RUN, 0), "fallback"))
            .when(runs > 1, out(None, "multi_number"))
            .otherwise(out(None, "non_numeric")))


def parse_number(col: Column) -> Column:
    return numeric_shape(col)["value"]


def bind(col: Column, body) -> Column:
    """Evaluate ``col`` once and hand it to ``body``; keeps plans small where an
    intermediate value is used many times."""
    return F.get(F.transform(F.array(col), body), F.lit(0))


def _twelve_hour(text: Column) -> Column:
    """Timestamp from ``y-m-d h:m[:s][am|pm]`` text; null when out of range."""
    clock = F.regexp_replace(text, r"(?i)( ?:+|:)?([ap]m)?$", "").try_cast("timestamp_ntz")
    half_day = F.expr("INTERVAL 12 HOURS")
    return (F.when(~text.rlike("(?i)[ap]m$"), clock)
            .when(text.rlike(r" (00?|1[3-9]|[2-9][0-9]):"), F.lit(None))
            .when(text.rlike(r"(?i) 12:.*am$"), clock - half_day)
            .when(text.rlike(r"(?i) (0?[1-9]|1[01]):.*pm$"), clock + half_day)
            .otherwise(clock))


def datetime_shape(col: Column) -> Column:
    """struct(value timestamp_ntz, route string, offset_dropped boolean).

    ``route`` is the rule the text was sent to: iso, day_first, month_first (only
    valid as month/day/year: rejected, not reinterpreted), month_name or other;
    null for an empty cell.  ``datetime_class`` turns it into the report class."""
    s = trim(col)
    blank = s.isNull() | (s == "") | (s == "NA")
    iso = F.translate(F.regexp_replace(s, ISO_OFFSET, "$1"), "/", "-").try_cast("timestamp_ntz")

    def spelled(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, "(?i)" + _MONTH_NAMES, 0))
        month = ((F.instr(F.lit(_MONTHS), name) + 2) / 3).cast("int").cast("string")
        return (F.when(t.rlike(DAY_FIRST),
                       F.regexp_replace(F.regexp_replace(t, DAY_FIRST, "$4-$3-$1 $5:$6:$7$8"),
                                        "^([0-9]{2})-", "20$1-"))
                .when(t.rlike(MONTH_DAY), F.regexp_replace(
                    t, F.lit(MONTH_DAY), F.concat(F.lit("$3-"), month, F.lit("-$2 $4:$5:$6$7"))))
                .when(t.rlike(DAY_MONTH), F.regexp_replace(
                    t, F.lit(DAY_MONTH), F.concat(F.lit("$3-"), month, F.lit("-$1 $4:$5:$6$7")))))

    route = (F.when(blank, F.lit(None)).when(s.rlike(ISO), "iso")
             .when(s.rlike(MONTH_FIRST), "month_first").when(s.rlike(DAY_FIRST), "day_first")
             .when(s.rlike(MONTH_DAY) | s.rlike(DAY_MONTH), "month_name").otherwise("other"))
    return F.struct(F.when(blank, F.lit(None)).when(s.rlike(ISO), iso)
                    .otherwise(bind(spelled(s), _twelve_hour)).alias("value"),
                    route.alias("route"),
                    F.coalesce(s.rlike(ISO) & s.rlike(ISO_OFFSET), F.lit(False))
                    .alias("offset_dropped"))


def datetime_class(d: Column) -> Column:
    """Report class of a ``datetime_shape`` struct: the route when a value came
    out of it, month_first, or unparsed."""
    return (F.when(d["route"].isNull() | (d["route"] == "month_first") | d["value"].isNotNull(),
                   d["route"]).otherwise(F.lit("unparsed")))


def parse_datetime(col: Column) -> Column:
    return datetime_shape(col)["value"]


def parse_boolean(col: Column) -> Column:
    """True/false words in any case; anything else is null."""
    s = F.lower(trim(col))
    return F.when(is_in(s, TRUE_TOKENS), F.lit(True)).when(is_in(s, FALSE_TOKENS), F.lit(False))


def format_datetime(col: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
