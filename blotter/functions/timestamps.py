"""Timestamp parsing and the date / time surrogate keys.

Raw timestamps arrive as text like ``2025/10/28 18:10:52+00``. The trailing
``+00`` is removed (not applied: the session zone is UTC) and the rest is
parsed with a tolerant parser, so malformed text becomes NULL instead of
failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw timestamp layout and the offset suffix it carries.
RAW_TS_FORMAT = "yyyy/MM/dd HH:mm:ss"
RAW_TS_SUFFIX = r"\+00$"


def parse_raw_ts(text: Column) -> Column:
    """Text -> TIMESTAMP; NULL when the text does not match the layout."""
    cleaned = F.regexp_replace(text.cast("string"), RAW_TS_SUFFIX, "")
    return F.try_to_timestamp(cleaned, F.lit(RAW_TS_FORMAT))


def parse_ts_column(df: DataFrame, name: str) -> Column:
    """Parse ``df[name]`` by its type: text is parsed, timestamps pass through.

    Casting a timestamp to text and parsing it with the raw layout would give
    NULL for every row, so already-typed columns are kept as they are.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name).cast(T.TimestampType())
    return parse_raw_ts(F.col(name))


def date_key(ts: Column) -> Column:
    """yyyyMMdd as INT (20251028); NULL for a NULL timestamp.

    One reference to ``ts``: when the timestamp is computed (parsed text) and
    a filter on the key is pushed into the scan, Catalyst inlines ``ts`` into
    the filter, where no common-subexpression elimination happens.
    """
    return F.date_format(ts, "yyyyMMdd").cast("int")


def time_key(ts: Column) -> Column:
    """Hour grain key HH00 as INT (18:10 -> 1800, 00:10 -> 0)."""
    return (F.hour(ts) * 100).cast("int")


def date_key_of_date(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
