"""Fact builders: one row per source call / incident, with star keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.timestamps import date_key, parse_ts_column, time_key
from blotter.operators.joins import MAX_BROADCAST_BYTES, left_lookup, measured
from blotter.operators.keys import dense_key

# The facts' columns, in the order of their tables.
CALL_FACT_COLUMNS = ["call_key", "complaint_number", "date_key", "time_key", "latitude",
                     "longitude", "rpa", "zone", "call_received", "ingest_run_ts_utc"]
INCIDENT_FACT_COLUMNS = ["incident_key", "incident_number", "date_key", "time_key",
                         "offense_number", "offense_nibrs", "latitude", "longitude",
                         "incident_occurred", "incident_reported"]
ENRICHED_CALL_COLUMNS = ["call_key", "event_number", "complaint_number", "date_key", "time_key",
                         "location_key", "call_type_key", "call_disposition_key", "shift",
                         "sector", "call_received_utc", "ingest_run_ts_utc"]


def fact_calls(calls_clean: DataFrame, with_key: bool = True, **key_options) -> DataFrame:
    """Calls fact keyed by complaint number (ties broken by event number).

    ``with_key=False`` skips the surrogate key for reports that never read
    it; every other column is a narrow projection of the clean calls.
    """
    ts = F.col("call_received")
    f = calls_clean.select(
        "event_number", "complaint_number",
        date_key(ts).alias("date_key"), time_key(ts).alias("time_key"),
        "latitude", "longitude", "rpa", F.col("zone_").alias("zone"),
        "call_received", "ingest_run_ts_utc")
    if not with_key:
        return f.select(*[c for c in CALL_FACT_COLUMNS if c != "call_key"])
    f = dense_key(f, ["complaint_number"], key="call_key", ties=["event_number"], **key_options)
    return f.select(*CALL_FACT_COLUMNS)


def fact_incidents(incidents_clean: DataFrame, with_key: bool = True, **key_options) -> DataFrame:
    ts = F.col("incident_occurred")
    f = incidents_clean.select(
        "incident_number", date_key(ts).alias("date_key"), time_key(ts).alias("time_key"),
        "offense_number", "offense_nibrs", "latitude", "longitude",
        "incident_occurred", "incident_reported")
    if not with_key:
        return f
    f = dense_key(f, ["incident_number"], key="incident_key", **key_options)
    return f.select(*INCIDENT_FACT_COLUMNS)


def lookup_calls(calls_clean: DataFrame, dim_location: DataFrame, dim_call_type: DataFrame,
                 dim_call_disposition: DataFrame, normalize: bool = False,
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The enriched calls before they are numbered.

    By default the lookups compare the codes as the feed has them, as the
    dimensions were built from trimmed / upper-cased codes: padded or
    lower-case codes and NULL suffixes then find no key. ``normalize=True``
    applies the dimensions' normalisation to the fact side and matches NULL
    suffixes null-safely. Dimensions are de-duplicated on their lookup key
    (smallest surrogate key wins) so a lookup never multiplies fact rows.
    """
    ts = parse_ts_column(calls_clean, "call_received")
    calls = calls_clean.select(
        "event_number", "complaint_number", "latitude", "longitude", "tencode", "tencode_suffix",
        "disposition_code", "shift", "sector", "ingest_run_ts_utc",
        ts.alias("call_received_utc"))
    calls = calls.withColumns({"date_key": date_key(F.col("call_received_utc")),
                               "time_key": time_key(F.col("call_received_utc"))})

    def first_keys(dim: DataFrame, key: str, on: list[str]) -> DataFrame:
        return dim.groupBy(*on).agg(F.min(key).alias(key))

    suffix, code = F.col("tencode_suffix"), F.col("disposition_code")
    if normalize:
        suffix, code = F.trim(F.upper(suffix)), F.trim(code)
    for dim, key, pairs, null_safe in [
            (dim_location, "location_key", [(F.col("latitude"), "latitude"), (F.col("longitude"), "longitude")], None),
            (dim_call_type, "call_type_key", [(F.col("tencode").try_cast("int"), "tencode"), (suffix, "tencode_suffix")],
             [False, normalize]),
            (dim_call_disposition, "call_disposition_key", [(code, "disposition_code")], None)]:
        lookup, size = measured(first_keys(dim, key, [c for _, c in pairs]))
        calls = left_lookup(calls, lookup, pairs, null_safe, max_broadcast_bytes, size)
    return calls.select(*[c for c in ENRICHED_CALL_COLUMNS if c != "call_key"])


def fact_calls_enriched(calls_clean: DataFrame, dim_location: DataFrame, dim_call_type: DataFrame,
                        dim_call_disposition: DataFrame, normalize: bool = False,
                        max_broadcast_bytes: int = MAX_BROADCAST_BYTES, **key_options) -> DataFrame:
    """Calls fact with location, call-type and disposition keys (see :func:`lookup_calls`)."""
    f = lookup_calls(calls_clean, dim_location, dim_call_type, dim_call_disposition, normalize, max_broadcast_bytes)
    return dense_key(f, ["event_number", "call_received_utc"], key="call_key", **key_options).select(*ENRICHED_CALL_COLUMNS)
