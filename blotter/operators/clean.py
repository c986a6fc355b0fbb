"""Clean layer: parse raw timestamp text in place, keep every row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from blotter.functions.timestamps import parse_ts_column


def clean_calls(calls: DataFrame) -> DataFrame:
    """``call_received`` text -> TIMESTAMP (NULL when unparseable)."""
    return calls.withColumn("call_received", parse_ts_column(calls, "call_received"))


def clean_incidents(incidents: DataFrame) -> DataFrame:
    """``incident_occurred`` / ``incident_reported`` text -> TIMESTAMP."""
    return incidents.withColumns({
        "incident_occurred": parse_ts_column(incidents, "incident_occurred"),
        "incident_reported": parse_ts_column(incidents, "incident_reported"),
    })
