"""Data-quality metrics, computed in one pass instead of one action each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from blotter.functions.rules import CALENDAR_END, CALENDAR_START


def _nulls(c: str) -> Column:
    return F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint")


def _outside(ts: str, start: str, end: str) -> Column:
    d = F.to_date(F.col(ts))
    return F.sum(F.when(d.isNotNull() & ((d < F.lit(start).cast("date")) | (d > F.lit(end).cast("date"))),
                        1).otherwise(0)).cast("bigint")


def table_metrics(df: DataFrame, table: str, null_cols: Sequence[str],
                  calendar_col: str | None = None, start: str = CALENDAR_START,
                  end: str = CALENDAR_END) -> DataFrame:
    """(table, metric, value) rows: row count, NULLs per column, and parsed
    timestamps that fall outside the calendar (they vanish in inner joins)."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("rows")]
    aggs += [_nulls(c).alias(f"null_{c}") for c in null_cols]
    if calendar_col:
        aggs.append(_outside(calendar_col, start, end).alias("outside_calendar"))
    wide = df.agg(*aggs)
    metrics = [c for c in wide.columns]
    return (wide.unpivot([], metrics, "metric", "value")
                .select(F.lit(table).alias("table"), "metric", "value"))


def quality_metrics(calls_clean: DataFrame, incidents_clean: DataFrame) -> DataFrame:
    return table_metrics(calls_clean, "calls", ["call_received"], "call_received").unionByName(
        table_metrics(incidents_clean, "incidents", ["incident_occurred", "incident_reported"],
                      "incident_occurred"))


def fact_metrics(calls_clean: DataFrame, looked_up: DataFrame) -> DataFrame:
    """(table, metric, value): rows into and out of the enriched calls, and its lookups without a key."""
    keys = ["location_key", "call_type_key", "call_disposition_key", "date_key"]
    rows_in = calls_clean.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(
        F.lit("fact_calls_enriched").alias("table"), F.lit("rows_in").alias("metric"), "value")
    return rows_in.unionByName(table_metrics(looked_up, "fact_calls_enriched", keys))


def observe_quality(df: DataFrame, name: str, null_cols: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Attach row / NULL counters to ``df``; they fill in during its write."""
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          *[_nulls(c).alias(f"null_{c}") for c in null_cols])
    return observed, obs


def preview(df: DataFrame, columns: Sequence[str] | None = None, n: int = 20) -> DataFrame:
    """A few rows to eyeball after a step (raw text next to its parsed value,
    say). The limit is the point here: it is a sample, never an input."""
    return (df.select(*columns) if columns else df).limit(n)
