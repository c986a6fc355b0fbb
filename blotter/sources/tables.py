"""Readers for the driver's test tables and for written layers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import prepare
from blotter.sources import fixtures


Feed = DataFrame | Callable[[], DataFrame]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table (``db.table``); the counterpart of a catalog scan."""
    return spark.table(name)


class RawInputs:
    """The four raw feeds, each built when first asked for: a report on calls plans no incidents.

    ``corrupt`` has, for feeds from CSV, (feed, ingest_run_ts_utc, rows, corrupt): how many rows of each drop did
    not fit their columns and so are in the feeds with NULLs; None for other sources.
    """

    def __init__(self, calls: Feed, incidents: Feed, ref_tencode: Feed, ref_suffix: Feed,
                 corrupt: DataFrame | None = None) -> None:
        self.corrupt = corrupt
        self._feeds = {"calls": calls, "incidents": incidents, "ref_tencode": ref_tencode, "ref_suffix": ref_suffix}

    def __getattr__(self, name: str) -> DataFrame:
        feeds = self.__dict__.get("_feeds", {})
        if name not in feeds:
            raise AttributeError(name)
        feed = feeds[name]
        setattr(self, name, feed if isinstance(feed, DataFrame) else feed())
        return self.__dict__[name]


def raw_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    """Raw calls / incidents mapped from ``events`` / ``orders`` under ``sf_dir``:
    lazy plans, built anew on each call, so files that were added are seen."""
    prepare(spark)
    return RawInputs(
        calls=lambda: fixtures.calls_from_events(read_parquet(spark, f"{sf_dir}/events.parquet")),
        incidents=lambda: fixtures.incidents_from_orders(read_parquet(spark, f"{sf_dir}/orders.parquet")),
        ref_tencode=lambda: fixtures.ref_tencode(spark),
        ref_suffix=lambda: fixtures.ref_suffix(spark),
    )


def raw_from_tables(spark: SparkSession, calls: str, incidents: str, ref_tencode: str, ref_suffix: str) -> RawInputs:
    """Raw inputs from catalog tables or views (``db.table``)."""
    prepare(spark)
    return RawInputs(*[read_table(spark, name) for name in (calls, incidents, ref_tencode, ref_suffix)])


def raw_from_csv(spark: SparkSession, calls_csv: str, incidents_csv: str, ref_tencode_csv: str,
                 ref_suffix_csv: str, run_ts: str | None = None,
                 raw_dir: str | None = None) -> RawInputs:
    """Raw inputs from CSV drops (header row, explicit schemas).

    With ``raw_dir`` the feeds are landed as Parquet there first and the whole
    raw layer, earlier drops included, is read back from it.
    """
    from blotter import schemas
    from blotter.sources.landing import corrupt_rows, land_csv, run_timestamp

    prepare(spark)
    run_ts = run_ts or run_timestamp()

    counts = []

    def landed(path: str, schema, name: str, stamp: bool) -> DataFrame:
        out = f"{raw_dir}/{name}" if raw_dir else None
        df = land_csv(spark, path, schema, run_ts=run_ts, out_path=out)
        counts.append(corrupt_rows(df).select(F.lit(name).alias("feed"), "*"))
        df = df.drop("_corrupt_record")
        return df if stamp else df.drop("ingest_run_ts_utc")

    feeds = {
        "calls": landed(calls_csv, schemas.CALLS_RAW, "calls", True),
        "incidents": landed(incidents_csv, schemas.INCIDENTS_RAW, "incidents", False),
        "ref_tencode": landed(ref_tencode_csv, schemas.REF_TENCODE, "ref_tencode", False),
        "ref_suffix": landed(ref_suffix_csv, schemas.REF_SUFFIX, "ref_suffix", False),
    }
    return RawInputs(**feeds, corrupt=reduce(DataFrame.unionByName, counts))
