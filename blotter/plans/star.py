"""The star schema as one set of layers: build in memory, write, read back.

:class:`Star` derives every layer lazily from the raw feeds, so a report
only plans the layers it reads (a report never builds a surrogate key it
does not use). :func:`write_star` persists the layers in dependency order and
rereads each one, so later layers start from the written files (exact sizes
for the broadcast checks, no recomputation) rather than from lineage.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import clean, dims, facts, quality
from blotter.sources.files import exists
from blotter.sources.sinks import write_table
from blotter.sources.tables import RawInputs

LAYERS = ["clean_calls", "clean_incidents", "dim_date", "dim_time", "dim_location", "dim_offense",
          "dim_call_type", "dim_call_disposition", "fact_calls", "fact_incidents",
          "fact_calls_enriched"]
FACTS = {"fact_calls", "fact_incidents", "fact_calls_enriched"}
# Columns whose NULLs are counted while a layer is written (row counts are
# observed for every layer).
OBSERVED_NULLS = {
    "clean_calls": ["call_received"],
    "clean_incidents": ["incident_occurred", "incident_reported"],
    "fact_calls": ["date_key"],
    "fact_incidents": ["date_key"],
    "fact_calls_enriched": ["location_key", "call_type_key", "call_disposition_key"],
}


@dataclass
class Star:
    spark: SparkSession
    raw: RawInputs | None
    normalize_lookups: bool = False
    tables: dict = field(default_factory=dict)

    def _layer(self, name: str, build) -> DataFrame:
        """A written layer when one was stored, else its lazy definition."""
        return self.tables[name] if name in self.tables else build()

    @cached_property
    def clean_calls(self) -> DataFrame:
        return self._layer("clean_calls", lambda: clean.clean_calls(self.raw.calls))

    @cached_property
    def clean_incidents(self) -> DataFrame:
        return self._layer("clean_incidents", lambda: clean.clean_incidents(self.raw.incidents))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._layer("dim_date", lambda: dims.dim_date(self.spark))

    @cached_property
    def dim_time(self) -> DataFrame:
        return self._layer("dim_time", lambda: dims.dim_time(self.spark))

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._layer("dim_location", lambda: dims.dim_location(
            self.clean_incidents, self.clean_calls))

    @cached_property
    def dim_offense(self) -> DataFrame:
        return self._layer("dim_offense", lambda: dims.dim_offense(self.clean_incidents))

    @cached_property
    def dim_call_type(self) -> DataFrame:
        return self._layer("dim_call_type", lambda: dims.dim_call_type(
            self.clean_calls, self.raw.ref_tencode, self.raw.ref_suffix))

    @cached_property
    def dim_call_disposition(self) -> DataFrame:
        return self._layer("dim_call_disposition",
                           lambda: dims.dim_call_disposition(self.clean_calls))

    @cached_property
    def fact_calls(self) -> DataFrame:
        return self._layer("fact_calls", lambda: facts.fact_calls(self.clean_calls))

    @cached_property
    def fact_incidents(self) -> DataFrame:
        return self._layer("fact_incidents", lambda: facts.fact_incidents(self.clean_incidents))

    @cached_property
    def fact_calls_enriched(self) -> DataFrame:
        return self._layer("fact_calls_enriched", lambda: facts.fact_calls_enriched(
            self.clean_calls, self.dim_location, self.dim_call_type, self.dim_call_disposition,
            normalize=self.normalize_lookups))

    @cached_property
    def matched_calls(self) -> DataFrame:
        """The enriched calls with 1 for every key that a lookup finds: nothing is numbered to count what is missing."""
        return facts.lookup_calls(
            self.clean_calls, dims.dim_location(self.clean_incidents, self.clean_calls, with_key=False),
            dims.dim_call_type(self.clean_calls, self.raw.ref_tencode, self.raw.ref_suffix, with_key=False),
            dims.dim_call_disposition(self.clean_calls, with_key=False), normalize=self.normalize_lookups)

    def stored(self, name: str, df: DataFrame) -> None:
        """Use ``df`` as layer ``name``: every layer not stored itself is built anew from it."""
        self.tables[name] = df
        for attr in [a for a, v in vars(type(self)).items() if isinstance(v, cached_property)]:
            if attr not in self.tables or attr == name:
                self.__dict__.pop(attr, None)

    # Report inputs: facts without surrogate keys unless already written.
    @cached_property
    def calls_for_reports(self) -> DataFrame:
        return self._layer("fact_calls", lambda: facts.fact_calls(self.clean_calls, with_key=False))

    @cached_property
    def incidents_for_reports(self) -> DataFrame:
        return self._layer("fact_incidents", lambda: facts.fact_incidents(self.clean_incidents, with_key=False))


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("year_month", (F.col("date_key") / 100).cast("int"))


def write_star(star: Star, out_dir: str, layers: list[str] | None = None,
               fact_partitions: int | None = None) -> dict:
    """Write the layers as Parquet under ``out_dir`` and reread each one.

    Facts are partitioned by ``year_month`` (reports filter by date, which
    then prunes directories) and range-clustered by (year_month, key) into
    ``fact_partitions`` tasks (default: the shuffle partitions; size it to
    about a gigabyte per task at scale), so a busy month is split over several
    tasks and files. Returns, per layer, the row and NULL counters observed
    while it was written (no extra pass over the data).
    """
    spark = star.spark
    metrics = {}
    for name in layers or LAYERS:
        path = f"{out_dir.rstrip('/')}/{name}"
        df = getattr(star, name)
        partition_by = []
        if name.startswith("dim_"):
            # Dimensions are written in key order (a distributed range sort).
            df = df.orderBy(df.columns[0])
        if name in FACTS:
            # Cluster first: the range bounds are sampled by a job of their
            # own, which must not run the observed plan (counters would double).
            n = fact_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
            df = _with_month(df).repartitionByRange(n, "year_month", df.columns[0])
            partition_by = ["year_month"]
        df, metrics[name] = quality.observe_quality(df, name, OBSERVED_NULLS.get(name, []))
        write_table(df, path, partition_by=partition_by)
        star.stored(name, spark.read.parquet(path))
    return {k: v.get for k, v in metrics.items()}


# Reports broadcast the calendar and the clock. Generated, their size follows
# from the calendar range; reread from files it is checked once here.
BROADCAST_DIM_ROWS = {"dim_date": 200_000, "dim_time": 24 * 60}


def read_star(spark: SparkSession, raw: RawInputs | None, out_dir: str, layers: list[str] | None = None) -> Star:
    """A written star. Each of ``layers`` (default: all) must be there; to build
    missing ones from raw feeds, name only those that exist."""
    star = Star(spark, raw)
    for name in layers or LAYERS:
        path = f"{out_dir.rstrip('/')}/{name}"
        if not exists(spark, path):
            raise FileNotFoundError(f"no layer {name} at {path}")
        star.stored(name, spark.read.parquet(path))
    for name, bound in BROADCAST_DIM_ROWS.items():
        if name in star.tables and star.tables[name].count() > bound:
            raise ValueError(f"{name} has more than {bound} rows; reports broadcast it")
    return star


# Table names the star schema is queried by in SQL.
VIEW_NAMES = {
    "clean_calls": "clean_calls_for_service_v2",
    "clean_incidents": "clean_incidents_v2",
    "dim_date": "dim_date",
    "dim_time": "dim_time",
    "dim_location": "dim_location",
    "dim_offense": "dim_offense",
    "dim_call_type": "dim_call_type",
    "dim_call_disposition": "dim_call_disposition",
    "fact_calls_enriched": "fact_calls_for_service_v2",
    "fact_calls": "fact_calls_for_service_v3",
    "fact_incidents": "fact_incidents_v2",
}


def register_views(star: Star, layers: list[str] | None = None) -> list[str]:
    """Expose layers as temp views under their SQL table names, so existing
    report SQL runs unchanged through ``spark.sql``.

    Only the named layers are touched: a layer with surrogate keys runs its
    key jobs when registered, so report-only sessions register just the facts
    and dimensions the reports read (the facts without keys when unwritten).
    """
    names = layers or ["dim_date", "dim_time", "fact_calls", "fact_incidents"]
    out = []
    for name in names:
        if name == "fact_calls" and "fact_calls" not in star.tables:
            df = star.calls_for_reports
        elif name == "fact_incidents" and "fact_incidents" not in star.tables:
            df = star.incidents_for_reports
        else:
            df = getattr(star, name)
        df.createOrReplaceTempView(VIEW_NAMES[name])
        out.append(VIEW_NAMES[name])
    return out
