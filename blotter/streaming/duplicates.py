"""Clean calls from a stream of files in which records come again.

A record is known by its event number and call time (one without an event number by
all its content). Copies that arrive within ``window`` of each other meet in the state
store; the event time of that state is the file's arrival, so a file with old calls is never
late. Copies that come after their state has gone are found by the sink, which looks
into the months that a batch touches.

The sink keeps one folder per (month, batch). A batch that runs again replaces its
own folders only, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from blotter.plans.star import _with_month
from blotter.functions.timestamps import date_key
from blotter.sources import files
from blotter.sources.sinks import write_table
from blotter.streaming.incremental import clean_stream, read_raw_stream

RECORD = "record_id"


def record_id(df: DataFrame) -> Column:
    """The event number, or a digest of the row (but for its run timestamp) where it has none."""
    content = F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns) if c not in ("ingest_run_ts_utc", "arrived")])
    return F.coalesce(F.concat(F.lit("e"), "event_number"), F.concat(F.lit("r"), F.sha2(F.to_json(content), 256)))


def drop_repeats(raw: DataFrame, window: str = "7 days") -> DataFrame:
    """Clean calls with ``record_id``, each once within ``window``; ``raw`` has the arrival as ``arrived``."""
    known = raw.withColumn(RECORD, record_id(raw))
    return clean_stream(known).withWatermark("arrived", window).dropDuplicatesWithinWatermark([RECORD, "call_received"])


def write_batch(sink_dir: str, batch: DataFrame, batch_id: int) -> None:
    """Add a batch's records that the sink has not, under the batch's own number."""
    spark = batch.sparkSession
    rows = _with_month(batch.drop("arrived").withColumn("date_key", date_key(F.col("call_received")))).drop("date_key")
    rows = rows.withColumn("batch", F.lit(batch_id)).persist()
    try:
        months = [r[0] for r in rows.select("year_month").distinct().collect()]  # of a batch: months of the calendar
        if not months:
            return
        if files.exists(spark, sink_dir):
            touched = F.col("year_month").isin([m for m in months if m is not None])
            if None in months:
                touched = touched | F.col("year_month").isNull()
            there = (spark.read.schema(rows.schema).parquet(sink_dir).where(touched & (F.col("batch") != batch_id))
                     .select(F.col(RECORD).alias("__id"), F.col("call_received").alias("__at")))
            rows = rows.join(there, (F.col(RECORD) == F.col("__id")) & F.col("call_received").eqNullSafe(F.col("__at")), "left_anti")
        write_table(rows, sink_dir, partition_by=["year_month", "batch"], only_partitions=True)
    finally:
        rows.unpersist()


def start_deduplicated(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, window: str = "7 days",
                       schema: T.StructType | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Clean every raw calls file not seen before into month folders, each record once."""
    raw = read_raw_stream(spark, source_dir, "calls", schema, max_files_per_trigger)
    raw = raw.select("*", F.col("_metadata.file_modification_time").alias("arrived"))
    return (drop_repeats(raw, window).writeStream.foreachBatch(partial(write_batch, sink_dir.rstrip("/")))
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
