"""Landing raw CSV drops as raw Parquet (the raw layer).

The uploaders only copied a file and printed a run timestamp; here the
landing is a Spark job that reads the CSV with an explicit schema (no schema
inference pass over the data) and stamps every row with the run timestamp, so
the value reaches the curated facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.sources.sinks import write_table


def run_timestamp() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def land_csv(spark: SparkSession, path: str, schema: T.StructType, run_ts: str | None = None,
             out_path: str | None = None, multi_line: bool = False) -> DataFrame:
    """Rows of a CSV drop with a header, stamped with ``ingest_run_ts_utc``.

    Columns are found by their header names, in any order; a missing one is an
    error, an unknown one is left out. A row that does not fit (too few or too many
    fields, an unreadable number) is kept, with its text in ``_corrupt_record``.
    ``multi_line`` accepts line breaks inside quotes; such files cannot be split, so
    it is off unless asked for. With ``out_path`` the drop is stored in the raw layer
    there under its run timestamp (a rerun replaces its own drop only), and
    the whole raw layer is returned.
    """
    reader = spark.read.option("header", "true").option("multiLine", multi_line)
    found = reader.csv(path).columns  # reads the header line only
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    types = {f.name: f.dataType for f in schema.fields}
    by_header = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in found]
                             + [T.StructField("_corrupt_record", T.StringType())])
    rows = (reader.schema(by_header).option("mode", "PERMISSIVE").option("enforceSchema", "false")
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)
            .select(*[f.name for f in schema.fields], "_corrupt_record"))
    if not out_path:
        return rows.withColumn("ingest_run_ts_utc", F.lit(run_ts or run_timestamp()))
    # directory names must not hold the timestamp's colons; the column keeps them
    stamped = rows.withColumns({"ingest_run_ts_utc": F.lit(run_ts or run_timestamp()),
                                "drop": F.regexp_replace(F.lit(run_ts or run_timestamp()), "[^0-9A-Za-z-]", "")})
    write_table(stamped, out_path, partition_by=["drop"], only_partitions=True)
    return spark.read.parquet(out_path).drop("drop")


def corrupt_rows(landed: DataFrame) -> DataFrame:
    """(ingest_run_ts_utc, rows, corrupt): how many rows of each drop did not fit."""
    return landed.groupBy("ingest_run_ts_utc").agg(
        F.count(F.lit(1)).alias("rows"), F.count("_corrupt_record").alias("corrupt"))
