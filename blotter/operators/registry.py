"""Surrogate keys that survive reruns: a registry of natural keys and the numbers they were given.

``dense_key`` numbers a table anew in each run, so a new member in the middle
changes the keys behind it. A registry keeps them: members that are there keep their
key, new ones are numbered from the highest key on, in key order among themselves.

The registry is a folder with one Parquet folder per batch of new members. A
batch is written under a hidden name and published by one rename, and an
assignment reads published batches only. So a failed or repeated run changes no key; of two
runs at once, the second to publish fails and can be run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.keys import dense_key
from blotter.session import checkpoint_dir
from blotter.sources import files


def _batches(spark: SparkSession, folder: str) -> list[str]:
    return [b for b in files.children(spark, folder) if b.startswith("batch=")]


def registered(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All published members with their keys; ``schema`` is that of a registry without batches."""
    folder = folder.rstrip("/")
    batches = _batches(spark, folder)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/{b}" for b in batches])


def assign_keys(members: DataFrame, natural: Sequence[str], key: str, folder: str,
                nulls_last: Sequence[str] = ()) -> DataFrame:
    """The registry after ``members`` were added: ``natural`` columns and ``key``.

    Members are compared null-safely by their ``natural`` columns; a member that comes several times
    gets one key. New members are checkpointed and found by one left-anti join with the
    registry, in which both sides are distinct, so no key is hot.
    """
    spark = members.sparkSession
    checkpoint_dir(spark)
    folder = folder.rstrip("/")
    distinct = members.select(*natural).distinct()
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in distinct.schema.fields], T.StructField(key, T.LongType())])
    known = registered(spark, folder, schema)
    batch = len(_batches(spark, folder))
    if batch:
        old = known.select(*[F.col(c).alias(f"__{c}") for c in natural])
        same = F.lit(True)
        for c in natural:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        distinct = distinct.join(old, same, "left_anti")
    highest = known.agg(F.max(key)).first()[0] or 0
    fresh = dense_key(distinct, natural, key, nulls_last=nulls_last, start=highest + 1)
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    fresh.write.parquet(hidden)
    files.publish(spark, hidden, f"{folder}/batch={batch:06d}")
    return registered(spark, folder, schema)
