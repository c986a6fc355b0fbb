"""Small helpers shared by the training-text operators."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotter.session import checkpoint_dir

# The separators of the word definition [^\x20\x09-\x0D]+.
SPACES = b" \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names: whatever other
    columns the caller has cannot clash with the operator's."""
    return df.select(*[F.col(f"`{c}`").alias(a) for a, c in names.items()])


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def salted_join(rows: DataFrame, small: DataFrame, keys: list[str], spread: Column, how: str = "inner", salts: int = 16) -> DataFrame:
    """Join ``rows`` with a table of distinct ``keys``: each key is split over
    ``salts`` tasks by the long column ``spread``, so one that a third of the rows have meets no single task."""
    left = rows.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Number of parts that keeps each one below ``rows_per_part`` on average."""
    return max(shuffle_partitions(spark), math.ceil(rows / rows_per_part))


def even_shares(counts: dict, rows: int) -> dict:
    """Share of each class's rows to sample so that about ``rows`` are drawn: all classes have the same quota, what
    a small one leaves of it goes to the others, and a class within its quota keeps all its rows."""
    left, shares = rows, {}
    for k, (name, c) in enumerate(sorted(counts.items(), key=lambda x: x[1])):
        taken = min(c, left / (len(counts) - k))
        shares[name] = taken / c
        left -= taken
    return shares


def slices(sizes: np.ndarray, budget: int):
    """Consecutive (start, end) row ranges of about ``budget`` bytes at most;
    a row above the budget gets a range of its own."""
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > budget:
            yield start, i
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finalizer over uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their counts."""
    x = np.sort(x)
    first = np.ones(len(x), bool)
    first[1:] = x[1:] != x[:-1]
    at = np.flatnonzero(first)
    return x[at], np.diff(at, append=len(x))


def among(x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in sorted ``values``."""
    if not len(values):
        return np.zeros(len(x), bool)
    at = np.searchsorted(values, x)
    at[at == len(values)] = 0
    return values[at] == x
