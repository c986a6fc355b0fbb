"""Dense surrogate keys (1..N in a global order) without a single-task sort.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
:func:`dense_key` numbers rows the same way in parallel, by one path at every size:

1. The input is checkpointed, so the source is read once and row ids stay put;
   its rows are counted while they are written.
2. Rows are range-partitioned and sorted on order columns, tie columns, all remaining
   columns and the row id. A value shared by many different rows is split by the
   remaining columns, copies of one whole row by the id. The placement (partition
   and position in it) is checkpointed, so a lost task cannot move a row.
3. A row's key is the number of rows in earlier partitions plus its position. The
   partitions' first keys are a running sum over one row per partition.

Rows that tie on order and tie columns are numbered by the remaining columns;
only copies of one whole row may swap keys. Keys are BIGINT: a fact at scale
has more than 2^31 rows. Spark removes the checkpoints with the result that
refers to them (``spark.cleaner.referenceTracking.cleanCheckpoints``).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import checkpoint_dir

ROWS_PER_PARTITION = 4_000_000
_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position
_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, _UNORDERABLE):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def _sort_columns(df: DataFrame, order_by: Sequence[str], ties: Sequence[str], nulls_last: set[str]) -> list[Column]:
    named = [*order_by, *(c for c in ties if c not in order_by)]
    rest = [c for c in df.columns if c not in named and _orderable(df.schema[c].dataType)]
    return [F.col(c).asc_nulls_last() if c in nulls_last else F.col(c).asc_nulls_first() for c in named + rest]


def dense_key(df: DataFrame, order_by: Sequence[str], key: str = "key", *, ties: Sequence[str] = (),
              nulls_last: Iterable[str] = (), start: int = 1, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Append ``key`` = position of the row in ascending ``order_by`` + ``ties``.

    Columns in ``nulls_last`` sort their NULLs last, all others first (Spark's
    ascending default). Returns the input columns followed by ``key``.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    counted = Observation("dense_key_input")
    source = df.observe(counted, F.count(F.lit(1)).alias("rows")).checkpoint()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                math.ceil((counted.get.get("rows") or 0) / rows_per_partition))
    order = [*_sort_columns(df, order_by, ties, set(nulls_last)), F.col("__dk_row")]
    placed = (source.withColumn("__dk_row", F.monotonically_increasing_id())
              .repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .select(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id().alias("__dk_part"),
                      F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("__dk_pos"))
              .checkpoint())
    # one row per partition, so its running sum may be broadcast
    earlier = Window.orderBy("__dk_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (placed.groupBy("__dk_part").agg(F.count(F.lit(1)).alias("n"))
              .select("__dk_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__dk_first")))
    return (placed.join(F.broadcast(firsts), "__dk_part")
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("__dk_first") + F.col("__dk_pos") + F.lit(start)).cast("bigint").alias(key)))
