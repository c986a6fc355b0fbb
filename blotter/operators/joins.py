"""Star lookups: broadcast behind a check of bytes, else a join that splits hot keys.

A dimension derived from the data (locations, call types) can outgrow any
broadcast budget. The lookup adds up its bytes and broadcasts it up to
``max_broadcast_bytes``. Beyond that, hot keys must not meet one reducer: each
fact row gets one of ``SALTS_PER_PARTITION`` times the shuffle partitions' salts by
a hash of the row. The distinct (salt, key) pairs, which map tasks combine, look
up the dimension, where a hot key comes once per salt, and the fact joins the
answers on (salt, key). NULL keys are spread in the same way. Nothing relies on
AQE, and the dimension is never replicated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import checkpoint_dir

MAX_BROADCAST_BYTES = 64 << 20
SALTS_PER_PARTITION = 8


def row_bytes(df: DataFrame) -> Column:
    """Sum over all rows of the bytes of their values: text and binary by length, anything else 8 or its text."""
    size = F.lit(8)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        else:
            size = size + 8
    return F.coalesce(F.sum(size.cast("bigint")), F.lit(0))


def table_bytes(df: DataFrame) -> int:
    return df.agg(row_bytes(df).alias("b")).first()["b"]


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` checkpointed, and its bytes, counted by the same pass."""
    checkpoint_dir(df.sparkSession)
    size = Observation("lookup")
    kept = df.observe(size, row_bytes(df).alias("b")).checkpoint()
    return kept, size.get.get("b") or 0


def bounded_broadcast(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES,
                      dim_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``(broadcast(dim), True)`` when ``dim`` has at most ``max_bytes`` bytes."""
    if (table_bytes(dim) if dim_bytes is None else dim_bytes) <= max_bytes:
        return F.broadcast(dim), True
    return dim, False


def left_lookup(fact: DataFrame, dim: DataFrame, pairs: Sequence[tuple[Column, str]],
                null_safe: Sequence[bool] | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                dim_bytes: int | None = None) -> DataFrame:
    """Left-join ``dim`` to ``fact`` on ``fact_expr == dim[col]`` pairs.

    ``dim`` key columns are dropped from the output; its other columns are
    added (NULL when no match). ``null_safe[i]`` makes pair ``i`` match NULL
    to NULL. ``dim_bytes`` is the dimension's size where the caller knows it. Several rows of ``dim`` with one key give several rows.
    """
    null_safe = list(null_safe or [False] * len(pairs))
    names = [c for _, c in pairs]
    values = [c for c in dim.columns if c not in names]
    side, small = bounded_broadcast(dim, max_broadcast_bytes, dim_bytes)
    side = side.select(*[F.col(f"`{c}`").alias(f"__dim_{i}") for i, c in enumerate(names)], *[F.col(f"`{c}`") for c in values])

    def matches(left: list[Column]) -> Column:
        cond = F.lit(True)
        for i, (expr, ns) in enumerate(zip(left, null_safe)):
            cond = cond & (expr.eqNullSafe(F.col(f"__dim_{i}")) if ns else expr == F.col(f"__dim_{i}"))
        return cond

    if small:
        return fact.join(side, matches([e for e, _ in pairs]), "left").select(*fact.columns, *values)

    salts = SALTS_PER_PARTITION * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"__key_{i}" for i in range(len(pairs))]
    keyed = fact.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(salts)).cast("int"))
    keyed = keyed.withColumns({k: e for k, (e, _) in zip(keys, pairs)})
    answers = (keyed.select("__salt", *keys).distinct().join(side, matches([F.col(k) for k in keys]))
               .select(F.col("__salt").alias("__salt_a"), *[F.col(k).alias(f"{k}_a") for k in keys], *values))
    # a NULL strict key has no answer, so comparing null-safely finds none either
    same = F.col("__salt") == F.col("__salt_a")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_a"))
    return keyed.join(answers, same, "left").select(*fact.columns, *values)
