import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from blotter.operators.keys import dense_key


def _expected(df, order, ties=(), nulls_last=()):
    nl = set(nulls_last)
    cols = list(order) + list(ties)
    w = Window.orderBy(*[F.col(c).asc_nulls_last() if c in nl else F.col(c).asc_nulls_first() for c in cols])
    return df.withColumn("k_exp", F.row_number().over(w))


def _check(df, order, ties=(), nulls_last=(), **kw):
    got = dense_key(df, order, key="k", ties=ties, nulls_last=nulls_last,
                    rows_per_partition=max(1, df.count() // 16), **kw)
    n = df.count()
    stats = got.agg(F.min("k"), F.max("k"), F.countDistinct("k"), F.count(F.lit(1))).first()
    assert tuple(stats) == ((1, n, n, n) if n else (None, None, 0, 0))
    cols = list(order) + list(ties)
    a = got.select(F.col("k").alias("kk"), *cols)
    b = _expected(df, order, ties, nulls_last).select(F.col("k_exp").alias("kk"),
                                                      *[F.col(c).alias("e_" + c) for c in cols])
    cond = " AND ".join(f"({c} <=> e_{c})" for c in cols)
    assert a.join(b, "kk", "full").where(f"NOT ({cond})").count() == 0
    return got


@pytest.fixture(scope="module")
def calls(spark):
    from blotter.operators.clean import clean_calls
    from blotter.sources.tables import raw_inputs
    return clean_calls(raw_inputs(spark, "/root/testdata/sf0.01").calls).select(
        "event_number", "complaint_number", "call_received", "tencode", "tencode_suffix")


def test_single_key_with_ties(calls):
    _check(calls, ["call_received"], ["event_number"])


def test_nulls_first_block_is_split(calls):
    _check(calls, ["complaint_number"], ["event_number"])


def test_nulls_last_and_heavy_repeats(calls):
    _check(calls, ["tencode", "tencode_suffix"], nulls_last=["tencode", "tencode_suffix"])


def test_hot_value_holding_a_third_of_rows(calls):
    """Every key equals row_number over order, ties and all other columns, also inside the hot value."""
    hot = calls.withColumn("complaint_number", F.when(F.col("event_number") < "E0000003334", F.lit("HOT"))
                           .otherwise(F.col("complaint_number"))).drop("event_number")
    got = _check(hot, ["complaint_number"])
    rest = [c for c in hot.columns if c != "complaint_number"]
    want = hot.withColumn("k", F.row_number().over(Window.orderBy(
        *[F.col(c).asc_nulls_first() for c in ["complaint_number", *rest]])).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_copies_of_one_row_holding_a_third_are_split(calls):
    is_hot = F.col("event_number") < "E0000003334"
    copies = calls.select(*[F.when(is_hot, F.lit("same")).otherwise(F.col(c)).alias(c) if c != "call_received"
                            else F.when(is_hot, F.lit(None)).otherwise(F.col(c)).alias(c) for c in calls.columns])
    got = _check(copies, ["complaint_number"], ["event_number"])
    assert got.where(F.col("event_number") == "same").count() == 3334
    parts = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < 3334 / 2


def test_same_keys_at_any_partitioning(calls):
    one = dense_key(calls.coalesce(1), ["complaint_number"], key="k")
    many = dense_key(calls.repartition(7), ["complaint_number"], key="k", rows_per_partition=300)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_empty_input(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert dense_key(df, ["a"], key="k").count() == 0


def test_start_offset(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "a string")
    got = dense_key(df, ["a"], key="k", start=10).orderBy("k").collect()
    assert [(r.a, r.k) for r in got] == [(None, 10), ("a", 11), ("b", 12)]


def _depth(line):
    return len(line) - len(line.lstrip(" :+-"))


def test_plan_has_no_single_partition_sort(calls):
    """Fact rows never meet a single-partition exchange; the only one sums the
    per-partition counts (one row per partition) on a broadcast side."""
    got = dense_key(calls, ["complaint_number"], key="k", ties=["event_number"], rows_per_partition=1000)
    lines = got._jdf.queryExecution().executedPlan().toString().split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            d = _depth(line)
            ancestors = []
            for prev in reversed(lines[:i]):
                if _depth(prev) < d:
                    ancestors.append(prev)
                    d = _depth(prev)
            assert any("BroadcastExchange" in a for a in ancestors), line


def test_source_is_read_once(calls):
    """The keyed result starts from checkpoints: the source is scanned by the input checkpoint only."""
    got = dense_key(calls, ["complaint_number"], key="k", ties=["event_number"])
    assert "FileScan" in calls._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
