"""Property: dense_key numbers rows exactly like a global
row_number, for random tables with NULLs, heavy repeats and full-row copies."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from blotter.operators.keys import dense_key

row = st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
                st.one_of(st.none(), st.integers(0, 3)),
                st.sampled_from([0.5, 1.5, -2.0]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=60), copies=st.integers(1, 40),
       nulls_last=st.booleans())
def test_distributed_keys_equal_row_number(spark, rows, copies, nulls_last):
    data = rows + [rows[0]] * copies          # a block of identical rows
    df = spark.createDataFrame(data, "a string, b int, c double")
    nl = ["a"] if nulls_last else []
    got = dense_key(df, ["a"], key="k", ties=["b"], nulls_last=nl, rows_per_partition=8)
    order = [F.col("a").asc_nulls_last() if nulls_last else F.col("a").asc_nulls_first(),
             F.col("b").asc_nulls_first()]
    exp = df.withColumn("k", F.row_number().over(Window.orderBy(*order)))
    n = len(data)
    assert sorted(r.k for r in got.collect()) == list(range(1, n + 1))
    # the (a, b) value at every key position matches the global numbering
    a = {r.k: (r.a, r.b) for r in got.select("k", "a", "b").collect()}
    b = {r.k: (r.a, r.b) for r in exp.select("k", "a", "b").collect()}
    assert a == b
    assert Counter(map(tuple, got.drop("k").collect())) == Counter(map(tuple, df.collect()))
