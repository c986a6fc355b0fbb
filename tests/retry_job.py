"""Run dense_key while the first attempt of some input tasks fails.

Started by tests/test_retry.py in its own process: local mode allows task
retries only with a ``local[N, maxFailures]`` master.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from blotter.operators.keys import dense_key  # noqa: E402
from blotter.session import get_session  # noqa: E402


@F.udf(T.LongType())
def flaky(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        raise RuntimeError("injected failure on a first attempt")
    return x


def main() -> None:
    spark = get_session("local[4,4]", app_name="blotter-retry", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("OFF")
    base = spark.range(0, 20000, 1, numPartitions=8).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 1000).alias("a"))
    flaky_df = base.withColumn("a", flaky(F.col("a")))
    got = dense_key(flaky_df, ["a"], key="k", ties=["id"], rows_per_partition=1500)
    exp = base.withColumn("k", F.row_number().over(Window.orderBy(F.col("a").asc_nulls_first(), "id")))
    diff = got.select("id", "k").exceptAll(exp.select("id", "k")).count()
    print(f"RESULT rows={got.count()} diff={diff}")
    spark.stop()


if __name__ == "__main__":
    main()
