import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from blotter.functions import stats
from blotter.operators import dims
from blotter.plans import reports, trends


def tail(spark, pairs):
    df = spark.createDataFrame(pairs, "t double, n long")
    return [r["p"] for r in stats.t_test(df, "t", "n", "p").select("t", "n", "p").collect()]


def test_t_tail_at_known_values(spark):
    """Printed tables of Student's t (two-sided), and the closed forms for 1 and 2 degrees of freedom."""
    known = [(12.706204736, 1, 0.05), (4.302652730, 2, 0.05), (2.228138852, 10, 0.05), (3.169272673, 10, 0.01), (2.042272456, 30, 0.05),
             (1.983971519, 100, 0.05), (2.625890521, 100, 0.01), (1.962339081, 1000, 0.05), (1.959966, 1_000_000, 0.05)]
    for (t, n, p), got in zip(known, tail(spark, [(t, n) for t, n, _ in known])):
        assert got == pytest.approx(p, rel=1e-6), (t, n)
    for t in (0.1, 0.9, 1.0, 3.0, 50.0):
        one, two = tail(spark, [(t, 1), (t, 2)])
        assert one == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-9)
        assert two == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
    assert tail(spark, [(-2.228138852, 10)])[0] == pytest.approx(0.05, rel=1e-6)
    assert tail(spark, [(0.0, 7)]) == [1.0] and tail(spark, [(None, 7)]) == [None]
    assert 0 < tail(spark, [(30.0, 100)])[0] < 1e-50  # far out in the tail it is not rounded to nothing


def test_log_gamma(spark):
    zs = [0.5, 1.0, 1.5, 2.0, 7.25, 100.0, 1461.5, 1e6]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(stats.log_gamma(F.col("z"))).collect()
    assert all(g[0] == pytest.approx(math.lgamma(z), rel=1e-12, abs=1e-12) for g, z in zip(got, zs))


def fit(spark, pairs):
    df = spark.createDataFrame(pairs, "x long, y long")
    return stats.regression(df.agg(*stats.moments(F.col("x"), F.col("y")))).first()


def test_regression_by_hand_and_degenerate(spark):
    r = fit(spark, [(1, 2), (2, 3), (3, 5), (4, 4), (5, 6), (None, 9), (7, None)])
    assert r["n"] == 5 and r["slope"] == pytest.approx(0.9) and r["intercept"] == pytest.approx(1.3)
    assert r["slope_se"] == pytest.approx(math.sqrt(1.9 / 3 / 10)) and r["deg_freedom"] == 3
    assert r["corr"] == pytest.approx(0.9) and r["p_value"] == pytest.approx(0.037386, rel=1e-4)
    exact = fit(spark, [(1, 2), (2, 4), (3, 6)])
    assert exact["p_value"] == 0.0 and exact["t_stat"] is None and exact["corr"] == pytest.approx(1.0)
    for pairs in ([], [(1, 1)], [(1, 1), (1, 2), (1, 3)]):
        got = fit(spark, pairs)
        assert got["slope"] is None and got["p_value"] is None
    flat = fit(spark, [(1, 5), (2, 5), (3, 5)])
    assert flat["slope"] == 0 and flat["corr"] is None and flat["p_value"] == 1.0
    two = fit(spark, [(1, 1), (2, 5)])
    assert two["slope"] == 4 and two["p_value"] is None and two["deg_freedom"] is None


def test_moments_merge(spark):
    """Sums of parts add up to the sums of the whole."""
    df = spark.range(100).selectExpr("id AS x", "id * id % 17 AS y", "id % 3 AS part")
    parts = df.groupBy("part").agg(*stats.moments(F.col("x"), F.col("y"))).drop("part")
    merged = parts.agg(*[F.sum(c).alias(c) for c in parts.columns]).first()
    assert tuple(merged) == tuple(df.agg(*stats.moments(F.col("x"), F.col("y"))).first())


def fact(spark, per_day):
    """Rows of a fact with so many rows on each day from 2024-01-01 on."""
    rows = []
    for k, n in enumerate(per_day):
        day = dt.date(2024, 1, 1) + dt.timedelta(k)
        rows += [(int(day.strftime("%Y%m%d")),)] * n
    return spark.createDataFrame(rows + [(None,), (19990101,)], "date_key int")


def test_lags_on_filled_days(spark):
    calls = [3, 0, 5, 2, 0, 0, 7, 1, 4, 6, 2, 9]
    incidents = [0, 0, 0] + [c + 1 for c in calls[:-3]]  # three days later
    got = trends.calls_incidents_lags(fact(spark, calls), fact(spark, incidents), dims.dim_date(spark), max_lag=4).collect()
    assert [r["lag"] for r in got] == [0, 1, 2, 3, 4]
    # the shared span is the incidents' first day to the calls' last
    assert [r["days"] for r in got] == [9, 8, 7, 6, 5]
    assert got[3]["corr"] == 1.0 and got[3]["slope"] == 1.0 and got[3]["p_value"] == 0.0 and abs(got[0]["corr"]) < 0.9
    none = trends.calls_incidents_lags(fact(spark, [1, 2]), fact(spark, []), dims.dim_date(spark), max_lag=2).collect()
    assert none == []


def test_moving_average(spark):
    per_day = [k % 5 for k in range(40)]
    got = trends.incidents_moving_average(fact(spark, [1] + per_day), dims.dim_date(spark)).collect()
    values = [1] + per_day
    values = values[:len(got)]
    assert [r["incidents"] for r in got] == values
    for k, r in enumerate(got):
        for n in (7, 28):
            assert r[f"average_{n}"] == (pytest.approx(sum(values[k + 1 - n:k + 1]) / n, abs=1e-6) if k >= n - 1 else None)
        assert r["change_7"] == (values[k] - values[k - 7] if k >= 7 else None)


def test_seasonal_index(spark):
    """A flat year with twice as many incidents each July: July's index is above 1, the ends have no average."""
    rows = [(y * 10000 + m * 100 + 15,) for y in (2021, 2022, 2023, 2024) for m in range(1, 13) for _ in range(20 if m == 7 else 10)]
    got = trends.seasonal_index(spark.createDataFrame(rows, "date_key int"), dims.dim_date(spark)).collect()
    assert len(got) == 48 and all(r["centred_average"] is None and r["ratio"] is None for r in got[:6] + got[-6:])
    assert all(r["centred_average"] == pytest.approx(130 / 12, abs=1e-6) for r in got[6:-6])
    index = {r["month"]: r["seasonal_index"] for r in got}
    assert index[7] == pytest.approx(2 * index[6], rel=1e-5) and sum(index.values()) == pytest.approx(12, abs=1e-4)
    short = trends.seasonal_index(spark.createDataFrame(rows[:60], "date_key int"), dims.dim_date(spark)).collect()
    assert all(r["seasonal_index"] is None for r in short)


def test_counts_do_as_well_as_a_fact(spark):
    f = fact(spark, [2, 0, 3])
    counted = f.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))
    d = dims.dim_date(spark)
    assert reports.calls_by_month(f, d).collect() == reports.calls_by_month(counted, d).collect()
    assert trends.calls_incidents_significance(f, f, d).collect() == trends.calls_incidents_significance(counted, counted, d).collect()
