"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_ORACLE
from tests.helpers import same_result

SQLS = entry.oracle_sql()


@pytest.mark.parametrize("name", list(entry.star_queries()))
def test_query_matches_oracle(spark, duck_oracle, name):
    assert name in SQLS
    same_result(entry.queries()[name](spark, SF_ORACLE), duck_oracle, SQLS[name])


def test_entry_is_the_flagship_report(spark, duck_small):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "month_name", "total_calls", "violent_incidents",
                          "violent_incident_rate_pct"]
    same_result(df, duck_small, SQLS["violent_rate_by_month"])


def test_queries_see_rows_added_in_the_session(spark, scratch):
    for t in ("events", "orders"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")
    first = {r.hour: r.call_count for r in entry.queries()["calls_by_hour"](spark, scratch).collect()}
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.mode("append").parquet(f"{scratch}/events.parquet")
    second = {r.hour: r.call_count for r in entry.queries()["calls_by_hour"](spark, scratch).collect()}
    assert second == {h: 2 * n for h, n in first.items()}
