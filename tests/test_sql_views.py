"""The registered star views answer SQL: rows per view, a lookup through fact
and dimension, a weekday count, each against the DataFrame layers."""

from pyspark.sql import functions as F

from blotter.plans.star import Star, register_views
from blotter.sources.tables import raw_inputs

SF = "/root/testdata/sf0.001"


def test_views(spark):
    star = Star(spark, raw_inputs(spark, SF))
    names = register_views(star)
    assert names == ["dim_date", "dim_time", "fact_calls_for_service_v3", "fact_incidents_v2"]
    rows = {n: spark.sql(f"SELECT count(*) AS n FROM {n}").first()["n"] for n in names}
    assert rows == {"dim_date": 2922, "dim_time": 24, "fact_calls_for_service_v3": star.clean_calls.count(),
                    "fact_incidents_v2": star.clean_incidents.count()}

    zones = spark.sql("""SELECT zone, max(received.is_weekend) AS any_weekend
                         FROM fact_calls_for_service_v3 LEFT JOIN dim_date AS received USING (date_key)
                         WHERE latitude > 36.2 GROUP BY zone""")
    want = (star.clean_calls.where("latitude > 36.2")
            .withColumn("w", F.when(F.col("call_received") < "2026-01-01", F.dayofweek("call_received").isin(1, 7)))
            .groupBy(F.col("zone_").alias("zone")).agg(F.max("w").alias("any_weekend")))
    assert sorted(zones.collect(), key=str) == sorted(want.collect(), key=str)

    mondays = spark.sql("SELECT count(*) AS n FROM fact_incidents_v2 NATURAL JOIN dim_date WHERE day_of_week = 2").first()["n"]
    assert mondays == star.clean_incidents.where(
        "dayofweek(incident_occurred) = 2 AND incident_occurred < '2026-01-01'").count()
