import datetime as dt

from pyspark.sql import functions as F

from blotter.functions.timestamps import date_key, parse_raw_ts, parse_ts_column, time_key
from blotter.operators.clean import clean_calls, clean_incidents

CASES = [
    ("2025/10/28 18:10:52+00", dt.datetime(2025, 10, 28, 18, 10, 52)),
    ("2025/10/28 18:10:52", dt.datetime(2025, 10, 28, 18, 10, 52)),
    ("bad", None),
    ("2025/1/5 18:10:52+00", None),
    ("2025-10-28 18:10:52+00", None),
    ("2025/10/28 18:10:52+05", None),
    (" 2025/10/28 18:10:52+00", None),
    ("2025/10/28 18:10:52+00 ", None),
    ("2025/02/30 10:00:00+00", None),
    (None, None),
]


def test_parse_raw_ts_tolerates_bad_text(spark):
    df = spark.createDataFrame([(c,) for c, _ in CASES], "t string")
    got = [r[0] for r in df.select(parse_raw_ts(F.col("t"))).collect()]
    assert got == [e for _, e in CASES]


def test_typed_timestamps_pass_through(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 1, 7, 5),)], "call_received timestamp")
    assert df.select(parse_ts_column(df, "call_received")).first()[0] == dt.datetime(2024, 3, 1, 7, 5)
    assert clean_calls(df).first()["call_received"] == dt.datetime(2024, 3, 1, 7, 5)


def test_date_and_time_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 10, 28, 18, 10),), (dt.datetime(2025, 1, 2, 0, 10),), (None,)],
                               "ts timestamp")
    got = df.select(date_key(F.col("ts")).alias("d"), time_key(F.col("ts")).alias("t")).collect()
    assert [(r.d, r.t) for r in got] == [(20251028, 1800), (20250102, 0), (None, None)]


def test_clean_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([("I1", "2025/10/28 18:10:52+00", None, 5), ("I2", "bad", "2025/10/28 19:00:00+00", 6)],
                               "incident_number string, incident_occurred string, incident_reported string, x int")
    out = clean_incidents(df)
    assert out.columns == df.columns
    rows = out.orderBy("incident_number").collect()
    assert rows[0].incident_occurred == dt.datetime(2025, 10, 28, 18, 10, 52) and rows[0].incident_reported is None
    assert rows[1].incident_occurred is None and rows[1].incident_reported == dt.datetime(2025, 10, 28, 19)


def test_preview_shows_raw_next_to_parsed(spark):
    from blotter.operators.quality import preview
    df = spark.createDataFrame([(c,) for c, _ in CASES], "raw string").withColumn("parsed", parse_raw_ts(F.col("raw")))
    rows = preview(df, ["raw", "parsed"], n=3).collect()
    assert len(rows) == 3 and set(rows[0].asDict()) == {"raw", "parsed"}
