import os

import pytest
from pyspark.sql import functions as F

from blotter import schemas
from blotter.operators.clean import clean_calls
from blotter.plans import reports
from blotter.plans.star import Star, read_star, write_star
from blotter.sources.landing import corrupt_rows, land_csv
from blotter.sources.tables import raw_inputs
from blotter.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_write_star_and_report_from_files(spark, scratch):
    raw = raw_inputs(spark, SF)
    star = Star(spark, raw)
    metrics = write_star(star, scratch)
    assert metrics["clean_calls"]["rows"] == raw.calls.count()
    assert metrics["clean_calls"]["null_call_received"] == star.clean_calls.where("call_received IS NULL").count()
    assert metrics["dim_time"]["rows"] == 24 and metrics["dim_date"]["rows"] == 2922
    assert metrics["fact_calls_enriched"]["rows"] == raw.calls.count()
    assert os.path.isdir(os.path.join(scratch, "fact_calls"))
    months = [d for d in os.listdir(os.path.join(scratch, "fact_incidents")) if d.startswith("year_month=")]
    assert "year_month=202501" in months and len(months) > 12
    stored = read_star(spark, raw, scratch)
    fresh = Star(spark, raw)
    a = reports.violent_rate_by_month(stored.calls_for_reports, stored.incidents_for_reports, stored.dim_date)
    b = reports.violent_rate_by_month(fresh.calls_for_reports, fresh.incidents_for_reports, fresh.dim_date)
    assert a.collect() == b.collect()
    # the year filter reaches the written fact: partition pruning + pushed date_key range
    q = reports.violent_by_dow_hour(stored.incidents_for_reports, stored.dim_date, stored.dim_time)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "date_key" in plan
    assert sorted(q.collect()) == sorted(
        reports.violent_by_dow_hour(fresh.incidents_for_reports, fresh.dim_date, fresh.dim_time).collect())


def test_star_on_a_uri_and_missing_layers(spark, scratch):
    raw = raw_inputs(spark, SF)
    out = f"file://{scratch}/star"
    write_star(Star(spark, raw), out, ["clean_calls", "dim_time", "fact_calls"])
    stored = read_star(spark, None, out, ["dim_time", "fact_calls"])
    fresh = Star(spark, raw)
    assert reports.calls_by_hour(stored.calls_for_reports, stored.dim_time).collect() == \
        reports.calls_by_hour(fresh.calls_for_reports, fresh.dim_time).collect()
    with pytest.raises(FileNotFoundError, match="clean_incidents"):
        read_star(spark, None, out)


def test_layers_built_before_a_write_are_built_anew(spark, scratch):
    star = Star(spark, raw_inputs(spark, SF))
    before = star.calls_for_reports
    write_star(star, scratch, ["clean_calls", "fact_calls"])
    assert star.calls_for_reports is not before and star.calls_for_reports.inputFiles()[0].startswith(f"file://{scratch}/fact_calls")


def test_star_from_catalog_tables(spark):
    from blotter.sources.tables import raw_from_tables
    raw = raw_inputs(spark, SF)
    names = ["t_calls", "t_incidents", "t_tencodes", "t_suffixes"]
    for name, df in zip(names, (raw.calls, raw.incidents, raw.ref_tencode, raw.ref_suffix)):
        df.createOrReplaceTempView(name)
    a, b = Star(spark, raw_from_tables(spark, *names)), Star(spark, raw)
    for layer in ("dim_call_type", "fact_calls_enriched"):
        x, y = getattr(a, layer), getattr(b, layer)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_land_csv_roundtrip(spark, scratch):
    raw = raw_inputs(spark, SF).calls.drop("ingest_run_ts_utc")
    src = os.path.join(scratch, "csv")
    raw.write.option("header", "true").csv(src)
    out = os.path.join(scratch, "landed")
    landed = land_csv(spark, src, schemas.CALLS_RAW, run_ts="2026-01-01T00:00:00Z", out_path=out)
    assert landed.columns == raw.columns + ["_corrupt_record", "ingest_run_ts_utc"]
    # CSV writes empty strings as "" and NULLs as empty fields; compare NULL-safe on the key columns
    assert landed.count() == raw.count() and landed.where("_corrupt_record IS NOT NULL").count() == 0
    a = landed.select("event_number", "call_received", "latitude", "rpa")
    b = raw.select("event_number", "call_received", "latitude", "rpa")
    assert a.exceptAll(b).count() == 0


def test_land_csv_cannot_swap_drop_or_lose(spark, scratch):
    def drop(name, text):
        path = os.path.join(scratch, name)
        with open(path, "w") as f:
            f.write(text)
        return path

    out = os.path.join(scratch, "raw")
    land = lambda name, text, ts, **kw: land_csv(spark, drop(name, text), schemas.REF_TENCODE, run_ts=ts, out_path=out, **kw)
    got = land("swapped.csv", "tencode_description,extra,tencode\nBurglary,x,70\n", "2026-01-01T00:00:00Z")
    assert [(r.tencode, r.tencode_description) for r in got.collect()] == [("70", "Burglary")]
    got = land("short.csv", "tencode,tencode_description\n40\n43,Want,Officer\n", "2026-01-02T00:00:00Z")
    assert got.count() == 3  # the first drop is still there
    assert {(r.ingest_run_ts_utc, r.rows, r.corrupt) for r in corrupt_rows(got).collect()} == {
        ("2026-01-01T00:00:00Z", 1, 0), ("2026-01-02T00:00:00Z", 2, 2)}
    got = land("short.csv", "tencode,tencode_description\n53,Robbery\n", "2026-01-02T00:00:00Z")
    assert sorted(r.tencode for r in got.collect()) == ["53", "70"]  # a rerun replaces its own drop
    got = land("quoted.csv", 'tencode,tencode_description\n87,"two\nlines"\n', "2026-01-03T00:00:00Z", multi_line=True)
    assert [r.tencode_description for r in got.where("tencode = '87'").collect()] == ["two\nlines"]
    with pytest.raises(ValueError, match="tencode_description"):
        land("missing.csv", "tencode\n40\n", "2026-01-04T00:00:00Z")


def test_streaming_clean_equals_batch(spark, scratch):
    raw = raw_inputs(spark, SF).calls
    src = os.path.join(scratch, "raw")
    raw.where(F.col("event_number") < "E0000000500").write.parquet(os.path.join(src, "part1"))
    q = incremental.start_clean(spark, os.path.join(src, "*"), os.path.join(scratch, "clean"),
                                os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    raw.where(F.col("event_number") >= "E0000000500").write.parquet(os.path.join(src, "part2"))
    q = incremental.start_clean(spark, os.path.join(src, "*"), os.path.join(scratch, "clean"),
                                os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(scratch, "clean"))
    exp = clean_calls(raw)
    assert got.count() == exp.count()
    assert got.select(exp.columns).exceptAll(exp).count() == 0


def test_streaming_hourly_counts(spark, scratch):
    raw = raw_inputs(spark, SF).calls
    src = os.path.join(scratch, "raw")
    raw.write.parquet(src)
    stream = incremental.clean_stream(incremental.read_raw_stream(spark, src), "calls")
    q = (incremental.hourly_call_counts(stream).writeStream.format("memory").queryName("hourly_calls_t")
         .outputMode("complete").start())
    q.processAllAvailable()
    q.stop()
    got = {(r.hour_start, r.call_count) for r in spark.sql("SELECT * FROM hourly_calls_t").collect()}
    exp = {(r.h, r.n) for r in clean_calls(raw).where("call_received IS NOT NULL")
           .groupBy(F.date_trunc("hour", "call_received").alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == exp


def test_command_line_build_and_report(spark, scratch, capsys):
    from blotter.__main__ import main
    assert main(["build", "--sf-dir", SF, "--out", scratch]) == 0
    assert main(["report", "calls_by_hour", "--sf-dir", SF, "--out", scratch]) == 0
    lines = capsys.readouterr().out.strip().split("\n")
    assert len(lines) == 1 + 24


def test_command_line_from_csv_drops(spark, scratch, capsys):
    from blotter.__main__ import main
    from blotter.sources import fixtures
    raw = raw_inputs(spark, SF)
    paths = []
    for name, df in [("calls", raw.calls.drop("ingest_run_ts_utc")), ("incidents", raw.incidents),
                     ("tencode", fixtures.ref_tencode(spark)), ("suffix", fixtures.ref_suffix(spark))]:
        path = os.path.join(scratch, "drop", name)
        (df.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
           .option("ignoreTrailingWhiteSpace", "false").csv(path))
        paths.append(path)
    out = os.path.join(scratch, "star")
    assert main(["build", "--csv", *paths, "--out", out]) == 0
    assert main(["report", "violent_rate_by_month", "--out", out]) == 0
    lines = capsys.readouterr().out.strip().split("\n")
    # the monthly report from landed CSV equals the one from the parquet tables
    fresh = reports.violent_rate_by_month(*(lambda s: (s.calls_for_reports, s.incidents_for_reports,
                                                       s.dim_date))(Star(spark, raw)))
    import json
    got = [json.loads(line) for line in lines[1:]]
    assert got == [json.loads(json.dumps(r.asDict(), default=str)) for r in fresh.collect()]


def test_streaming_clean_incidents_equals_batch(spark, scratch):
    from blotter.operators.clean import clean_incidents
    raw = raw_inputs(spark, SF).incidents
    src = os.path.join(scratch, "raw_incidents")
    raw.write.parquet(src)
    q = incremental.start_clean(spark, src, os.path.join(scratch, "clean_incidents"),
                                os.path.join(scratch, "ckpt_incidents"), feed="incidents")
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(scratch, "clean_incidents"))
    exp = clean_incidents(raw)
    assert got.count() == exp.count()
    assert got.select(exp.columns).exceptAll(exp).count() == 0
