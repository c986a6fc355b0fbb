"""Runs that build on earlier ones: key registry, incremental facts and rollups, the quality gate."""

import os

import pytest
from pyspark.sql import functions as F

from blotter.operators import dims, gate
from blotter.operators.registry import assign_keys
from blotter.plans import incremental_star, reports
from blotter.plans.incremental_star import FEEDS, IncrementalStar
from blotter.plans.star import Star
from blotter.sources import files, fixtures
from blotter.sources.tables import raw_inputs

SF = "/root/testdata/sf0.001"


def members(spark, *rows):
    return spark.createDataFrame(list(rows), "a string, b long")


def test_registry_keeps_keys(spark, scratch):
    folder = f"file://{scratch}/reg"
    first = {(r.a, r.b): r.k for r in assign_keys(members(spark, ("b", 1), ("d", None), ("b", 1), (None, 2)), ["a", "b"], "k", folder).collect()}
    assert first == {(None, 2): 1, ("b", 1): 2, ("d", None): 3}
    # new members in the middle go behind; known ones (NULLs too) stay
    second = {(r.a, r.b): r.k for r in assign_keys(members(spark, ("c", 1), ("d", None), ("a", 9), (None, 2)), ["a", "b"], "k", folder).collect()}
    assert second == first | {("a", 9): 4, ("c", 1): 5}
    again = assign_keys(members(spark, ("c", 1)), ["a", "b"], "k", folder)
    assert {(r.a, r.b): r.k for r in again.collect()} == second
    assert {(r.a, r.b): r.k for r in assign_keys(members(spark).limit(0), ["a", "b"], "k", folder).collect()} == second


def test_registry_survives_a_run_that_breaks_off(spark, scratch, monkeypatch):
    folder = f"{scratch}/reg"
    first = assign_keys(members(spark, ("a", 1), ("c", 1)), ["a", "b"], "k", folder).collect()
    with monkeypatch.context() as m:
        m.setattr(files, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            assign_keys(members(spark, ("b", 1)), ["a", "b"], "k", folder)
    # what was written is not published, so it has no effect
    after = {(r.a, r.b): r.k for r in assign_keys(members(spark, ("b", 1)), ["a", "b"], "k", folder).collect()}
    assert after == {(r.a, r.b): r.k for r in first} | {("b", 1): 3}
    # a second run that took the same batch number fails instead of giving keys twice
    os.makedirs(f"{folder}/.x")
    with pytest.raises(Exception, match="(?i)exist"):
        files.publish(spark, f"{folder}/.x", f"{folder}/batch=000001")


def test_location_keys_over_runs(spark, scratch):
    star = Star(spark, raw_inputs(spark, SF))
    once = dims.stable_dim_location(scratch + "/r", incidents=star.clean_incidents).collect()
    twice = dims.stable_dim_location(scratch + "/r", calls=star.clean_calls).collect()
    assert set(once) < set(twice) and sorted(r.location_key for r in twice) == list(range(1, len(twice) + 1))
    assert {tuple(r)[1:] for r in twice} == {tuple(r)[1:] for r in star.dim_location.collect()}


def land(raw, feed, folder, *drops):
    rows = fixtures.in_drops(getattr(raw, feed))
    for d in drops:
        rows.where(F.col("drop") == d).drop("drop").write.parquet(f"{folder}/raw/{feed}/drop={d}")


def no_keys(df):
    return df.drop("call_key", "incident_key", "year_month", "drop")


def same_rows(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_facts_equal_a_rebuild(spark, scratch):
    raw = raw_inputs(spark, SF)
    star, whole = IncrementalStar(spark, f"{scratch}/raw", f"{scratch}/star"), Star(spark, raw)
    for k, drop in enumerate(["d1", "d2", "d3"]):
        for feed in FEEDS:
            land(raw, feed, scratch, drop)
            assert star.pending(feed) == [drop]
            done = star.process(feed)
            assert [n["drop"] for n in done] == [drop] and star.pending(feed) == [] and star.process(feed) == []
        calls, incidents = star.fact("calls"), star.fact("incidents")
        # reports on the merged counts equal those on the facts so far
        for report, a, b in ((reports.calls_by_hour, [star.rollup("calls"), whole.dim_time], [calls, whole.dim_time]),
                             (reports.calls_by_month, [star.rollup("calls"), whole.dim_date], [calls, whole.dim_date]),
                             (reports.violent_by_dow_hour, [star.rollup("incidents"), whole.dim_date, whole.dim_time], [incidents, whole.dim_date, whole.dim_time]),
                             (reports.violent_rate_by_month, [star.rollup("calls"), star.rollup("incidents"), whole.dim_date], [calls, incidents, whole.dim_date])):
            assert report(*a).collect() == report(*b).collect(), (drop, report)
    assert same_rows(no_keys(calls), no_keys(whole.fact_calls)) and same_rows(no_keys(incidents), no_keys(whole.fact_incidents))
    for fact, key in ((calls, "call_key"), (incidents, "incident_key")):
        n = fact.count()
        assert fact.agg(F.min(key), F.max(key), F.count_distinct(key)).first() == (1, n, n)
    # the late drop reaches old months, and a month filter prunes folders
    assert len([n for n in star.notes("calls")[2]["months"]]) > 12
    plan = calls.where("year_month = 202501")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_a_drop_that_breaks_off_starts_again(spark, scratch, monkeypatch):
    raw = raw_inputs(spark, SF)
    land(raw, "calls", scratch, "d1", "d2")
    star = IncrementalStar(spark, f"{scratch}/raw", f"{scratch}/star")
    real, calls = files.note, []

    def second_fails(*a):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*a)

    monkeypatch.setattr(incremental_star.files, "note", second_fails)
    with pytest.raises(RuntimeError):
        star.process("calls")
    first = star.fact("calls")
    assert {r[0] for r in first.select("drop").distinct().collect()} == {"d1"}  # what d2 left is not seen
    assert star.rollup("calls").agg(F.sum("n")).first()[0] == first.count()
    assert star.pending("calls") == ["d2"]
    star.process("calls")
    fact = star.fact("calls")
    n = fixtures.in_drops(raw.calls).where("drop <> 'd3'").count()
    assert fact.count() == n == fact.select("call_key").distinct().count() == star.rollup("calls").agg(F.sum("n")).first()[0]


def test_empty_drop(spark, scratch):
    raw = raw_inputs(spark, SF)
    raw.calls.limit(0).write.parquet(f"{scratch}/raw/calls/drop=a")
    star = IncrementalStar(spark, f"{scratch}/raw", f"{scratch}/star")
    with pytest.raises(FileNotFoundError):
        star.fact("calls")
    assert star.process("calls")[0]["rows"] == 0 and star.fact("calls").count() == 0
    land(raw, "calls", scratch, "d1")
    assert star.process("calls")[0]["first_key"] == 1 and star.fact("calls").agg(F.min("call_key")).first()[0] == 1


CALLS = "event_number string, call_received timestamp, tencode string, latitude double, longitude double"


def some_calls(spark, bad):
    rows = [(f"E{i}", "2024-05-01 10:00:00", "40", 36.0, -87.0) for i in range(100 - bad)]
    rows += [("E" if i % 2 else None, None, "4X", 36.0, None) for i in range(bad)]
    return spark.createDataFrame(rows, "event_number string, t string, tencode string, latitude double, longitude double").select(
        "event_number", F.col("t").cast("timestamp").alias("call_received"), "tencode", "latitude", "longitude")


def test_gate_splits_and_publishes(spark, scratch):
    rules = [gate.Rule("unparsed_time", "call_received IS NULL", 0.05), gate.Rule("tencode_not_a_number", "try_cast(tencode AS INT) IS NULL"),
             gate.Rule("no_event_number", "event_number IS NULL")]
    good, held = f"{scratch}/calls", f"{scratch}/held"
    counts = gate.write_checked(some_calls(spark, 4), rules, good, held, "a")
    assert counts == {"rows": 100, "unparsed_time": 4, "tencode_not_a_number": 4, "no_event_number": 2}
    assert gate.read_checked(spark, good).count() == 96
    rejected = spark.read.parquet(f"{held}/drop=a").collect()
    assert sorted(tuple(r[gate.FAILED]) for r in rejected) == [("unparsed_time", "tencode_not_a_number")] * 2 + \
        [("unparsed_time", "tencode_not_a_number", "no_event_number")] * 2
    before = sorted(map(str, gate.read_checked(spark, good).collect()))
    with pytest.raises(gate.RejectedDrop, match="unparsed_time") as e:
        gate.write_checked(some_calls(spark, 20), rules, good, held, "b")
    assert e.value.counts["rows"] == 100 and set(e.value.broken) == {"unparsed_time"}
    # the old layer is as it was, the drop's bad rows can be looked at, nothing else is left behind
    assert sorted(map(str, gate.read_checked(spark, good).collect())) == before and files.children(spark, good) == ["drop=a"]
    assert spark.read.parquet(f"{held}/drop=b").count() == 20
    # mended, the drop goes in; a drop that is in is not taken twice
    gate.write_checked(some_calls(spark, 0), rules, good, held, "b")
    assert gate.read_checked(spark, good).count() == 196
    with pytest.raises(FileExistsError):
        gate.write_checked(some_calls(spark, 0), rules, good, held, "b")


def test_gate_edges(spark, scratch):
    empty = some_calls(spark, 0).limit(0)
    assert gate.write_checked(empty, gate.CALL_RULES, f"{scratch}/c", f"{scratch}/q", "a")["rows"] == 0
    assert gate.read_checked(spark, f"{scratch}/c").count() == 0
    assert gate.rule_counts(empty, "calls", gate.CALL_RULES).agg(F.sum("rows"), F.count(F.lit(1))).first() == (0, len(gate.CALL_RULES))
    checked = gate.apply_rules(some_calls(spark, 10), gate.CALL_RULES)
    assert gate.accepted(checked).count() == 90 and gate.quarantined(checked).count() == 10
    counts = {r["rule"]: (r["rows"], r["first_of_row"]) for r in gate.rule_counts(some_calls(spark, 10), "calls", gate.CALL_RULES).collect()}
    assert counts["unparsed_time"] == (10, 10) and counts["tencode_not_a_number"] == (10, 0) and counts["half_a_coordinate"] == (10, 0)


def test_command_line_update_and_misfit_rows(spark, scratch, capsys):
    from blotter.__main__ import main
    raw = raw_inputs(spark, SF)
    paths = []
    for name, df in [("calls", raw.calls.drop("ingest_run_ts_utc")), ("incidents", raw.incidents),
                     ("tencode", fixtures.ref_tencode(spark)), ("suffix", fixtures.ref_suffix(spark))]:
        paths.append(f"{scratch}/drop/{name}")
        (df.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
           .option("ignoreTrailingWhiteSpace", "false").csv(paths[-1]))
    with open(f"{scratch}/drop/tencode/more.csv", "w") as f:
        f.write("tencode,tencode_description\n99,too,many\n")
    out = f"{scratch}/star"
    assert main(["build", "--csv", *paths, "--out", out]) == 0
    said = capsys.readouterr().out.strip().split("\n")
    assert len(said) == 2 and '"feed": "ref_tencode"' in said[1] and '"corrupt": 1' in said[1]
    assert main(["update", "--out", out]) == 0
    assert len(capsys.readouterr().out.strip().split("\n")) == 2
    assert main(["update", "--out", out]) == 0
    assert capsys.readouterr().out == ""
    for report in ("violent_rate_by_month", "calls_incidents_lags"):
        assert main(["report", report, "--out", out]) == 0
        whole = capsys.readouterr().out
        assert main(["report", report, "--merged", "--out", out]) == 0
        assert capsys.readouterr().out == whole and whole
