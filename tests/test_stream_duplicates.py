import os
import shutil

from pyspark.sql import functions as F

from blotter.operators.clean import clean_calls
from blotter.sources.tables import raw_inputs
from blotter.streaming import duplicates

SF = "/root/testdata/sf0.001"


def run(spark, scratch, window="7 days"):
    duplicates.start_deduplicated(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt", window, max_files_per_trigger=1).awaitTermination()


def drop(df, scratch, name):
    df.coalesce(1).write.parquet(f"{scratch}/tmp-{name}")
    os.makedirs(f"{scratch}/in", exist_ok=True)
    part = next(f for f in os.listdir(f"{scratch}/tmp-{name}") if f.endswith(".parquet"))
    shutil.copy(f"{scratch}/tmp-{name}/{part}", f"{scratch}/in/{name}.parquet")


def batch_result(raw):
    return (clean_calls(raw.withColumn(duplicates.RECORD, duplicates.record_id(raw)))
            .dropDuplicates([duplicates.RECORD, "call_received"]))


def same(spark, scratch, raw):
    got = spark.read.parquet(f"{scratch}/out")
    want = batch_result(raw).select(*[c for c in got.columns if c not in ("year_month", "batch")])
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_replayed_and_late_files_give_the_batch_result(spark, scratch):
    calls = raw_inputs(spark, SF).calls
    raw = calls.where("zone_ < '4'")
    nameless = raw.limit(30).withColumn("event_number", F.lit(None).cast("string"))
    raw = raw.unionByName(raw.where("zone_ = '1'")).unionByName(nameless).unionByName(nameless.limit(10))  # copies in one file
    late = calls.where("zone_ >= '4'")  # old months, new records
    drop(raw, scratch, "a")
    run(spark, scratch)
    same(spark, scratch, raw)
    drop(raw.where("zone_ > '1'"), scratch, "b")  # replayed: its state is there
    drop(late, scratch, "c")
    run(spark, scratch)
    same(spark, scratch, raw.unionByName(late))
    before = spark.read.parquet(f"{scratch}/out").count()
    run(spark, scratch)  # nothing new
    assert spark.read.parquet(f"{scratch}/out").count() == before


def test_copies_beyond_the_window_are_found_by_the_sink(spark, scratch):
    raw = raw_inputs(spark, SF).calls.where("zone_ = '2'")
    drop(raw, scratch, "a")
    run(spark, scratch)
    shutil.rmtree(f"{scratch}/ckpt")  # the state is gone: every file is new again
    drop(raw, scratch, "b")
    run(spark, scratch)
    same(spark, scratch, raw)


def test_a_batch_that_runs_again_replaces_itself(spark, scratch):
    raw = raw_inputs(spark, SF).calls.where("zone_ = '3'")
    batch = batch_result(raw)
    for _ in range(2):
        duplicates.write_batch(f"{scratch}/out", batch, 4)
    same(spark, scratch, raw)
    duplicates.write_batch(f"{scratch}/out", batch, 5)
    same(spark, scratch, raw)
    duplicates.write_batch(f"{scratch}/none", batch.limit(0), 0)
    assert not os.path.exists(f"{scratch}/none")
