"""Facts and report counts kept up to date drop by drop.

A raw layer holds one folder per drop (``<raw>/<feed>/drop=<name>``). A drop is read
once: its facts go to a folder of their own, by month, numbered behind the keys there are,
and its counts per date, hour and code are added to the feed's rollup, the table
that the reports read. A note per drop, written last, says that it is done;
readers go by the notes alone, and a drop whose run broke off starts again from nothing.

Late rows need no rewrite: they land in their month under the drop that brought them. Reports by
month prune by ``year_month`` inside each drop, and reports on the rollup never see a fact.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators import clean, facts
from blotter.plans.star import _with_month
from blotter.sources import files


@dataclass(frozen=True)
class Feed:
    clean: Callable[[DataFrame], DataFrame]
    fact: Callable[..., DataFrame]
    key: str
    counted_by: tuple[str, ...]


FEEDS = {
    "calls": Feed(clean.clean_calls, facts.fact_calls, "call_key", ("date_key", "time_key")),
    "incidents": Feed(clean.clean_incidents, facts.fact_incidents, "incident_key", ("date_key", "time_key", "offense_nibrs")),
}


def count_rows(fact: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows per key as ``n``; adds up tables that have such counts already."""
    n = F.sum("n") if "n" in fact.columns else F.count(F.lit(1))
    return fact.groupBy(*keys).agg(n.cast("bigint").alias("n"))


class IncrementalStar:
    def __init__(self, spark: SparkSession, raw_dir: str, out_dir: str) -> None:
        self.spark, self.raw, self.out = spark, raw_dir.rstrip("/"), out_dir.rstrip("/")

    def notes(self, feed: str) -> list[dict]:
        """What was done, in the order in which drops were processed."""
        folder = f"{self.out}/{feed}/_drops"
        found = [files.read_note(self.spark, f"{folder}/{n}") for n in files.children(self.spark, folder) if n.endswith(".json")]
        return sorted(found, key=lambda n: n["order"])

    def pending(self, feed: str) -> list[str]:
        done = {n["drop"] for n in self.notes(feed)}
        there = [c.removeprefix("drop=") for c in files.children(self.spark, f"{self.raw}/{feed}") if c.startswith("drop=")]
        return [d for d in there if d not in done]

    def process(self, feed: str) -> list[dict]:
        """Process the drops that were not seen before, oldest name first. One run at a time per feed."""
        return [self._process(feed, drop) for drop in self.pending(feed)]

    def _process(self, feed: str, drop: str) -> dict:
        spark, kind, before = self.spark, FEEDS[feed], self.notes(feed)
        first = max((n["last_key"] for n in before), default=0) + 1
        fact = kind.fact(kind.clean(spark.read.parquet(f"{self.raw}/{feed}/drop={drop}")), start=first)
        # clustered first: the range bounds are sampled by a job that must not run the observed plan
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        clustered = _with_month(fact).repartitionByRange(parts, "year_month", kind.key)
        seen = Observation(f"drop-{uuid.uuid4().hex}")
        observed = clustered.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(kind.key).alias("last"))
        facts_at = f"{self.out}/{feed}/fact/drop={drop}"
        self._replace(observed, facts_at, ["year_month"])
        rows, last = seen.get["rows"], seen.get["last"]

        counts = count_rows(self._read([facts_at], clustered.schema), kind.counted_by)
        if before:
            counts = count_rows(counts.unionByName(self.rollup(feed)), kind.counted_by)
        self._replace(counts.coalesce(1), f"{self.out}/{feed}/rollup/version={len(before) + 1:06d}", [])

        months = [c.removeprefix("year_month=") for c in files.children(spark, facts_at) if c.startswith("year_month=")]
        done = {"drop": drop, "order": len(before) + 1, "rows": rows, "first_key": first, "last_key": last or first - 1,
                "months": months, "schema": json.loads(clustered.schema.json()), "rollup": json.loads(counts.schema.json())}
        files.note(spark, f"{self.out}/{feed}/_drops/{drop}.json", done)
        if len(before) > 1:  # the version before this one may still have readers
            files.delete(spark, f"{self.out}/{feed}/rollup/version={len(before) - 1:06d}")
        return done

    def _replace(self, df: DataFrame, final: str, by: list[str]) -> None:
        """Write beside the final folder, then take its place; what is there is of a run that broke off."""
        parent, _, name = final.rpartition("/")
        hidden = f"{parent}/.{uuid.uuid4().hex}"
        writer = df.write.option("compression", "snappy")
        (writer.partitionBy(*by) if by else writer).parquet(hidden)
        files.delete(self.spark, final)
        files.publish(self.spark, hidden, final)

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*folders)

    def fact(self, feed: str) -> DataFrame:
        """The rows of all processed drops, with their ``year_month`` and ``drop``."""
        notes = self.notes(feed)
        if not notes:
            raise FileNotFoundError(f"no drop of {feed} was processed to {self.out}")
        base = f"{self.out}/{feed}/fact"
        schema = T.StructType.fromJson(notes[-1]["schema"]).add("drop", T.StringType())
        return (self.spark.read.option("basePath", base).schema(schema)
                .parquet(*[f"{base}/drop={n['drop']}" for n in notes]))

    def rollup(self, feed: str) -> DataFrame:
        """Rows per date, hour (and code) of all processed drops: what the reports read instead of the fact."""
        notes = self.notes(feed)
        if not notes:
            raise FileNotFoundError(f"no drop of {feed} was processed to {self.out}")
        return self._read([f"{self.out}/{feed}/rollup/version={notes[-1]['order']:06d}"], T.StructType.fromJson(notes[-1]["rollup"]))
