"""Quality rules that are enforced: bad rows go to quarantine, and a bad drop publishes nothing.

A rule names rows that must not enter a layer and the share of them that a drop
may have. Rows are split in one pass: the layer's columns plus ``failed_rules``, the
names of the rules that a row breaks. :func:`write_checked` writes that once, accepted and rejected rows
side by side, counts while it writes, and publishes the accepted ones only if every
rule's share is within its limit; else the old layer stays as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from blotter.functions.rules import CALENDAR_END, CALENDAR_START
from blotter.sources import files

FAILED = "failed_rules"


@dataclass(frozen=True)
class Rule:
    """Rows for which ``broken`` (SQL text) is true break the rule; NULL is not broken."""

    name: str
    broken: str
    max_share: float = 1.0


def _outside(column: str) -> str:
    return f"to_date({column}) < DATE'{CALENDAR_START}' OR to_date({column}) > DATE'{CALENDAR_END}'"


CALL_RULES = [
    Rule("unparsed_time", "call_received IS NULL", 0.05),
    Rule("outside_calendar", _outside("call_received")),
    Rule("no_event_number", "event_number IS NULL OR trim(event_number) = ''", 0.0),
    Rule("tencode_not_a_number", "tencode IS NOT NULL AND try_cast(tencode AS INT) IS NULL", 0.1),
    Rule("half_a_coordinate", "(latitude IS NULL) <> (longitude IS NULL)"),
]
INCIDENT_RULES = [
    Rule("unparsed_time", "incident_occurred IS NULL", 0.05),
    Rule("outside_calendar", _outside("incident_occurred")),
    Rule("no_incident_number", "incident_number IS NULL OR trim(incident_number) = ''", 0.0),
    Rule("reported_before_it_occurred", "incident_reported < incident_occurred", 0.01),
    Rule("no_offense_number", "offense_number IS NULL"),
    Rule("half_a_coordinate", "(latitude IS NULL) <> (longitude IS NULL)"),
]


class RejectedDrop(Exception):
    """A drop broke a rule too often; ``counts`` has rows and rows per rule."""

    def __init__(self, broken: dict[str, float], counts: dict[str, int]) -> None:
        super().__init__("too many rows break " + ", ".join(f"{r} ({s:.2%})" for r, s in broken.items()))
        self.broken, self.counts = broken, counts


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules of a row, in the rules' order."""
    return F.filter(F.array(*[F.when(F.expr(r.broken), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(FAILED, failed_rules(rules))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(FAILED) == 0).drop(FAILED)


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(FAILED) > 0)


def rule_counts(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """(table, rule, rows, first_of_row): rows that break each rule, and rows for which it is the first one; one pass."""
    broken = [F.coalesce(F.expr(r.broken), F.lit(False)) for r in rules]
    sums = []
    for k, r in enumerate(rules):
        first = broken[k]
        for b in broken[:k]:
            first = first & ~b
        sums.append(F.struct(F.lit(r.name).alias("rule"), F.count_if(broken[k]).alias("rows"), F.count_if(first).alias("first_of_row")))
    return (df.agg(F.array(*sums).alias("r")).select(F.lit(table).alias("table"), F.explode("r").alias("r"))
            .select("table", "r.rule", "r.rows", "r.first_of_row"))


def write_checked(df: DataFrame, rules: Sequence[Rule], path: str, quarantine: str, drop: str) -> dict[str, int]:
    """Add a drop's accepted rows to the layer at ``path`` as ``drop=<drop>`` and its rejected ones to ``quarantine``.

    Rows are written once, to a hidden folder. If a rule's share of the rows is above its limit, the layer does
    not change and :class:`RejectedDrop` is raised; the rejected rows are in quarantine either way. A drop that is
    in the layer is an error. Returns rows and rows per rule.
    """
    spark = df.sparkSession
    path, quarantine = path.rstrip("/"), quarantine.rstrip("/")
    final = f"{path}/drop={drop}"
    if files.exists(spark, final):
        raise FileExistsError(f"drop {drop} is in {path}")
    seen = Observation(f"rules-{uuid.uuid4().hex}")
    counters = [F.count_if(F.array_contains(FAILED, r.name)).alias(r.name) for r in rules]
    observed = apply_rules(df, rules).observe(seen, F.count(F.lit(1)).alias("rows"), *counters)
    staged = f"{path}/.{uuid.uuid4().hex}"
    observed.withColumn("accepted", F.size(FAILED) == 0).write.partitionBy("accepted").parquet(staged)
    counts = {k: v or 0 for k, v in seen.get.items()}
    rows = max(1, counts["rows"])
    broken = {r.name: counts[r.name] / rows for r in rules if counts[r.name] > r.max_share * rows}
    bad = f"{staged}/accepted=false"
    if files.exists(spark, bad):
        files.delete(spark, f"{quarantine}/drop={drop}")  # of an earlier try
        files.publish(spark, bad, f"{quarantine}/drop={drop}")
    if not broken:
        good = f"{staged}/accepted=true"
        if not files.exists(spark, good):  # an empty drop is a drop
            apply_rules(df.limit(0), rules).write.parquet(good)
        files.publish(spark, good, final)
    files.delete(spark, staged)
    if broken:
        raise RejectedDrop(broken, counts)
    return counts


def read_checked(spark, path: str) -> DataFrame:
    """The layer's accepted rows of all drops."""
    return spark.read.parquet(path).drop(FAILED)
