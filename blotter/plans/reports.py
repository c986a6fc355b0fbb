"""Trend reports over the star schema.

Each report counts the fact per date / time key first. That partial
aggregate runs on the map side and leaves at most one row per key and task,
so the joins to the calendar and clock dimensions touch a few thousand rows
instead of every fact row. A table of counts (column ``n``, see ``incremental_star``) does as
well as a fact: its counts are added up. Those dimensions are generated from parameters,
so their broadcast size is known in advance (2,922 days, 24 hours).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.rules import VIOLENT_NIBRS


def _ordered(result: DataFrame, *cols: str) -> DataFrame:
    """Sort a report result whose size is bounded by its dimensions (at most
    24 hours, 96 calendar months, 7 x 24 weekday hours, ...). One task sorts
    those few rows; a global ``orderBy`` would add a range-sampling job and a
    shuffle for them."""
    return result.repartition(1).sortWithinPartitions(*cols)


def weight(fact: DataFrame) -> Column:
    """What a row counts for: ``n`` in a table of counts, 1 in a fact."""
    return F.col("n") if "n" in fact.columns else F.lit(1).cast("bigint")


def tagged_counts(facts: dict[str, DataFrame]) -> DataFrame:
    """date_key and one count per named fact, of days that any of them has: one partial aggregate for all."""
    tagged = None
    for name, fact in facts.items():
        rows = fact.select("date_key", *[(weight(fact) if n == name else F.lit(0).cast("bigint")).alias(n) for n in facts])
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return tagged.groupBy("date_key").agg(*[F.sum(n).alias(n) for n in facts])


def _per_key(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, combined on the map side. A NULL key forms its own group
    and is dropped by the inner join with its dimension (Catalyst infers and
    pushes ``IS NOT NULL`` from that join)."""
    n = F.sum("n") if "n" in fact.columns else F.count(F.lit(1))
    return fact.groupBy(*keys).agg(n.alias("__n"))


def _violent(fact_incidents: DataFrame) -> DataFrame:
    return fact_incidents.where(F.col("offense_nibrs").isin(*VIOLENT_NIBRS))


def calls_by_hour(fact_calls: DataFrame, dim_time: DataFrame) -> DataFrame:
    per = _per_key(fact_calls, ["time_key"])
    return (per.join(F.broadcast(dim_time.select("time_key", "hour")), "time_key")
            .groupBy("hour").agg(F.sum("__n").cast("bigint").alias("call_count"))
            .transform(_ordered, "hour"))


def _by_month(per_date: DataFrame, dim_date: DataFrame, name: str) -> DataFrame:
    return (per_date.join(F.broadcast(dim_date.select("date_key", "year", "month", "month_name")),
                          "date_key")
            .groupBy("year", "month", "month_name")
            .agg(F.sum("__n").cast("bigint").alias(name)))


def calls_by_month(fact_calls: DataFrame, dim_date: DataFrame) -> DataFrame:
    return _by_month(_per_key(fact_calls, ["date_key"]), dim_date, "call_count").transform(_ordered, "year", "month")


def violent_by_dow_hour(fact_incidents: DataFrame, dim_date: DataFrame, dim_time: DataFrame,
                        year: int = 2025) -> DataFrame:
    """Violent incidents (NIBRS list) in ``year`` by weekday name and hour.

    On a written fact ``year`` is also turned into a date_key range and a
    month-partition filter, so it reaches the Parquet scan.
    """
    fact = _violent(fact_incidents)
    if "year_month" in fact_incidents.columns:
        # A written fact stores its keys: the range reaches the Parquet scan
        # and prunes month directories. On a fact computed from raw text the
        # year-filtered calendar join below does the filtering instead, so
        # the timestamp parse is not repeated inside a pushed-down filter.
        fact = fact.where(F.col("year_month").between(year * 100 + 1, year * 100 + 12)
                          & F.col("date_key").between(year * 10000 + 101, year * 10000 + 1231))
    per = _per_key(fact, ["date_key", "time_key"])
    days = dim_date.where(F.col("year") == year).select("date_key", "day_of_week_name")
    return (per.join(F.broadcast(days), "date_key")
            .join(F.broadcast(dim_time.select("time_key", "hour")), "time_key")
            .groupBy("day_of_week_name", "hour")
            .agg(F.sum("__n").cast("bigint").alias("violent_incident_count"))
            .transform(_ordered, "day_of_week_name", "hour"))


def violent_rate_by_month(fact_calls: DataFrame, fact_incidents: DataFrame,
                          dim_date: DataFrame) -> DataFrame:
    """Monthly calls, violent incidents and violent incidents per 100 calls.

    Months with calls and no violent incident report 0; months without calls
    are absent; the rate is NULL on zero calls. Both facts are tagged and
    stacked (call = 1 or violent = 1 per row) so one partial aggregation per
    date_key and one calendar join serve both counts: a single shuffle of
    partial counts instead of one per fact, and the same result as joining
    the two monthly aggregates.
    """
    per_date = tagged_counts({"__c": fact_calls, "__v": _violent(fact_incidents)})
    monthly = (per_date.join(F.broadcast(dim_date.select("date_key", "year", "month", "month_name")),
                             "date_key")
               .groupBy("year", "month", "month_name")
               .agg(F.sum("__c").cast("bigint").alias("total_calls"),
                    F.sum("__v").cast("bigint").alias("violent_incidents"))
               .where(F.col("total_calls") > 0))
    return (monthly.select(
                "year", "month", "month_name", "total_calls", "violent_incidents",
                F.round(F.col("violent_incidents").cast("double") / F.nullif(F.col("total_calls"), F.lit(0))
                        * 100, 2).alias("violent_incident_rate_pct"))
            .transform(_ordered, "year", "month"))


def incidents_by_time_of_day(fact_incidents: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Incidents per time-of-day bucket, with the share of all keyed incidents."""
    per = _per_key(fact_incidents, ["time_key"])
    counts = (per.join(F.broadcast(dim_time.select("time_key", "time_of_day")), "time_key")
              .groupBy("time_of_day").agg(F.sum("__n").cast("bigint").alias("incident_count")))
    total = F.sum("incident_count").over(Window.partitionBy())
    return (counts.withColumn("share_pct", F.round(F.col("incident_count") * 100.0 / total, 2).cast("double"))
            .transform(_ordered, "time_of_day"))


def incidents_weekend(fact_incidents: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Incidents on weekend vs weekday days, normalised per calendar day."""
    per = _per_key(fact_incidents, ["date_key"])
    counts = (per.join(F.broadcast(dim_date.select("date_key", "is_weekend")), "date_key")
              .groupBy("is_weekend").agg(F.sum("__n").cast("bigint").alias("incident_count")))
    days = dim_date.groupBy("is_weekend").agg(F.count(F.lit(1)).cast("bigint").alias("day_count"))
    return (counts.join(F.broadcast(days), "is_weekend")
            .withColumn("incidents_per_day",
                        F.round(F.col("incident_count").cast("double") / F.col("day_count"), 4))
            .transform(_ordered, "is_weekend"))


def calls_incidents_correlation(fact_calls: DataFrame, fact_incidents: DataFrame,
                                dim_date: DataFrame, digits: int = 8) -> DataFrame:
    """Daily call volume vs daily incidents on days both feeds cover.

    Pearson correlation, least-squares slope / intercept (incidents on calls)
    and R^2, over calendar days with at least one call and one incident. Both
    facts are counted per day in one partial aggregation (tagged rows).
    """
    daily = (tagged_counts({"calls": fact_calls, "incidents": fact_incidents})
             .join(F.broadcast(dim_date.select("date_key")), "date_key")
             .where((F.col("calls") > 0) & (F.col("incidents") > 0)))
    y, x = F.col("incidents").cast("double"), F.col("calls").cast("double")
    return daily.agg(
        F.count(F.lit(1)).cast("bigint").alias("days"),
        F.round(F.corr(x, y), digits).alias("corr"),
        F.round(F.regr_slope(y, x), digits).alias("slope"),
        F.round(F.regr_intercept(y, x), digits).alias("intercept"),
        F.round(F.regr_r2(y, x), digits).alias("r2"))
