"""Trend analyses over daily and monthly series: significance, lags, moving averages, seasons.

Facts are counted per day first (one partial aggregate, combined on the map side), then
joined to the calendar, which fills days without rows. What follows works on a row per
calendar day or month, so unpartitioned windows see at most the calendar's 2,922 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.stats import moments, regression
from blotter.plans.reports import _ordered, tagged_counts

MAX_LAG = 14
SEASON = 12


def _days() -> Window:
    return Window.orderBy("date_key")


def _all() -> Window:
    return Window.partitionBy()


def daily_series(facts: dict[str, DataFrame], dim_date: DataFrame, *more: str) -> DataFrame:
    """A row per calendar day from the first to the last day that all facts' spans share, 0 where a fact has none."""
    days = (dim_date.select("date_key", *more).join(tagged_counts(facts), "date_key", "left")
            .withColumns({n: F.coalesce(n, F.lit(0).cast("bigint")) for n in facts}))
    first = F.greatest(*[F.min(F.when(F.col(n) > 0, F.col("date_key"))).over(_all()) for n in facts], F.lit(0))
    last = F.least(*[F.max(F.when(F.col(n) > 0, F.col("date_key"))).over(_all()) for n in facts], F.lit(99991231))
    every = [F.max(n).over(_all()) > 0 for n in facts]
    inside = F.col("date_key").between(F.col("__first"), F.col("__last"))
    for n in range(len(facts)):
        inside = inside & F.col(f"__any{n}")
    return (days.withColumns({"__first": first, "__last": last, **{f"__any{k}": e for k, e in enumerate(every)}})
            .where(inside).select("date_key", *more, *facts))


def _rounded(names: list[str], digits: int) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


def calls_incidents_significance(fact_calls: DataFrame, fact_incidents: DataFrame, dim_date: DataFrame,
                                 alpha: float = 0.05, digits: int = 8) -> DataFrame:
    """Is the daily number of calls a significant predictor of the daily number of incidents?

    Regression of incidents on calls over calendar days with both, from one row of
    sums: correlation, slope, its standard error, t statistic, degrees of freedom, two-sided p-value.
    """
    daily = (tagged_counts({"calls": fact_calls, "incidents": fact_incidents})
             .join(F.broadcast(dim_date.select("date_key")), "date_key").where("calls > 0 AND incidents > 0"))
    fit = regression(daily.agg(*moments(F.col("calls"), F.col("incidents"))))
    return fit.select(F.col("n").alias("days"), *_rounded(["corr", "slope", "intercept", "slope_se", "t_stat"], digits), "deg_freedom",
                      *_rounded(["p_value"], digits), (F.col("p_value") < alpha).alias("significant"))


def calls_incidents_lags(fact_calls: DataFrame, fact_incidents: DataFrame, dim_date: DataFrame,
                         max_lag: int = MAX_LAG, digits: int = 8) -> DataFrame:
    """Incidents of a day against the calls ``lag`` days before, for lags 0 to ``max_lag``, over all days that both
    feeds' spans share; days without rows count 0."""
    days = daily_series({"calls": fact_calls, "incidents": fact_incidents}, dim_date)
    lagged = days.select("incidents", *[F.lag("calls", k).over(_days()).alias(str(k)) for k in range(max_lag + 1)])
    long = lagged.unpivot(["incidents"], [str(k) for k in range(max_lag + 1)], "lag", "calls")
    fit = regression(long.groupBy(F.col("lag").cast("int").alias("lag")).agg(*moments(F.col("calls"), F.col("incidents"))))
    return (fit.select("lag", F.col("n").alias("days"), *_rounded(["corr", "slope", "t_stat", "p_value"], digits))
            .transform(_ordered, "lag"))


def incidents_moving_average(fact_incidents: DataFrame, dim_date: DataFrame, digits: int = 6) -> DataFrame:
    """Every day's incidents with the averages of the 7 and 28 days up to it, and the change from the same
    weekday a week before. An average is NULL until its days are full."""
    days = daily_series({"incidents": fact_incidents}, dim_date)

    def trailing(n: int) -> Column:
        frame = _days().rowsBetween(1 - n, 0)
        return F.when(F.count(F.lit(1)).over(frame) == n, F.round(F.sum("incidents").over(frame) / n, digits)).cast("double")

    return days.select("date_key", "incidents", trailing(7).alias("average_7"), trailing(28).alias("average_28"),
                       (F.col("incidents") - F.lag("incidents", 7).over(_days())).alias("change_7")).transform(_ordered, "date_key")


def seasonal_index(fact_incidents: DataFrame, dim_date: DataFrame, digits: int = 6) -> DataFrame:
    """Monthly incidents with their season (which months of the year are busy?).

    ``centred_average`` spans a year around the month (half weight for the two outer
    months of 13), ``ratio`` is the month's count over it: both NULL in the first and last six months.
    ``seasonal_index`` is the mean ratio of the month of the year, scaled so that the indexes of the months
    that have one average 1; NULL for a month of the year without a ratio. Months without incidents count 0.
    """
    months = (daily_series({"incidents": fact_incidents}, dim_date, "year", "month")
              .groupBy("year", "month").agg(F.sum("incidents").alias("incidents")))
    in_order = Window.orderBy("year", "month")
    half = SEASON // 2
    wide, narrow = in_order.rowsBetween(-half, half), in_order.rowsBetween(1 - half, half - 1)
    # in halves, so that the sum stays a whole number
    twice = F.sum("incidents").over(wide) + F.sum("incidents").over(narrow)
    average = F.when(F.count(F.lit(1)).over(wide) == SEASON + 1, twice.cast("double") / (2 * SEASON))
    rated = (months.withColumn("centred_average", average)
             .withColumn("ratio", F.col("incidents").cast("double") / F.nullif("centred_average", F.lit(0.0))))
    seasons = rated.groupBy("month").agg(F.avg("ratio").alias("raw"))
    seasons = seasons.select(F.col("month").alias("m"), (F.col("raw") / F.nullif(F.avg("raw").over(_all()), F.lit(0.0))).alias("seasonal_index"))
    return (rated.join(F.broadcast(seasons), F.col("month") == F.col("m"))  # 12 rows
            .select("year", "month", "incidents", *[F.round(c, digits).alias(c) for c in ("centred_average", "ratio", "seasonal_index")])
            .transform(_ordered, "year", "month"))
