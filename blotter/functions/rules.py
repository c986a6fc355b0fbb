"""Fixed classification values and the column expressions built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offense category rules, tried in this order; the first
# matching pattern (searched in the upper-cased offense description) wins and
# anything unmatched is "Other".
OFFENSE_CATEGORY_RULES = [
    ("HOMICIDE|MURDER|MANSLAUGHTER|KIDNAP|KIDNAPPING", "Violent"),
    ("ASSAULT|AGG ASSAULT|DOMESTIC ASSAULT", "Violent"),
    ("ROBBERY|CARJACKING", "Violent"),
    ("RAPE|SEXUAL|SODOMY|FONDLING", "Violent"),
    ("BURGLARY|BREAKING AND ENTERING", "Property"),
    ("THEFT|LARCENY|SHOPLIFT|STOLEN PROPERTY", "Property"),
    ("VANDALISM|DAMAGE PROP|GRAFFITI", "Property"),
]
OFFENSE_CATEGORY_DEFAULT = "Other"
VIOLENT_CATEGORY = "Violent"

# NIBRS codes the reports count as violent
# (09A homicide, 13A aggravated assault, 120 robbery, 11A rape).
VIOLENT_NIBRS = ["09A", "13A", "120", "11A"]

# Hour-of-day buckets of dim_time, as [first hour, last hour].
TIME_OF_DAY_BUCKETS = [
    (0, 5, "Overnight"),
    (6, 11, "Morning"),
    (12, 17, "Afternoon"),
    (18, 23, "Evening"),
]

# The calendar covered by dim_date.
CALENDAR_START = "2018-01-01"
CALENDAR_END = "2025-12-31"


def offense_category(description: Column) -> Column:
    desc = F.upper(description)
    expr = None
    for pattern, category in OFFENSE_CATEGORY_RULES:
        cond = desc.rlike(pattern)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lit(OFFENSE_CATEGORY_DEFAULT))


def time_of_day(hour: Column) -> Column:
    """Bucket name of an hour 0..23 (the last bucket takes the remaining hours)."""
    *first, (_, _, last) = TIME_OF_DAY_BUCKETS
    expr = None
    for lo, hi, name in first:
        cond = hour.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(last))
