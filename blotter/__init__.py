"""blotter: a Spark-native star-schema engine for public-safety records.

Layers: raw feeds -> clean (parsed timestamps) -> dimensions and facts with
surrogate keys -> trend reports. Everything is DataFrame code planned by
Catalyst; see README.md for the operator map.

    from blotter import get_session, raw_inputs, Star, write_star, reports
    spark = get_session()
    star = Star(spark, raw_inputs(spark, "/path/to/tables"))
    reports.violent_rate_by_month(star.calls_for_reports, star.incidents_for_reports, star.dim_date).show()
"""

from blotter.operators.clean import clean_calls, clean_incidents
from blotter.operators.keys import dense_key
from blotter.operators.joins import bounded_broadcast, left_lookup
from blotter.operators.quality import observe_quality, preview, quality_metrics
from blotter.operators.gate import Rule, write_checked
from blotter.operators.registry import assign_keys
from blotter.plans import reports, trends
from blotter.plans.incremental_star import IncrementalStar
from blotter.plans.star import Star, read_star, register_views, write_star
from blotter.session import checkpoint_dir, get_session, prepare
from blotter.sources.landing import corrupt_rows, land_csv
from blotter.sources.tables import raw_from_csv, raw_from_tables, raw_inputs

__all__ = [
    "IncrementalStar", "Rule", "Star", "assign_keys", "bounded_broadcast", "checkpoint_dir", "clean_calls", "clean_incidents",
    "corrupt_rows", "dense_key",
    "get_session", "land_csv", "left_lookup", "observe_quality", "prepare", "preview",
    "quality_metrics", "raw_from_csv", "raw_from_tables", "raw_inputs", "read_star", "register_views", "reports",
    "trends", "write_checked", "write_star",
]
