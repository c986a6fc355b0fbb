"""Raw calls and incidents derived from the driver's test tables.

``events`` feeds the calls-for-service feed and ``orders`` the incident feed.
Every column is a plain expression of the source row, so the mapping is a
narrow projection of the parquet scan: it partitions exactly like the scan and
adds no shuffle. The rules deliberately produce the awkward inputs the
pipeline must survive (unparseable timestamps, NULL keys, uncastable codes,
padded and mixed-case codes, duplicate descriptions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import schemas

# Ten-code by event type, NIBRS code and description by
# offense slot (id % 9), weapon by id % 5, shift by id % 3.
TENCODE_BY_EVENT_TYPE = [("click", "43"), ("error", "40"), ("purchase", "53"),
                         ("signup", "70"), ("view", "87")]
OFFENSES = [
    ("09A", "Homicide - Murder"),
    ("13A", "Aggravated Assault"),
    ("120", "Robbery"),
    ("11A", "Rape"),
    ("13B", "Simple Assault"),
    ("23F", "Theft From Motor Vehicle"),
    ("220", "Burglary"),
    ("290", "Damage Prop/Vandalism"),
    ("35A", "Drug/Narcotic Violation"),
]
WEAPONS = ["HANDGUN", "KNIFE", None, "HANDS", "UNKNOWN"]
SHIFTS = ["A", "B", "C"]
INGEST_RUN_TS = "2026-01-01T00:00:00Z"

# The reference lookups (ten-code 87 is left out on purpose so
# one code has no description).
REF_TENCODE_ROWS = [("40", "Suspicious Person"), ("43", "Want Officer for Investigation"),
                    ("53", "Holdup / Robbery"), ("70", "Burglary")]
REF_SUFFIX_ROWS = [("P", "Progress"), ("A", "Alarm")]


# The mappings are SQL expression text: one round trip to the JVM for a whole
# projection instead of one for each node, and reports build their plans anew each time.

def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else f"'{value}'"


def _pick(index: str, values: list) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in enumerate(values)) + " END"


def _padded(prefix: str, ident: str) -> str:
    return f"concat('{prefix}', lpad(CAST({ident} AS STRING), 10, '0'))"


def _raw_time(ts: str) -> str:
    return f"concat(date_format({ts}, 'yyyy/MM/dd HH:mm:ss'), '+00')"


def _coord(base: int, ident: str, modulus: int) -> str:
    return f"CAST({base} AS DOUBLE) + CAST({ident} % {modulus} AS DOUBLE) / CAST(100 AS DOUBLE)"


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def calls_from_events(events: DataFrame) -> DataFrame:
    i, u = "event_id", "user_id"
    by_type = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{code}'" for t, code in TENCODE_BY_EVENT_TYPE) + " END"
    return _project(events, {
        "event_number": _padded("E", i),
        "complaint_number": f"CASE WHEN {i} % 10 = 0 THEN CAST(NULL AS STRING) ELSE {_padded('C', i)} END",
        "call_received": f"CASE WHEN {i} % 97 = 0 THEN 'bad' ELSE "
                         + _raw_time(f"ts + make_dt_interval(CAST({i} % 730 AS INT))") + " END",
        "tencode": f"CASE WHEN {i} % 53 = 0 THEN CAST(NULL AS STRING) WHEN {i} % 59 = 0 THEN '4X' ELSE {by_type} END",
        "tencode_suffix": _pick(f"{i} % 4", [None, "p", " P ", "A"]),
        "disposition_code": _pick(f"{i} % 6", ["1 ", "1", "4", "  ", None, "11"]),
        "disposition_description": _pick(f"{i} % 6", ["Assisted Citizen ", "ASSISTED CITIZEN", "Assisted Other Unit",
                                                      None, None, "Disregarded"]),
        "latitude": f"CASE WHEN {i} % 41 = 0 THEN CAST(NULL AS DOUBLE) ELSE {_coord(36, u, 50)} END",
        "longitude": _coord(-87, u, 30),
        "street_name": f"concat('STREET ', CAST({u} % 20 AS STRING))",
        "zone_": f"CAST({u} % 9 AS STRING)",
        "rpa": f"CAST(1000 + {u} % 40 AS INT)",
        "shift": _pick(f"{i} % 3", SHIFTS),
        "sector": f"CAST({u} % 8 AS STRING)",
        "ingest_run_ts_utc": f"'{INGEST_RUN_TS}'",
    })


def incidents_from_orders(orders: DataFrame) -> DataFrame:
    i, c = "o_orderkey", "o_custkey"
    day = "o_orderdate + INTERVAL '24' YEAR"
    occurred = f"{day} + make_dt_interval(0, CAST({i} % 24 AS INT), CAST({i} % 60 AS INT))"
    reported = f"{day} + make_dt_interval(0, CAST({i} % 24 + {i} % 5 AS INT), CAST({i} % 60 AS INT))"
    slot = f"{i} % 9"
    return _project(orders, {
        "incident_number": _padded("I", i),
        "incident_occurred": f"CASE WHEN {i} % 89 = 0 THEN 'bad' ELSE {_raw_time(occurred)} END",
        "incident_reported": f"CASE WHEN {i} % 83 = 0 THEN CAST(NULL AS STRING) ELSE {_raw_time(reported)} END",
        "offense_number": f"CASE WHEN {i} % 71 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST({slot} + 1 AS BIGINT) END",
        "offense_nibrs": _pick(slot, [code for code, _ in OFFENSES]),
        "offense_description": _pick(slot, [text for _, text in OFFENSES]),
        "weapon_primary": f"CASE WHEN {slot} = 8 THEN CAST(NULL AS STRING) ELSE {_pick(f'{i} % 5', WEAPONS)} END",
        "latitude": f"CASE WHEN {i} % 43 = 0 THEN CAST(NULL AS DOUBLE) ELSE {_coord(36, c, 50)} END",
        "longitude": _coord(-87, c, 30),
        "mapped_location": f"concat('ADDR ', CAST({c} % 25 AS STRING))",
        "zone": f"CAST({c} % 9 AS STRING)",
        "rpa": f"CAST(1000 + {c} % 40 AS INT)",
    })


def in_drops(feed: DataFrame) -> DataFrame:
    """A feed with the name of the drop that brings each row: by zone, but rows whose number ends in 7 come late, in the last."""
    number, zone = ("event_number", "zone_") if "event_number" in feed.columns else ("incident_number", "zone")
    return feed.withColumn("drop", F.expr(f"CASE WHEN {number} LIKE '%7' THEN 'd3' WHEN {zone} < '4' THEN 'd1' ELSE 'd2' END"))


def ref_tencode(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else REF_TENCODE_ROWS, schemas.REF_TENCODE)


def ref_suffix(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else REF_SUFFIX_ROWS, schemas.REF_SUFFIX)
