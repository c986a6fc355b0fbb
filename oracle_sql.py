"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: the mapping of the driver tables,
the clean layer, dimensions, facts and reports are plain SQL over the
pre-registered views ``events`` and ``orders``. Surrogate keys are
``row_number()`` over the same order the Spark side uses, with NULL
placement spelled out (DuckDB sorts NULLs last by default, Spark first).
"""

RAW_CALLS = r"""
raw_calls AS (
  SELECT
    'E' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS event_number,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'C' || lpad(CAST(event_id AS VARCHAR), 10, '0') END AS complaint_number,
    CASE WHEN event_id % 97 = 0 THEN 'bad'
         ELSE strftime(ts + to_days(CAST(event_id % 730 AS INTEGER)), '%Y/%m/%d %H:%M:%S') || '+00' END AS call_received,
    CASE WHEN event_id % 53 = 0 THEN NULL
         WHEN event_id % 59 = 0 THEN '4X'
         ELSE CASE event_type WHEN 'click' THEN '43' WHEN 'error' THEN '40' WHEN 'purchase' THEN '53'
                              WHEN 'signup' THEN '70' WHEN 'view' THEN '87' END END AS tencode,
    CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'p' WHEN 2 THEN ' P ' ELSE 'A' END AS tencode_suffix,
    CASE event_id % 6 WHEN 0 THEN '1 ' WHEN 1 THEN '1' WHEN 2 THEN '4' WHEN 3 THEN '  '
                      WHEN 4 THEN NULL ELSE '11' END AS disposition_code,
    CASE event_id % 6 WHEN 0 THEN 'Assisted Citizen ' WHEN 1 THEN 'ASSISTED CITIZEN'
                      WHEN 2 THEN 'Assisted Other Unit' WHEN 5 THEN 'Disregarded' END AS disposition_description,
    CASE WHEN event_id % 41 = 0 THEN NULL
         ELSE CAST(36 AS DOUBLE) + CAST(user_id % 50 AS DOUBLE) / CAST(100 AS DOUBLE) END AS latitude,
    CAST(-87 AS DOUBLE) + CAST(user_id % 30 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude,
    'STREET ' || CAST(user_id % 20 AS VARCHAR) AS street_name,
    CAST(user_id % 9 AS VARCHAR) AS zone_,
    CAST(1000 + user_id % 40 AS INTEGER) AS rpa,
    CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS shift,
    CAST(user_id % 8 AS VARCHAR) AS sector,
    '2026-01-01T00:00:00Z' AS ingest_run_ts_utc
  FROM events)"""

RAW_INCIDENTS = r"""
raw_incidents AS (
  SELECT
    'I' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS incident_number,
    CASE WHEN o_orderkey % 89 = 0 THEN 'bad'
         ELSE strftime(o_orderdate + INTERVAL 24 YEAR + to_hours(CAST(o_orderkey % 24 AS INTEGER))
                       + to_minutes(CAST(o_orderkey % 60 AS INTEGER)), '%Y/%m/%d %H:%M:%S') || '+00' END AS incident_occurred,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL
         ELSE strftime(o_orderdate + INTERVAL 24 YEAR + to_hours(CAST(o_orderkey % 24 + o_orderkey % 5 AS INTEGER))
                       + to_minutes(CAST(o_orderkey % 60 AS INTEGER)), '%Y/%m/%d %H:%M:%S') || '+00' END AS incident_reported,
    CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE CAST(o_orderkey % 9 + 1 AS BIGINT) END AS offense_number,
    CASE o_orderkey % 9 WHEN 0 THEN '09A' WHEN 1 THEN '13A' WHEN 2 THEN '120' WHEN 3 THEN '11A' WHEN 4 THEN '13B'
                        WHEN 5 THEN '23F' WHEN 6 THEN '220' WHEN 7 THEN '290' ELSE '35A' END AS offense_nibrs,
    CASE o_orderkey % 9 WHEN 0 THEN 'Homicide - Murder' WHEN 1 THEN 'Aggravated Assault' WHEN 2 THEN 'Robbery'
                        WHEN 3 THEN 'Rape' WHEN 4 THEN 'Simple Assault' WHEN 5 THEN 'Theft From Motor Vehicle'
                        WHEN 6 THEN 'Burglary' WHEN 7 THEN 'Damage Prop/Vandalism'
                        ELSE 'Drug/Narcotic Violation' END AS offense_description,
    CASE WHEN o_orderkey % 9 = 8 THEN NULL
         ELSE CASE o_orderkey % 5 WHEN 0 THEN 'HANDGUN' WHEN 1 THEN 'KNIFE' WHEN 2 THEN NULL
                                  WHEN 3 THEN 'HANDS' ELSE 'UNKNOWN' END END AS weapon_primary,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL
         ELSE CAST(36 AS DOUBLE) + CAST(o_custkey % 50 AS DOUBLE) / CAST(100 AS DOUBLE) END AS latitude,
    CAST(-87 AS DOUBLE) + CAST(o_custkey % 30 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude,
    'ADDR ' || CAST(o_custkey % 25 AS VARCHAR) AS mapped_location,
    CAST(o_custkey % 9 AS VARCHAR) AS zone,
    CAST(1000 + o_custkey % 40 AS INTEGER) AS rpa
  FROM orders)"""

CLEAN = r"""
clean_calls AS (
  SELECT * REPLACE (try_strptime(regexp_replace(call_received, '\+00$', ''), '%Y/%m/%d %H:%M:%S') AS call_received)
  FROM raw_calls),
clean_incidents AS (
  SELECT * REPLACE (
    try_strptime(regexp_replace(incident_occurred, '\+00$', ''), '%Y/%m/%d %H:%M:%S') AS incident_occurred,
    try_strptime(regexp_replace(incident_reported, '\+00$', ''), '%Y/%m/%d %H:%M:%S') AS incident_reported)
  FROM raw_incidents)"""

DIMS = r"""
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
         dayname(d) AS day_of_week_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(range AS DATE) AS d FROM range(DATE '2018-01-01', DATE '2026-01-01', INTERVAL 1 DAY))),
dim_time AS (
  SELECT CAST(h * 100 AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour, 0 AS minute,
         CASE WHEN h < 6 THEN 'Overnight' WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon'
              ELSE 'Evening' END AS time_of_day
  FROM range(24) t(h)),
dim_location AS (
  SELECT row_number() OVER (ORDER BY latitude NULLS FIRST, longitude NULLS FIRST, block_address NULLS FIRST,
                                     zone NULLS FIRST, rpa NULLS FIRST) AS location_key, *
  FROM (SELECT DISTINCT * FROM (
          SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
                 mapped_location AS block_address, CAST(zone AS VARCHAR) AS zone, CAST(rpa AS VARCHAR) AS rpa
          FROM clean_incidents
          UNION ALL
          SELECT CAST(latitude AS DOUBLE), CAST(longitude AS DOUBLE), street_name, CAST(zone_ AS VARCHAR),
                 CAST(rpa AS VARCHAR)
          FROM clean_calls)
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL)),
ref_tencode AS (
  SELECT * FROM (VALUES ('40', 'Suspicious Person'), ('43', 'Want Officer for Investigation'),
                        ('53', 'Holdup / Robbery'), ('70', 'Burglary')) t(tencode, tencode_description)),
ref_suffix AS (
  SELECT * FROM (VALUES ('P', 'Progress'), ('A', 'Alarm')) t(tencode_suffix, tencode_suffix_description)),
dim_call_type AS (
  SELECT row_number() OVER (ORDER BY b.tencode NULLS LAST, b.tencode_suffix NULLS LAST,
                                     t.tencode_description NULLS FIRST,
                                     s.tencode_suffix_description NULLS FIRST) AS call_type_key,
         b.tencode, t.tencode_description, b.tencode_suffix, s.tencode_suffix_description
  FROM (SELECT DISTINCT TRY_CAST(tencode AS INTEGER) AS tencode, trim(upper(tencode_suffix)) AS tencode_suffix
        FROM clean_calls WHERE tencode IS NOT NULL) b
  LEFT JOIN (SELECT TRY_CAST(tencode AS INTEGER) AS ref_tencode, trim(tencode_description) AS tencode_description
             FROM ref_tencode) t ON b.tencode = t.ref_tencode
  LEFT JOIN (SELECT trim(upper(tencode_suffix)) AS ref_suffix,
                    trim(tencode_suffix_description) AS tencode_suffix_description
             FROM ref_suffix) s ON b.tencode_suffix = s.ref_suffix),
dim_call_disposition AS (
  SELECT row_number() OVER (ORDER BY disposition_code NULLS FIRST) AS call_disposition_key,
         disposition_code, disposition_description
  FROM (SELECT trim(disposition_code) AS disposition_code,
               min(trim(disposition_description)) AS disposition_description
        FROM clean_calls
        WHERE disposition_code IS NOT NULL AND trim(disposition_code) <> ''
        GROUP BY 1)),
dim_offense AS (
  SELECT row_number() OVER (ORDER BY offense_number NULLS FIRST, offense_nibrs NULLS FIRST,
                                     offense_description NULLS FIRST) AS offense_key,
         offense_number, offense_nibrs, offense_description, weapon_primary, offense_category,
         offense_category = 'Violent' AS is_violent
  FROM (
    -- Fixed values: the patterns of each category, in order.
    SELECT offense_number, offense_nibrs, offense_description,
           coalesce(string_agg(DISTINCT weapon_primary, ', ' ORDER BY weapon_primary), '') AS weapon_primary,
           CASE WHEN regexp_matches(upper(offense_description), 'HOMICIDE|MURDER|MANSLAUGHTER|KIDNAP|KIDNAPPING') THEN 'Violent'
                WHEN regexp_matches(upper(offense_description), 'ASSAULT|AGG ASSAULT|DOMESTIC ASSAULT') THEN 'Violent'
                WHEN regexp_matches(upper(offense_description), 'ROBBERY|CARJACKING') THEN 'Violent'
                WHEN regexp_matches(upper(offense_description), 'RAPE|SEXUAL|SODOMY|FONDLING') THEN 'Violent'
                WHEN regexp_matches(upper(offense_description), 'BURGLARY|BREAKING AND ENTERING') THEN 'Property'
                WHEN regexp_matches(upper(offense_description), 'THEFT|LARCENY|SHOPLIFT|STOLEN PROPERTY') THEN 'Property'
                WHEN regexp_matches(upper(offense_description), 'VANDALISM|DAMAGE PROP|GRAFFITI') THEN 'Property'
                ELSE 'Other' END AS offense_category
    FROM clean_incidents
    WHERE offense_number IS NOT NULL AND offense_description IS NOT NULL
    GROUP BY offense_number, offense_nibrs, offense_description))"""

FACTS = r"""
fact_calls AS (
  SELECT row_number() OVER (ORDER BY complaint_number NULLS FIRST, event_number NULLS FIRST) AS call_key,
         complaint_number,
         CAST(year(call_received) * 10000 + month(call_received) * 100 + day(call_received) AS INTEGER) AS date_key,
         CAST(hour(call_received) * 100 AS INTEGER) AS time_key,
         latitude, longitude, rpa, zone_ AS zone, call_received, ingest_run_ts_utc
  FROM clean_calls),
fact_incidents AS (
  SELECT row_number() OVER (ORDER BY incident_number NULLS FIRST, date_key NULLS FIRST, time_key NULLS FIRST,
                                     offense_number NULLS FIRST, offense_nibrs NULLS FIRST, latitude NULLS FIRST,
                                     longitude NULLS FIRST, incident_occurred NULLS FIRST,
                                     incident_reported NULLS FIRST) AS incident_key, *
  FROM (SELECT incident_number,
               CAST(year(incident_occurred) * 10000 + month(incident_occurred) * 100 + day(incident_occurred)
                    AS INTEGER) AS date_key,
               CAST(hour(incident_occurred) * 100 AS INTEGER) AS time_key,
               offense_number, offense_nibrs, latitude, longitude, incident_occurred, incident_reported
        FROM clean_incidents))"""


def _enriched(normalize: bool) -> str:
    suffix = "trim(upper(c.tencode_suffix))" if normalize else "c.tencode_suffix"
    suffix_eq = "IS NOT DISTINCT FROM" if normalize else "="
    code = "trim(c.disposition_code)" if normalize else "c.disposition_code"
    return f"""
SELECT row_number() OVER (ORDER BY c.event_number NULLS FIRST, c.call_received NULLS FIRST) AS call_key,
       c.event_number, c.complaint_number,
       CAST(year(c.call_received) * 10000 + month(c.call_received) * 100 + day(c.call_received) AS INTEGER) AS date_key,
       CAST(hour(c.call_received) * 100 AS INTEGER) AS time_key,
       l.location_key, t.call_type_key, d.call_disposition_key, c.shift, c.sector,
       c.call_received AS call_received_utc, c.ingest_run_ts_utc
FROM clean_calls c
LEFT JOIN (SELECT latitude, longitude, min(location_key) AS location_key FROM dim_location GROUP BY 1, 2) l
  ON c.latitude = l.latitude AND c.longitude = l.longitude
LEFT JOIN (SELECT tencode, tencode_suffix, min(call_type_key) AS call_type_key FROM dim_call_type GROUP BY 1, 2) t
  ON TRY_CAST(c.tencode AS INTEGER) = t.tencode AND {suffix} {suffix_eq} t.tencode_suffix
LEFT JOIN (SELECT disposition_code, min(call_disposition_key) AS call_disposition_key
           FROM dim_call_disposition GROUP BY 1) d
  ON {code} = d.disposition_code"""


def _with(body: str) -> str:
    return "WITH " + ",".join([RAW_CALLS, RAW_INCIDENTS, CLEAN, DIMS, FACTS]) + "\n" + body


# NIBRS codes the reports count as violent, and the calendar's days.
VIOLENT = "('09A', '13A', '120', '11A')"
CALENDAR = "BETWEEN 20180101 AND 20251231"

QUERIES = {
    "clean_calls": "SELECT * FROM clean_calls",
    "clean_incidents": "SELECT * FROM clean_incidents",
    "dim_location": "SELECT * FROM dim_location",
    "dim_offense": "SELECT * FROM dim_offense",
    "dim_call_type": "SELECT * FROM dim_call_type",
    "dim_call_disposition": "SELECT * FROM dim_call_disposition",
    "fact_calls": "SELECT * FROM fact_calls",
    "fact_incidents": "SELECT * FROM fact_incidents",
    "fact_calls_enriched": _enriched(False),
    "fact_calls_enriched_normalized": _enriched(True),
    # The reports are written from their definitions on the facts' own
    # timestamps: the clock has every hour, the calendar the days of CALENDAR.
    "calls_by_hour": """
SELECT hour(call_received) AS hour, count(*) AS call_count
FROM fact_calls WHERE call_received IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "calls_by_month": f"""
SELECT year(call_received) AS year, month(call_received) AS month, any_value(monthname(call_received)) AS month_name,
       count(*) AS call_count
FROM fact_calls WHERE date_key {CALENDAR} GROUP BY 1, 2 ORDER BY 1, 2""",
    "violent_by_dow_hour": f"""
SELECT dayname(incident_occurred) AS day_of_week_name, hour(incident_occurred) AS hour, count(*) AS violent_incident_count
FROM fact_incidents WHERE year(incident_occurred) = 2025 AND offense_nibrs IN {VIOLENT} GROUP BY 1, 2 ORDER BY 1, 2""",
    # S18: months that have calls; violent incidents of the month per 100 of its calls
    "violent_rate_by_month": f"""
, happened AS (
  SELECT call_received AS moment, 1 AS is_call, 0 AS is_violent FROM fact_calls WHERE date_key {CALENDAR}
  UNION ALL
  SELECT incident_occurred, 0, 1 FROM fact_incidents WHERE date_key {CALENDAR} AND offense_nibrs IN {VIOLENT}),
per_month AS (
  SELECT date_trunc('month', moment) AS first_day, sum(is_call) AS n_calls, sum(is_violent) AS n_violent FROM happened GROUP BY 1)
SELECT year(first_day) AS year, month(first_day) AS month, monthname(first_day) AS month_name,
       CAST(n_calls AS BIGINT) AS total_calls, CAST(n_violent AS BIGINT) AS violent_incidents,
       round(CAST(n_violent AS DOUBLE) / n_calls * 100, 2) AS violent_incident_rate_pct
FROM per_month WHERE n_calls > 0 ORDER BY first_day""",
    "fact_metrics": f"""
, f AS ({_enriched(False)}
), wide AS (
  SELECT count(*) AS "rows", count(*) - count(location_key) AS null_location_key,
         count(*) - count(call_type_key) AS null_call_type_key,
         count(*) - count(call_disposition_key) AS null_call_disposition_key, count(*) - count(date_key) AS null_date_key,
         (SELECT count(*) FROM clean_calls) AS rows_in
  FROM f)
SELECT 'fact_calls_enriched' AS "table", metric, value FROM wide
UNPIVOT (value FOR metric IN ("rows", rows_in, null_location_key, null_call_type_key, null_call_disposition_key, null_date_key))""",
    # the query lists one code of each reference a second time
    "duplicate_ref_codes": """
, listed AS (
  SELECT 'tencode' AS kind, CAST(TRY_CAST(tencode AS INTEGER) AS VARCHAR) AS code
  FROM (SELECT tencode FROM ref_tencode UNION ALL SELECT '070')
  UNION ALL
  SELECT 'tencode_suffix', trim(upper(tencode_suffix)) FROM (SELECT tencode_suffix FROM ref_suffix UNION ALL SELECT ' p')),
used AS (
  SELECT 'tencode' AS kind, CAST(TRY_CAST(tencode AS INTEGER) AS VARCHAR) AS code FROM clean_calls WHERE tencode IS NOT NULL
  UNION ALL
  SELECT 'tencode_suffix', trim(upper(tencode_suffix)) FROM clean_calls WHERE tencode IS NOT NULL)
SELECT kind, code, count(*) AS copies, (SELECT count(*) FROM used u WHERE u.kind = l.kind AND u.code = l.code) AS calls
FROM listed l WHERE code IS NOT NULL GROUP BY kind, code HAVING count(*) > 1""",
    "quality_metrics": """
SELECT 'calls' AS "table", metric, value FROM (
  SELECT COUNT(*) AS "rows",
         CAST(SUM(CASE WHEN call_received IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_call_received,
         CAST(SUM(CASE WHEN call_received IS NOT NULL AND (CAST(call_received AS DATE) < DATE '2018-01-01'
                            OR CAST(call_received AS DATE) > DATE '2025-12-31') THEN 1 ELSE 0 END) AS BIGINT)
           AS outside_calendar
  FROM clean_calls) UNPIVOT (value FOR metric IN ("rows", null_call_received, outside_calendar))
UNION ALL
SELECT 'incidents', metric, value FROM (
  SELECT COUNT(*) AS "rows",
         CAST(SUM(CASE WHEN incident_occurred IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_incident_occurred,
         CAST(SUM(CASE WHEN incident_reported IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_incident_reported,
         CAST(SUM(CASE WHEN incident_occurred IS NOT NULL AND (CAST(incident_occurred AS DATE) < DATE '2018-01-01'
                            OR CAST(incident_occurred AS DATE) > DATE '2025-12-31') THEN 1 ELSE 0 END) AS BIGINT)
           AS outside_calendar
  FROM clean_incidents)
UNPIVOT (value FOR metric IN ("rows", null_incident_occurred, null_incident_reported, outside_calendar))""",
    "incidents_by_time_of_day": """
SELECT time_of_day, incident_count,
       CAST(ROUND(incident_count * 100.0 / SUM(incident_count) OVER (), 2) AS DOUBLE) AS share_pct
FROM (SELECT t.time_of_day, COUNT(*) AS incident_count
      FROM fact_incidents f JOIN dim_time t ON f.time_key = t.time_key GROUP BY t.time_of_day)
ORDER BY time_of_day""",
    "incidents_weekend": """
SELECT c.is_weekend, c.incident_count, d.day_count,
       ROUND(CAST(c.incident_count AS DOUBLE) / d.day_count, 4) AS incidents_per_day
FROM (SELECT d.is_weekend, COUNT(*) AS incident_count
      FROM fact_incidents f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.is_weekend) c
JOIN (SELECT is_weekend, COUNT(*) AS day_count FROM dim_date GROUP BY is_weekend) d
  ON c.is_weekend = d.is_weekend
ORDER BY c.is_weekend""",
    "calls_incidents_correlation": """
, daily AS (
  SELECT c.date_key, c.calls, i.incidents
  FROM (SELECT f.date_key, COUNT(*) AS calls FROM fact_calls f JOIN dim_date d ON f.date_key = d.date_key
        GROUP BY f.date_key) c
  JOIN (SELECT f.date_key, COUNT(*) AS incidents FROM fact_incidents f JOIN dim_date d ON f.date_key = d.date_key
        GROUP BY f.date_key) i ON c.date_key = i.date_key)
SELECT COUNT(*) AS days,
       ROUND(corr(CAST(calls AS DOUBLE), CAST(incidents AS DOUBLE)), 8) AS corr,
       ROUND(regr_slope(CAST(incidents AS DOUBLE), CAST(calls AS DOUBLE)), 8) AS slope,
       ROUND(regr_intercept(CAST(incidents AS DOUBLE), CAST(calls AS DOUBLE)), 8) AS intercept,
       ROUND(regr_r2(CAST(incidents AS DOUBLE), CAST(calls AS DOUBLE)), 8) AS r2
FROM daily""",
    "quality_rule_rows": """
, tested AS (
  SELECT 'calls' AS "table", [
    call_received IS NULL,
    coalesce(year(call_received) NOT BETWEEN 2018 AND 2025, false),
    coalesce(trim(event_number), '') = '',
    tencode IS NOT NULL AND TRY_CAST(tencode AS INTEGER) IS NULL,
    (latitude IS NULL) <> (longitude IS NULL)] AS broken,
    ['unparsed_time', 'outside_calendar', 'no_event_number', 'tencode_not_a_number', 'half_a_coordinate'] AS names
  FROM clean_calls
  UNION ALL
  SELECT 'incidents', [
    incident_occurred IS NULL,
    coalesce(year(incident_occurred) NOT BETWEEN 2018 AND 2025, false),
    coalesce(trim(incident_number), '') = '',
    coalesce(incident_reported < incident_occurred, false),
    offense_number IS NULL,
    (latitude IS NULL) <> (longitude IS NULL)],
    ['unparsed_time', 'outside_calendar', 'no_incident_number', 'reported_before_it_occurred', 'no_offense_number', 'half_a_coordinate']
  FROM clean_incidents),
each AS (
  SELECT "table", unnest(names) AS rule, unnest(broken) AS b, unnest(generate_series(1, len(broken))) AS k, list_position(broken, true) AS first
  FROM tested)
SELECT "table", rule, count(*) FILTER (b) AS "rows", count(*) FILTER (b AND k = first) AS first_of_row FROM each GROUP BY 1, 2""",
    "stable_location_keys": """
, seen AS (
  SELECT 1 AS run, latitude, longitude, mapped_location AS block_address, CAST(zone AS VARCHAR) AS zone, CAST(rpa AS VARCHAR) AS rpa
  FROM clean_incidents
  UNION ALL
  SELECT 2, latitude, longitude, street_name, CAST(zone_ AS VARCHAR), CAST(rpa AS VARCHAR) FROM clean_calls),
members AS (
  SELECT min(run) AS run, latitude, longitude, block_address, zone, rpa FROM seen
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL)
SELECT row_number() OVER (ORDER BY run, latitude, longitude, block_address NULLS FIRST, zone NULLS FIRST, rpa NULLS FIRST) AS location_key,
       * EXCLUDE (run)
FROM members""",
    "incremental_fact_calls": """
, dropped AS (
  SELECT *, CASE WHEN event_number LIKE '%7' THEN 'd3' WHEN zone_ < '4' THEN 'd1' ELSE 'd2' END AS "drop" FROM clean_calls)
SELECT row_number() OVER (ORDER BY "drop", complaint_number NULLS FIRST, event_number NULLS FIRST) AS call_key, complaint_number,
       CAST(strftime(call_received, '%Y%m%d') AS INTEGER) AS date_key, CAST(strftime(call_received, '%H00') AS INTEGER) AS time_key,
       latitude, longitude, rpa, zone_ AS zone, call_received, ingest_run_ts_utc, "drop"
FROM dropped""",
    # the t tail of whole degrees of freedom has a finite series in the angle whose tangent is t / sqrt(df)
    "calls_incidents_significance": f"""
, counted AS (
  SELECT date_key, sum(is_call) AS x, sum(1 - is_call) AS y FROM (
    SELECT date_key, 1 AS is_call FROM fact_calls UNION ALL SELECT date_key, 0 FROM fact_incidents)
  WHERE date_key {CALENDAR} GROUP BY date_key HAVING x > 0 AND y > 0),
sums AS (
  SELECT count(*) AS n, CAST(sum(x) AS DOUBLE) AS sx, CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(x * x) AS DOUBLE) AS sxx,
         CAST(sum(x * y) AS DOUBLE) AS sxy, CAST(sum(y * y) AS DOUBLE) AS syy FROM counted),
centred AS (
  SELECT n, n - 2 AS df, sx / n AS mx, sy / n AS my, sxx - sx * sx / n AS cxx, sxy - sx * sy / n AS cxy, syy - sy * sy / n AS cyy FROM sums),
fit AS (
  SELECT *, cxy / cxx AS slope, sqrt((cyy - cxy * cxy / cxx) / df / cxx) AS se FROM centred),
angle AS (
  SELECT *, abs(slope / se) AS t, atan(abs(slope / se) / sqrt(df)) AS theta FROM fit),
series AS (
  SELECT sum(term) AS total FROM (
    SELECT exp(sum(ln(CASE WHEN k < 2 THEN 1 ELSE (k - 1) / CAST(k AS DOUBLE) END)) OVER (ORDER BY k)) * power(cos(theta), k) AS term
    FROM angle, (SELECT unnest(generate_series(CAST(df % 2 AS BIGINT), CAST(df - 2 AS BIGINT), 2)) AS k FROM fit)))
SELECT n AS days, round(cxy / sqrt(cxx * cyy), 8) AS corr, round(slope, 8) AS slope, round(my - slope * mx, 8) AS intercept,
       round(se, 8) AS slope_se, round(slope / se, 8) AS t_stat, df AS deg_freedom,
       round(1 - CASE WHEN df % 2 = 0 THEN sin(theta) * total ELSE 2 / pi() * (theta + sin(theta) * total) END, 8) AS p_value,
       1 - CASE WHEN df % 2 = 0 THEN sin(theta) * total ELSE 2 / pi() * (theta + sin(theta) * total) END < 0.05 AS significant
FROM angle, series""",
    "calls_incidents_lags": f"""
, counted AS (
  SELECT date_key, sum(is_call) AS x, sum(1 - is_call) AS y FROM (
    SELECT date_key, 1 AS is_call FROM fact_calls UNION ALL SELECT date_key, 0 FROM fact_incidents)
  WHERE date_key {CALENDAR} GROUP BY date_key),
span AS (
  SELECT greatest(min(date_key) FILTER (x > 0), min(date_key) FILTER (y > 0)) AS first_day,
         least(max(date_key) FILTER (x > 0), max(date_key) FILTER (y > 0)) AS last_day FROM counted),
days AS (
  SELECT date, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM dim_date LEFT JOIN counted USING (date_key), span
  WHERE date_key BETWEEN first_day AND last_day),
pairs AS (
  SELECT k AS lag, CAST(b.x AS DOUBLE) AS x, CAST(d.y AS DOUBLE) AS y
  FROM days d, range(15) r(k), days b WHERE b.date = d.date - CAST(k AS INTEGER)),
fit AS (
  SELECT CAST(lag AS INTEGER) AS lag, count(*) AS days, corr(x, y) AS r, regr_slope(y, x) AS slope FROM pairs GROUP BY lag),
tested AS (
  SELECT *, r * sqrt((days - 2) / (1 - r * r)) AS t, days - 2 AS df, atan(abs(r) / sqrt(1 - r * r)) AS theta FROM fit),
series AS (
  SELECT lag, sum(term) AS total FROM (
    SELECT lag, exp(sum(ln(CASE WHEN k < 2 THEN 1 ELSE (k - 1) / CAST(k AS DOUBLE) END)) OVER (PARTITION BY lag ORDER BY k))
                * power(cos(theta), k) AS term
    FROM (SELECT lag, theta, unnest(generate_series(CAST(df % 2 AS BIGINT), CAST(df - 2 AS BIGINT), 2)) AS k FROM tested)) GROUP BY lag)
SELECT lag, days, round(r, 8) AS corr, round(slope, 8) AS slope, round(t, 8) AS t_stat,
       round(1 - CASE WHEN df % 2 = 0 THEN sin(theta) * total ELSE 2 / pi() * (theta + sin(theta) * total) END, 8) AS p_value
FROM tested JOIN series USING (lag) ORDER BY lag""",
    "incidents_moving_average": f"""
, counted AS (
  SELECT date_key, count(*) AS n FROM fact_incidents WHERE date_key {CALENDAR} GROUP BY date_key),
days AS (
  SELECT date_key, date, coalesce(n, 0) AS incidents FROM dim_date LEFT JOIN counted USING (date_key)
  WHERE date_key BETWEEN (SELECT min(date_key) FROM counted) AND (SELECT max(date_key) FROM counted))
SELECT d.date_key, d.incidents,
       CASE WHEN count(*) FILTER (b.date > d.date - 7) = 7 THEN round(sum(b.incidents) FILTER (b.date > d.date - 7) / 7, 6) END AS average_7,
       CASE WHEN count(*) = 28 THEN round(sum(b.incidents) / 28, 6) END AS average_28,
       CAST(d.incidents - max(b.incidents) FILTER (b.date = d.date - 7) AS BIGINT) AS change_7
FROM days d JOIN days b ON b.date BETWEEN d.date - 27 AND d.date GROUP BY d.date_key, d.date, d.incidents ORDER BY d.date_key""",
    "seasonal_index": f"""
, span AS (
  SELECT date_trunc('month', min(incident_occurred)) AS first_month, date_trunc('month', max(incident_occurred)) AS last_month
  FROM fact_incidents WHERE date_key {CALENDAR}),
months AS (
  SELECT m, (SELECT count(*) FROM fact_incidents WHERE date_key {CALENDAR} AND date_trunc('month', incident_occurred) = m) AS n
  FROM (SELECT unnest(generate_series(CAST(first_month AS TIMESTAMP), CAST(last_month AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM span)),
averaged AS (
  SELECT a.m, a.n, CASE WHEN count(*) = 13 THEN sum(CASE WHEN abs(date_diff('month', a.m, b.m)) = 6 THEN 0.5 ELSE 1 END * b.n) / 12 END AS around
  FROM months a JOIN months b ON abs(date_diff('month', a.m, b.m)) <= 6 GROUP BY a.m, a.n),
raw AS (
  SELECT month(m) AS mm, avg(n / CAST(nullif(around, 0) AS DOUBLE)) AS r FROM averaged GROUP BY 1)
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, n AS incidents, round(CAST(around AS DOUBLE), 6) AS centred_average,
       round(n / CAST(nullif(around, 0) AS DOUBLE), 6) AS ratio, round(r / (SELECT avg(r) FROM raw), 6) AS seasonal_index
FROM averaged JOIN raw ON mm = month(m) ORDER BY 1, 2""",
}


# Counts merged drop by drop give what the report on the whole fact gives.
QUERIES["rollup_violent_rate_by_month"] = QUERIES["violent_rate_by_month"]


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in QUERIES.items():
        if body.lstrip().startswith(","):
            out[name] = "WITH " + ",".join([RAW_CALLS, RAW_INCIDENTS, CLEAN, DIMS, FACTS]) + body
        else:
            out[name] = _with(body)
    return out
