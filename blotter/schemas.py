"""Explicit input schemas (raw layer) and the reference-table schemas."""

from pyspark.sql import types as T

CALLS_RAW = T.StructType([
    T.StructField("event_number", T.StringType()),
    T.StructField("complaint_number", T.StringType()),
    T.StructField("call_received", T.StringType()),
    T.StructField("tencode", T.StringType()),
    T.StructField("tencode_suffix", T.StringType()),
    T.StructField("disposition_code", T.StringType()),
    T.StructField("disposition_description", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("street_name", T.StringType()),
    T.StructField("zone_", T.StringType()),
    T.StructField("rpa", T.IntegerType()),
    T.StructField("shift", T.StringType()),
    T.StructField("sector", T.StringType()),
])

INCIDENTS_RAW = T.StructType([
    T.StructField("incident_number", T.StringType()),
    T.StructField("incident_occurred", T.StringType()),
    T.StructField("incident_reported", T.StringType()),
    T.StructField("offense_number", T.LongType()),
    T.StructField("offense_nibrs", T.StringType()),
    T.StructField("offense_description", T.StringType()),
    T.StructField("weapon_primary", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("mapped_location", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("rpa", T.IntegerType()),
])

REF_TENCODE = T.StructType([
    T.StructField("tencode", T.StringType()),
    T.StructField("tencode_description", T.StringType()),
])

REF_SUFFIX = T.StructType([
    T.StructField("tencode_suffix", T.StringType()),
    T.StructField("tencode_suffix_description", T.StringType()),
])

DIM_TIME = T.StructType([
    T.StructField("time_key", T.IntegerType(), nullable=False),
    T.StructField("hour", T.IntegerType(), nullable=False),
    T.StructField("minute", T.IntegerType(), nullable=False),
    T.StructField("time_of_day", T.StringType(), nullable=False),
])
