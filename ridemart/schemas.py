"""Table schemas and the fixed reference tables of the trip mart."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


STRING, DOUBLE, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
NTZ, DATE = T.TimestampNTZType(), T.DateType()

# One raw ride: the field order is also the field order of a CSV line.
RAW = _struct(
    trip_id=STRING,
    start_lat=DOUBLE, start_lon=DOUBLE, end_lat=DOUBLE, end_lon=DOUBLE,
    start_time=NTZ, end_time=NTZ,
    distance=DOUBLE,
)

SILVER = _struct(
    trip_id=STRING, start_time=NTZ, start_geo_hash=STRING, end_geo_hash=STRING, trip_duration_sec=LONG,
)

# Where a Silver row came from. The feed tables are partitioned by these two columns.
ORIGIN = _struct(source=STRING, batch_id=LONG)
FEED = T.StructType(SILVER.fields + ORIGIN.fields)
UNIFIED = T.StructType(FEED.fields + _struct(run_id=LONG).fields)
# A ride's record as it came, and where it came from: what a person needs to repair a reject.
RECORD = _struct(line=STRING, place=STRING)
REJECTS = T.StructType(RAW.fields + _struct(reject_reason=STRING).fields + RECORD.fields + ORIGIN.fields)

DIM_DATE = _struct(
    date_key=INT, full_date=DATE, day=INT, day_name=STRING, day_of_week=INT, is_weekend=INT,
    week_of_year=INT, month=INT, month_name=STRING, quarter=INT, year=INT,
)
DIM_TIME = _struct(time_key=INT, hour=INT, minute=INT, period=STRING, is_rush_hour=INT)
DIM_GEOGRAPHY = _struct(
    geo_hash=STRING, lat=DOUBLE, lon=DOUBLE, parent_geo_res6=STRING, parent_geo_res5=STRING,
)
DIM_DURATION_BUCKET = _struct(
    duration_bucket_key=INT, bucket_label=STRING, min_seconds=INT, max_seconds=INT,
)
FACT = _struct(
    trip_id=STRING, date_key=INT, time_key=INT, start_geo_key=STRING, end_geo_key=STRING,
    duration_bucket_key=INT, start_time=NTZ, trip_duration_sec=LONG, trip_count=INT, is_same_cell=INT,
)
# The stored fact adds its two partition columns.
FACT_STORED = T.StructType(FACT.fields + _struct(month_key=INT, run_id=LONG).fields)

FEED_PROGRESS = T.StructType(ORIGIN.fields + _struct(run_id=LONG).fields)
RUN_PROGRESS = _struct(run_id=LONG)
ID_LEDGER = T.StructType(_struct(trip_id=STRING).fields + ORIGIN.fields)
FILE_MANIFEST = _struct(path=STRING)
FILE_LEDGER = _struct(path=STRING, digest=STRING)
METRICS = T.StructType(
    _struct(rows_in=LONG, rejected=LONG, duplicates=LONG, written=LONG).fields + ORIGIN.fields
)

# The star's tables, by their names under the gold folder.
FACT_TABLE, DATE_TABLE, TIME_TABLE = "fact_trip", "dim_date", "dim_time"
GEOGRAPHY_TABLE, BUCKET_TABLE = "dim_geography", "dim_duration_bucket"
STAR_TABLES = {
    DATE_TABLE: DIM_DATE,
    TIME_TABLE: DIM_TIME,
    GEOGRAPHY_TABLE: DIM_GEOGRAPHY,
    BUCKET_TABLE: DIM_DURATION_BUCKET,
    FACT_TABLE: FACT_STORED,
}

# Duration bands as (key, label, min seconds, max seconds exclusive).
BANDS = (
    (1, "0-5 min", 0, 300),
    (2, "5-15 min", 300, 900),
    (3, "15-30 min", 900, 1800),
    (4, "30-60 min", 1800, 3600),
    (5, "60+ min", 3600, 999999999),
)
# Named parts of the day as (label, first hour, end hour exclusive); the rest is Night.
PERIODS = (("Morning", 6, 12), ("Afternoon", 12, 17), ("Evening", 17, 21))
OTHER_PERIOD = "Night"
# Rush hours, and weekend days counted from Sunday = 1.
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)
WEEKEND_DAYS = (1, 7)
