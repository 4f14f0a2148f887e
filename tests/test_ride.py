from datetime import date

import pytest
from conftest import at
from pyspark.sql import functions as F

from ridemart.functions import ride as fn
from ridemart.plans import gold


def test_bands(spark):
    seconds = [0, 299, 300, 899, 900, 1799, 1800, 3599, 3600, 10**8, None]
    rows = spark.createDataFrame([(s,) for s in seconds], "s long").select(fn.band_key(F.col("s")))
    assert [row[0] for row in rows.collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, None]


def test_band_case_equals_range_join(spark):
    seconds = spark.range(0, 4000).select(F.col("id").alias("s"))
    inside = (F.col("s") >= F.col("min_seconds")) & (F.col("s") < F.col("max_seconds"))
    joined = seconds.join(F.broadcast(gold.dim_duration_bucket(spark)), inside, "left")
    assert joined.count() == 4000
    assert joined.filter(~F.col("duration_bucket_key").eqNullSafe(fn.band_key(F.col("s")))).isEmpty()


def test_periods_and_rush_hours(spark):
    rows = {row.hour: row for row in gold.dim_time(spark).collect()}
    assert len(rows) == 24
    expected = ["Night"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 5 + ["Evening"] * 4 + ["Night"] * 3
    assert [rows[h].period for h in range(24)] == expected
    assert [h for h in range(24) if rows[h].is_rush_hour] == [7, 8, 9, 16, 17, 18, 19]
    assert {row.minute for row in rows.values()} == {0}


@pytest.mark.parametrize("day, week, day_of_week, weekend, name", [
    ("2014-12-31", 1, 4, 0, "Wednesday"),
    ("2015-01-01", 1, 5, 0, "Thursday"),
    ("2016-01-03", 53, 1, 1, "Sunday"),
    ("2016-02-29", 9, 2, 0, "Monday"),
    ("2024-01-06", 1, 7, 1, "Saturday"),
])
def test_calendar(spark, day, week, day_of_week, weekend, name):
    keys = spark.createDataFrame([(at(day),)], "ts timestamp_ntz").select(fn.date_key(F.col("ts")).alias("date_key"))
    row = gold.date_attributes(keys).first()
    assert row.date_key == int(day.replace("-", ""))
    assert row.full_date == date.fromisoformat(day)
    assert (row.week_of_year, row.day_of_week, row.is_weekend, row.day_name) == (week, day_of_week, weekend, name)
    assert row.quarter == (row.month + 2) // 3


def test_labels(spark):
    flags = spark.createDataFrame([(0,), (1,), (None,)], "f int")
    got = flags.select(fn.day_type(F.col("f")), fn.rush_label(F.col("f"))).collect()
    assert [tuple(row) for row in got] == [("Weekday", "Non-Rush"), ("Weekend", "Rush Hour"), (None, None)]
    ends = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "s string, e string")
    assert [row[0] for row in ends.select(fn.route_region(F.col("s"), F.col("e"))).collect()] == ["a -> b", None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_durations_ignore_the_session_zone(spark, zone):
    cases = [
        ("2024-03-10 01:30:00", "2024-03-10 02:30:00", 3600),
        ("2024-03-10 02:30:00", "2024-03-10 03:30:00", 3600),
        ("2024-11-03 00:30:00", "2024-11-03 02:30:00", 7200),
        ("2024-01-01 10:00:00.900000", "2024-01-01 10:00:01.100000", 1),
        ("1969-12-31 23:59:58.500000", "1970-01-01 00:00:01", 3),
        ("9999-12-30 00:00:00", "9999-12-31 00:00:01", 86401),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = spark.createDataFrame([case[:2] for case in cases], "s string, e string")
        ends = [F.col(name).cast("timestamp_ntz") for name in ("s", "e")]
        got = texts.select(
            fn.duration_seconds(*ends).alias("d"), fn.date_key(ends[0]).alias("k"), F.hour(ends[0]).alias("h"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [row.d for row in got] == [case[2] for case in cases]
    assert [row.k for row in got] == [int(case[0][:10].replace("-", "")) for case in cases]
    assert [row.h for row in got] == [int(case[0][11:13]) for case in cases]


def test_bands_by_case_and_by_range_agree_everywhere(spark):
    rows = spark.createDataFrame([(s,) for s in (None, -5, 0, 299, 300, 3600, 999999998, 999999999, 10**12)], "s long")
    seconds = F.col("s")
    joined = rows.join(gold.dim_duration_bucket(spark), fn.in_band(seconds, F.col("min_seconds"), F.col("max_seconds")), "left")
    found = joined.select("s", "duration_bucket_key", fn.band_key(seconds).alias("k")).collect()
    assert len(found) == 9 and all(r.k == r.duration_bucket_key for r in found)
    assert {r.s: r.k for r in found}[-5] == 1 and {r.s: r.k for r in found}[10**12] == 5
