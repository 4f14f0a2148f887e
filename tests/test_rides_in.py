import os

import pytest
from conftest import as_set, at, ride
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ridemart import fixtures
from ridemart.operators.clean import clean_rides, is_valid, reject_reason, split_valid_rejects
from ridemart.schemas import FILE_MANIFEST, RAW
from ridemart.sources.rides import (
    new_files_only, parse_ride_lines, read_lines_stream, read_ride_files, to_csv_lines,
)
from ridemart.sources.tables import append_ledger, read_ledger

GOOD = "t1,40.7,-74.0,40.75,-73.95,2024-01-05 10:00:00,2024-01-05 10:10:00,2.5"


def parse(spark, *lines):
    return parse_ride_lines(spark.createDataFrame([(line.encode(),) for line in lines], "value binary"))


def test_good_line(spark):
    row = parse(spark, GOOD).first()
    assert tuple(row) == ("t1", 40.7, -74.0, 40.75, -73.95, at("2024-01-05 10:00:00"), at("2024-01-05 10:10:00"), 2.5)


def test_bad_lines_never_raise(spark):
    header = ",".join(RAW.names)
    rows = parse(
        spark, "t2,40.7,-74.0", GOOD + ",extra", "", "   ", header, GOOD.replace("40.7,", "zz,"),
        GOOD.replace("2024-01-05 10:00:00", "yesterday"), GOOD.replace("t1", ""), GOOD.replace("40.7,", " 40.7 ,"),
        GOOD + "\r",
    ).collect()
    assert len(rows) == 8  # blank lines are gone
    short, extra, head, bad_lat, bad_time, no_id, spaces, windows = rows
    assert short.start_lon == -74.0 and short.end_lat is None and short.distance is None
    assert extra.distance == 2.5
    assert head.start_lat is None and head.start_time is None
    assert bad_lat.start_lat is None and bad_lat.end_lat == 40.75
    assert bad_time.start_time is None and bad_time.end_time is not None
    assert no_id.trip_id is None
    assert spaces.start_lat == 40.7 and windows.distance == 2.5


def test_lines_round_trip(spark, sf):
    rides = fixtures.rides_events(spark, sf)
    back = parse_ride_lines(to_csv_lines(rides))
    assert back.exceptAll(rides).isEmpty() and rides.exceptAll(back).isEmpty()


def test_validity_and_reasons(rides):
    rows = [
        (ride("ok"), None),
        (ride(None), "no trip id"),
        (ride("a", end="2024-01-05 10:00:00"), "end not after start"),
        (ride("b", end="2024-01-05 09:59:59"), "end not after start"),
        (ride("c", start=None), "no time"),
        (ride("d", end=None), "no time"),
        *[(ride(f"e-{name}", **{name: None}), "no coordinate") for name in RAW.names[1:5]],
        (ride("f", distance=None), None),
    ]
    frame = rides(*[row for row, _ in rows])
    got = frame.select(reject_reason().alias("reason"), F.coalesce(is_valid(), F.lit(False)).alias("ok")).collect()
    assert [row.reason for row in got] == [reason for _, reason in rows]
    assert all(row.ok == (row.reason is None) for row in got)
    valid, rejects = split_valid_rejects(frame)
    assert (valid.count(), rejects.count()) == (2, len(rows) - 2)


def test_clean_keeps_rides_without_a_cell(rides):
    row = clean_rides(rides(ride("far", start_lat=120.0))).first()
    assert row.start_geo_hash is None and row.end_geo_hash is not None and row.trip_duration_sec == 600


def test_rides_shorter_than_a_second_count(rides):
    row = clean_rides(rides(ride("a", "2024-01-05 10:00:00.200000", "2024-01-05 10:00:00.900000"))).first()
    assert row.trip_duration_sec == 0


def test_not_a_number_is_not_missing(spark):
    row = clean_rides(parse(spark, GOOD.replace("40.7,", "NaN,"))).first()
    assert row.trip_id == "t1" and row.start_geo_hash is None


def test_new_files(spark, rides, folder):
    files, manifest = f"{folder}/in", f"{folder}/manifest"
    rides(ride("a")).write.option("header", True).csv(files)
    arrived = len([name for name in os.listdir(files) if name.endswith(".csv")])
    append_ledger(new_files_only(spark, files, manifest), manifest)
    assert new_files_only(spark, files, manifest).isEmpty()
    rides(ride("b")).write.mode("append").option("header", True).csv(files)
    paths = [row.path for row in new_files_only(spark, files, manifest).collect()]
    assert as_set(read_ride_files(spark, *paths), "trip_id") == {("b",)}
    assert read_ledger(spark, manifest, FILE_MANIFEST).count() == arrived


def test_headed_files_are_read_by_name(spark, rides, folder):
    row = ride("a", distance=None)
    shuffled = rides(row).select(*reversed(RAW.names), F.lit("x").alias("extra"))
    shuffled.write.option("header", True).csv(f"{folder}/other")
    back = read_ride_files(spark, f"{folder}/other")
    assert back.schema.names == RAW.names and back.collect() == rides(row).collect()


def test_headed_files_without_a_needed_column(spark, rides, folder):
    rides(ride("a")).drop("end_lat").write.option("header", True).csv(f"{folder}/short")
    with pytest.raises(ValueError, match="end_lat"):
        read_ride_files(spark, f"{folder}/short")


def test_headed_files_that_differ_are_not_mixed(spark, rides, folder):
    rides(ride("a")).coalesce(1).write.option("header", True).csv(f"{folder}/a")
    rides(ride("b")).select(*reversed(RAW.names)).coalesce(1).write.option("header", True).csv(f"{folder}/b")
    with pytest.raises(Exception, match="header"):
        read_ride_files(spark, f"{folder}/a", f"{folder}/b").collect()


def test_no_files_are_no_rides(spark):
    assert read_ride_files(spark).schema.names == RAW.names and read_ride_files(spark).isEmpty()


def test_absent_ledger_is_empty(spark, folder):
    ledger = read_ledger(spark, f"{folder}/none", FILE_MANIFEST)
    assert ledger.schema.names == ["path"] and ledger.isEmpty()


def test_kafka_source_takes_its_options(spark):
    """The connector is not on the class path here, so only its absence shows up."""
    options = {"kafka.bootstrap.servers": "broker:9092", "subscribe": "rides", "startingOffsets": "latest"}
    with pytest.raises(PySparkException, match="kafka"):
        read_lines_stream(spark, "kafka", **options)
