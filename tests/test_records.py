"""Rejects with their record, metrics of a feed with its own state, CSV by header, stars that know their grid."""

import pytest
from conftest import as_set, ride
from pyspark.sql import functions as F

from ridemart.operators.incremental import ROCKSDB, STATE_STORE
from ridemart.operators.star import GRID_NOTE, load_star
from ridemart.plans import report
from ridemart.plans.mart import MartPaths, refresh_mart
from ridemart.queries import _describe_other_cells, _other_cell
from ridemart.schemas import FEED, METRICS, RAW, REJECTS, SILVER
from ridemart.sources.commits import read_text
from ridemart.sources.rides import parse_ride_lines, place_of, read_lines_stream, stream_ride_files, to_csv_lines
from ridemart.sources.tables import csv_headers, read_headed_csv, read_table
from ridemart.streaming.feeds import Feed, await_feed, merge_new, start_feed

GOOD = "t1,40.7,-74.0,40.75,-73.95,2024-01-05 10:00:00,2024-01-05 10:10:00,2.5"


def test_rejected_messages_keep_their_text(spark, folder):
    lines = [GOOD, "t2,40.7", GOOD.replace("40.7,", "zz,", 1), GOOD.replace("t1", ""), GOOD.replace("t1", "t3") + ",x,y", "  "]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{folder}/lines")
    feed = Feed("s", f"{folder}/silver", rejects=f"{folder}/rejects")
    rides = parse_ride_lines(read_lines_stream(spark, "text", path=f"{folder}/lines"), keep_record=True)
    start_feed(rides, feed, f"{folder}/checkpoint", availableNow=True).awaitTermination()
    rejects = read_table(spark, feed.rejects, REJECTS)
    assert as_set(rejects, "line", "reject_reason") == {
        (lines[1], "no time"), (lines[2], "no coordinate"), (lines[3], "no trip id"),
    }
    assert rejects.filter(F.col("place").contains("/lines/part-")).count() == 3
    assert as_set(read_table(spark, feed.target, FEED), "trip_id") == {("t1",), ("t3",)}


def test_places_of_messages(spark):
    kafka = spark.sql("SELECT 'rides' AS topic, 3 AS partition, 70L AS offset, CAST('x' AS binary) AS value")
    assert kafka.select(place_of(kafka)).first()[0] == "rides-3@70"
    other = spark.sql("SELECT 'x' AS value")
    assert other.select(place_of(other)).first()[0] is None
    parsed = parse_ride_lines(kafka, keep_record=True).first()
    assert (parsed.line, parsed.place, parsed.trip_id) == ("x", "rides-3@70", "x")


def test_rejected_csv_rows_keep_their_text(spark, folder):
    header, bad = ",".join(RAW.names), GOOD.replace("40.7,", '"4,0",', 1).replace("t1", "t4")
    reversed_ = "t5,40.7,-74.0,40.75,-73.95,2024-01-05 10:00:00,2024-01-05 09:10:00,2.5"
    text = "\n".join([header, GOOD, bad, "t2,40.7", reversed_])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/csv")
    feed = Feed("s", f"{folder}/silver", rejects=f"{folder}/rejects")
    start_feed(stream_ride_files(spark, f"{folder}/csv", keep_record=True), feed, f"{folder}/checkpoint", availableNow=True).awaitTermination()
    got = {row.trip_id: row for row in read_table(spark, feed.rejects, REJECTS).collect()}
    assert set(got) == {"t2", "t4", "t5"} and got["t4"].line == bad and got["t2"].line == "t2,40.7"
    assert got["t5"].line.startswith("t5,40.7,-74.0,40.75,-73.95,2024-01-05 10:00:00") and got["t5"].reject_reason == "end not after start"
    assert all(row.place.endswith((".txt", ".csv")) for row in got.values())


def test_rejects_without_a_record(spark, rides, folder):
    feed = Feed("s", f"{folder}/silver", rejects=f"{folder}/rejects")
    merge_new(rides(ride("a"), ride("b", end_lat=None)), 0, feed)
    row = read_table(spark, feed.rejects, REJECTS).first()
    assert (row.trip_id, row.line, row.place, row.reject_reason) == ("b", None, None, "no coordinate")


def test_state_with_an_audit(spark, rides, folder):
    feed = Feed("s", f"{folder}/silver", rejects=f"{folder}/rejects", metrics=f"{folder}/metrics", dedup="audited-state")
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        batches = [[ride("a"), ride("a"), ride("x", end_lat=None)], [ride("a"), ride("b"), ride("x", end_lat=None)], [ride("a"), ride("b")]]
        for batch in batches:
            to_csv_lines(rides(*batch)).write.mode("append").text(f"{folder}/lines")
            lines = parse_ride_lines(read_lines_stream(spark, "text", path=f"{folder}/lines"))
            await_feed(start_feed(lines, feed, f"{folder}/checkpoint", availableNow=True))
    finally:
        spark.conf.unset(STATE_STORE)
    metrics = read_table(spark, feed.metrics, METRICS)
    assert as_set(metrics, "batch_id", "rows_in", "rejected", "duplicates", "written") == {(0, 3, 1, 1, 1), (1, 3, 1, 1, 1), (2, 2, 0, 2, 0)}
    assert as_set(read_table(spark, feed.target, FEED), "trip_id", "batch_id") == {("a", 0), ("b", 1)}
    assert as_set(read_table(spark, feed.rejects, REJECTS), "trip_id", "batch_id") == {("x", 0), ("x", 1)}
    with pytest.raises(ValueError, match="audited-state"):
        Feed("s", f"{folder}/silver", metrics=f"{folder}/metrics", dedup="state")


def write_csv(spark, folder, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(folder)


def test_csv_files_by_their_own_headers(spark, folder):
    path = f"{folder}/t"
    write_csv(spark, path, "trip_id,start_time,start_geo_hash,end_geo_hash,trip_duration_sec\na,2024-01-05 10:00:00,s1,e1,5")
    write_csv(spark, path, 'END_geo_hash,"note, x",trip_id, start_geo_hash,trip_duration_sec,start_time\ne2,"n,m",b,s2,long,2024-01-05 11:00:00')
    write_csv(spark, path, "trip_id,start_time,start_geo_hash,end_geo_hash,trip_duration_sec")
    rows = read_table(spark, path, SILVER, fmt="csv")
    assert rows.schema == SILVER
    assert as_set(rows, "trip_id", "start_geo_hash", "end_geo_hash", "trip_duration_sec") == {("a", "s1", "e1", 5), ("b", "s2", "e2", None)}
    assert [len(files) for _, files in sorted(csv_headers(spark, path).items())] == [1, 2]
    write_csv(spark, path, "trip_id,start_time\nx,2024-01-05 10:00:00")
    with pytest.raises(ValueError, match="no column start_geo_hash, end_geo_hash, trip_duration_sec"):
        read_headed_csv(spark, path, SILVER)


def test_a_star_knows_its_grid(spark, rides, folder):
    own, other = MartPaths(f"{folder}/own"), MartPaths(f"{folder}/other")
    rows = rides(ride("a"), ride("b", end_lat=40.7001, end_lon=-73.9999), ride("c"))
    for paths, options, cells in ((own, {}, {}), (other, {"cell_fn": _other_cell}, {"describe_cells": _describe_other_cells})):
        merge_new(rows, 0, paths.feed("e", **options))
        refresh_mart(spark, paths, **cells)
    assert read_text(spark, f"{own.gold}/{GRID_NOTE}") is None and load_star(spark, own.gold).region is not None
    star = load_star(spark, other.gold)
    assert star.region is None
    assert as_set(report.top_routes(star), "route_region", "total_trips") == {("407x-740 -> 407x-740", 3)} or \
        as_set(report.top_routes(star)) == as_set(report.top_routes(star, region=None))
    assert report.pct_same_region_res6(star).first() == report.pct_same_region_res6(star, region=None).first()
    assert all("x" in row.route_region for row in report.top_routes(star).collect())
