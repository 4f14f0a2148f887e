import os

import pytest
from conftest import as_set, plan_of, ride
from pyspark.sql import functions as F

from ridemart import fixtures, queries
from ridemart.operators.clean import clean_first_rides
from ridemart.operators.incremental import ROCKSDB, STATE_STORE
from ridemart.queries import _arrivals, _run_csv_feed, _write_ride_files, registered
from ridemart.schemas import FEED, METRICS, RAW, SILVER
from ridemart.sources.rides import parse_ride_lines, read_lines_stream, split_ride_lines, stream_ride_files, to_csv_lines
from ridemart.sources.tables import read_table
from ridemart.streaming.feeds import Feed, land_rides, merge_new, start_feed


def run(stream, feed, checkpoint, **options):
    start_feed(stream, feed, checkpoint, availableNow=True, **options).awaitTermination()


def test_stream_equals_batch(spark, sf, folder):
    rides = fixtures.rides_events(spark, sf)
    feed = Feed("s", f"{folder}/silver")
    _run_csv_feed(spark, rides, ("2024-01-10", "2024-01-20"), feed, folder)
    streamed = read_table(spark, feed.target, FEED).select(*SILVER.names)
    batch = clean_first_rides(rides)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_files_per_trigger(spark, rides, folder):
    for name in "abcde":
        rides(ride(name), ride("same")).coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/csv")
    for limit, batches in ((2, 3), (5, 1), (None, 1)):
        feed = Feed(f"s{limit}", f"{folder}/silver{limit}", metrics=f"{folder}/metrics{limit}")
        run(stream_ride_files(spark, f"{folder}/csv", limit), feed, f"{folder}/checkpoint{limit}")
        assert as_set(read_table(spark, feed.target, FEED), "trip_id") == {(n,) for n in [*"abcde", "same"]}
        assert read_table(spark, feed.target, FEED).count() == 6
        metrics = read_table(spark, feed.metrics, METRICS)
        assert metrics.count() == batches
        assert metrics.agg(F.sum("rows_in"), F.sum("duplicates"), F.sum("written")).first() == (10, 4, 6)


def test_restart_takes_only_new_files(spark, rides, folder):
    feed = Feed("s", f"{folder}/silver", metrics=f"{folder}/metrics")
    for batch in ([ride("a"), ride("b")], [ride("b"), ride("c")], []):
        if batch:
            _write_ride_files(rides(*batch), f"{folder}/csv")
        run(stream_ride_files(spark, f"{folder}/csv"), feed, f"{folder}/checkpoint")
    rows = read_table(spark, feed.target, FEED)
    assert as_set(rows, "trip_id", "batch_id") == {("a", 0), ("b", 0), ("c", 1)} and rows.count() == 3
    assert read_table(spark, feed.metrics, METRICS).agg(F.sum("rows_in")).first()[0] == 4


def test_a_lost_checkpoint_needs_a_new_source(spark, rides, folder):
    _write_ride_files(rides(ride("a"), ride("b")), f"{folder}/csv")
    for number in (1, 2):
        feed = Feed(f"run-{number}", f"{folder}/silver")
        run(stream_ride_files(spark, f"{folder}/csv"), feed, f"{folder}/checkpoint-{number}")
    rows = read_table(spark, f"{folder}/silver", FEED)
    assert as_set(rows, "trip_id", "source") == {("a", "run-1"), ("b", "run-1")} and rows.count() == 2


def test_state_survives_a_restart(spark, rides, folder):
    feed = Feed("s", f"{folder}/silver", dedup="state")
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        for batch in ([ride("a"), ride("a"), ride("x", end_lat=None)], [ride("a"), ride("b")]):
            _write_ride_files(rides(*batch), f"{folder}/csv")
            run(stream_ride_files(spark, f"{folder}/csv"), feed, f"{folder}/checkpoint", persist=False)
    finally:
        spark.conf.unset(STATE_STORE)
    rows = read_table(spark, feed.target, FEED)
    assert as_set(rows, "trip_id") == {("a",), ("b",)} and rows.count() == 2


def test_state_in_memory_is_refused(spark, folder):
    feed = Feed("s", f"{folder}/silver", dedup="state")
    with pytest.raises(ValueError, match="RocksDB"):
        start_feed(stream_ride_files(spark, folder), feed, f"{folder}/checkpoint")


def test_messages_land_as_headed_files(spark, rides, folder):
    for batch in ([ride("a"), ride("b", end_lat=None)], [ride("c")]):
        to_csv_lines(rides(*batch)).write.mode("append").text(f"{folder}/lines")
        lines = parse_ride_lines(read_lines_stream(spark, "text", path=f"{folder}/lines"))
        land_rides(lines, f"{folder}/bronze", f"{folder}/checkpoint", bounded=True).awaitTermination()
    landed = spark.read.schema(RAW).option("header", True).csv(f"{folder}/bronze")
    expected = rides(ride("a"), ride("b", end_lat=None), ride("c"))
    assert landed.exceptAll(expected).isEmpty() and expected.exceptAll(landed).isEmpty()


def test_arrivals_cover_every_ride(spark, sf):
    rides = fixtures.rides_events(spark, sf)
    assert sum(part.count() for part in _arrivals(rides, ("2024-01-10", "2024-01-20"))) == rides.count()


def test_registered_feeds_agree(spark, sf):
    both = registered()["stream_silver"](spark, sf)
    loop = registered()["stream_replay_silver"](spark, sf)
    assert both.exceptAll(loop).isEmpty() and loop.exceptAll(both).isEmpty()


def test_replay_that_writes_nothing_empties_its_partition(spark, folder):
    rides = spark.sql("""
        SELECT 'x' AS trip_id, 41.0D AS start_lat, -87.0D AS start_lon, 41.5D AS end_lat, -87.5D AS end_lon,
            TIMESTAMP_NTZ '2024-05-01 08:00:00' AS start_time, TIMESTAMP_NTZ '2024-05-01 09:00:00' AS end_time, 1.0D AS distance
    """).select(*RAW.names)
    own = Feed("a", f"{folder}/a", metrics=f"{folder}/m", other_targets=(f"{folder}/b",))
    merge_new(rides, 0, own)
    # Another feed took the id meanwhile, as happens when two queries run at once.
    merge_new(rides, 0, Feed("b", f"{folder}/b"))
    merge_new(rides, 0, own)
    assert read_table(spark, f"{folder}/a", FEED).count() == 0
    metrics = read_table(spark, f"{folder}/m", METRICS).first()
    assert (metrics.written, metrics.duplicates) == (0, 1)


def test_landing_keeps_the_text(spark, folder):
    size = len(RAW.names)
    whole = ",".join(f"f{k}" for k in range(size))
    lines = spark.createDataFrame([(whole,), (whole + ",more,still",), ("id,abc",), (" ",), (None,)], "value string")
    rows = {tuple(row) for row in split_ride_lines(lines).collect()}
    fields = tuple(f"f{k}" for k in range(size))
    assert rows == {(*fields, None), (*fields, "more,still"), ("id", "abc", *[None] * (size - 1))}


def test_one_file_is_read_and_picked_by_many_tasks(spark, rides, folder, monkeypatch):
    """Ten files were written by a task each that read the whole table."""
    plans, write = [], queries._write_ride_files

    def seen(rows, path):
        plans.append(plan_of(rows))
        write(rows, path)

    monkeypatch.setattr(queries, "_write_ride_files", seen)
    rows = rides(*[ride(f"r{k}") for k in range(20)]).repartition(4).filter("trip_id != 'r3'")
    queries._write_one_file(rows, folder)
    assert "Coalesce" not in plans[0] and "SinglePartition" in plans[0]
    assert len([name for name in os.listdir(folder) if name.endswith(".csv")]) == 1
    assert spark.read.option("header", True).csv(folder).count() == 19
