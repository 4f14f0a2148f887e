import pytest
from conftest import as_set, plan_of, ride
from pyspark.sql import functions as F

from ridemart.operators import incremental
from ridemart.operators.clean import clean_first_rides, clean_rides
from ridemart.schemas import FEED, METRICS, REJECTS, SILVER
from ridemart.sources.tables import path_exists, read_table
from ridemart.streaming.feeds import Feed, merge_new


@pytest.fixture(params=["small", "large"])
def batch_size(request, monkeypatch):
    """Both ways of looking up known keys: the batch's keys sent to the history, and a staged join."""
    if request.param == "large":
        monkeypatch.setattr(incremental, "BROADCAST_KEY_BYTES", -1)
    return request.param


def feed(folder, source="run-1", **options):
    return Feed(source, f"{folder}/silver", rejects=f"{folder}/rejects", metrics=f"{folder}/metrics", **options)


def ids(spark, folder, table="silver"):
    rows = read_table(spark, f"{folder}/{table}", FEED).select("trip_id").collect()
    return sorted(row.trip_id for row in rows)


def test_first_ride_wins(rides):
    rows = rides(
        ride("a", "2024-01-05 12:00:00", "2024-01-05 12:05:00"),
        ride("a", "2024-01-05 10:00:00", "2024-01-05 10:30:00"),
        ride("a", "2024-01-05 10:00:00", "2024-01-05 10:10:00", distance=9.0),
        ride("b"),
    )
    got = incremental.dedup_first(rows, ["trip_id"], ["start_time", "end_time"])
    assert got.columns == rows.columns
    assert as_set(got, "trip_id", "distance") == {("a", 9.0), ("b", 2.5)}


def test_cleaning_first_rides(rides):
    rows = rides(
        ride("a", "2024-01-05 10:00:00", "2024-01-05 10:00:30.800000", end_lat=40.8),
        ride("a", "2024-01-05 10:00:00", "2024-01-05 10:00:30.300000"),
        ride("a", "2024-01-05 09:00:00", "2024-01-05 09:00:00"),
        ride("b", start_lat=None), ride("b", distance=None), ride(None),
    )
    first = clean_first_rides(rows)
    assert first.columns == SILVER.names and first.count() == 2
    assert as_set(first.join(clean_rides(rides(ride("a"))), "end_geo_hash", "left_semi"), "trip_id") == {("a",), ("b",)}
    assert as_set(first, "trip_id", "trip_duration_sec") == {("a", 30), ("b", 600)}


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id",
    )
    got = incremental.dedup_first(rows, ["k"], ["id"])
    assert got.count() == 20_001 and got.filter("k = 'hot'").first().id == 0
    plan = plan_of(got)
    assert plan.index("SortAggregate") < plan.index("Exchange") < plan.index("partial_min")


@pytest.mark.parametrize("broadcast", [True, False])
def test_seen_keys(spark, broadcast):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    stored = spark.createDataFrame([("b",), ("b",), ("x",), (None,)], "k string")
    assert as_set(incremental.seen_keys(stored, wanted, "k", broadcast)) == {("b",)}


@pytest.mark.parametrize("limits", [(10**9, 10**9), (-1, 10**9), (-1, -1)])
def test_write_new_by_every_way(spark, monkeypatch, limits):
    monkeypatch.setattr(incremental, "BROADCAST_KEY_BYTES", limits[0])
    monkeypatch.setattr(incremental, "BLOOM_FILTER_KEYS", limits[1])
    raw = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    stored = spark.createDataFrame([("b",), ("x",), (None,)], "k string")
    written = []
    write = lambda rows: written.append(as_set(rows)) or len(written[0])
    assert incremental.write_new(raw.distinct(), stored, "k", write, raw=raw) == 2
    assert written == [{("a",), ("c",)}]


def test_small_batches_leave_the_history_unshuffled(spark, sf):
    history = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("k"))
    rows = spark.range(50).select(F.col("id").cast("string").alias("k"))
    plan = plan_of(incremental.seen_keys(history, rows, "k", broadcast=True))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan


def test_large_batches_filter_the_history_as_it_is_read(spark, folder):
    """Thresholds are set to zero, as the filter is meant for histories of many gigabytes."""
    spark.range(1000).select(F.col("id").cast("string").alias("k")).write.parquet(f"{folder}/history")
    history = spark.read.parquet(f"{folder}/history")
    rows = spark.range(50).select(F.col("id").cast("string").alias("k"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        with incremental.staged(rows) as unique, incremental.bloom_filter(spark, 50):
            seen = incremental.seen_keys(history, unique, "k", broadcast=False)
            assert "might_contain" in plan_of(seen) and "50, 500" in plan_of(seen)
            assert seen.count() == 50
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold") == "10485760b"


def test_key_size_is_measured(spark, monkeypatch):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"))
    size = incremental.measure_keys(rows, "k")
    assert size.rows == 100 and size.bytes == 190 + 6400 and size.fits_broadcast
    monkeypatch.setattr(incremental, "BROADCAST_KEY_BYTES", 1000)
    assert not size.fits_broadcast
    assert incremental.measure_keys(rows.limit(0), "k") == incremental.KeySize(0, 0)


def test_staged_rows_go_away(spark):
    with incremental.staged(spark.range(10)) as rows:
        path = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert rows.count() == 10 and path_exists(spark, path)
    assert not path_exists(spark, path)


def test_distinct_keys_of_two_columns(spark):
    rows = spark.createDataFrame([("a", "b"), ("b", None), ("c", "a")], "s string, e string")
    assert as_set(incremental.distinct_keys(rows, "s", "e", name="k")) == {("a",), ("b",), ("c",)}


def test_duplicates_in_and_across_batches(spark, rides, folder, batch_size):
    merge_new(rides(ride("a"), ride("a"), ride("b"), ride(None), ride("bad", start_lat=None)), 0, feed(folder))
    merge_new(rides(ride("b"), ride("c")), 1, feed(folder))
    assert ids(spark, folder) == ["a", "b", "c"]
    rejects = read_table(spark, f"{folder}/rejects", REJECTS)
    assert as_set(rejects, "trip_id", "reject_reason", "batch_id") == {
        (None, "no trip id", 0), ("bad", "no coordinate", 0),
    }
    metrics = read_table(spark, f"{folder}/metrics", METRICS)
    assert as_set(metrics, "batch_id", "rows_in", "rejected", "duplicates", "written") == {(0, 5, 2, 1, 2), (1, 2, 0, 1, 1)}


def test_replayed_batch_changes_nothing(spark, rides, folder, batch_size):
    merge_new(rides(ride("a"), ride("b")), 0, feed(folder))
    merge_new(rides(ride("c")), 1, feed(folder))
    for _ in range(2):
        merge_new(rides(ride("c")), 1, feed(folder))
        merge_new(rides(ride("a"), ride("b")), 0, feed(folder))
    assert ids(spark, folder) == ["a", "b", "c"]


def test_feeds_see_each_other(spark, rides, folder, batch_size):
    batch = Feed("batch", f"{folder}/batch", other_targets=(f"{folder}/stream",))
    stream = Feed("stream", f"{folder}/stream", other_targets=(f"{folder}/batch",))
    merge_new(rides(ride("a"), ride("b")), 0, batch)
    merge_new(rides(ride("b"), ride("c")), 0, stream)
    merge_new(rides(ride("c"), ride("d")), 1, batch, persist=False)
    assert ids(spark, folder, "batch") == ["a", "b", "d"]
    assert ids(spark, folder, "stream") == ["c"]


def test_a_new_run_needs_its_own_source(spark, rides, folder):
    merge_new(rides(ride("a")), 0, feed(folder, "run-1"))
    merge_new(rides(ride("a"), ride("b")), 0, feed(folder, "run-2"))
    assert ids(spark, folder) == ["a", "b"]


def test_empty_batch_writes_nothing(spark, rides, folder):
    merge_new(rides(), 0, feed(folder))
    assert read_table(spark, f"{folder}/silver", SILVER) is None


def test_feed_options_are_checked(folder):
    with pytest.raises(ValueError):
        Feed("a", folder, dedup="never")
    with pytest.raises(ValueError):
        Feed("a/b", folder)
    with pytest.raises(ValueError):
        feed(folder, dedup="state")
