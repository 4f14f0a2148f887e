import re
from datetime import date

import pytest
from conftest import as_set, ride
from pyspark.sql import functions as F

from ridemart import fixtures
from ridemart.operators.star import load_star
from ridemart.plans import gold as gold_plan, mart, report, silver as silver_plan
from ridemart.plans.gold import build_gold
from ridemart.plans.mart import MartPaths, refresh_mart, run_mart
from ridemart.plans.silver import union_silver
from ridemart.schemas import DIM_DATE, DIM_GEOGRAPHY, FACT, FACT_STORED, FEED, FEED_PROGRESS, UNIFIED
from ridemart.sources.tables import (
    TableBusy, batch_folders, constant_rows, merged_batches, partition_folders, read_partitions, read_table,
    seed_table,
)
from ridemart.streaming.feeds import merge_new, stored_trip_ids

FACTS = [name for name in FACT.names]


def unified_ids(spark, paths):
    rows = read_table(spark, paths.unified, UNIFIED).select("trip_id").collect()
    return sorted(row.trip_id for row in rows)


def union(spark, paths):
    return union_silver(spark, [paths.batch_output, paths.stream_output], paths.unified, paths.unified_progress)


def fact(spark, paths):
    return read_table(spark, f"{paths.gold}/fact_trip", FACT_STORED)


class Crash(Exception):
    pass


def crash(*_):
    raise Crash


def test_no_feed_is_no_work(spark, folder):
    assert union(spark, MartPaths(folder)) is None
    assert refresh_mart(spark, MartPaths(folder)) == {"unified": None, "fact": 0}


def test_union_runs(spark, rides, folder):
    paths = MartPaths(folder)
    batch, stream = paths.feed("b"), paths.feed("s", stream=True)
    merge_new(rides(ride("a"), ride("b")), 0, batch)
    assert union(spark, paths) == 2  # the stream's feed does not exist yet
    assert union(spark, paths) == 0
    merge_new(rides(ride("c")), 0, stream)
    merge_new(rides(ride("d")), 1, batch)
    assert union(spark, paths) == 2
    assert unified_ids(spark, paths) == ["a", "b", "c", "d"]
    assert set(partition_folders(spark, paths.unified, ["run_id"])) == {("1",), ("2",)}


def test_a_union_inside_a_union(spark, rides, folder, monkeypatch):
    """A second run between the first one's plan and its write, with more batches: no ride is lost or doubled."""
    paths = MartPaths(folder)
    feed = paths.feed("b")
    merge_new(rides(ride("a"), ride("b")), 0, feed)
    write = silver_plan.write_new

    def meanwhile(*args, **options):
        merge_new(rides(ride("b"), ride("c"), ride("d")), 1, feed)
        with pytest.raises(TableBusy):
            union(spark, paths)
        return write(*args, **options)

    monkeypatch.setattr(silver_plan, "write_new", meanwhile)
    assert union(spark, paths) == 2
    monkeypatch.undo()
    assert union(spark, paths) == 2
    assert unified_ids(spark, paths) == ["a", "b", "c", "d"]
    build_gold(spark, paths.unified, paths.gold)
    assert as_set(fact(spark, paths), "trip_id") == {("a",), ("b",), ("c",), ("d",)}


def test_batches_may_come_out_of_order(spark, rides, folder):
    paths = MartPaths(folder)
    merge_new(rides(ride("a")), 5, paths.feed("b"))
    assert union(spark, paths) == 1
    merge_new(rides(ride("b")), 3, paths.feed("b"))
    merge_new(rides(ride("c")), 10, paths.feed("b"))
    assert union(spark, paths) == 2
    assert unified_ids(spark, paths) == ["a", "b", "c"]
    assert refresh_mart(spark, paths) == {"unified": 0, "fact": 3}


def test_union_settles_ids_both_feeds_took(spark, rides, folder):
    """Two queries running at once may both accept an id; the union keeps one row."""
    paths = MartPaths(folder)
    late = ride("a", "2024-01-05 12:00:00", "2024-01-05 12:10:00")
    merge_new(rides(late, ride("b")), 0, mart.Feed("b", paths.batch_output))
    merge_new(rides(ride("a")), 0, mart.Feed("s", paths.stream_output))
    union(spark, paths)
    assert unified_ids(spark, paths) == ["a", "b"]
    assert read_table(spark, paths.unified, UNIFIED).filter("trip_id = 'a'").first().source == "s"
    merge_new(rides(ride("a"), ride("e")), 1, mart.Feed("s", paths.stream_output + "2"))
    union_silver(spark, [paths.stream_output + "2"], paths.unified, paths.unified_progress)
    assert unified_ids(spark, paths) == ["a", "b", "e"]


def test_bulk_feeds_leave_duplicates_to_the_union(spark, rides, folder):
    paths = MartPaths(folder)
    feed = paths.feed("bulk", audit=False, dedup="union")
    merge_new(rides(ride("a"), ride("a"), ride("b"), ride(None)), 0, feed, persist=False)
    merge_new(rides(ride("b")), 1, feed, persist=False)
    assert read_table(spark, feed.target, FEED).count() == 4
    assert union(spark, paths) == 2
    assert unified_ids(spark, paths) == ["a", "b"]


@pytest.mark.parametrize("limit", [None, -1])
def test_union_crash_before_its_ledger(spark, rides, folder, monkeypatch, limit):
    from ridemart.operators import incremental
    if limit is not None:
        monkeypatch.setattr(incremental, "BROADCAST_KEY_BYTES", limit)
    paths = MartPaths(folder)
    merge_new(rides(ride("a"), ride("b")), 0, paths.feed("b"))
    with monkeypatch.context() as patch:
        patch.setattr(silver_plan, "append_ledger", crash)
        with pytest.raises(Crash):
            union(spark, paths)
    merge_new(rides(ride("c")), 1, paths.feed("b"))
    assert union(spark, paths) == 1
    assert unified_ids(spark, paths) == ["a", "b", "c"]


def test_only_new_batches_are_opened(spark, rides, folder):
    paths = MartPaths(folder)
    merge_new(rides(ride("a")), 0, paths.feed("b"))
    union(spark, paths)
    merge_new(rides(ride("b")), 1, paths.feed("b"))
    folders = batch_folders(spark, paths.batch_output, skip=merged_batches(spark, paths.unified_progress))
    assert set(folders) == {("b", 1)}
    pending = read_partitions(spark, paths.batch_output, FEED, folders.values())
    assert as_set(pending, "trip_id", "source", "batch_id") == {("b", "b", 1)}
    assert all("batch_id=1/" in name for name in pending.inputFiles())


def test_merged_batches_are_looked_up_in_the_unified_table(spark, rides, folder):
    paths = MartPaths(folder)
    batch, stream = paths.feed("b"), paths.feed("s", stream=True)
    merge_new(rides(ride("a"), ride("b")), 0, batch)
    union(spark, paths)
    merge_new(rides(ride("c")), 1, batch)
    known = stored_trip_ids(spark, 0, stream)
    assert as_set(known) == {("a",), ("b",), ("c",)}
    assert {re.search(r"(run|batch)_id=\d+", name).group() for name in known.inputFiles()} == {"run_id=1", "batch_id=1"}
    merge_new(rides(ride("b"), ride("c"), ride("d")), 0, stream)
    assert as_set(read_table(spark, paths.stream_output, FEED), "trip_id") == {("d",)}
    for _ in range(2):  # replays, after the union has taken the batch
        merge_new(rides(ride("a"), ride("b")), 0, batch)
    assert read_table(spark, paths.batch_output, FEED).filter("batch_id = 0").count() == 2
    assert union(spark, paths) == 2
    assert unified_ids(spark, paths) == ["a", "b", "c", "d"]


def test_many_constant_rows(spark):
    rows = [("s", number, 1) for number in range(300)]
    assert as_set(constant_rows(spark, rows, FEED_PROGRESS)) == set(rows)
    assert as_set(constant_rows(spark, rows[:3], FEED_PROGRESS)) == set(rows[:3])
    assert constant_rows(spark, [], FEED_PROGRESS).isEmpty()


def test_a_half_written_seed_is_written_again(spark, folder):
    spark.range(0).selectExpr("CAST(id AS int) AS time_key").write.parquet(f"{folder}/dim_time")
    seed_table(gold_plan.dim_time(spark), f"{folder}/dim_time")
    assert spark.read.parquet(f"{folder}/dim_time").count() == 24
    seed_table(gold_plan.dim_time(spark).limit(1), f"{folder}/dim_time")
    assert spark.read.parquet(f"{folder}/dim_time").count() == 24


def test_star_rows(spark, rides, folder):
    paths = MartPaths(folder)
    saturday = ride("a", "2024-01-06 08:00:00", "2024-01-06 08:05:00", end_lat=40.7, end_lon=-74.0)
    merge_new(rides(saturday, ride("b", "2024-02-29 23:59:59", "2024-03-01 01:00:00")), 0, paths.feed("b"))
    assert refresh_mart(spark, paths) == {"unified": 2, "fact": 2}
    rows = {row.trip_id: row for row in fact(spark, paths).collect()}
    a, b = rows["a"], rows["b"]
    assert (a.date_key, a.time_key, a.duration_bucket_key, a.is_same_cell, a.trip_count) == (20240106, 8, 2, 1, 1)
    assert (b.date_key, b.time_key, b.duration_bucket_key, b.is_same_cell, b.month_key) == (20240229, 23, 5, 0, 202402)
    dates = read_table(spark, f"{paths.gold}/dim_date", DIM_DATE)
    assert as_set(dates, "date_key", "full_date", "day_name", "is_weekend") == {
        (20240106, date(2024, 1, 6), "Saturday", 1), (20240229, date(2024, 2, 29), "Thursday", 0),
    }


def test_repeated_refresh_changes_nothing(spark, sf, folder):
    paths = MartPaths(folder)
    merge_new(fixtures.rides_events(spark, sf), 0, paths.feed("e"))
    refresh_mart(spark, paths)
    names = ("dim_date", "dim_time", "dim_geography", "dim_duration_bucket", "fact_trip")
    count = lambda: {name: spark.read.parquet(f"{paths.gold}/{name}").count() for name in names}
    before = count()
    assert refresh_mart(spark, paths) == {"unified": 0, "fact": 0}
    assert count() == before


def test_steps_equal_one_go(spark, sf, folder):
    """A, then B, gives the same star as both at once when they arrive in order."""
    rides = fixtures.rides_events(spark, sf)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    early, late = rides.filter(F.col("start_time") < cut), rides.filter(F.col("start_time") >= cut)
    steps, at_once = MartPaths(f"{folder}/steps"), MartPaths(f"{folder}/once")
    for batch_id, part in enumerate((early, late)):
        merge_new(part, batch_id, steps.feed("e"))
        refresh_mart(spark, steps)
    merge_new(rides, 0, at_once.feed("e"))
    refresh_mart(spark, at_once)
    for name in ("dim_date", "dim_geography"):
        mine, theirs = (spark.read.parquet(f"{paths.gold}/{name}") for paths in (steps, at_once))
        assert mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()
    mine, theirs = (fact(spark, paths).select(*FACTS) for paths in (steps, at_once))
    assert mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()


def test_gold_crash_before_its_ledger(spark, sf, folder, monkeypatch):
    paths = MartPaths(folder)
    merge_new(fixtures.rides_events(spark, sf), 0, paths.feed("e"))
    union(spark, paths)
    with monkeypatch.context() as patch:
        patch.setattr(gold_plan, "extend_dimension", crash)
        with pytest.raises(Crash):
            build_gold(spark, paths.unified, paths.gold, unique=True)
    written = fact(spark, paths).count()
    assert build_gold(spark, paths.unified, paths.gold, unique=True) == written
    assert fact(spark, paths).count() == written == fact(spark, paths).select("trip_id").distinct().count()
    assert_keys_resolve(spark, paths)


def assert_keys_resolve(spark, paths):
    star = load_star(spark, paths.gold)
    cells = star.geography.select(F.col("geo_hash"))
    checks = [
        (star.date, "date_key"), (star.time, "time_key"), (star.bucket, "duration_bucket_key"),
        (cells.withColumnRenamed("geo_hash", "start_geo_key"), "start_geo_key"),
        (cells.withColumnRenamed("geo_hash", "end_geo_key"), "end_geo_key"),
    ]
    for dim, key in checks:
        assert dim.count() == dim.select(key).distinct().count()
        assert star.fact.join(dim, key, "left_anti").isEmpty(), key


@pytest.mark.parametrize("limit", [None, -1])
def test_gold_over_a_table_with_repeated_ids(spark, folder, monkeypatch, limit):
    from ridemart.operators import incremental
    if limit is not None:
        monkeypatch.setattr(incremental, "BROADCAST_KEY_BYTES", limit)
    unified, gold = f"{folder}/unified", f"{folder}/gold"

    def add(run_id, *ids):
        rows = spark.createDataFrame([(trip_id,) for trip_id in ids], "trip_id string").selectExpr(
            "trip_id", "timestamp_ntz'2024-01-05 10:00:00' AS start_time", "'000000000000000' AS start_geo_hash",
            "CAST(NULL AS string) AS end_geo_hash", "60L AS trip_duration_sec", "'x' AS source", "0L AS batch_id",
            f"{run_id}L AS run_id",
        )
        rows.write.mode("append").partitionBy("run_id").parquet(unified)

    add(1, "a", "a", "b", None)
    assert build_gold(spark, unified, gold) == 2
    add(2, "b", "c")
    assert build_gold(spark, unified, gold) == 1
    assert build_gold(spark, unified, gold) == 0
    rows = spark.read.schema(FACT_STORED).parquet(f"{gold}/fact_trip")
    assert sorted(row.trip_id for row in rows.collect()) == ["a", "b", "c"]
    assert {row.is_same_cell for row in rows.collect()} == {0}
    assert as_set(read_table(spark, f"{gold}/dim_geography", DIM_GEOGRAPHY), "geo_hash") == {("000000000000000",)}


def test_chain_with_export(spark, sf, folder):
    paths = MartPaths(folder)
    merge_new(fixtures.rides_events(spark, sf), 0, paths.feed("e"))
    counts = run_mart(spark, paths)
    assert counts["gold_dim_time"] == 24 and counts["gold_dim_duration_bucket"] == 5
    assert counts["gold_fact_trip"] == counts["silver_unified_rides"] == fact(spark, paths).count()
    back = spark.read.schema(DIM_DATE).option("header", True).csv(f"{folder}/export/gold_dim_date")
    stored = spark.read.parquet(f"{paths.gold}/dim_date")
    assert back.exceptAll(stored).isEmpty() and back.count() == stored.count()
    assert_keys_resolve(spark, paths)


def rounded_cell(lat, lon):
    return F.concat_ws("/", F.round(lat, 2), F.round(lon, 2))


def describe_rounded(cells):
    part = [F.split_part("geo_hash", F.lit("/"), F.lit(number)).cast("double") for number in (1, 2)]
    parents = [F.concat_ws("/", *[F.round(value, digits) for value in part]) for digits in (1, 0)]
    return cells.select("geo_hash", *part, *parents).toDF(*DIM_GEOGRAPHY.names)


def test_a_mart_on_another_grid(spark, sf, folder):
    paths = MartPaths(folder)
    merge_new(fixtures.rides_events(spark, sf), 0, paths.feed("e", cell_fn=rounded_cell))
    refresh_mart(spark, paths, describe_cells=describe_rounded)
    assert_keys_resolve(spark, paths)
    star = load_star(spark, paths.gold)
    places = as_set(star.geography, "geo_hash", "parent_geo_res6")
    assert all(len(place.split("/")) == 2 and region.count(".") == 2 for place, region in places)
    routes = report.top_routes(star, region=None).collect()
    assert len(routes) == 10 and all("/" in row.route_region for row in routes)
    assert report.trips_by_start_cell(star).agg(F.sum("total_trips")).first()[0] == star.fact.count()


def test_a_failing_step_stops_the_chain(spark, sf, folder, monkeypatch):
    paths = MartPaths(folder)
    merge_new(fixtures.rides_events(spark, sf), 0, paths.feed("e"))
    monkeypatch.setattr(mart, "union_silver", crash)
    with pytest.raises(Crash):
        run_mart(spark, paths)
    assert read_table(spark, f"{paths.gold}/dim_time", DIM_DATE) is None
