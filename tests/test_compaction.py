"""Many small partitions in few segments: nothing is lost or doubled, whoever reads, replays, loads or dies meanwhile."""

import pytest
from conftest import as_set, ride
from pyspark.sql import functions as F, types as T

from ridemart.operators import serve
from ridemart.operators.star import load_star
from ridemart.plans import report
from ridemart.plans.gold import build_gold
from ridemart.plans.mart import MartPaths, compact_mart, refresh_mart
from ridemart.schemas import FACT_TABLE, FEED, UNIFIED
from ridemart.sources import compaction
from ridemart.sources.commits import TableBusy, exclusive, file_names
from ridemart.sources.compaction import compact, count_files
from ridemart.sources.live import (
    BATCHES, FACT_RUNS, RUNS, SEGMENTS, live_partitions, partition_folders, read_live, read_manifest, read_runs,
)
from ridemart.sources.tables import delete_path, read_table, replace_partitions
from ridemart.streaming.feeds import Feed, merge_new, stored_trip_ids

NUMBERS = T.StructType([T.StructField("n", T.LongType()), T.StructField("run_id", T.LongType())])
MONTHS = T.StructType([*NUMBERS.fields, T.StructField("month_key", T.IntegerType())])


def add_runs(spark, path, first, last, per_run=3):
    rows = spark.range(first * per_run, (last + 1) * per_run).select(F.col("id").alias("n"), (F.col("id") / per_run).cast("bigint").alias("run_id"))
    replace_partitions(rows, path, ["run_id"])


def test_two_hundred_runs_keep_few_files(spark, folder):
    path, most = f"{folder}/t", 0
    for first in range(1, 201, 20):
        last = first + 19
        add_runs(spark, path, first, last)
        assert compact(spark, path, NUMBERS, RUNS, {"": last - 2}, grace=0) >= 18
        assert as_set(read_live(spark, path, NUMBERS)) == {(n, n // 3) for n in range(3, (last + 1) * 3)}
        most = max(most, count_files(spark, path))
    manifest = read_manifest(spark, path)
    assert most <= 40 and len(manifest.segments) <= 8 and manifest.through == 198
    # What segments have replaced goes with the next compaction.
    assert compact(spark, path, NUMBERS, RUNS, {"": 198}, grace=0) == 0
    assert len(partition_folders(spark, path, ["run_id"])) == 2
    assert len(partition_folders(spark, f"{path}/{SEGMENTS}/data", ["segment"])) == len(manifest.segments)
    assert len(file_names(spark, f"{path}/{SEGMENTS}/log")) <= compaction.KEPT_VERSIONS + 1
    assert as_set(read_runs(spark, path, NUMBERS, lambda run: run in (5, 199))) == {(n, n // 3) for n in (15, 16, 17, 597, 598, 599)}
    assert read_runs(spark, path, NUMBERS, lambda run: run > 900) is None
    assert read_table(spark, path, NUMBERS).count() == 600


def test_months_stay_partitions(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(3, 60).select(F.col("id").alias("n"), (F.col("id") / 3).cast("bigint").alias("run_id"), (F.col("id") % 2 + 202401).cast("int").alias("month_key"))
    replace_partitions(rows, path, ["run_id", "month_key"])
    want = as_set(rows)
    assert compact(spark, path, MONTHS, FACT_RUNS, {"": 15}, order=["n"], grace=0) == 15
    found = read_live(spark, path, MONTHS)
    assert as_set(found) == want
    one = found.filter("month_key = 202402")
    assert as_set(one) == {row for row in want if row[2] == 202402}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(month_key") == 2


def test_a_reader_on_its_way_and_a_dead_or_second_compaction(spark, folder, monkeypatch):
    path = f"{folder}/t"
    add_runs(spark, path, 1, 12)
    before = read_live(spark, path, NUMBERS)
    assert compact(spark, path, NUMBERS, RUNS, {"": 4}) == 0  # too few to be worth it
    assert compact(spark, path, NUMBERS, RUNS, {"": 10}) == 10
    assert compact(spark, path, NUMBERS, RUNS, {"": 12}, at_least=1) == 2  # within the grace: nothing is deleted
    assert before.count() == 36 == read_live(spark, path, NUMBERS).count()
    assert len(partition_folders(spark, path, ["run_id"])) == 12
    add_runs(spark, path, 13, 24)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "create_once", die)
        with pytest.raises(RuntimeError):
            compact(spark, path, NUMBERS, RUNS, {"": 24}, grace=0)
    live = [segment["name"] for segment in read_manifest(spark, path).segments]
    assert len(partition_folders(spark, f"{path}/{SEGMENTS}/data", ["segment"])) > len(live)
    assert read_live(spark, path, NUMBERS).count() == 72
    with exclusive(spark, f"{path}/{SEGMENTS}/writer"), pytest.raises(TableBusy):
        compact(spark, path, NUMBERS, RUNS, {"": 24})
    assert compact(spark, path, NUMBERS, RUNS, {"": 24}, grace=0) == 12
    add_runs(spark, path, 7, 7)  # a late replay of a run that a segment stands for
    assert as_set(read_live(spark, path, NUMBERS)) == {(n, n // 3) for n in range(3, 75)}
    compact(spark, path, NUMBERS, RUNS, {"": 24}, grace=0)
    assert partition_folders(spark, path, ["run_id"]) == {} and read_live(spark, path, NUMBERS).count() == 72
    assert len(partition_folders(spark, f"{path}/{SEGMENTS}/data", ["segment"])) == len(read_manifest(spark, path).segments)


def test_nothing_to_compact(spark, folder):
    assert compact(spark, f"{folder}/none", NUMBERS, RUNS, {"": 9}, at_least=1) == 0
    assert read_live(spark, f"{folder}/none", NUMBERS) is None
    assert set(compact_mart(spark, MartPaths(f"{folder}/mart")).values()) == {0}
    with pytest.raises(ValueError):
        count_files(spark, f"{folder}/none")


def test_the_whole_mart(spark, folder, rides):
    paths = MartPaths(f"{folder}/mart")
    feed = paths.feed("a-1", audit=False)

    def batch(k):
        return rides(ride(f"t{k}", f"2024-0{k % 3 + 1}-05 10:00:00", f"2024-0{k % 3 + 1}-05 10:10:00"), ride(f"t{k - 1}", "2024-04-01 08:00:00", "2024-04-01 08:30:00"))

    spark.sql("CREATE DATABASE IF NOT EXISTS compacted")
    for k in range(9):
        merge_new(batch(k), k, feed)
        if k % 3 == 2:
            refresh_mart(spark, paths)
    serve.register_mart(spark, paths.base, "compacted")
    serve.register_mart(spark, paths.base)
    before = as_set(report.trips_by_month(load_star(spark, paths.gold)))
    ids = {(f"t{k}",) for k in range(-1, 9)}
    for grace in (3600, 0):
        taken = compact_mart(spark, paths, at_least=1, grace=grace)
        assert as_set(read_table(spark, paths.batch_output, FEED), "trip_id") == ids
        assert read_table(spark, paths.unified, UNIFIED).count() == 10
        assert as_set(report.trips_by_month(load_star(spark, paths.gold))) == before
        for table in ("compacted.silver_unified_rides", "compacted.gold_fact_trip", "silver_unified_rides", "gold_fact_trip"):
            assert spark.table(table).count() == 10 == spark.table(table).select("trip_id").distinct().count(), table
        if grace:
            assert taken == {"batch_output": 8, "stream_output": 0, "unified": 3, "fact": 3}
    assert set(taken.values()) == {0}
    assert partition_folders(spark, paths.unified, ["run_id"]) == {} and len(live_partitions(spark, paths.batch_output, BATCHES, read_manifest(spark, paths.batch_output))) == 1

    # A replay of a batch in a segment, a batch of known ids, and a new one.
    merge_new(batch(4), 4, feed)
    merge_new(batch(8), 9, feed)
    merge_new(batch(20), 10, feed)
    assert refresh_mart(spark, paths) == {"unified": 2, "fact": 2}
    assert as_set(read_table(spark, paths.batch_output, FEED), "trip_id") == ids | {("t20",), ("t19",)}
    assert read_table(spark, paths.batch_output, FEED).count() == 12
    assert as_set(read_table(spark, paths.unified, UNIFIED).select("run_id").distinct()) == {(1,), (2,), (3,), (4,)}
    for table in ("compacted.silver_unified_rides", "compacted.gold_fact_trip", "silver_unified_rides", "gold_fact_trip"):
        assert spark.table(table).count() == 12, table
    assert serve.export_mart(spark, paths.base)["gold_fact_trip"] == 12

    # A second star, and one that looks for known ids, start from segments; a feed without a union looks into them.
    for unique in (True, False):
        assert build_gold(spark, paths.unified, f"{folder}/gold-{unique}", unique=unique) == 12
        assert build_gold(spark, paths.unified, f"{folder}/gold-{unique}", unique=unique) == 0
    assert read_table(spark, f"{folder}/gold-True/{FACT_TABLE}", load_star(spark, paths.gold).fact.schema).count() == 12
    alone = Feed("other", f"{folder}/alone", other_targets=(paths.batch_output,))
    assert as_set(stored_trip_ids(spark, 0, alone)) == ids | {("t20",), ("t19",)}

    # The ledger of ids is made anew from segments.
    delete_path(spark, f"{paths.unified}_ids")
    merge_new(batch(3), 11, paths.feed("a-2", audit=False))
    merge_new(batch(30), 12, paths.feed("a-2", audit=False))
    assert refresh_mart(spark, paths) == {"unified": 2, "fact": 2}
    assert read_table(spark, paths.unified, UNIFIED).count() == 14
