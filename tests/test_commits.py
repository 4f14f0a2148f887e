"""Leases that heal, tables that grow under several writers, and star loads that overlap."""

import subprocess
import sys
import threading
import time

import pytest
from conftest import ROOT, as_set, ride
from pyspark.sql import types as T

from ridemart.operators.star import load_star
from ridemart.plans import gold as gold_plan, report
from ridemart.plans.gold import build_gold, cell_attributes
from ridemart.plans.mart import MartPaths, refresh_mart
from ridemart.plans.silver import union_silver
from ridemart.schemas import UNIFIED
from ridemart.sources.commits import LeaseLost, TableBusy, create_once, exclusive, file_names, finish_growth, grow_table, leased, read_text
from ridemart.sources.tables import delete_path, read_table
from ridemart.streaming.feeds import merge_new

NUMBERS = T.StructType([T.StructField("n", T.LongType())])


def test_only_one_creates(spark, folder):
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(k) if create_once(spark, f"{folder}/a/b", str(k)) else None) for k in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(won) == 1 and read_text(spark, f"{folder}/a/b") == str(won[0])
    assert file_names(spark, f"{folder}/a") == ["b"] and read_text(spark, f"{folder}/a/c") is None


def test_live_runs_exclude_each_other(spark, folder):
    with exclusive(spark, f"{folder}/t", seconds=0.4) as lease:
        time.sleep(1.5)  # longer than the lease: the heartbeat keeps it
        with pytest.raises(TableBusy), exclusive(spark, f"{folder}/t", seconds=0.4):
            pass
        lease.check()
    with exclusive(spark, f"{folder}/t"):
        pass


def test_claims_are_single(spark, folder):
    with leased(spark, folder) as one, leased(spark, folder) as two:
        assert one.claim("a") and two.claim("b") and not two.claim("a") and not one.claim("b")
    with leased(spark, folder) as one:
        assert one.claim("a") and one.claim("b")


KILLED = """
import os, sys
sys.path.insert(0, sys.argv[1])
from ridemart.session import local_session
from ridemart.sources.commits import Lease
spark = local_session(1)
lease = Lease(spark, sys.argv[2] + ".running", 2.0)
assert lease.claim("writer")
print("taken", flush=True)
spark.stop()
os._exit(9)
"""


def test_a_killed_run_does_not_block_the_next_one(spark, rides, folder):
    """A process dies while it holds the union's lease; later unions work, and a frozen one notices that it lost."""
    paths = MartPaths(folder)
    merge_new(rides(ride("a")), 0, paths.feed("b"))
    done = subprocess.run([sys.executable, "-c", KILLED, str(ROOT), paths.unified], capture_output=True, text=True, timeout=120, cwd=folder)
    assert "taken" in done.stdout and "writer" in file_names(spark, f"{paths.unified}.running")
    with pytest.raises(TableBusy), exclusive(spark, paths.unified, seconds=600):
        pass
    time.sleep(2.5)
    with exclusive(spark, paths.unified, seconds=2.0) as frozen:
        frozen._stop.set()
        frozen._beat.join()
        time.sleep(2.5)
        with exclusive(spark, paths.unified, seconds=2.0) as other:
            with pytest.raises(LeaseLost):
                frozen.check()
            other.check()
    assert union_silver(spark, [paths.batch_output], paths.unified, paths.unified_progress) == 1


def test_a_table_grows_once_per_key(spark, folder):
    """A second writer between the look at the table and the publication: the first one looks again."""
    table, log, looks = f"{folder}/t", f"{folder}/log", []

    def missing(stored, upto):
        rows = spark.range(upto).toDF("n")
        return rows if stored is None else rows.join(stored, "n", "left_anti")

    def slow(stored):
        looks.append(None)
        if len(looks) <= 2:
            assert grow_table(spark, table, log, NUMBERS, lambda other: missing(other, 3 * len(looks))) == 3
        return missing(stored, 8)

    assert grow_table(spark, table, log, NUMBERS, slow) == 2 and len(looks) == 3
    assert sorted(row.n for row in spark.read.parquet(table).collect()) == list(range(8))
    assert grow_table(spark, table, log, NUMBERS, lambda stored: missing(stored, 8)) == 0
    assert [name for name in file_names(spark, log) if not name.startswith("v")] == []


def test_a_published_version_outlives_its_writer(spark, folder, monkeypatch):
    from ridemart.sources import commits
    table, log = f"{folder}/t", f"{folder}/log"
    moves = []

    def die(*_):
        moves.append(None)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(commits, "_rename", die)
        with pytest.raises(KeyboardInterrupt):
            grow_table(spark, table, log, NUMBERS, lambda stored: spark.range(5).toDF("n"))
    assert moves and finish_growth(spark, table, log) == 1
    assert spark.read.parquet(table).count() == 5


def assert_each_key_once(spark, paths, trips):
    star = load_star(spark, paths.gold)
    assert report.total_trips(star).first().total_trips == trips
    for dim, key in ((star.date, "date_key"), (star.geography, "geo_hash"), (star.time, "time_key")):
        assert dim.count() == dim.select(key).distinct().count() > 0, key
    by_day = report.trips_by_day_name(star).collect()
    assert sum(row.total_trips for row in by_day) == trips


@pytest.mark.parametrize("step", ["new_dates", "new_cells"])
def test_a_load_inside_a_load(spark, rides, folder, monkeypatch, step):
    """The second load runs while the first looks for new keys of a dimension, and finds the same ones."""
    paths = MartPaths(folder)
    days = ["2024-01-05", "2024-01-06", "2024-01-07"]
    merge_new(rides(*[ride(f"a{day}", f"{day} 10:00:00", f"{day} 10:10:00") for day in days]), 0, paths.feed("b"))
    feeds = [paths.batch_output]
    union_silver(spark, feeds, paths.unified, paths.unified_progress)
    find, inner = getattr(gold_plan, step), []

    def meanwhile(*args, **options):
        found = find(*args, **options)
        if not inner:
            inner.append(None)
            merge_new(rides(*[ride(f"b{day}", f"{day} 11:00:00", f"{day} 11:10:00") for day in days]), 1, paths.feed("b"))
            union_silver(spark, feeds, paths.unified, paths.unified_progress)
            inner.append(build_gold(spark, paths.unified, paths.gold, unique=True))
        return found

    monkeypatch.setattr(gold_plan, step, meanwhile)
    assert build_gold(spark, paths.unified, paths.gold, unique=True) == 3
    assert inner == [None, 3]
    monkeypatch.undo()
    assert build_gold(spark, paths.unified, paths.gold, unique=True) == 0
    assert_each_key_once(spark, paths, 6)


def test_two_loads_at_the_same_time(spark, rides, folder):
    paths = MartPaths(folder)
    for batch in range(3):
        merge_new(rides(*[ride(f"r{batch}-{k}", f"2024-01-0{k + 1} 10:00:00", f"2024-01-0{k + 1} 10:10:00") for k in range(4)]), batch, paths.feed("b"))
        union_silver(spark, [paths.batch_output], paths.unified, paths.unified_progress)
    added, errors = [], []

    def load():
        try:
            added.append(build_gold(spark, paths.unified, paths.gold, unique=True))
        except Exception as failed:  # noqa: BLE001
            errors.append(failed)

    threads = [threading.Thread(target=load) for _ in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors and sum(added) == 12
    assert_each_key_once(spark, paths, 12)


def test_loads_that_look_for_known_ids_take_turns(spark, rides, folder):
    paths = MartPaths(folder)
    merge_new(rides(ride("a")), 0, paths.feed("b"))
    union_silver(spark, [paths.batch_output], paths.unified, paths.unified_progress)
    with leased(spark, f"{paths.gold}/_claims") as other:
        assert other.claim("ids")
        with pytest.raises(TableBusy):
            build_gold(spark, paths.unified, paths.gold)
    assert build_gold(spark, paths.unified, paths.gold) == 1


def test_the_star_does_not_wait_for_a_union(spark, rides, folder):
    paths = MartPaths(folder)
    merge_new(rides(ride("a")), 0, paths.feed("b"))
    union_silver(spark, [paths.batch_output], paths.unified, paths.unified_progress)
    with exclusive(spark, paths.unified):
        assert refresh_mart(spark, paths) == {"unified": None, "fact": 1}
    assert as_set(read_table(spark, paths.unified, UNIFIED), "trip_id") == {("a",)}


def test_a_cell_description_that_fails_leaves_no_claim(spark, rides, folder):
    paths = MartPaths(folder)
    merge_new(rides(ride("a")), 0, paths.feed("b"))
    union_silver(spark, [paths.batch_output], paths.unified, paths.unified_progress)

    def fail(cells):
        raise RuntimeError("no description")

    with pytest.raises(RuntimeError):
        build_gold(spark, paths.unified, paths.gold, unique=True, describe_cells=fail)
    assert build_gold(spark, paths.unified, paths.gold, unique=True, describe_cells=cell_attributes) == 1
    assert_each_key_once(spark, paths, 1)
    delete_path(spark, paths.gold)
