"""The ledger of ids: no history moves, a batch costs the same however many came before, nothing is missed."""

import os
import random

import pytest
from conftest import as_set, plan_of, ride

from ridemart.operators import incremental, ledger as ledger_ops
from ridemart.operators.incremental import KeySize
from ridemart.operators.ledger import IdLedger, buckets_for, open_batches, unseen, write_unseen
from ridemart.plans import silver as silver_plan
from ridemart.plans.mart import MartPaths
from ridemart.plans.silver import id_ledger, union_silver
from ridemart.schemas import FEED, ID_LEDGER, METRICS, UNIFIED
from ridemart.sources.tables import path_exists, read_table
from ridemart.streaming import feeds as feeds_module
from ridemart.streaming.feeds import merge_new, stored_ids


def union(spark, paths):
    return union_silver(spark, [paths.batch_output, paths.stream_output], paths.unified, paths.unified_progress)


def entries(spark, first, last, batch_id=0):
    return spark.range(first, last).selectExpr("CONCAT('r', id) AS trip_id", "'b' AS source", f"{batch_id}L AS batch_id")


def held(spark, ledger):
    return sorted(row[0] for history in ledger.histories(spark) for row in history.rows.collect())


def test_runs_merge_and_keep_every_id(spark, folder):
    ledger = IdLedger(f"{folder}/ids")
    assert ledger.state(spark) is None and ledger.histories(spark) == []
    for number in range(12):
        ledger.add(spark, entries(spark, 10 * number, 10 * number + 10, number), number + 1)
    state = ledger.state(spark)
    assert state["through"] == 12 and len(state["runs"]) <= 4 and sum(run["rows"] for run in state["runs"]) == 120
    assert held(spark, ledger) == sorted(f"r{k}" for k in range(120))
    on_disk = set(os.listdir(f"{folder}/ids/runs"))
    assert on_disk == {run["name"] for run in state["runs"]} | set(state["retired"])
    own = [row[0] for history in ledger.histories(spark, own=("b", 3)) for row in history.rows.collect()]
    assert len(own) == 110 and "r35" not in own
    ledger.add(spark, entries(spark, 0, 0), 13)
    assert ledger.state(spark)["through"] == 13 and len(held(spark, ledger)) == 120


def test_buckets_follow_the_number_of_ids():
    assert buckets_for(10) == 8 and buckets_for(40_000_000) == 8 and buckets_for(40_000_001) == 16
    assert buckets_for(10_000_000_000) == 2048


def below(plan, line_with):
    """The lines of a plan below the first one that holds a text: those that are further in."""
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if line_with in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*"))
    out = []
    for line in lines[at + 1:]:
        if len(line) - len(line.lstrip(" :+-*")) <= depth:
            break
        out.append(line)
    return out


@pytest.mark.parametrize("rows, broadcast", [(100, True), (100, False), (10**9, False)])
def test_the_history_never_moves(spark, folder, monkeypatch, rows, broadcast):
    """At any size of a batch, nothing is exchanged between the scan of the stored ids and its join."""
    monkeypatch.setattr(ledger_ops, "BUCKET_ROWS", 100)
    monkeypatch.setattr(incremental, "BROADCAST_KEY_BYTES", 10**12 if broadcast else -1)
    ledger = IdLedger(f"{folder}/ids")
    ledger.add(spark, entries(spark, 0, 2000), 1)
    ledger.add(spark, entries(spark, 2000, 2100, 1), 2)
    batch = spark.range(1990, 2300).selectExpr("CONCAT('r', id) AS trip_id", "id AS n")
    histories = ledger.histories(spark)
    assert sorted(history.buckets for history in histories) == [8, 32]
    found = unseen(batch, histories, batch, KeySize(rows, 1))
    plan = plan_of(found)
    scans = [line for line in plan.splitlines() if "FileScan" in line and "ridemart_ids" in line]
    assert len(scans) == 2 and (broadcast or all("Bucketed: true" in line for line in scans))
    lines = plan.splitlines()
    for scan in scans:
        at = lines.index(scan)
        above = at - 1
        while "LeftSemi" not in lines[above]:
            assert "Exchange" not in lines[above], plan
            above -= 1
    assert ("ShuffledHashJoin" in plan) == (not broadcast and rows == 100)
    assert as_set(found, "trip_id") == {(f"r{k}",) for k in range(2100, 2300)}


def test_a_history_that_is_not_bucketed_may_move(spark):
    batch = spark.createDataFrame([("a",), ("b",)], "trip_id string")
    recent = ledger_ops.History(spark.createDataFrame([("b",), ("c",)], "trip_id string"))
    for bytes_ in (1, 10**12):
        assert as_set(unseen(batch, [recent], batch, KeySize(2, bytes_))) == {("a",)}
    written = []
    write_unseen(batch, [], lambda rows: written.append(rows.count()) or 2, raw=batch)
    assert written == [2]


def test_a_batch_looks_at_nothing_that_grows(spark, rides, folder, monkeypatch):
    """Thousands of batches have been merged: none of their folders is listed and their ledger is not read."""
    paths = MartPaths(folder)
    feed = paths.feed("b")
    merge_new(rides(ride("a"), ride("b")), 0, feed)
    assert union(spark, paths) == 2
    for number in range(1, 3000):
        os.makedirs(f"{paths.batch_output}/source=b/batch_id={number}")
    spark.range(1, 3000).selectExpr("'b' AS source", "id AS batch_id", "1L AS run_id").coalesce(1).write.mode("append").parquet(paths.unified_progress)
    merge_new(rides(ride("c")), 3000, feed)
    assert set(open_batches(spark, paths.unified_progress)) == {("b", 3000)}

    def listed(*_, **__):
        raise AssertionError("a micro-batch looked at all batches")

    calls = []
    list_names = ledger_ops.file_names
    monkeypatch.setattr(feeds_module, "batch_folders", listed)
    monkeypatch.setattr(feeds_module, "merged_batches", listed)
    monkeypatch.setattr(ledger_ops, "file_names", lambda spark, path: calls.append(list_names(spark, path)) or calls[-1])
    merge_new(rides(ride("a"), ride("c"), ride("d")), 3001, feed)
    assert sum(map(len, calls)) < 20
    metrics = read_table(spark, paths.metrics, METRICS).filter("batch_id = 3001").first()
    assert (metrics.rows_in, metrics.duplicates, metrics.written) == (3, 2, 1)


@pytest.mark.parametrize("limit", [None, -1])
def test_batches_unions_and_replays_against_sets(spark, rides, folder, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(incremental, "BROADCAST_KEY_BYTES", limit)
    rng, paths = random.Random(4), MartPaths(folder)
    feeds = [paths.feed("b"), paths.feed("s", stream=True)]
    accepted, batches = set(), {}
    for step in range(6):
        which = step % 2
        ids = [f"r{rng.randrange(14)}" for _ in range(5)]
        merge_new(rides(*map(ride, ids)), step // 2, feeds[which])
        batches[which, step // 2] = set(ids) - accepted, ids
        accepted |= set(ids)
        if step in (1, 4):
            union(spark, paths)
        if step in (2, 5):  # a replay of the last batch, and of one that the union has taken
            for replayed in ((which, step // 2), (0, 0)):
                merge_new(rides(*map(ride, batches[replayed][1])), replayed[1], feeds[replayed[0]])
    for which, table in enumerate((paths.batch_output, paths.stream_output)):
        rows = read_table(spark, table, FEED).select("trip_id", "batch_id").collect()
        assert sorted(map(tuple, rows)) == sorted((name, batch) for (feed, batch), (new, _) in batches.items() if feed == which for name in new)
    union(spark, paths)
    stored = sorted(row.trip_id for row in read_table(spark, paths.unified, UNIFIED).collect())
    assert stored == sorted(accepted) == held(spark, id_ledger(paths.unified))
    assert open_batches(spark, paths.unified_progress) == {}


def test_a_union_that_died_before_its_ids_were_noted(spark, rides, folder, monkeypatch):
    paths = MartPaths(folder)
    merge_new(rides(ride("a"), ride("b")), 0, paths.feed("b"))
    union(spark, paths)
    merge_new(rides(ride("c")), 1, paths.feed("b"))

    def die(spark, ledger, unified, runs, schema):
        if 2 in runs:
            raise RuntimeError("lost")
        return catch_up(spark, ledger, unified, runs, schema)

    catch_up = silver_plan.catch_up
    with monkeypatch.context() as patch:
        patch.setattr(silver_plan, "catch_up", die)
        with pytest.raises(RuntimeError):
            union(spark, paths)
    assert held(spark, id_ledger(paths.unified)) == ["a", "b"]
    # The batch is still open, so its ids are found there.
    merge_new(rides(ride("c"), ride("d")), 0, paths.feed("s", stream=True))
    assert as_set(read_table(spark, paths.stream_output, FEED), "trip_id") == {("d",)}
    assert union(spark, paths) == 1
    assert held(spark, id_ledger(paths.unified)) == ["a", "b", "c", "d"]


def test_a_mart_from_before_gets_its_ledger(spark, rides, folder):
    paths = MartPaths(folder)
    merge_new(rides(ride("a"), ride("b")), 0, paths.feed("b"))
    union(spark, paths)
    from ridemart.sources.tables import delete_path
    delete_path(spark, id_ledger(paths.unified).path)
    delete_path(spark, ledger_ops.open_folder(paths.unified_progress))
    known = stored_ids(spark, 0, paths.feed("s", stream=True))
    assert len(known) == 1 and known[0].buckets is None and as_set(known[0].rows) == {("a",), ("b",)}
    merge_new(rides(ride("b"), ride("c")), 1, paths.feed("b"))
    assert union(spark, paths) == 1 and path_exists(spark, id_ledger(paths.unified).path)
    assert held(spark, id_ledger(paths.unified)) == ["a", "b", "c"]
    assert [field.name for field in ID_LEDGER] == ["trip_id", "source", "batch_id"]
