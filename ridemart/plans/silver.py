"""The unified Silver table: every feed's new rides, one row per trip id, added run by run."""

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ridemart.operators.incremental import dedup_first
from ridemart.operators.ledger import IdLedger, catch_up, close_batches, write_unseen as write_new
from ridemart.schemas import FEED, FEED_PROGRESS, UNIFIED
from ridemart.session import small_tasks
from ridemart.sources.commits import Lease, exclusive
from ridemart.sources.live import RUNS, live_partitions, read_manifest
from ridemart.sources.tables import (
    append_ledger, batch_folders, constant_rows, merged_batches, path_exists, read_partitions, replace_partitions,
)

log = logging.getLogger(__name__)
UNION_ORDER = ("start_time", "trip_duration_sec", "source", "batch_id")


def id_ledger(unified: str) -> IdLedger:
    """The ledger of the ids in a unified table, next to it."""
    return IdLedger(f"{unified.rstrip('/')}_ids")


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, feeds)


def merge_feeds(pending: DataFrame) -> DataFrame:
    """One row per id among the pending rows."""
    return dedup_first(pending, ["trip_id"], UNION_ORDER)


def union_silver(spark: SparkSession, feeds: Sequence[str], unified: str, progress: str) -> int | None:
    """Add the feeds' new rides to ``unified`` as the next run; returns the number of rides added.

    A feed that does not exist yet is skipped; None means that no feed exists. The progress ledger of
    batches only saves work: uniqueness rests on the ids in ``unified``, so a crash between the write
    and the ledger costs a second look at the same batches and nothing else. The ids are kept once more in a
    ledger bucketed by id next to the table, so that new ones are looked up without moving the history; what
    a crash kept out of it is added by the next run.

    One union runs at a time: a run that starts before another has ended raises TableBusy and writes
    nothing, so that no two runs take one number or accept one id twice. Its batches wait for the next run.
    A run that died is noticed by its missing heartbeat and does not keep the next one from working.
    """
    with exclusive(spark, unified) as lease, small_tasks(spark):
        return _union_silver(spark, feeds, unified, progress, lease)


def _union_silver(spark: SparkSession, feeds: Sequence[str], unified: str, progress: str, lease: Lease) -> int | None:
    present = [path for path in feeds if path_exists(spark, path)]
    for path in set(feeds) - set(present):
        log.warning("feed %s does not exist, skipped", path)
    if not present:
        return None
    merged = merged_batches(spark, progress)
    close_batches(spark, progress, merged)  # replays of batches that an earlier run took
    unmerged = {path: batch_folders(spark, path, skip=merged) for path in present}
    parts = [
        read_partitions(spark, path, FEED, folders.values()) for path, folders in unmerged.items() if folders
    ]
    if not parts:
        return 0
    pending = union_feeds(parts).filter(F.col("trip_id").isNotNull())

    lease.check()
    manifest = read_manifest(spark, unified)
    runs = {int(run): folder for (run,), folder in live_partitions(spark, unified, RUNS, manifest).items()}
    ledger = id_ledger(unified)
    catch_up(spark, ledger, unified, runs, UNIFIED)
    run_id = max([*runs, manifest.through if manifest else 0], default=0) + 1
    run = F.lit(run_id).cast("bigint").alias("run_id")
    added = write_new(
        merge_feeds(pending), ledger.histories(spark),
        lambda rows: replace_partitions(rows.select(*FEED.names, run), unified, ["run_id"]), raw=pending,
    )
    if added:
        catch_up(spark, ledger, unified, {run_id: f"{unified}/run_id={run_id}"}, UNIFIED)
    lease.check()
    done = [batch for folders in unmerged.values() for batch in folders]
    append_ledger(constant_rows(spark, [(*batch, run_id) for batch in done], FEED_PROGRESS), progress)
    close_batches(spark, progress, done)
    return added
