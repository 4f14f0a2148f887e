"""The whole chain over one base folder: feeds, unified Silver, star, export."""

import logging
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ridemart.operators.serve import export_mart, refresh_served
from ridemart.plans.gold import CellDescription, build_gold, cell_attributes, loaded_runs
from ridemart.plans.silver import id_ledger, union_silver
from ridemart.schemas import FACT_STORED, FACT_TABLE, FEED, UNIFIED
from ridemart.sources.commits import TableBusy
from ridemart.sources.compaction import GRACE_SECONDS, LEAST_PARTITIONS, compact
from ridemart.sources.live import BATCHES, FACT_RUNS, RUNS
from ridemart.sources.tables import batch_folders, merged_batches
from ridemart.streaming.feeds import Feed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class MartPaths:
    base: str

    @property
    def batch_output(self) -> str:
        return f"{self.base}/silver/batch_output"

    @property
    def stream_output(self) -> str:
        return f"{self.base}/silver/stream_output"

    @property
    def unified(self) -> str:
        return f"{self.base}/silver/unified_rides"

    @property
    def unified_progress(self) -> str:
        return f"{self.base}/silver/merged_batches"

    @property
    def rejects(self) -> str:
        return f"{self.base}/silver/rejects"

    @property
    def metrics(self) -> str:
        return f"{self.base}/silver/batch_metrics"

    @property
    def gold(self) -> str:
        return f"{self.base}/gold"

    def feed(self, source: str, stream: bool = False, audit: bool = True, **options) -> Feed:
        """A feed into this mart that also sees what the other kind of feed and the union have written."""
        target, other = self.batch_output, self.stream_output
        if stream:
            target, other = other, target
        return Feed(
            source, target, other_targets=(other,), unified=self.unified, progress=self.unified_progress,
            rejects=self.rejects if audit else None, metrics=self.metrics if audit else None, **options,
        )


def refresh_mart(
    spark: SparkSession, paths: MartPaths, describe_cells: CellDescription = cell_attributes,
) -> dict[str, int | None]:
    """Union the feeds, then extend the star. An error in one step stops the chain.

    A union that another run is at work on is none: this run goes on with the star, and "unified" is None.
    Views of this session and catalog tables over the mart show the new rows afterwards.
    """
    feeds = [paths.batch_output, paths.stream_output]
    try:
        unified = union_silver(spark, feeds, paths.unified, paths.unified_progress)
    except TableBusy as busy:
        log.warning("%s; the star takes the runs that are there", busy)
        unified = None
    # The union has just made sure that ids are unique across all runs.
    loaded = build_gold(spark, paths.unified, paths.gold, unique=True, describe_cells=describe_cells)
    refresh_served(spark, paths.base)
    return {"unified": unified, "fact": loaded}


def compact_mart(
    spark: SparkSession, paths: MartPaths, at_least: int = LEAST_PARTITIONS, grace: float = GRACE_SECONDS,
) -> dict[str, int]:
    """Take the mart's small partitions into segments; returns how many of each table. Feeds, unions and loads may go on.

    Taken are the batches that the union has merged, but for the last of each source, which its stream may repeat;
    the runs whose ids are in the union's ledger; and the facts of the runs up to the first that is not loaded.
    """
    merged = merged_batches(spark, paths.unified_progress)
    state = id_ledger(paths.unified).state(spark)
    through = state["through"] if state else 0
    taken = {}
    for name, feed in (("batch_output", paths.batch_output), ("stream_output", paths.stream_output)):
        taken[name] = compact(
            spark, feed, FEED, BATCHES, _settled_batches(spark, feed, merged), at_least=at_least, grace=grace,
        )
    taken["unified"] = compact(spark, paths.unified, UNIFIED, RUNS, {"": through}, at_least=at_least, grace=grace)
    loaded = loaded_runs(spark, paths.gold)
    first_open = min(set(range(1, max(loaded, default=0) + 2)) - loaded)
    taken["fact"] = compact(
        spark, f"{paths.gold}/{FACT_TABLE}", FACT_STORED, FACT_RUNS, {"": first_open - 1}, order=["date_key"],
        at_least=at_least, grace=grace,
    )
    refresh_served(spark, paths.base)
    return taken


def _settled_batches(spark: SparkSession, feed: str, merged: set[tuple[str, int]]) -> dict[str, int]:
    """For each source of a feed the batch up to which all are merged, and none is its last."""
    present: dict[str, list[int]] = {}
    for (source, batch_id) in batch_folders(spark, feed, skip=set()):
        present.setdefault(source, []).append(batch_id)
    settled = {}
    for source, batches in present.items():
        for batch_id in sorted(batches)[:-1]:
            if (source, batch_id) not in merged:
                break
            settled[source] = batch_id
    return settled


def run_mart(
    spark: SparkSession, paths: MartPaths, describe_cells: CellDescription = cell_attributes,
) -> dict[str, int]:
    """``refresh_mart`` and the export; returns the exported row counts."""
    refresh_mart(spark, paths, describe_cells)
    return export_mart(spark, paths.base)
