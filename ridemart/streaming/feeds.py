"""Feeds into Silver: the micro-batch sink and the streaming queries around it."""

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from ridemart.functions.geo import geo_cell
from ridemart.operators.clean import (
    CellFunction, clean_first_rides, clean_rides, is_valid, split_valid_rejects,
)
from ridemart.operators.incremental import KeySize, dedup_stream, key_bytes
from ridemart.operators.ledger import History, IdLedger, note_open, open_batches, write_unseen
from ridemart.schemas import FEED, METRICS, ORIGIN, RECORD, UNIFIED
from ridemart.sources.live import read_manifest, read_segments
from ridemart.sources.tables import (
    batch_folders, constant_rows, merged_batches, path_exists, read_partitions, read_table, replace_batch,
)


# The valid rides of a batch before the state, as its query reports them.
VALID_IN = "valid_rides_in"


@dataclass(frozen=True)
class Feed:
    """Where one feed writes, and where else its ids may be stored already.

    ``source`` must carry the run: a query restarted on a new checkpoint counts its batches from 0
    again, so it needs a new source name or it would replace the partitions of the old one.

    ``dedup`` says who removes repeated ids from the feed's table:

    - "stored": each batch is checked against everything the feeds have written.
    - "state": the streaming query's own state; a batch then never looks at the history, and ids that
      another feed has written are left to the union. Of several rides with one id the state keeps the
      one it sees first. State takes valid rides only, so rejects and metrics need another choice:
    - "audited-state": the same, and invalid rides go past the state to the rejects. What the state drops is only
      known to the query's progress, so metrics are completed when that is reported, see ``await_feed``.
    - "union": nobody before the union; the feed is written without any shuffle. For bulk loads.
    """

    source: str
    target: str
    rejects: str | None = None
    metrics: str | None = None
    other_targets: Sequence[str] = ()
    unified: str | None = None
    progress: str | None = None
    cell_fn: CellFunction = field(default=geo_cell)
    dedup: str = "stored"

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[\w.-]+", self.source):
            raise ValueError(f"a source name may hold letters, digits, '_', '.' and '-', not {self.source!r}")
        if self.dedup not in ("stored", "state", "audited-state", "union"):
            raise ValueError(f"dedup must be 'stored', 'state', 'audited-state' or 'union', not {self.dedup!r}")
        if bool(self.unified) != bool(self.progress):
            raise ValueError("a unified table goes with its progress ledger")
        if self.dedup == "state" and (self.rejects or self.metrics):
            raise ValueError("state alone keeps no rejects and no metrics; use 'audited-state'")


def stored_trip_ids(spark: SparkSession, batch_id: int, feed: Feed) -> DataFrame | None:
    """Ids that any feed has written, but for those of this very batch (it may be a replay).

    Batches that the union has taken are looked up in the unified table, with its few large files. The
    union's ledger is read first: what it lists is in the table by then, and the rest in the feeds.
    """
    own = (feed.source, batch_id)
    merged = merged_batches(spark, feed.progress) if feed.unified else set()
    tables = []
    for path in (feed.target, *feed.other_targets):
        folders = batch_folders(spark, path, skip=merged | {own})
        if folders:
            tables.append(read_partitions(spark, path, FEED, folders.values()))
        segments = None if feed.unified else read_segments(spark, path, FEED, read_manifest(spark, path))
        if segments is not None:
            tables.append(segments.filter((F.col("source") != feed.source) | (F.col("batch_id") != batch_id)))
    unified = read_table(spark, feed.unified, UNIFIED) if feed.unified else None
    if unified is not None:
        tables.append(unified.filter((F.col("source") != feed.source) | (F.col("batch_id") != batch_id)))
    return reduce(DataFrame.unionByName, [table.select("trip_id") for table in tables]) if tables else None


def stored_ids(spark: SparkSession, batch_id: int, feed: Feed) -> list[History]:
    """Where the ids of other batches are: in the batches that the union has not taken yet, and in its ledger of ids.

    The notes of open batches are read first: what has left them is in the ledger by then. Neither the feeds'
    folders nor the list of merged batches is looked at, so a batch costs the same however many came before. A
    feed without a union, and a mart whose union has not made its ledger yet, are looked up in their tables.
    """
    if feed.unified:
        recent = open_batches(spark, feed.progress)
        ledger = IdLedger(f"{feed.unified.rstrip('/')}_ids")
        if ledger.state(spark) is not None or not path_exists(spark, feed.unified):
            recent.pop((feed.source, batch_id), None)
            found = ledger.histories(spark, own=(feed.source, batch_id))
            by_table: dict[str, list[str]] = {}
            for folder in recent.values():
                if not path_exists(spark, folder):
                    continue  # noted, and not written yet or without rows
                by_table.setdefault(folder.rpartition("/source=")[0], []).append(folder)
            rows = [read_partitions(spark, table, FEED, folders).select("trip_id") for table, folders in by_table.items()]
            return [*found, History(reduce(DataFrame.unionByName, rows))] if rows else found
    stored = stored_trip_ids(spark, batch_id, feed)
    return [] if stored is None else [History(stored)]


def merge_new(rides: DataFrame, batch_id: int, feed: Feed, persist: bool = True) -> None:
    """Write the rides whose ids are new, as partition (source, batch_id) of the feed's target.

    The target's own key column is the ledger, so there is one commit and nothing to get out of step.
    A replayed batch replaces its own partition. ``persist`` suits micro-batches, whose size the
    trigger bounds; turn it off for a bulk load.
    """
    if persist:
        rides = rides.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        spark = rides.sparkSession
        stored = stored_ids(spark, batch_id, feed) if feed.dedup == "stored" else []
        size = _measure(rides) if feed.metrics or stored else None
        if size is not None and size["rows_in"] == 0:
            return
        if feed.rejects and (size is None or size["rows_in"] > size["valid"]):
            _, rejects = split_valid_rejects(rides)
            missing = {name: F.lit(None).cast("string") for name in RECORD.names if name not in rejects.columns}
            replace_batch(rejects.withColumns(missing), feed.rejects, feed.source, batch_id)
        # State has removed repeated ids already, or the union will.
        clean = clean_first_rides if feed.dedup == "stored" else clean_rides
        if feed.progress:
            # Noted before it is written: a batch that is noted and not there is skipped, the other way round it is missed.
            note_open(spark, feed.progress, feed.source, batch_id, f"{feed.target}/source={feed.source}/batch_id={batch_id}")
        written = write_unseen(
            clean(rides, feed.cell_fn), stored, lambda rows: replace_batch(rows, feed.target, feed.source, batch_id),
            raw=rides.filter(is_valid()), size=size and KeySize(size["valid"], size["key_bytes"]),
        )
        if feed.metrics:
            _write_metrics(rides, size, written, batch_id, feed)
    finally:
        if persist:
            rides.unpersist()


def _measure(rides: DataFrame):
    """Counts and key size of a batch, in one pass that also fills its cache."""
    checked = rides.select(is_valid().alias("ok"), F.when(is_valid(), F.col("trip_id")).alias("id"))
    return checked.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("ok")).alias("valid"),
        key_bytes("id").alias("key_bytes"),
    ).first()


def _write_metrics(rides: DataFrame, size, written: int, batch_id: int, feed: Feed) -> None:
    rejected, duplicates = size["rows_in"] - size["valid"], size["valid"] - written
    row = (size["rows_in"], rejected, duplicates, written)
    if feed.dedup == "audited-state":
        row = (None, rejected, None, written)  # what the state dropped is not known yet
    _replace_metrics(rides.sparkSession, row, batch_id, feed)


def _replace_metrics(spark: SparkSession, row: tuple, batch_id: int, feed: Feed) -> None:
    columns = [field for field in METRICS if field.name not in ORIGIN.names]
    replace_batch(constant_rows(spark, [row], T.StructType(columns)), feed.metrics, feed.source, batch_id)


class StateMetrics(StreamingQueryListener):
    """Completes the metrics of an "audited-state" feed by what its query reports of each batch.

    The batch's sink has noted what it rejected and wrote; the report has the valid rides that went into the
    state. If the query dies between the two, rows_in and duplicates of that batch stay NULL.
    """

    def __init__(self, spark: SparkSession, feed: Feed) -> None:
        self.session, self.feed, self.lock, self.done = spark, feed, Lock(), set()

    def complete(self, progress: StreamingQueryProgress) -> None:
        observed = progress.observedMetrics.get(VALID_IN)
        with self.lock:
            if observed is None or progress.batchId in self.done:
                return
            self.done.add(progress.batchId)
            stored = read_table(self.session, self.feed.metrics, METRICS)
            own = (F.col("source") == self.feed.source) & (F.col("batch_id") == progress.batchId)
            noted = stored.filter(own).first() if stored is not None else None
            rejected, written = (noted.rejected, noted.written) if noted else (0, 0)
            if observed.valid or noted:
                row = (observed.valid + rejected, rejected, observed.valid - written, written)
                _replace_metrics(self.session, row, progress.batchId, self.feed)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.feed.source:
            self.complete(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_state_metrics: dict[str, StateMetrics] = {}


def await_feed(query: StreamingQuery) -> None:
    """Wait for the end of a feed's query, and for the metrics of its last batches."""
    query.awaitTermination()
    listener = _state_metrics.pop(str(query.runId), None)
    if listener is not None:
        listener.session.streams.removeListener(listener)
        for progress in query.recentProgress:
            listener.complete(progress)


def micro_batch_sink(feed: Feed, persist: bool = True) -> Callable[[DataFrame, int], None]:
    """The function to hand to ``foreachBatch``."""
    return lambda rides, batch_id: merge_new(rides, batch_id, feed, persist)


def start_feed(
    rides: DataFrame, feed: Feed, checkpoint: str, persist: bool = True, **trigger: object,
) -> StreamingQuery:
    """Run a stream of raw rides into Silver; ``availableNow=True`` for a bounded run."""
    spark, listener = rides.sparkSession, None
    if feed.dedup == "state":
        rides = dedup_stream(rides.filter(is_valid()), ["trip_id"])
    elif feed.dedup == "audited-state":
        valid = rides.filter(is_valid()).observe(VALID_IN, F.count(F.lit(1)).alias("valid"))
        rides = dedup_stream(valid, ["trip_id"]).unionByName(rides.filter(~F.coalesce(is_valid(), F.lit(False))))
        if feed.metrics:
            listener = StateMetrics(spark, feed)
            spark.streams.addListener(listener)
    writer = (
        rides.writeStream.queryName(feed.source)
        .foreachBatch(micro_batch_sink(feed, persist))
        .option("checkpointLocation", checkpoint)
    )
    query = (writer.trigger(**trigger) if trigger else writer).start()
    if listener is not None:
        _state_metrics[str(query.runId)] = listener
    return query


def land_rides(
    rides: DataFrame, path: str, checkpoint: str, every: str = "10 seconds", bounded: bool = False,
) -> StreamingQuery:
    """Land a stream of rides as headed CSV files; the checkpoint makes a restart exact.

    The columns go out as they are: ``split_ride_lines`` keeps the text of messages, typed rides lose what
    did not parse.
    """
    writer = (
        rides.writeStream.format("csv").option("header", True).option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if bounded else {"processingTime": every}
    return writer.trigger(**trigger).start()
