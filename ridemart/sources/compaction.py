"""Rewriting many small partitions as a few large segments, see ``live`` for how readers go by them."""

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridemart.sources.commits import Lease, TableBusy, create_once, exclusive, file_names, hadoop_path
from ridemart.sources.live import (
    SEGMENTS, Layout, Manifest, live_partitions, manifest_versions, partition_folders, read_manifest, read_partitions,
    read_segments, segment_folder, union_of, version_file,
)

log = logging.getLogger(__name__)
# Fewer partitions than this are left as they are.
LEAST_PARTITIONS = 8
# Seconds for which a reader may go by what it has listed; nothing that a segment replaced goes before.
GRACE_SECONDS = 3600.0
KEPT_VERSIONS = 5


def _size(spark: SparkSession, folder: str) -> int:
    files, name = hadoop_path(spark, folder)
    return files.getContentSummary(name).getLength()


def _delete(spark: SparkSession, path: str) -> None:
    files, name = hadoop_path(spark, path)
    files.delete(name, True)


def drop_replaced(spark: SparkSession, path: str, manifest: Manifest, lease: Lease, grace: float = GRACE_SECONDS) -> int:
    """Delete partitions and segments that the manifest has replaced, once it is old enough; returns their number."""
    age = lease.age(version_file(path, manifest.version))
    if age is None or age < grace:
        return 0
    layout = manifest.layout
    folders = partition_folders(spark, path, (*layout.groups, layout.number))
    gone = [folder for values, folder in folders.items() if layout.covers(manifest.upto, values)]
    live = {segment["name"] for segment in manifest.segments}
    gone += [
        folder for (name,), folder in partition_folders(spark, f"{path}/{SEGMENTS}/data", ["segment"]).items() if name not in live
    ]
    for folder in gone:
        _delete(spark, folder)
    for old in manifest_versions(spark, path)[:-KEPT_VERSIONS]:
        _delete(spark, version_file(path, old))
    return len(gone)


def compact(
    spark: SparkSession, path: str, schema: T.StructType, layout: Layout, upto: Mapping[str, int],
    order: Sequence[str] = (), at_least: int = LEAST_PARTITIONS, grace: float = GRACE_SECONDS,
) -> int:
    """Take the partitions up to a number of each group into a segment; returns how many were taken.

    ``upto`` names the groups by their values, joined by "/", and "" where there are none. Partitions up to there
    must not change any more; what is written into one of them afterwards is not read. Fewer than ``at_least`` of
    them stay as they are. A new segment takes along the last ones while they are at most twice its size, so their
    number grows with the logarithm of the table, and a row is rewritten as many times.

    Readers and writers of later partitions go on meanwhile. One compaction of a table runs at a time: a second one
    raises TableBusy. If one dies before the manifest is published, nothing has changed; its files are deleted with
    those that segments replaced, by a later compaction ``grace`` seconds after the manifest was published.
    """
    if not hadoop_path(spark, path)[0].exists(hadoop_path(spark, path)[1]):
        return 0
    with exclusive(spark, f"{path}/{SEGMENTS}/writer") as lease:
        before = read_manifest(spark, path) or Manifest(layout)
        if before.version:
            drop_replaced(spark, path, before, lease, grace)
        live = live_partitions(spark, path, layout, before)
        taken = {values: folder for values, folder in live.items() if layout.covers(dict(upto), values)}
        if len(taken) < at_least:
            return 0
        size, kept, along = sum(_size(spark, folder) for folder in taken.values()), list(before.segments), []
        while kept and kept[-1]["bytes"] <= 2 * size:
            along.append(kept.pop())
            size += along[-1]["bytes"]
        rows = union_of([
            read_partitions(spark, path, schema, taken.values()).select(*schema.names),
            read_segments(spark, path, schema, before, [segment["name"] for segment in along]),
        ])
        covered = dict(before.upto)
        for values in taken:
            group = "/".join(values[:len(layout.groups)])
            covered[group] = max(covered.get(group, -1), int(values[len(layout.groups)]))
        segment = {**_write_segment(rows, path, layout, order), "made": before.version + 1}
        lease.check()
        manifest = Manifest(layout, before.version + 1, covered, (*kept, segment))
        if not create_once(spark, version_file(path, manifest.version), manifest.text()):
            raise TableBusy(f"another run has compacted {path}")
        log.info("%s: %d partitions and %d segments are one segment now", path, len(taken), len(along))
        return len(taken)


def _write_segment(rows: DataFrame, path: str, layout: Layout, order: Sequence[str]) -> dict:
    """Write rows as a segment that no manifest names yet; its files get the size that AQE aims at."""
    spark, name = rows.sparkSession, uuid.uuid4().hex
    rows = rows.hint("rebalance", *layout.kept)
    if layout.kept or order:
        rows = rows.sortWithinPartitions(*layout.kept, *order)
    folder = segment_folder(path, name)
    rows.write.partitionBy(*layout.kept).parquet(folder)
    return {"name": name, "bytes": _size(spark, folder)}


def count_files(spark: SparkSession, path: str) -> int:
    """Live data files of a table, for monitoring: those of its segments and of the partitions beyond them."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise ValueError(f"{path} has not been compacted")
    folders = [*live_partitions(spark, path, manifest.layout, manifest, below=True).values()]
    for segment in manifest.segments:
        folders += partition_folders(spark, segment_folder(path, segment["name"]), manifest.layout.kept).values()
    return sum(name.startswith("part-") for folder in folders for name in file_names(spark, folder))
