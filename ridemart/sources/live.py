"""What of a stored table is live: its partitions, and the segments that stand for many small ones.

A table grows by numbered partitions: runs, or batches of a source. ``compact`` rewrites many of them as a segment
below SEGMENTS, with every column in its files, and publishes a manifest: up to which number the partitions of each
group are covered, and the segments that hold them. A reader goes by one version of it: segments for what it covers,
partitions beyond. So a reader sees every row once, whether covered partitions are still there or not.
"""

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ridemart.sources.commits import file_names, hadoop_path, read_text

# Readers that list a folder pass over names with a leading underscore.
SEGMENTS = "_segments"


def path_exists(spark: SparkSession, path: str) -> bool:
    files, name = hadoop_path(spark, path)
    return files.exists(name)


def partition_folders(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[tuple[str, ...], str]:
    """The partitions of a stored table: folder by partition values.

    Folder names only, one listing per level: neither the table's files nor their footers are touched.
    """
    files, root = hadoop_path(spark, path)
    if not files.exists(root):
        return {}
    found = {(): path}
    for column in columns:
        below = {}
        for values, folder in found.items():
            for status in files.listStatus(hadoop_path(spark, folder)[1]):
                name = status.getPath().toString()
                label, _, value = name.rpartition("/")[2].partition("=")
                if label == column and value:
                    below[(*values, value)] = name
        found = below
    return found


def read_partitions(spark: SparkSession, path: str, schema: T.StructType, folders: Iterable[str]) -> DataFrame:
    """Some partitions of a stored table. The others are not even listed."""
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


@dataclass(frozen=True)
class Layout:
    """How a table is partitioned: columns that stand above the number, the number, and columns below it."""

    number: str
    groups: tuple[str, ...] = ()
    kept: tuple[str, ...] = ()

    def covers(self, upto: dict[str, int], values: Sequence[str]) -> bool:
        group = "/".join(values[:len(self.groups)])
        return int(values[len(self.groups)]) <= upto.get(group, 0 if not self.groups else -1)


BATCHES = Layout("batch_id", groups=("source",))
RUNS = Layout("run_id")
FACT_RUNS = Layout("run_id", kept=("month_key",))


@dataclass(frozen=True)
class Manifest:
    """The number up to which each group is covered, and the live segments, oldest first."""

    layout: Layout
    version: int = 0
    upto: dict[str, int] = field(default_factory=dict)
    segments: tuple[dict, ...] = ()

    def text(self) -> str:
        return json.dumps(asdict(self))

    @property
    def through(self) -> int:
        """The last covered run, for tables whose numbers have no groups."""
        return self.upto.get("", 0)


def version_file(path: str, version: int) -> str:
    return f"{path}/{SEGMENTS}/log/v{version:012d}"


def manifest_versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name[1:]) for name in file_names(spark, f"{path}/{SEGMENTS}/log") if name[:1] == "v" and name[1:].isdigit())


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The last published version, None for a table that was never compacted."""
    versions = manifest_versions(spark, path)
    text = read_text(spark, version_file(path, versions[-1])) if versions else None
    if not text:
        return None
    entry = json.loads(text)
    layout = entry["layout"]
    layout = Layout(layout["number"], tuple(layout["groups"]), tuple(layout["kept"]))
    return Manifest(layout, entry["version"], entry["upto"], tuple(entry["segments"]))


def covered_through(spark: SparkSession, path: str) -> int:
    """The last run that segments stand for, 0 without any."""
    manifest = read_manifest(spark, path)
    return manifest.through if manifest else 0


def live_partitions(
    spark: SparkSession, path: str, layout: Layout, manifest: Manifest | None, below: bool = False,
) -> dict[tuple[str, ...], str]:
    """Folders of the partitions that no segment stands for; ``below`` goes down to the columns under the number."""
    columns = (*layout.groups, layout.number, *(layout.kept if below else ()))
    found = partition_folders(spark, path, columns)
    if manifest is None:
        return found
    return {values: folder for values, folder in found.items() if not layout.covers(manifest.upto, values)}


def segment_folder(path: str, name: str) -> str:
    return f"{path}/{SEGMENTS}/data/segment={name}"


def read_segments(
    spark: SparkSession, path: str, schema: T.StructType, manifest: Manifest | None, names: Sequence[str] | None = None,
) -> DataFrame | None:
    """Rows of the live segments, or of some; None without any."""
    if names is None:
        names = [segment["name"] for segment in manifest.segments] if manifest else []
    if not names:
        return None
    folders = [segment_folder(path, name) for name in names]
    return read_partitions(spark, f"{path}/{SEGMENTS}/data", schema, folders).select(*schema.names)


def union_of(parts: Sequence[DataFrame | None]) -> DataFrame | None:
    parts = [part for part in parts if part is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_live(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The stored table, every row once; None when nothing is there. A table without segments is read as its folder."""
    if not path_exists(spark, path):
        return None
    manifest = read_manifest(spark, path)
    if manifest is None:
        return spark.read.schema(schema).parquet(path)
    folders = live_partitions(spark, path, manifest.layout, manifest)
    rows = read_partitions(spark, path, schema, folders.values()).select(*schema.names) if folders else None
    return union_of([rows, read_segments(spark, path, schema, manifest)])


def read_runs(
    spark: SparkSession, path: str, schema: T.StructType, wanted: Callable[[int], bool], layout: Layout = RUNS,
) -> DataFrame | None:
    """The rows of some runs, None without such runs. Partitions of others are not listed, segments without any not read."""
    manifest = read_manifest(spark, path)
    folders = [folder for values, folder in live_partitions(spark, path, layout, manifest).items() if wanted(int(values[0]))]
    rows = read_partitions(spark, path, schema, folders).select(*schema.names) if folders else None
    within = range(1, manifest.through + 1) if manifest else ()
    covered = [run for run in within if wanted(run)]
    packed = read_segments(spark, path, schema, manifest) if covered else None
    if packed is not None and len(covered) < len(within):
        packed = packed.filter(F.col(layout.number).isin(covered))
    return union_of([rows, packed])
