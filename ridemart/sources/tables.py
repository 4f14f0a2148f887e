"""Stored tables: typed reads, key ledgers, seeds, and replay-safe partition writes."""

import csv
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from ridemart.schemas import FACT_TABLE, FEED_PROGRESS, ORIGIN, STAR_TABLES
from ridemart.session import new_folder, shared_folder
from ridemart.sources.commits import TableBusy, exclusive, hadoop_path  # noqa: F401  both are part of this module's interface
from ridemart.sources.live import (  # noqa: F401  the same
    BATCHES, live_partitions, partition_folders, path_exists, read_live, read_manifest, read_partitions,
)

MAX_PLAN_ROWS = 100


def delete_path(spark: SparkSession, path: str) -> None:
    files, name = hadoop_path(spark, path)
    files.delete(name, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that two spellings of one folder compare equal."""
    files, name = hadoop_path(spark, path)
    return files.makeQualified(name).toString()


def merged_batches(spark: SparkSession, progress: str) -> set[tuple[str, int]]:
    """The feed batches that the union has taken, as (source, batch_id)."""
    ledger = read_ledger(spark, progress, FEED_PROGRESS).select(*ORIGIN.names)
    return {tuple(row) for row in ledger.collect()}


def batch_folders(spark: SparkSession, feed: str, skip: set[tuple[str, int]]) -> dict[tuple[str, int], str]:
    """Folders of a feed's batches, without some and without those that segments stand for: the union has taken these."""
    folders = live_partitions(spark, feed, BATCHES, read_manifest(spark, feed))
    found = {(source, int(batch_id)): folder for (source, batch_id), folder in folders.items()}
    return {batch: folder for batch, folder in found.items() if batch not in skip}


def constant_rows(spark: SparkSession, rows: Sequence[Sequence[object]], schema: T.StructType) -> DataFrame:
    """Literal rows: a few become a plan constant, without a Python task."""
    if len(rows) > MAX_PLAN_ROWS:
        return spark.createDataFrame(rows, schema)

    def literal(value: object, field: T.StructField):
        return F.lit(value).cast(field.dataType).alias(field.name)

    one = spark.range(1)
    if not rows:
        return one.filter(F.lit(False)).select(*[literal(None, field) for field in schema])
    structs = [F.struct(*[literal(value, field) for value, field in zip(row, schema)]) for row in rows]
    return one.select(F.inline(F.array(*structs)))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
) -> DataFrame | None:
    """The table at ``path`` with a declared schema, or None when nothing is there.

    Headed CSV goes by the headers' names, a compacted table by its manifest.
    """
    if not path_exists(spark, path):
        return None
    if fmt == "csv":
        return read_headed_csv(spark, path, schema)
    if fmt == "parquet":
        return read_live(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def csv_headers(spark: SparkSession, *paths: str) -> dict[str, list[str]]:
    """The files of each distinct first line. One pass over the lines, without parsing them."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    firsts = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    grouped = firsts.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return {row["header"]: row["files"] for row in grouped.collect()}


def read_headed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headed CSV files with the declared types, each file by the names in its own header.

    The files of a folder may have their columns in different orders, and others besides. A column that a header
    lacks is an error, and what does not convert becomes NULL. Files are read in one go per distinct header.
    """
    parts = []
    for header, files in sorted(csv_headers(spark, path).items()):
        names = next(csv.reader([header.lstrip("\ufeff")]))
        at = {name.strip().lower(): f"_c{k}" for k, name in reversed(list(enumerate(names)))}
        missing = [name for name in schema.names if name.lower() not in at]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header of {', '.join(files[:3])}")
        text = T.StructType([T.StructField(f"_c{k}", T.StringType()) for k in range(len(names))])
        rows = spark.read.schema(text).option("header", True).csv(files)
        parts.append(rows.select(*[F.col(at[field.name.lower()]).try_cast(field.dataType).alias(field.name) for field in schema]))
    return reduce(DataFrame.unionByName, parts) if parts else constant_rows(spark, [], schema)


def read_star_table(spark: SparkSession, gold: str, name: str) -> DataFrame:
    if name == FACT_TABLE:
        return read_live(spark, f"{gold}/{name}", STAR_TABLES[name])
    return spark.read.schema(STAR_TABLES[name]).parquet(f"{gold}/{name}")


def read_ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A ledger of what has been handled; an empty one when there is none yet."""
    table = read_table(spark, path, schema)
    return constant_rows(spark, [], schema) if table is None else table


def append_ledger(rows: DataFrame, path: str) -> None:
    if not rows.isEmpty():
        rows.write.mode("append").parquet(path)


def new_rows_only(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not among the known ones. NULL keys never match, so filter them before."""
    return rows.join(known.select(*keys), list(keys), "left_anti")


def set_down(rows: DataFrame) -> DataFrame:
    """The rows as they are now, kept below the shared folder without their lineage."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(rows.sparkSession)}/ridemart")
    return rows.checkpoint()


@contextmanager
def staged(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows as a table of their own under the shared folder, for as long as the block runs."""
    spark = rows.sparkSession
    path = new_folder(spark, "staged")
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        delete_path(spark, path)


def seed_table(rows: DataFrame, path: str) -> None:
    """Write a small constant table unless it is already there."""
    stored = read_table(rows.sparkSession, path, rows.schema)
    if stored is None or stored.isEmpty():
        rows.coalesce(1).write.mode("overwrite").parquet(path)


def replace_partitions(rows: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Write rows so that they replace exactly the partitions they belong to; returns the row count.

    Writing the same rows twice leaves the table as after the first time, which makes a replayed
    micro-batch or a repeated run harmless. The count comes from the write itself, not a second scan.
    """
    written = Observation()
    (
        rows.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
    return written.get["rows"]


def replace_batch(rows: DataFrame, path: str, source: str, batch_id: int) -> int:
    """Write the rows as the one partition of a feed's batch; returns the row count.

    Without rows the partition is empty afterwards: what a former run of the batch left there goes.
    """
    origin = {"source": F.lit(source), "batch_id": F.lit(batch_id).cast("bigint")}
    written = replace_partitions(rows.withColumns(origin), path, ORIGIN.names)
    if written == 0:
        delete_path(rows.sparkSession, f"{path}/source={source}/batch_id={batch_id}")
    return written
