"""Serving: catalog tables over the mart, several SQL statements at once, CSV export."""

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from ridemart.schemas import STAR_TABLES, UNIFIED
from ridemart.session import small_tasks
from ridemart.sources.commits import create_once, file_names
from ridemart.sources.live import (
    FACT_RUNS, RUNS, Manifest, live_partitions, partition_folders, read_manifest, segment_folder,
)
from ridemart.sources.tables import path_exists, qualified, read_table, set_down

UNIFIED_NAME = "silver_unified_rides"
SERVED = {UNIFIED_NAME: ("silver/unified_rides", UNIFIED)} | {
    f"gold_{name}": (f"gold/{name}", schema) for name, schema in STAR_TABLES.items()
}


PARTITIONS = {UNIFIED_NAME: ("run_id",), "gold_fact_trip": ("run_id", "month_key")}
LAYOUTS = {UNIFIED_NAME: RUNS, "gold_fact_trip": FACT_RUNS}
SINGLE_FILES = ("gold_dim_date", "gold_dim_time", "gold_dim_duration_bucket")
# A folder of the mart with one file per database that has tables over it.
REGISTERED = "_registered"
# Columns that serve the loading of the mart and stay out of its exports.
INTERNAL_COLUMNS = ("run_id", "month_key", "source", "batch_id")


def exported_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([field for field in schema if field.name not in INTERNAL_COLUMNS])


def register_mart(spark: SparkSession, base: str, database: str | None = None) -> list[str]:
    """Make the mart's tables known to SQL; returns their names.

    With a database they become external tables in the catalog, which outlive the session; without
    one they are temporary views. Registering again shows what has been written since, and another
    ``base`` takes the place of the former one.
    """
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        create_once(spark, f"{base}/{REGISTERED}/{database}", database)
    names = []
    for name, (folder, schema) in SERVED.items():
        location = f"{base}/{folder}"
        rows = read_table(spark, location, schema)
        if rows is None:
            continue
        if database is None:
            rows.createOrReplaceTempView(name)
        else:
            name = _external_table(spark, f"{database}.{name}", location, schema, PARTITIONS.get(name, ()))
        names.append(name)
    return names


def refresh_served(spark: SparkSession, base: str) -> None:
    """Show what has been written below ``base`` in this session's views and in catalog tables over it.

    Only the databases in which ``register_mart`` has put this mart are asked.
    """
    for table in spark.catalog.listTables():
        if table.isTemporary and table.name in SERVED:
            spark.catalog.refreshTable(table.name)
            _follow_manifest(spark, table.name, base)
    for database in file_names(spark, f"{base}/{REGISTERED}"):
        for name, (folder, _) in SERVED.items():
            full = f"{database}.{name}"
            if _stored_location(spark, full) == qualified(spark, f"{base}/{folder}"):
                _show_new_files(spark, full, PARTITIONS.get(name, ()))


def _follow_manifest(spark: SparkSession, name: str, base: str) -> None:
    """Let a view over a compacted table of this mart read what is live now."""
    folder, schema = SERVED[name]
    location = f"{base}/{folder}"
    if name in LAYOUTS and read_manifest(spark, location) is not None:
        root = local_name(qualified(spark, location))
        if any(local_name(file).startswith(f"{root}/") for file in spark.table(name).inputFiles()):
            read_table(spark, location, schema).createOrReplaceTempView(name)


def local_name(path: str) -> str:
    """A qualified path with its scheme in one spelling: file:/a and file:///a are the same."""
    return re.sub(r"^file:/+", "file:/", path)


def register_exports(spark: SparkSession, base: str, database: str) -> list[str]:
    """External tables over the exported CSV files, headers skipped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return [
        _external_table(spark, f"{database}.{name}", f"{base}/export/{name}", exported_schema(schema), fmt="csv")
        for name, (_, schema) in SERVED.items()
        if path_exists(spark, f"{base}/export/{name}")
    ]


def _external_table(
    spark: SparkSession, name: str, location: str, schema: T.StructType, partitions: Sequence[str] = (),
    fmt: str = "parquet",
) -> str:
    """An external table over a folder. One of that name over another folder is replaced; its files stay."""
    if _stored_location(spark, name) not in (None, qualified(spark, location)):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} exists and is not an external table")
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
    header = "OPTIONS (header 'true')" if fmt == "csv" else ""
    partitioned = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} {header} {partitioned} LOCATION '{location}'"
    )
    _show_new_files(spark, name, partitions)
    return name


def _stored_location(spark: SparkSession, name: str) -> str | None:
    """The folder of a catalog table, None without such a table."""
    if not spark.catalog.tableExists(name):
        return None
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return row and qualified(spark, row["data_type"])


def _show_new_files(spark: SparkSession, name: str, partitions: Sequence[str]) -> None:
    if partitions:
        location, layout = _stored_location(spark, name), LAYOUTS.get(name.rpartition(".")[2])
        manifest = read_manifest(spark, location) if layout else None
        if manifest is None:
            spark.catalog.recoverPartitions(name)
        else:
            _show_live(spark, name, location, manifest)
    spark.catalog.refreshTable(name)


def _show_live(spark: SparkSession, name: str, location: str, manifest: Manifest) -> None:
    """Partitions of a catalog table over a compacted one: those beyond its segments, and a segment's as one run.

    That run's number is minus its place in the order of segments ever made, so that it is nobody else's.
    """
    layout = manifest.layout
    columns = (layout.number, *layout.kept)
    wanted = live_partitions(spark, location, layout, manifest, below=True)
    for segment in manifest.segments:
        for values, folder in partition_folders(spark, segment_folder(location, segment["name"]), layout.kept).items():
            wanted[(str(-segment["made"]), *values)] = folder
    shown = {
        tuple(part.partition("=")[2] for part in row[0].split("/")) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()
    }

    def spec(values: tuple[str, ...]) -> str:
        return f"PARTITION ({', '.join(f'{column} = {value}' for column, value in zip(columns, values))})"

    if gone := sorted(shown - wanted.keys()):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(spec, gone))}")
    if new := sorted(wanted.keys() - shown):
        added = " ".join(f"{spec(values)} LOCATION '{wanted[values]}'" for values in new)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")


# A quoted text, a comment, or a statement's end, whichever comes first.
_TOKEN = re.compile(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;""", re.DOTALL)


def split_statements(text: str) -> list[str]:
    """The statements of a script; semicolons inside quotes and comments do not count.

    A piece that holds nothing but comments is no statement.
    """
    ends = [match.start() for match in _TOKEN.finditer(text) if match.group() == ";"]
    starts = [0] + [end + 1 for end in ends]
    pieces = [text[start:end].strip() for start, end in zip(starts, ends + [len(text)])]
    return [piece for piece in pieces if _without_comments(piece)]


def _without_comments(statement: str) -> str:
    return _TOKEN.sub(lambda token: " " if token.group().startswith(("--", "/*")) else token.group(), statement).strip()


# Statements that change nothing a pending result could read.
_READING = re.compile(r"[(\s]*(SELECT|VALUES|TABLE|USE|SHOW|DESC|DESCRIBE|EXPLAIN)\b", re.IGNORECASE)


def run_sql_script(spark: SparkSession, text: str) -> list[DataFrame]:
    """One result per statement, each as of its place in the script.

    Results are lazy until a statement follows that may change something; then those before it are set down
    below the shared folder. Commands run at once.
    """
    results, pending = [], []
    for statement in split_statements(text):
        if not _READING.match(_without_comments(statement)):
            for k in pending:
                results[k] = set_down(results[k])
            pending = []
        result = spark.sql(statement)
        if result.columns:
            pending.append(len(results))
        results.append(result)
    return results


def export_csv(rows: DataFrame, path: str, single_file: bool = False) -> int:
    """Write a headed CSV folder and return its row count, taken while writing.

    ``single_file`` sends everything through one task: for dimensions and results only.
    """
    counted = Observation()
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").option("header", True).csv(path)
    return counted.get["rows"]


def export_mart(spark: SparkSession, base: str) -> dict[str, int]:
    """Export every table of the mart below ``base``/export; those of a fixed size as one file each."""
    counts = {}
    for name, (folder, schema) in SERVED.items():
        rows = read_table(spark, f"{base}/{folder}", schema)
        if rows is not None:
            exported = rows.drop(*INTERNAL_COLUMNS)
            with small_tasks(spark):
                counts[name] = export_csv(exported, f"{base}/export/{name}", single_file=name in SINGLE_FILES)
    return counts
