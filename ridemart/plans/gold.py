"""The star schema: a trip fact and four dimensions, extended with new keys only."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ridemart.functions import ride
from ridemart.functions.geo import DISTRICT_LEVEL, REGION_LEVEL, cell_lat, cell_lon, cell_parent
from ridemart.operators.incremental import dedup_first, distinct_keys, write_new
from ridemart.schemas import (
    BANDS, BUCKET_TABLE, DATE_TABLE, DIM_DURATION_BUCKET, FACT_STORED, FACT_TABLE, GEOGRAPHY_TABLE,
    RUN_PROGRESS, SILVER, STAR_TABLES, TIME_TABLE, UNIFIED,
)
from ridemart.operators.star import note_grid
from ridemart.session import small_tasks
from ridemart.sources.commits import Lease, TableBusy, grow_table, leased
from ridemart.sources.live import FACT_RUNS, RUNS, live_partitions, read_manifest, read_runs
from ridemart.sources.tables import constant_rows, new_rows_only, read_ledger, replace_partitions, seed_table

PROGRESS_TABLE = "loaded_runs"
FACT_PARTITIONS = ("run_id", "month_key")
CellDescription = Callable[[DataFrame], DataFrame]


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        hour.alias("time_key"),
        hour.alias("hour"),
        F.lit(0).alias("minute"),
        ride.period(hour).alias("period"),
        ride.is_rush_hour(hour).alias("is_rush_hour"),
    )


def dim_duration_bucket(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, BANDS, DIM_DURATION_BUCKET)


def fact_columns(silver: DataFrame) -> DataFrame:
    """Silver rides at fact grain: foreign keys, the additive count and the same-cell flag."""
    start = F.col("start_time")
    return silver.withColumns({
        "date_key": ride.date_key(start),
        "time_key": F.hour(start),
        "start_geo_key": F.col("start_geo_hash"),
        "end_geo_key": F.col("end_geo_hash"),
        "duration_bucket_key": ride.band_key(F.col("trip_duration_sec")),
        "trip_count": F.lit(1),
        "is_same_cell": ride.flag(F.col("start_geo_hash") == F.col("end_geo_hash")),
    })


def date_attributes(keys: DataFrame) -> DataFrame:
    """dim_date rows for distinct ``date_key`` values."""
    day = F.col("full_date")
    return keys.select("date_key", ride.date_of_key(F.col("date_key")).alias("full_date")).select(
        "date_key",
        "full_date",
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).alias("day_of_week"),
        ride.is_weekend(day).alias("is_weekend"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    )


def cell_attributes(cells: DataFrame) -> DataFrame:
    """dim_geography rows for distinct ``geo_hash`` values."""
    cell = F.col("geo_hash")
    return cells.select(
        "geo_hash",
        cell_lat(cell).alias("lat"),
        cell_lon(cell).alias("lon"),
        cell_parent(cell, REGION_LEVEL).alias("parent_geo_res6"),
        cell_parent(cell, DISTRICT_LEVEL).alias("parent_geo_res5"),
    )


def dates_of(fact: DataFrame) -> DataFrame:
    return distinct_keys(fact, "date_key", name="date_key")


def cells_of(fact: DataFrame) -> DataFrame:
    return distinct_keys(fact, "start_geo_key", "end_geo_key", name="geo_hash")


def new_dates(fact: DataFrame, stored: DataFrame | None) -> DataFrame:
    """dim_date rows for the dates that are not in ``stored``."""
    keys = dates_of(fact)
    return date_attributes(keys if stored is None else new_rows_only(keys, stored, ["date_key"]))


def new_cells(
    fact: DataFrame, stored: DataFrame | None, describe_cells: CellDescription = cell_attributes,
) -> DataFrame:
    """dim_geography rows for the cells that are not in ``stored``."""
    keys = cells_of(fact)
    return describe_cells(keys if stored is None else new_rows_only(keys, stored, ["geo_hash"]))


def build_gold(
    spark: SparkSession, unified: str, gold: str, unique: bool = False,
    describe_cells: CellDescription = cell_attributes,
) -> int:
    """Load the unified runs that the star does not hold yet; returns the number of trips added.

    A unified run never changes, and a trip keeps its run number in the fact's partitions, so a
    repeated load replaces what a crashed one left behind. Say ``unique`` when ``unified`` holds one
    row per trip id across all its runs, as ``union_silver`` makes sure; the load is then a single
    pass without a join against the fact's history. A grid plugged in by ``cell_fn`` brings its own
    ``describe_cells``, from ``geo_hash`` values to dim_geography rows.

    A star whose cells' regions are not those of the built-in grid is noted as such, so that ``load_star`` knows
    where its regions come from.

    Loads may overlap. Each takes the runs that no other one has claimed, by a lease that ends with its
    heartbeat, and the dimensions grow by published versions, so every key is there once. Loads that are not
    ``unique`` look at each other's ids, so the second of two raises TableBusy.
    """
    with leased(spark, f"{gold}/_claims") as lease, small_tasks(spark):
        return _build_gold(spark, unified, gold, unique, describe_cells, lease)


def _build_gold(
    spark: SparkSession, unified: str, gold: str, unique: bool, describe_cells: CellDescription, lease: Lease,
) -> int:
    if lease.claim("seeds"):
        seed_table(dim_time(spark), f"{gold}/{TIME_TABLE}")
        seed_table(dim_duration_bucket(spark), f"{gold}/{BUCKET_TABLE}")
    if not unique and not lease.claim("ids"):
        raise TableBusy(f"another load is looking for known ids in {gold}")

    manifest = read_manifest(spark, unified)
    present = {int(run) for (run,) in live_partitions(spark, unified, RUNS, manifest)}
    present.update(range(1, manifest.through + 1) if manifest else ())
    claimed = {run for run in sorted(present - loaded_runs(spark, gold)) if lease.claim(f"run-{run}")}
    # The ledger is read again after the claims: what another load has let go of is in it by then.
    runs = claimed - loaded_runs(spark, gold) if claimed else set()
    pending = read_runs(spark, unified, UNIFIED, runs.__contains__) if runs else None
    if pending is None:
        return 0
    pending = pending.filter(F.col("trip_id").isNotNull())

    fact_path = f"{gold}/{FACT_TABLE}"
    fresh, stored = pending, None
    if not unique:
        fresh = dedup_first(pending, ["trip_id"], ["run_id", "start_time", "trip_duration_sec"])
        stored = read_fact_runs(spark, fact_path, lambda run: run not in runs)
    lease.check()
    added = write_new(
        fresh, stored, "trip_id", lambda rows: write_fact(rows, fact_path), raw=pending,
    )
    if added:
        # The dimensions' keys come from the columns just written: narrow, encoded, already unique.
        written = read_fact_runs(spark, fact_path, lambda run: run in runs)
        extend_dimension(spark, gold, DATE_TABLE, written, new_dates)
        extend_dimension(
            spark, gold, GEOGRAPHY_TABLE, written, partial(new_cells, describe_cells=describe_cells),
        )
        note_grid(spark, gold)
    lease.check()
    done = constant_rows(spark, [(run,) for run in sorted(runs)], RUN_PROGRESS)
    _grow(spark, gold, PROGRESS_TABLE, RUN_PROGRESS, lambda known: done)
    return added


def loaded_runs(spark: SparkSession, gold: str) -> set[int]:
    return {row["run_id"] for row in read_ledger(spark, f"{gold}/{PROGRESS_TABLE}", RUN_PROGRESS).collect()}


def _grow(
    spark: SparkSession, gold: str, name: str, schema: T.StructType, new_rows: Callable[[DataFrame | None], DataFrame],
) -> int:
    return grow_table(spark, f"{gold}/{name}", f"{gold}/_commits/{name}", schema, new_rows)


def read_fact_runs(spark: SparkSession, path: str, wanted: Callable[[int], bool]) -> DataFrame | None:
    """The stored fact rows of some runs, None when there are none. Other runs' files are not listed."""
    return read_runs(spark, path, FACT_STORED, wanted, FACT_RUNS)


def write_fact(silver: DataFrame, path: str) -> int:
    """Store the fact rows of unified rides by run and month, in date order inside each file.

    The rebalance brings a month's rows together and lets AQE cut a month that holds far more rows
    than others into several tasks; date order lets a date filter skip row groups. The rides move as they are,
    and the fact's other columns are added where they arrive.
    """
    day = ride.date_key(F.col("start_time"))
    rows = silver.select(*SILVER.names, "run_id", day.alias("date_key"), ride.month_key_of(day).alias("month_key"))
    rows = rows.hint("rebalance", *FACT_PARTITIONS).sortWithinPartitions(*FACT_PARTITIONS, "date_key")
    return replace_partitions(fact_columns(rows).select(*FACT_STORED.names), path, FACT_PARTITIONS)


def extend_dimension(
    spark: SparkSession, gold: str, name: str, fact: DataFrame,
    new_rows: Callable[[DataFrame, DataFrame | None], DataFrame],
) -> int:
    """Add the rows that a dimension lacks for these facts; what an overlapping load adds meanwhile counts as there."""
    return _grow(spark, gold, name, STAR_TABLES[name], lambda stored: new_rows(fact, stored))
