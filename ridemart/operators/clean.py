"""Cleaning: which rides are valid, why others are not, and the Silver shape. Batch or stream."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ridemart.functions.geo import geo_cell
from ridemart.functions.ride import duration_seconds
from ridemart.operators.incremental import dedup_first
from ridemart.schemas import RAW, RECORD

COORDINATES = ("start_lat", "start_lon", "end_lat", "end_lon")
CellFunction = Callable[[Column, Column], Column]


def is_valid() -> Column:
    """A ride has an id, ends strictly after it starts and has all four coordinates.

    Written as a plain conjunction, so that the null checks reach the scan.
    """
    condition = F.col("trip_id").isNotNull() & (F.col("end_time") > F.col("start_time"))
    for name in COORDINATES:
        condition = condition & F.col(name).isNotNull()
    return condition


def reject_reason() -> Column:
    """The first rule a ride breaks, NULL for a valid ride."""
    start, end = F.col("start_time"), F.col("end_time")
    missing_coordinate = F.lit(False)
    for name in COORDINATES:
        missing_coordinate = missing_coordinate | F.col(name).isNull()
    return (
        F.when(F.col("trip_id").isNull(), F.lit("no trip id"))
        .when(start.isNull() | end.isNull(), F.lit("no time"))
        .when(end <= start, F.lit("end not after start"))
        .when(missing_coordinate, F.lit("no coordinate"))
    )


def split_valid_rejects(rides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rides, and the others with their ``reject_reason``, and with their record if they carry it."""
    record = [name for name in RECORD.names if name in rides.columns]
    rejects = rides.select(*RAW.names, reject_reason().alias("reject_reason"), *record)
    return rides.filter(is_valid()), rejects.filter(F.col("reject_reason").isNotNull())


def clean_rides(rides: DataFrame, cell_fn: CellFunction = geo_cell) -> DataFrame:
    """Valid rides in Silver shape: a grid cell for each end, and the duration.

    ``cell_fn`` maps a latitude and a longitude column to a cell column, so that another grid can be
    plugged in, as native expressions or as a ``pandas_udf``.
    """
    return _silver_columns(rides.filter(is_valid()), cell_fn)


def clean_first_rides(rides: DataFrame, cell_fn: CellFunction = geo_cell) -> DataFrame:
    """``clean_rides`` with one ride per id: the earliest start wins, then the earliest end.

    The choice comes first, on the raw numbers: they are narrower in the shuffle than cells, and no
    cell is computed for a ride that goes.
    """
    valid = rides.filter(is_valid()).select(*[name for name in RAW.names if name != "distance"])
    return _silver_columns(dedup_first(valid, ["trip_id"], ["start_time", "end_time"]), cell_fn)


def _silver_columns(rides: DataFrame, cell_fn: CellFunction) -> DataFrame:
    return rides.select(
        "trip_id",
        "start_time",
        cell_fn(F.col("start_lat"), F.col("start_lon")).alias("start_geo_hash"),
        cell_fn(F.col("end_lat"), F.col("end_lon")).alias("end_geo_hash"),
        duration_seconds(F.col("start_time"), F.col("end_time")).alias("trip_duration_sec"),
    )
