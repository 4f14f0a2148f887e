"""The dashboard's questions, each one a function of the star."""

from pyspark.sql import DataFrame, functions as F

from ridemart.functions.ride import route_region
from ridemart.operators import star as ops
from ridemart.operators.star import OWN_GRID, RegionFunction, Star

TRIPS = "total_trips"
ROUND = 6


def _trips(rolled: DataFrame, *keys: str) -> DataFrame:
    return rolled.groupBy(*keys).agg(ops.total_trips().alias(TRIPS))


def _with_share(trips: DataFrame) -> DataFrame:
    return trips.withColumn("share", F.round(ops.share_of_total(TRIPS), ROUND))


# --- cards ---

def total_trips(star: Star) -> DataFrame:
    return ops.rollup(star.fact).agg(ops.total_trips().alias(TRIPS))


def avg_duration_min(star: Star) -> DataFrame:
    return ops.rollup(star.fact).agg(F.round(ops.avg_duration_min(), ROUND).alias("avg_duration_min"))


def pct_same_region(star: Star) -> DataFrame:
    return ops.rollup(star.fact).agg(F.round(ops.pct_same_region(), ROUND).alias("pct_same_region"))


def pct_same_region_res6(star: Star, region: RegionFunction | str = OWN_GRID) -> DataFrame:
    """Share of trips that start and end in one region, one level up from the cell."""
    same = ops.by_region(star, "start", "end", name="same", region=region, label=lambda a, b: a == b)
    share = F.sum(F.when(F.col("same"), F.col("trips")).otherwise(0)) / F.sum("trips")
    return same.agg(F.round(share, ROUND).alias("pct_same_region_res6"))


# --- one attribute ---

def trips_by_day_name(star: Star) -> DataFrame:
    return _trips(ops.by_attributes(star.fact, star.date, "date_key", "day_name"), "day_name")


def trips_by_month(star: Star) -> DataFrame:
    """By month name, so the same month of different years counts together; most trips first."""
    months = ops.by_attributes(star.fact, star.date, "date_key", "month_name")
    return _trips(months, "month_name").orderBy(F.desc(TRIPS), "month_name")


def trips_by_day_type(star: Star) -> DataFrame:
    types = ops.by_attributes(star.fact, star.date, "date_key", "day_type")
    return _with_share(_trips(types, "day_type")).orderBy(F.desc(TRIPS), "day_type")


def trips_by_hour(star: Star) -> DataFrame:
    hours = ops.by_attributes(star.fact, star.time, "time_key", "hour")
    return _trips(hours, "hour").orderBy(F.desc(TRIPS), "hour")


def trips_by_rush(star: Star) -> DataFrame:
    labels = ops.by_attributes(star.fact, star.time, "time_key", "rush_label")
    return _with_share(_trips(labels, "rush_label"))


def trips_by_bucket(star: Star) -> DataFrame:
    labels = ops.by_attributes(star.fact, star.bucket, "duration_bucket_key", "bucket_label")
    return _with_share(_trips(labels, "bucket_label"))


def avg_duration_by_bucket(star: Star) -> DataFrame:
    labels = ops.by_attributes(star.fact, star.bucket, "duration_bucket_key", "bucket_label")
    average = F.round(ops.avg_duration_min(), ROUND).alias("avg_duration_min")
    return labels.groupBy("bucket_label").agg(average)


def trips_by_start_cell(star: Star) -> DataFrame:
    """Bubble map: trips per centroid of the start cell."""
    cells = ops.with_geography(ops.rollup(star.fact, "start_geo_key"), star, "start", "start_lat", "start_lon")
    return _trips(cells, "start_lon", "start_lat")


# --- top 10 ---

def top_regions(
    star: Star, end: str, n: int = 10, region: RegionFunction | str = None, ties: str = "key",
) -> DataFrame:
    name = f"{end}_region"
    trips = _trips(ops.by_region(star, end, name=name, region=region), name)
    return ops.top_n(trips, TRIPS, n, tie_break=[name], ties=ties)


def top_start_regions(star: Star, **options) -> DataFrame:
    return top_regions(star, "start", **options)


def top_end_regions(star: Star, **options) -> DataFrame:
    return top_regions(star, "end", **options)


def top_routes(star: Star, n: int = 10, region: RegionFunction | str = OWN_GRID) -> DataFrame:
    """The busiest routes between regions, listed by route."""
    routes = ops.by_region(star, "start", "end", name="route_region", region=region, label=route_region)
    best = ops.top_n(_trips(routes, "route_region"), TRIPS, n, tie_break=["route_region"])
    return best.orderBy("route_region")


# --- day by hour ---

def pivot_day_hour(star: Star) -> DataFrame:
    return ops.pivot_hours(ops.day_by_hour(star))


def pivot_totals(star: Star) -> DataFrame:
    """The pivot's cells with row, column and grand totals; level 0 cell, 1 row, 2 column, 3 grand."""
    cube = ops.day_by_hour(star).cube("day_name", "hour")
    return cube.agg(F.grouping_id().cast("int").alias("level"), ops.total_trips().alias(TRIPS))


def heat_intensity(star: Star) -> DataFrame:
    heat = ops.heat_intensity(pivot_day_hour(star))
    return heat.withColumn("intensity", F.round("intensity", ROUND))


# --- slices ---

def sliced_trips(star: Star, conditions: ops.Conditions, *by: str) -> DataFrame:
    """Trips by any attributes under any conditions, such as a chosen bar filtering other charts."""
    average = F.round(ops.avg_duration_min(), ROUND).alias("avg_duration_min")
    return ops.slice_fact(star, conditions, *by).groupBy(*by).agg(ops.total_trips().alias(TRIPS), average)
