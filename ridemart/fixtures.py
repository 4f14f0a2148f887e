"""Raw rides derived from the test tables, for tests, queries and benchmarks."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ridemart.schemas import RAW

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _grid(number: Column, factor: int, origin: float, step: float) -> Column:
    return F.lit(origin) + ((number * F.lit(factor)) % 1000).cast("double") * F.lit(step)


def _coordinates(a: Column, b: Column, c: Column, d: Column) -> dict[str, Column]:
    """Points in a box of 0.35 by 0.30 degrees."""
    return {
        "start_lat": _grid(a, 7919, 40.55, 0.00035),
        "start_lon": _grid(b, 6101, -74.05, 0.0003),
        "end_lat": _grid(c, 3571, 40.55, 0.00035),
        "end_lon": _grid(d, 2741, -74.05, 0.0003),
    }


def _after(start: Column, seconds: Column) -> Column:
    return start + F.expr("INTERVAL '1' SECOND") * seconds.cast("bigint")


def _whole_second(ts: Column) -> Column:
    midnight = ts.cast("date").cast("timestamp_ntz")
    return _after(midnight, F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def rides_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides with repeated ids, zero and negative lengths, and missing coordinates."""
    number, user = F.col("event_id"), F.col("user_id")
    start = _whole_second(F.col("ts"))
    seconds = F.floor(F.col("value") * 60) + 1
    points = _coordinates(user, number, number % 97, user + number % 13)
    end = (
        F.when(number % 61 == 0, start)
        .when(number % 67 == 0, _after(start, -seconds))
        .otherwise(_after(start, seconds))
    )
    points["start_lat"] = F.when(number % 53 != 0, points["start_lat"])
    points["end_lon"] = F.when(number % 59 != 0, points["end_lon"])
    repeated = F.when(number % 10 == 9, 1).otherwise(0)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("E"), (number - repeated).cast("string")).alias("trip_id"),
        *[column.alias(name) for name, column in points.items()],
        start.alias("start_time"),
        end.alias("end_time"),
        F.col("value").alias("distance"),
    ).select(*RAW.names)


def ride_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event rides as CSV lines (value), some short, some too long, with text for a number, or without an id.

    Coordinates have five decimals, which holds all of them exactly. ``start_time`` says when a line arrives.
    """
    rides = rides_events(spark, sf_dir)
    number = F.substring("trip_id", 2, 20).cast("bigint")
    fixed = {name: F.coalesce(F.col(name).cast("decimal(12,5)").cast("string"), F.lit("")) for name in RAW.names[1:5]}
    fixed["start_lat"] = F.when(number % 79 == 0, F.lit("zz")).otherwise(fixed["start_lat"])
    name = F.when(number % 83 == 0, F.lit("")).otherwise(F.col("trip_id"))
    times = [F.date_format(column, "yyyy-MM-dd HH:mm:ss") for column in ("start_time", "end_time")]
    first = [name, fixed["start_lat"], fixed["start_lon"]]
    rest = [fixed["end_lat"], fixed["end_lon"], *times, F.col("distance").cast("decimal(12,2)").cast("string")]
    whole = F.concat_ws(",", *first, *rest)
    line = F.when(number % 71 == 0, F.concat_ws(",", *first)).when(number % 73 == 0, F.concat(whole, F.lit(",more,")))
    return rides.select(line.otherwise(whole).alias("value"), "start_time")


def rides_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of rides with naturally repeated ids."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    start = _after(F.col("o_orderdate"), (part * 37 + supplier * 101) % 86400)
    seconds = (part * 13 + line * 97 + F.floor("l_extendedprice")) % 5400
    points = _coordinates(supplier, part, part % 89, supplier + line)
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"),
    )
    return joined.select(
        F.concat(F.lit("O"), order.cast("string"), F.lit("-"), line.cast("string")).alias("trip_id"),
        *[column.alias(name) for name, column in points.items()],
        start.alias("start_time"),
        _after(start, seconds).alias("end_time"),
        F.col("l_quantity").alias("distance"),
    ).select(*RAW.names)
