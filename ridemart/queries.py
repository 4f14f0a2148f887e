"""The registered queries: each takes a session and a folder of test tables and gives a DataFrame."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ridemart import fixtures
from ridemart.functions import geo, ride
from ridemart.functions.geo import DISTRICT_LEVEL, REGION_LEVEL
from ridemart.operators import clean, incremental, serve, star as star_ops
from ridemart.operators.ranges import join_ranges
from ridemart.operators.star import Star, load_star
from ridemart.plans import gold, report, silver
from ridemart.plans.mart import MartPaths, compact_mart, refresh_mart
from ridemart.schemas import DIM_DATE, DIM_GEOGRAPHY, FACT, FEED, METRICS, RAW, REJECTS, SILVER, UNIFIED
from ridemart.session import new_folder, small_tasks
from ridemart.sources import rides as ride_sources
from ridemart.sources.tables import append_ledger, new_rows_only, read_table
from ridemart.streaming.feeds import Feed, await_feed, land_rides, merge_new, start_feed

Query = Callable[[SparkSession, str], DataFrame]

# The two feeds of the event rides overlap on one day.
BATCH_FEED_BEFORE = "2024-01-24"
STREAM_FEED_FROM = "2024-01-23"
# Arrival order inside each feed: rides before the first day, up to the second, and so on.
BATCH_ARRIVALS = ("2024-01-08", "2024-01-16")
STREAM_ARRIVALS = ("2024-01-27",)
# Ten files that a stream takes one at a time.
CAPPED_ARRIVALS = tuple(f"2024-01-{day:02d}" for day in range(4, 31, 3))


def _since(day: str | None):
    return F.lit(True) if day is None else F.col("start_time") >= F.lit(day).cast("timestamp_ntz")


def _before(day: str | None):
    return F.lit(True) if day is None else F.col("start_time") < F.lit(day).cast("timestamp_ntz")


def batch_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.rides_events(spark, sf_dir).filter(_before(BATCH_FEED_BEFORE))


def stream_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.rides_events(spark, sf_dir).filter(_since(STREAM_FEED_FROM))


# --- parsing and cleaning ---

def parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ride_sources.parse_ride_lines(ride_sources.to_csv_lines(fixtures.rides_events(spark, sf_dir)))


def valid_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.rides_events(spark, sf_dir).filter(clean.is_valid())


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = clean.split_valid_rejects(fixtures.rides_events(spark, sf_dir))
    return rejects.select("trip_id", "start_time", "end_time", "reject_reason")


def ride_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = ride.duration_seconds(F.col("start_time"), F.col("end_time"))
    return fixtures.rides_orders(spark, sf_dir).select(
        "trip_id", "start_time", seconds.alias("trip_duration_sec"),
        ride.band_key(seconds).alias("duration_bucket_key"),
    )


def silver_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_rides(fixtures.rides_events(spark, sf_dir))


# --- grid cells ---

def geo_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("start_lat"), F.col("start_lon")
    return fixtures.rides_events(spark, sf_dir).select(
        *start,
        geo.geo_cell(*start).alias("cell"),
        geo.geo_cell(*start, REGION_LEVEL).alias("region_cell"),
        geo.geo_cell(*start, DISTRICT_LEVEL).alias("district_cell"),
    )


def cell_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("geo_hash")
    return _orders_cells(spark, sf_dir).select(
        cell, geo.cell_lat(cell).alias("lat"), geo.cell_lon(cell).alias("lon"),
    )


def cell_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("geo_hash")
    return _orders_cells(spark, sf_dir).select(
        cell,
        geo.cell_parent(cell, REGION_LEVEL).alias("parent_geo_res6"),
        geo.cell_parent(cell, DISTRICT_LEVEL).alias("parent_geo_res5"),
    )


def _orders_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = clean.clean_rides(fixtures.rides_orders(spark, sf_dir))
    return incremental.distinct_keys(rides, "start_geo_hash", "end_geo_hash", name="geo_hash")


# --- incremental steps ---

def dedup_first_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_first_rides(fixtures.rides_orders(spark, sf_dir))


def new_trips_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream feed's rides whose ids the batch feed does not have."""
    stored = clean.clean_rides(batch_feed(spark, sf_dir))
    return new_rows_only(clean.clean_first_rides(stream_feed(spark, sf_dir)), stored, ["trip_id"])


def new_trips_small_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by sending the batch's keys to the stored rides, when their measured size allows."""
    raw = stream_feed(spark, sf_dir).filter(clean.is_valid())
    stored = clean.clean_rides(batch_feed(spark, sf_dir))
    fits = incremental.measure_keys(raw, "trip_id").fits_broadcast
    wanted = raw if fits else incremental.distinct_keys(raw, "trip_id", name="trip_id")
    seen = incremental.seen_keys(stored, wanted, "trip_id", broadcast=fits)
    return new_rows_only(clean.clean_first_rides(raw), seen, ["trip_id"])


def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = [("batch", batch_feed), ("stream", stream_feed)]
    origin = {"batch_id": F.lit(0).cast("bigint")}
    rows = [
        clean.clean_rides(feed(spark, sf_dir)).withColumns(origin | {"source": F.lit(source)})
        for source, feed in feeds
    ]
    return silver.merge_feeds(silver.union_feeds(rows)).select(*SILVER.names, "source")


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides from the CSV files that arrived after the manifest was written."""
    folder = new_folder(spark, "new-files")
    files, manifest = f"{folder}/in", f"{folder}/manifest"
    rides = fixtures.rides_events(spark, sf_dir)
    _write_ride_files(rides.filter(_before(STREAM_FEED_FROM)), files)
    append_ledger(ride_sources.new_files_only(spark, files, manifest), manifest)
    _write_ride_files(rides.filter(_since(STREAM_FEED_FROM)), files)
    paths = [row["path"] for row in ride_sources.new_files_only(spark, files, manifest).collect()]
    return ride_sources.read_ride_files(spark, *paths)


def _write_ride_files(rides: DataFrame, path: str) -> None:
    rides.write.mode("append").option("header", True).csv(path)


def _write_one_file(rides: DataFrame, path: str) -> None:
    """Rides as one more file: every task reads and picks its share of the table, and only what it picked goes to the writer."""
    _write_ride_files(rides.repartition(1), path)


# --- the star, step by step ---

def _orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_columns(clean.clean_first_rides(fixtures.rides_orders(spark, sf_dir)))


def fact_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_fact(spark, sf_dir).select(*FACT.names)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.new_dates(stored_star(spark, sf_dir).fact, None)


def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.new_cells(stored_star(spark, sf_dir).fact, None)


def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours of the day with the rides that start in each."""
    hours = F.hour("start_time").alias("time_key")
    rides = fixtures.rides_events(spark, sf_dir).groupBy(hours).agg(F.count(F.lit(1)).alias("rides"))
    joined = gold.dim_time(spark).join(rides, "time_key", "left")
    return joined.withColumn("rides", F.coalesce("rides", F.lit(0)))


def dim_duration_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The duration bands with the rides in each."""
    rides = clean.clean_rides(fixtures.rides_events(spark, sf_dir))
    band = ride.band_key(F.col("trip_duration_sec")).alias("duration_bucket_key")
    counted = rides.groupBy(band).agg(F.count(F.lit(1)).alias("rides"))
    joined = gold.dim_duration_bucket(spark).join(counted, "duration_bucket_key", "left")
    return joined.withColumn("rides", F.coalesce("rides", F.lit(0)))


def band_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band of each ride by joining the band table on its range, next to the derived CASE."""
    rides = clean.clean_rides(fixtures.rides_orders(spark, sf_dir))
    seconds = F.col("trip_duration_sec")
    bands = F.broadcast(gold.dim_duration_bucket(spark))
    inside = ride.in_band(seconds, F.col("min_seconds"), F.col("max_seconds"))
    joined = rides.select(seconds, ride.band_key(seconds).alias("case_key")).join(bands, inside, "left")
    return joined.groupBy("bucket_label", "duration_bucket_key", "case_key").agg(
        F.count(F.lit(1)).alias("rides"),
    )


def _arrived_fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Facts of the rides known before the stream feed began, and of the stream feed."""
    rides = fixtures.rides_events(spark, sf_dir)
    known = clean.clean_first_rides(rides.filter(_before(STREAM_FEED_FROM)))
    return gold.fact_columns(known), gold.fact_columns(clean.clean_first_rides(rides.filter(_since(STREAM_FEED_FROM))))


def new_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, arrived = _arrived_fact(spark, sf_dir)
    return gold.new_dates(arrived, gold.new_dates(known, None))


def new_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, arrived = _arrived_fact(spark, sf_dir)
    return gold.new_cells(arrived, gold.new_cells(known, None))


# --- questions over the stored star ---

_marts: dict[tuple[str, str], MartPaths] = {}
_stars: dict[tuple[str, str], Star] = {}


def build_mart(spark: SparkSession, sf_dir: str) -> MartPaths:
    """Bring the order rides through all layers into stored tables under the shared folder."""
    paths = MartPaths(new_folder(spark, "mart"))
    rides = fixtures.rides_orders(spark, sf_dir)
    with small_tasks(spark):
        merge_new(rides, 0, paths.feed("orders", audit=False, dedup="union"), persist=False)
    refresh_mart(spark, paths)
    return paths


def stored_mart(spark: SparkSession, sf_dir: str) -> MartPaths:
    """The mart of a folder of test tables, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        _marts[key] = build_mart(spark, sf_dir)
    return _marts[key]


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """Its star, whose file listings are kept for all questions."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = load_star(spark, stored_mart(spark, sf_dir).gold)
    return _stars[key]


def _question(ask: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: ask(stored_star(spark, sf_dir))


def slice_weekend_rush(star: Star) -> DataFrame:
    chosen = {"day_type": ["Weekend"], "rush_label": ["Rush Hour"], "year": (">=", 1998)}
    return report.sliced_trips(star, chosen, "bucket_label")


def slice_places(star: Star) -> DataFrame:
    """Rides from west of a meridian to north of a parallel, by hour."""
    return report.sliced_trips(star, {"start_lon": ("<", -73.9), "end_lat": (">=", 40.7)}, "hour")


def slice_wide(star: Star) -> DataFrame:
    """A free-form question: rides that stay in their district, by year."""
    rows = star_ops.wide_sums(star, "start_district", "end_district", "year")
    rows = rows.filter(F.col("start_district") == F.col("end_district"))
    return rows.groupBy("year").agg(star_ops.total_trips().alias(report.TRIPS))


STORED_QUESTIONS = {
    "total_trips": report.total_trips,
    "avg_duration_min": report.avg_duration_min,
    "pct_same_region": report.pct_same_region,
    "pct_same_region_res6": report.pct_same_region_res6,
    "trips_by_day_name": report.trips_by_day_name,
    "trips_by_month": report.trips_by_month,
    "trips_by_day_type": report.trips_by_day_type,
    "trips_by_hour": report.trips_by_hour,
    "trips_by_rush": report.trips_by_rush,
    "trips_by_bucket": report.trips_by_bucket,
    "avg_duration_by_bucket": report.avg_duration_by_bucket,
    "trips_by_start_cell": report.trips_by_start_cell,
    "top_start_regions": report.top_start_regions,
    "top_start_regions_ties": lambda star: report.top_start_regions(star, ties="all"),
    "top_end_regions": report.top_end_regions,
    "top_routes": report.top_routes,
    "top_routes_role_join": lambda star: report.top_routes(star, region=None),
    "pivot_day_hour": report.pivot_day_hour,
    "pivot_totals": report.pivot_totals,
    "heat_intensity": report.heat_intensity,
    "slice_weekend_rush": slice_weekend_rush,
    "slice_places": slice_places,
    "slice_wide": slice_wide,
}


# --- a star that grew in two runs ---

_grown: dict[tuple[str, str], Star] = {}


def grown_star(spark: SparkSession, sf_dir: str) -> Star:
    """The event rides' star: the batch feed is loaded first, the stream feed in a second run."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _grown:
        paths = MartPaths(new_folder(spark, "grown"))
        merge_new(batch_feed(spark, sf_dir), 0, paths.feed("batch-1", audit=False))
        refresh_mart(spark, paths)
        merge_new(stream_feed(spark, sf_dir), 0, paths.feed("stream-1", stream=True, audit=False))
        refresh_mart(spark, paths)
        _grown[key] = load_star(spark, paths.gold)
    return _grown[key]


def fact_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grown_star(spark, sf_dir).fact.select(*FACT.names, "run_id")


def dim_date_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grown_star(spark, sf_dir).date.select(*DIM_DATE.names)


def dim_geography_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grown_star(spark, sf_dir).geography


def star_overlapping_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per key of a star that two overlapping loads have filled.

    The first load takes the rides before the stream feed began. While it looks for new cells, the stream feed, which
    shares days and cells, is merged and loaded by a second one.
    """
    paths = MartPaths(new_folder(spark, "overlap"))
    feeds = [paths.batch_output, paths.stream_output]
    second: list[int] = []

    def describe_cells(cells: DataFrame) -> DataFrame:
        if not second:
            second.append(0)
            merge_new(stream_feed(spark, sf_dir), 0, paths.feed("stream-1", stream=True, audit=False))
            silver.union_silver(spark, feeds, paths.unified, paths.unified_progress)
            second[0] = gold.build_gold(spark, paths.unified, paths.gold, unique=True)
        return gold.cell_attributes(cells)

    merge_new(batch_feed(spark, sf_dir), 0, paths.feed("batch-1", audit=False))
    silver.union_silver(spark, feeds, paths.unified, paths.unified_progress)
    gold.build_gold(spark, paths.unified, paths.gold, unique=True, describe_cells=describe_cells)
    star = load_star(spark, paths.gold)
    tables = [
        (star.fact, "fact_trip", F.col("trip_id")), (star.date, "dim_date", F.col("date_key").cast("string")),
        (star.geography, "dim_geography", F.col("geo_hash")),
    ]
    return silver.union_feeds([
        rows.groupBy(F.lit(name).alias("table_name"), key.alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
        for rows, name, key in tables
    ])


# --- serving ---

def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    serve.register_mart(spark, stored_mart(spark, sf_dir).base)
    results = serve.run_sql_script(spark, """
        SELECT COUNT(*) AS total_trips FROM gold_fact_trip;
        -- a comment; with a semicolon
        SELECT d.year, concat(t.period, ';') AS period, COUNT(*) AS total_trips
        FROM gold_fact_trip f
        JOIN gold_dim_date d ON f.date_key = d.date_key
        JOIN gold_dim_time t ON f.time_key = t.time_key
        GROUP BY d.year, t.period;
    """)
    return results[-1]


def count_all_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    serve.register_mart(spark, stored_mart(spark, sf_dir).base)
    return serve.run_sql_script(spark, "SELECT COUNT(*) AS total_trips FROM gold_fact_trip")[0]


def export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every exported table, counted in the exported files."""
    base = stored_mart(spark, sf_dir).base
    exported = serve.export_mart(spark, base)
    counts = [
        spark.read.option("header", True).csv(f"{base}/export/{name}")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in exported
    ]
    return silver.union_feeds(counts)


# --- streams ---

def _arrivals(rides: DataFrame, days: tuple[str, ...]) -> list[DataFrame]:
    """The rides in the order they arrive, cut at the given days. The cuts cover every ride."""
    bounds = [None, *days, None]
    return [rides.filter(_since(low) & _before(high)) for low, high in zip(bounds, bounds[1:])]


def _run_csv_feed(spark: SparkSession, rides: DataFrame, days: tuple[str, ...], feed: Feed, folder: str) -> None:
    """Let headed CSV files arrive; the query stops and restarts from its checkpoint in between."""
    for arrived in _arrivals(rides, days):
        _write_ride_files(arrived, f"{folder}/csv")
        files = ride_sources.stream_ride_files(spark, f"{folder}/csv", max_files=None)
        start_feed(files, feed, f"{folder}/csv-checkpoint", availableNow=True).awaitTermination()


def _run_line_feed(spark: SparkSession, rides: DataFrame, days: tuple[str, ...], feed: Feed, folder: str) -> None:
    """The same for messages, one CSV line each."""
    for arrived in _arrivals(rides, days):
        ride_sources.publish_rides(arrived, "text", path=f"{folder}/lines")
        lines = ride_sources.read_lines_stream(spark, "text", path=f"{folder}/lines")
        rides_stream = ride_sources.parse_ride_lines(lines)
        start_feed(rides_stream, feed, f"{folder}/lines-checkpoint", availableNow=True).awaitTermination()


def _run_both_feeds(spark: SparkSession, sf_dir: str) -> MartPaths:
    folder = new_folder(spark, "feeds")
    paths = MartPaths(f"{folder}/mart")
    batch, stream = paths.feed("batch-1"), paths.feed("stream-1", stream=True)
    _run_csv_feed(spark, batch_feed(spark, sf_dir), BATCH_ARRIVALS, batch, folder)
    _run_line_feed(spark, stream_feed(spark, sf_dir), STREAM_ARRIVALS, stream, folder)
    return paths


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds streamed into Silver, then unified."""
    paths = _run_both_feeds(spark, sf_dir)
    feeds = [paths.batch_output, paths.stream_output]
    silver.union_silver(spark, feeds, paths.unified, paths.unified_progress)
    return spark.read.parquet(paths.unified).select(*SILVER.names)


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch of both feeds read, rejected, dropped as duplicate and wrote."""
    paths = _run_both_feeds(spark, sf_dir)
    return read_table(spark, paths.metrics, METRICS)


def stream_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ten micro-batches of one file each did: the query restarts after five, a union runs after each half."""
    folder = new_folder(spark, "capped")
    paths = MartPaths(f"{folder}/mart")
    arrivals = _arrivals(fixtures.rides_events(spark, sf_dir), CAPPED_ARRIVALS)
    half = len(arrivals) // 2
    for part in (arrivals[:half], arrivals[half:]):
        for arrived in part:
            _write_one_file(arrived, f"{folder}/csv")
        files = ride_sources.stream_ride_files(spark, f"{folder}/csv", max_files=1)
        start_feed(files, paths.feed("capped-1"), f"{folder}/checkpoint", availableNow=True).awaitTermination()
        silver.union_silver(spark, [paths.batch_output], paths.unified, paths.unified_progress)
    return read_table(spark, paths.metrics, METRICS)


def mart_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per id of feed, unified table and fact, after ten micro-batches, two loads and a compaction after each."""
    folder = new_folder(spark, "compacted")
    paths = MartPaths(f"{folder}/mart")
    arrivals = _arrivals(fixtures.rides_events(spark, sf_dir), CAPPED_ARRIVALS)
    half = len(arrivals) // 2
    for part in (arrivals[:half], arrivals[half:]):
        for arrived in part:
            _write_one_file(arrived, f"{folder}/csv")
        files = ride_sources.stream_ride_files(spark, f"{folder}/csv", max_files=1)
        start_feed(files, paths.feed("capped-1"), f"{folder}/checkpoint", availableNow=True).awaitTermination()
        refresh_mart(spark, paths)
        compact_mart(spark, paths, at_least=1, grace=0)
    tables = {"feed": read_table(spark, paths.batch_output, FEED), "unified": read_table(spark, paths.unified, UNIFIED)}
    tables["fact_trip"] = load_star(spark, paths.gold).fact
    ids = [rows.select(F.lit(name).alias("table_name"), "trip_id") for name, rows in tables.items()]
    return silver.union_feeds(ids).groupBy("table_name", "trip_id").agg(F.count(F.lit(1)).alias("row_count"))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rides that each micro-batch of both feeds turned away, and why."""
    paths = _run_both_feeds(spark, sf_dir)
    rejects = read_table(spark, paths.rejects, REJECTS)
    return rejects.select("trip_id", "start_time", "reject_reason", "source", "batch_id")


def stream_replay_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A producer that loops over the same lines, and a sink called twice for one batch."""
    folder = new_folder(spark, "replay")
    paths = MartPaths(f"{folder}/mart")
    feed = paths.feed("loop-1", stream=True)
    rides = fixtures.rides_events(spark, sf_dir)
    for _ in range(2):
        _run_line_feed(spark, rides, (), feed, folder)
    lines = spark.read.text(f"{folder}/lines")
    merge_new(ride_sources.parse_ride_lines(lines), 0, feed)
    return read_table(spark, paths.stream_output, FEED).select(*SILVER.names)


def stream_state_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that a feed keeps by its own state. The lines arrive twice, with a restart in between."""
    folder = new_folder(spark, "state")
    feed = Feed("state-1", f"{folder}/stream_output", dedup="state")
    before = spark.conf.get(incremental.STATE_STORE)
    spark.conf.set(incremental.STATE_STORE, incremental.ROCKSDB)
    try:
        for _ in range(2):
            _run_line_feed(spark, fixtures.rides_events(spark, sf_dir), (), feed, folder)
    finally:
        spark.conf.set(incremental.STATE_STORE, before)
    return read_table(spark, feed.target, FEED).select("trip_id")


def landed_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed as headed CSV files and read back."""
    folder = new_folder(spark, "landing")
    ride_sources.publish_rides(fixtures.rides_events(spark, sf_dir), "text", path=f"{folder}/lines")
    lines = ride_sources.read_lines_stream(spark, "text", path=f"{folder}/lines")
    rides = ride_sources.parse_ride_lines(lines)
    land_rides(rides, f"{folder}/bronze", f"{folder}/checkpoint", bounded=True).awaitTermination()
    return ride_sources.read_ride_files(spark, f"{folder}/bronze").select(*RAW.names)


def stream_reject_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that two micro-batches turned away, as they came, and why."""
    folder = new_folder(spark, "reject-text")
    paths = MartPaths(f"{folder}/mart")
    for arrived in _arrivals(fixtures.ride_lines(spark, sf_dir), STREAM_ARRIVALS):
        arrived.select("value").write.mode("append").text(f"{folder}/lines")
        lines = ride_sources.read_lines_stream(spark, "text", path=f"{folder}/lines")
        rides = ride_sources.parse_ride_lines(lines, keep_record=True)
        start_feed(rides, paths.feed("lines-1", stream=True), f"{folder}/checkpoint", availableNow=True).awaitTermination()
    rejects = read_table(spark, paths.rejects, REJECTS)
    return rejects.select("line", "reject_reason", "batch_id", F.col("place").isNotNull().cast("int").alias("has_place"))


def stream_state_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch of a feed with a state of its own did. The lines arrive in two parts, then all again."""
    folder = new_folder(spark, "state-metrics")
    feed = Feed("state-1", f"{folder}/stream", rejects=f"{folder}/rejects", metrics=f"{folder}/metrics", dedup="audited-state")
    before = spark.conf.get(incremental.STATE_STORE)
    spark.conf.set(incremental.STATE_STORE, incremental.ROCKSDB)
    try:
        rides = fixtures.rides_events(spark, sf_dir)
        for arrived in (*_arrivals(rides, STREAM_ARRIVALS), rides):
            ride_sources.publish_rides(arrived, "text", path=f"{folder}/lines")
            lines = ride_sources.read_lines_stream(spark, "text", path=f"{folder}/lines")
            await_feed(start_feed(ride_sources.parse_ride_lines(lines), feed, f"{folder}/checkpoint", availableNow=True))
    finally:
        spark.conf.set(incremental.STATE_STORE, before)
    return read_table(spark, feed.metrics, METRICS)


def landed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed field by field as they came, the faulty ones too, and read back as text."""
    folder = new_folder(spark, "landed-text")
    fixtures.ride_lines(spark, sf_dir).select("value").write.text(f"{folder}/lines")
    fields = ride_sources.split_ride_lines(ride_sources.read_lines_stream(spark, "text", path=f"{folder}/lines"))
    land_rides(fields, f"{folder}/bronze", f"{folder}/checkpoint", bounded=True).awaitTermination()
    rows = spark.read.option("header", True).csv(f"{folder}/bronze")
    return rows.select("trip_id", "start_lat", "start_lon", "end_lat", "end_lon", "start_time", "end_time", "distance", "extra")


def silver_csv_permuted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rides from one folder of headed CSV files whose columns stand in different orders."""
    folder = new_folder(spark, "permuted")
    rides = clean.clean_rides(fixtures.rides_events(spark, sf_dir))
    orders = (SILVER.names, SILVER.names[::-1], [*SILVER.names[2:], "note", *SILVER.names[:2]])
    for k, names in enumerate(orders):
        part = rides.filter(F.hour("start_time") % len(orders) == k).withColumn("note", F.lit("x, y"))
        part.select(*names).write.mode("append").option("header", True).csv(f"{folder}/silver")
    return read_table(spark, f"{folder}/silver", SILVER, fmt="csv")


_other_grids: dict[tuple[str, str], Star] = {}


def _other_cell(lat: Column, lon: Column) -> Column:
    return F.concat_ws("x", F.floor(lat * 100).cast("string"), F.floor(lon * 100).cast("string"))


def _describe_other_cells(cells: DataFrame) -> DataFrame:
    lat, lon = (F.split_part("geo_hash", F.lit("x"), F.lit(k)).cast("int") for k in (1, 2))
    tens, ones = (
        F.concat_ws("x", F.floor(lat / size).cast("string"), F.floor(lon / size).cast("string")) for size in (10, 100)
    )
    return cells.select("geo_hash", lat / 100, lon / 100, tens, ones).toDF(*DIM_GEOGRAPHY.names)


def other_grid_star(spark: SparkSession, sf_dir: str) -> Star:
    """The event rides' star on a grid of hundredths of a degree, read like any other star."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _other_grids:
        paths = MartPaths(new_folder(spark, "other-grid"))
        rides = fixtures.rides_events(spark, sf_dir)
        merge_new(rides, 0, paths.feed("events", audit=False, dedup="union", cell_fn=_other_cell), persist=False)
        refresh_mart(spark, paths, describe_cells=_describe_other_cells)
        _other_grids[key] = load_star(spark, paths.gold)
    return _other_grids[key]


def top_routes_other_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_routes(other_grid_star(spark, sf_dir))


def pct_same_region_other_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.pct_same_region_res6(other_grid_star(spark, sf_dir))


def new_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides from files that hold something new: a copy under another name of what was taken before does not count."""
    folder = new_folder(spark, "new-content")
    files, ledger = f"{folder}/in", f"{folder}/ledger"
    rides = fixtures.rides_events(spark, sf_dir)
    _write_ride_files(rides.filter(_before(STREAM_FEED_FROM)).coalesce(1), files)
    append_ledger(ride_sources.new_content_only(spark, files, ledger), ledger)
    _write_ride_files(rides.filter(_before(STREAM_FEED_FROM)).coalesce(1), files)
    for _ in range(2):
        _write_ride_files(rides.filter(_since(STREAM_FEED_FROM)).coalesce(1), files)
    paths = [row["path"] for row in ride_sources.new_content_only(spark, files, ledger).collect()]
    return ride_sources.read_ride_files(spark, *paths)


def price_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by the price ranges that hold them: as many overlapping ranges as there are orders."""
    low = F.floor("o_totalprice").cast("double")
    width = F.when(F.col("o_orderkey") % 97 == 0, 5000.0).otherwise((F.col("o_orderkey") % 40 + 1) / 2)
    ranges = fixtures.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("range_key"), low.alias("low"), (low + width).alias("high"))
    lines = fixtures.table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price"), "l_quantity")
    held = join_ranges(lines, ranges, "price", "low", "high", summed=True)
    return held.groupBy("range_key").agg(
        F.sum("rows_held").alias("lines"), F.min("least").alias("least"), F.max("most").alias("most"),
    )


DIRECT = (
    parse_lines, valid_rides, reject_reasons, ride_duration, silver_rides,
    geo_cells, cell_centroids, cell_parents,
    dedup_first_rides, new_trips_anti, new_trips_small_batch, silver_union, new_files,
    fact_trip, dim_date, dim_geography, dim_time, dim_duration_bucket, band_range_join, new_dates, new_cells,
    fact_two_runs, dim_date_two_runs, dim_geography_two_runs, star_overlapping_loads,
    sql_script, count_all_sql, export_counts,
    stream_silver, stream_metrics, stream_capped, mart_compacted, stream_rejects, stream_replay_silver, stream_state_dedup,
    landed_rides, stream_reject_text, stream_state_metrics, landed_text, silver_csv_permuted, top_routes_other_grid, pct_same_region_other_grid,
    new_content, price_ranges,
)


def registered() -> dict[str, Query]:
    found = {query.__name__: query for query in DIRECT}
    return found | {name: _question(ask) for name, ask in STORED_QUESTIONS.items()}
