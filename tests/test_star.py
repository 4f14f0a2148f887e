import pytest
from conftest import as_set, ride
from pyspark.sql import functions as F

from ridemart.operators import star as ops
from ridemart.plans import report
from ridemart.plans.mart import MartPaths, refresh_mart
from ridemart.queries import stored_star
from ridemart.streaming.feeds import merge_new


@pytest.fixture(scope="module")
def star(spark):
    return stored_star(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Five rides: three in one hour of a Friday, one on a Saturday, one without a start cell."""
    from conftest import RAW
    rows = [
        ride("a"), ride("b"), ride("c", end="2024-01-05 10:01:00"),
        ride("d", "2024-01-06 17:00:00", "2024-01-06 18:30:00", end_lat=40.7, end_lon=-74.0),
        ride("e", "2024-02-09 03:00:00", "2024-02-09 03:20:00", start_lat=100.0),
    ]
    paths = MartPaths(str(tmp_path_factory.mktemp("small")))
    frame = spark.createDataFrame([[row[name] for name in RAW.names] for row in rows], RAW)
    merge_new(frame, 0, paths.feed("s"))
    refresh_mart(spark, paths)
    return ops.load_star(spark, paths.gold)


def test_cards(small):
    assert report.total_trips(small).first()[0] == 5
    assert report.avg_duration_min(small).first()[0] == pytest.approx((10 + 10 + 1 + 90 + 20) / 5)
    assert report.pct_same_region(small).first()[0] == pytest.approx(1 / 5)


def test_one_attribute(small):
    assert as_set(report.trips_by_day_name(small)) == {("Friday", 4), ("Saturday", 1)}
    assert [tuple(row) for row in report.trips_by_month(small).collect()] == [("January", 4), ("February", 1)]
    assert as_set(report.trips_by_day_type(small)) == {("Weekday", 4, 0.8), ("Weekend", 1, 0.2)}
    assert as_set(report.trips_by_hour(small)) == {(10, 3), (17, 1), (3, 1)}
    assert as_set(report.trips_by_rush(small)) == {("Rush Hour", 1, 0.2), ("Non-Rush", 4, 0.8)}
    assert as_set(report.avg_duration_by_bucket(small)) == {
        ("0-5 min", 1.0), ("5-15 min", 10.0), ("15-30 min", 20.0), ("60+ min", 90.0),
    }


def test_rides_without_a_cell_stay_in_the_results(small):
    assert sum(row.total_trips for row in report.trips_by_start_cell(small).collect()) == 5
    for region in (None, ops.cell_region):
        starts = report.top_start_regions(small, region=region)
        assert (None, 1) in as_set(starts)
        assert (None, 1) in as_set(report.top_routes(small, region=region))


def test_month_names_merge_years(star):
    assert report.trips_by_month(star).count() == 12


def test_every_breakdown_adds_up(star):
    total = report.total_trips(star).first()[0]
    for ask in (
        report.trips_by_day_name, report.trips_by_month, report.trips_by_day_type, report.trips_by_hour,
        report.trips_by_rush, report.trips_by_bucket, report.trips_by_start_cell,
    ):
        assert ask(star).agg(F.sum("total_trips")).first()[0] == total, ask.__name__
    cube = report.pivot_totals(star)
    for level in range(4):
        assert cube.filter(F.col("level") == level).agg(F.sum("total_trips")).first()[0] == total
    pivot = report.pivot_day_hour(star)
    cells = sum(F.coalesce(F.col(ops.hour_column(hour)), F.lit(0)) for hour in ops.HOURS)
    assert pivot.agg(F.sum(cells)).first()[0] == total


def test_regions_by_prefix_equal_regions_by_join(star):
    for ask in (report.top_start_regions, report.top_end_regions, report.top_routes, report.pct_same_region_res6):
        assert as_set(ask(star, region=None)) == as_set(ask(star, region=ops.cell_region)), ask.__name__


def test_routes_are_listed_by_name(star):
    routes = [row.route_region for row in report.top_routes(star).collect()]
    assert len(routes) == 10 and routes == sorted(routes)


def test_top_n(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 3), ("e", 1)], "k string, n int")
    assert [row.k for row in ops.top_n(rows, "n", 2, ["k"]).collect()] == ["a", "b"]
    assert as_set(ops.top_n(rows, "n", 2, ["k"], ties="all"), "k") == {("a",), ("b",), ("c",), ("d",)}
    assert ops.top_n(rows, "n", 10, ["k"]).count() == 5
    assert ops.top_n(rows, "n", 10, ["k"], ties="all").count() == 5
    assert ops.top_n(rows.limit(0), "n", 3, ties="all").isEmpty()
    with pytest.raises(ValueError):
        ops.top_n(rows, "n", 2, ties="some")


def test_pivot_and_heat(small):
    pivot = {row.day_name: row for row in report.pivot_day_hour(small).collect()}
    assert set(pivot) == {"Friday", "Saturday"}
    assert pivot["Friday"].h10 == 3 and pivot["Friday"].h11 is None
    heat = {(row.day_name, row.hour): row.intensity for row in report.heat_intensity(small).collect()}
    assert len(heat) == 48
    assert heat["Friday", 10] == 1.0 and heat["Friday", 11] == 0.0
    assert heat["Saturday", 17] == pytest.approx(1 / 3, abs=1e-6)


def test_flat_heat_has_no_scale(spark):
    columns = ", ".join(f"2L AS {ops.hour_column(hour)}" for hour in ops.HOURS)
    pivot = spark.sql(f"SELECT 'Monday' AS day_name, {columns}")
    assert as_set(ops.heat_intensity(pivot), "intensity") == {(None,)}


def test_slices(small):
    def trips(conditions, *by):
        return as_set(report.sliced_trips(small, conditions, *by).drop("avg_duration_min"))

    assert trips({}, "hour") == {(10, 3), (17, 1), (3, 1)}
    assert trips({"day_name": ["Friday"], "month": ("<", 2)}, "hour") == {(10, 3)}
    assert trips({"bucket_label": ["60+ min", "0-5 min"]}, "day_type") == {("Weekend", 1), ("Weekday", 1)}
    assert trips({"hour": (">=", 10), "rush_label": ("<>", "Rush Hour")}, "year", "hour") == {(2024, 10, 3)}
    assert trips({"start_lat": ("<=", 90)}, "day_name") == {("Friday", 3), ("Saturday", 1)}
    assert trips({"date_key": [20240106]}) == {(1,)}
    assert trips({"time_key": ("=", 3), "end_lon": (">", -74.0)}, "start_region") == {(None, 1)}
    with pytest.raises(ValueError, match="colour"):
        report.sliced_trips(small, {"colour": ["red"]}, "hour")


def test_slices_equal_the_wide_star(star):
    conditions = {"year": (">=", 1997), "period": ["Morning", "Night"], "start_lat": (">", 40.7)}
    direct = ops.slice_rows(ops.wide(star), conditions).groupBy("end_district").agg(F.sum("trip_count"))
    summed = report.sliced_trips(star, conditions, "end_district").drop("avg_duration_min")
    assert as_set(direct) == as_set(summed) and direct.count() > 1


def test_wide_keeps_every_ride(small):
    assert ops.wide(small).count() == 5
