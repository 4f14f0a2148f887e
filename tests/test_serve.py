import pytest
from conftest import as_set

from ridemart.operators.serve import export_csv, register_mart, run_sql_script, split_statements
from ridemart.plans.mart import MartPaths, refresh_mart
from ridemart.queries import stored_mart
from ridemart.schemas import RAW
from ridemart.streaming.feeds import merge_new


def test_statements():
    text = "SELECT 'a;b' ; -- one; two\nSELECT \"c;d\"; /* x;\ny */ SELECT 1 ;;  ; SELECT 'it''s;', '\\';', `e;f`"
    assert split_statements(text) == [
        "SELECT 'a;b'", "-- one; two\nSELECT \"c;d\"", "/* x;\ny */ SELECT 1", "SELECT 'it''s;', '\\';', `e;f`",
    ]
    assert split_statements(" ; \n") == []


def test_script_over_views(spark, sf):
    names = register_mart(spark, stored_mart(spark, sf).base)
    assert set(names) == {
        "silver_unified_rides", "gold_dim_date", "gold_dim_time", "gold_dim_geography",
        "gold_dim_duration_bucket", "gold_fact_trip",
    }
    trips, bands = run_sql_script(spark, """
        SELECT COUNT(*) AS total_trips FROM gold_fact_trip;
        SELECT bucket_label FROM gold_dim_duration_bucket WHERE min_seconds >= 1800
    """)
    assert trips.columns == ["total_trips"] and trips.first()[0] > 0
    assert as_set(bands) == {("30-60 min",), ("60+ min",)}


def test_external_tables(spark, sf):
    base = stored_mart(spark, sf).base
    for _ in range(2):
        names = register_mart(spark, base, database="ride_mart")
    assert len(names) == 6
    script = """
        USE ride_mart;
        SELECT COUNT(*) FROM gold_fact_trip WHERE month_key = 199607;
        SELECT COUNT(*) FROM gold_fact_trip WHERE date_key BETWEEN 19960701 AND 19960731;
        USE default
    """
    _, by_partition, by_date, _ = run_sql_script(spark, script)
    spark.sql("USE ride_mart")
    try:
        assert by_partition.first()[0] == by_date.first()[0] > 0
    finally:
        spark.sql("USE default")


@pytest.mark.parametrize("single", [True, False])
def test_export_counts_what_it_wrote(spark, folder, single):
    rows = spark.range(0, 1000, 1, 4).toDF("n")
    assert export_csv(rows, f"{folder}/out", single_file=single) == 1000
    assert spark.read.option("header", True).csv(f"{folder}/out").count() == 1000
    assert export_csv(rows.filter("n < 0"), f"{folder}/out", single_file=single) == 0


def test_pieces_of_comments_are_no_statements(spark):
    assert split_statements("SELECT 1; -- done") == ["SELECT 1"]
    assert split_statements("/* a; b */ ; -- c\n; SELECT '--x'") == ["SELECT '--x'"]


def test_results_are_of_their_place_in_the_script(spark):
    spark.sql("DROP TABLE IF EXISTS places")
    _, before, _, after = run_sql_script(spark, """
        CREATE TABLE places USING parquet AS SELECT id FROM range(3); SELECT COUNT(*) AS n FROM places;
        WITH more AS (SELECT id FROM range(1)) INSERT INTO places SELECT id FROM more;
        SELECT COUNT(*) AS n FROM places -- as it is now
    """)
    assert (before.first().n, after.first().n) == (3, 4)
    spark.sql("DROP TABLE places")


def test_tables_follow_the_data(spark, folder):
    rides = spark.sql("""
        SELECT CONCAT('t', id) AS trip_id, 41.0D AS start_lat, -87.0D AS start_lon, 41.5D AS end_lat, -87.5D AS end_lon,
            make_timestamp_ntz(2024, 5, 1, 8, id, 0) AS start_time, make_timestamp_ntz(2024, 5, 1, 9, id, 0) AS end_time, 1.0D AS distance
        FROM range(6)
    """).select(*RAW.names)
    spark.sql("CREATE DATABASE IF NOT EXISTS follows")
    bases = [MartPaths(f"{folder}/{name}") for name in ("one", "other")]
    merge_new(rides.filter("trip_id < 't2'"), 0, bases[0].feed("a"))
    merge_new(rides, 0, bases[1].feed("a"))
    for paths in bases:
        refresh_mart(spark, paths)
    register_mart(spark, bases[0].base, "follows")
    register_mart(spark, bases[0].base)

    def counts():
        return [spark.sql(f"SELECT COUNT(*) FROM {name}").first()[0] for name in ("follows.gold_fact_trip", "gold_fact_trip")]

    assert counts() == [2, 2]
    merge_new(rides.filter("trip_id < 't5'"), 1, bases[0].feed("a"))
    refresh_mart(spark, bases[0])
    assert counts() == [5, 5]
    register_mart(spark, bases[1].base, "follows")
    assert counts() == [6, 5]
    spark.sql("DROP DATABASE follows CASCADE")
    for table in spark.catalog.listTables():
        if table.isTemporary:
            spark.catalog.dropTempView(table.name)
