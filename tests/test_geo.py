import math

import pandas as pd
import pytest
from conftest import plan_of, ride
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ridemart.functions import geo
from ridemart.operators.clean import clean_rides


def cell_at(level=geo.GRID_LEVEL):
    return geo.geo_cell(F.col("lat"), F.col("lon"), level)


def points(spark, rows):
    return spark.createDataFrame(rows, "lat double, lon double")


def expected_cell(lat, lon, level):
    n = 1 << level
    x = min(math.floor((lon + 180) / 360 * n), n - 1)
    y = min(math.floor((90 - lat) / 180 * n), n - 1)
    return "".join(str(((x >> i) & 1) + 2 * ((y >> i) & 1)) for i in range(level - 1, -1, -1))


def test_corners_and_centre(spark):
    rows = [(90.0, -180.0), (90.0, 180.0), (-90.0, -180.0), (-90.0, 180.0), (0.0, 0.0)]
    got = points(spark, rows).select(cell_at(3)).collect()
    assert [row[0] for row in got] == ["000", "111", "222", "333", "300"]


def test_outside_is_null(spark):
    bad = [
        (None, 0.0), (0.0, None), (float("nan"), 0.0), (0.0, float("nan")), (91.0, 0.0), (-90.001, 0.0),
        (0.0, 180.001), (float("inf"), 0.0), (0.0, float("-inf")),
    ]
    assert [row[0] for row in points(spark, bad).select(cell_at()).collect()] == [None] * len(bad)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-90, 90), st.floats(-180, 180)), min_size=20, max_size=60))
def test_cells_agree_with_their_definition(spark, rows):
    cell = cell_at()
    got = points(spark, rows).select(
        "lat", "lon", cell.alias("cell"),
        geo.cell_parent(cell, 12).alias("parent"), cell_at(12).alias("coarse"),
        geo.geo_cell(geo.cell_lat(cell), geo.cell_lon(cell)).alias("of_centroid"),
    )
    for row in got.collect():
        assert row.cell == expected_cell(row.lat, row.lon, 15)
        assert row.parent == row.coarse == row.cell[:12]
        assert row.of_centroid == row.cell


def test_cells_are_made_of_numbers_at_every_level(spark):
    rows = [(90.0, -180.0), (-90.0, 180.0), (40.7, -73.9), (-33.3, 151.2), (0.0, 0.0), (-0.0001, 0.0001)]
    levels = range(1, geo.MAX_LEVEL + 1)
    got = points(spark, rows).select("lat", "lon", *[cell_at(level).alias(f"at{level}") for level in levels])
    assert "bin(" not in plan_of(got)
    for row in got.collect():
        assert [row[f"at{level}"] for level in levels] == [expected_cell(row.lat, row.lon, level) for level in levels]


def test_bad_cells_give_null(spark):
    cells = spark.createDataFrame([("",), ("01x",), ("0124",), (None,), ("8a2a1072b59ffff",)], "cell string")
    cell = F.col("cell")
    got = cells.select(geo.cell_lat(cell), geo.cell_lon(cell), geo.cell_parent(cell, 2)).collect()
    assert all(value is None for row in got for value in row)


def test_parent_is_not_finer(spark):
    one = spark.createDataFrame([("012",)], "cell string")
    assert one.select(geo.cell_parent(F.col("cell"), 5)).first()[0] is None
    assert one.select(geo.cell_parent(F.col("cell"), 3)).first()[0] == "012"


def test_level_is_checked(spark):
    for level in (0, 19):
        with pytest.raises(ValueError):
            cell_at(level)


def test_deepest_level(spark):
    rows = [(40.7, -73.9), (-90.0, 180.0), (89.999, -179.999)]
    got = points(spark, rows).select("lat", "lon", cell_at(18).alias("cell")).collect()
    assert all(row.cell == expected_cell(row.lat, row.lon, 18) for row in got)


def test_another_grid_plugs_in(spark, rides):
    @F.pandas_udf("string")
    def rounded(lat: pd.Series, lon: pd.Series) -> pd.Series:
        return lat.round(1).astype(str) + "/" + lon.round(1).astype(str)

    got = clean_rides(rides(ride("a")), cell_fn=rounded).first()
    assert (got.start_geo_hash, got.end_geo_hash) == ("40.7/-74.0", "40.8/-74.0")
