"""Range joins by bins, questions over sums, files known by what they hold."""

import random

import pytest
from conftest import as_set, plan_of, ride
from pyspark.sql import functions as F

from ridemart.operators import star as ops
from ridemart.operators.ranges import binned_ranges, join_ranges
from ridemart.queries import STORED_QUESTIONS, _write_ride_files, price_ranges, stored_star
from ridemart.sources.rides import file_digests, new_content_only
from ridemart.sources.tables import append_ledger


def test_ranges_against_brute_force(spark):
    rng = random.Random(6)
    ranges = [(k, float(a), float(a) + rng.choice([0.001, 0.5, 1, 3, 64, 900, 1e6])) for k, a in enumerate(rng.randrange(-500, 500) / 4 for _ in range(300))]
    ranges += [(900, None, -100.0), (901, 100.0, None), (902, None, None), (903, 5.0, 5.0), (904, 6.0, 5.0), (905, -1e15, 1e15)]
    values = [float(rng.randrange(-2000, 2000)) / 8 for _ in range(400)] + [None, float("nan"), 5.0, 5.0, -1e14]
    rows = spark.createDataFrame([(k, value) for k, value in enumerate(values)], "n long, v double")
    bands = spark.createDataFrame(ranges, "key long, low double, high double")
    got = join_ranges(rows, bands, "v", "low", "high")
    assert got.columns == ["n", "v", "key", "low", "high"]
    want = {
        (n, key) for n, v in enumerate(values) if v is not None and v == v for key, low, high in ranges
        if (low is None or v >= low) and (high is None or v < high)
    }
    pairs = [(row.n, row.key) for row in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    per_range = binned_ranges(bands, "low", "high").groupBy("key").count().agg(F.max("count")).first()[0]
    assert per_range <= 3


def test_sums_by_range_against_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    ranges = [(k % 290, float(a), float(a) + rng.choice([0.001, 0.5, 1, 3, 64, 900, 1e6])) for k, a in enumerate(rng.randrange(-500, 500) / 4 for _ in range(300))]
    ranges += [(900, None, -100.0), (901, 100.0, None), (902, None, None), (903, 5.0, 5.0), (904, 6.0, 5.0), (905, -1e15, 1e15), (906, 3e5, 4e5)]
    values = [float(rng.randrange(-2000, 2000)) / 8 for _ in range(400)] + [None, float("nan"), 5.0, 5.0, -1e14] + [7.0] * 200
    rows = spark.createDataFrame([(value,) for value in values], "v double")
    bands = spark.createDataFrame(ranges, "key long, low double, high double")
    want = []
    for key, low, high in ranges:
        held = [v for v in values if v is not None and v == v and (low is None or v >= low) and (high is None or v < high)]
        if held:
            want.append((key, low, high, len(held), min(held), max(held)))
    for block_rows in (500_000, 50):  # one block, and many
        monkeypatch.setattr("ridemart.operators.ranges.BLOCK_ROWS", block_rows)
        got = join_ranges(rows, bands, "v", "low", "high", summed=True)
        assert got.columns == ["key", "low", "high", "rows_held", "least", "most"]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert join_ranges(rows.limit(0), bands, "v", "low", "high", summed=True).count() == 0
    assert join_ranges(rows, bands.limit(0), "v", "low", "high", summed=True).count() == 0


def test_price_ranges_form_no_pairs(spark, folder):
    """100,000 lines in each of 2,000 ranges, 200 million pairs: they are summed without the join by bins that forms them."""
    spark.range(2000).select((F.col("id") * 97).alias("o_orderkey"), F.lit(1000.5).alias("o_totalprice")).write.parquet(f"{folder}/orders.parquet")
    lines = spark.range(100_000).select((F.lit(1000.0) + F.col("id") % 4000).alias("l_extendedprice"), F.lit(1.0).alias("l_quantity"))
    lines.write.parquet(f"{folder}/lineitem.parquet")
    got = price_ranges(spark, folder)
    assert as_set(got.agg(F.count("*"), F.min("lines"), F.max("lines"), F.min("least"), F.max("most"))) == {(2000, 100_000, 100_000, 1000.0, 4999.0)}
    assert "_range_bin" not in plan_of(got)


def test_whole_numbers_and_no_ranges(spark):
    rows = spark.range(10).withColumnRenamed("id", "v")
    bands = spark.createDataFrame([(1, 0, 3), (2, 2, 5)], "key int, low int, high int")
    assert as_set(join_ranges(rows, bands, "v", "low", "high"), "v", "key") == {(0, 1), (1, 1), (2, 1), (2, 2), (3, 2), (4, 2)}
    assert join_ranges(rows, bands.limit(0), "v", "low", "high").count() == 0


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_no_nested_loop(spark, sf, threshold):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        plan = plan_of(price_ranges(spark, sf))
    finally:
        spark.conf.set(name, before)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "HashJoin" in plan + plan.replace("SortMergeJoin", "HashJoin")


def test_questions_about_both_ends_join_sums_only(spark, sf):
    star = stored_star(spark, sf)
    plan = plan_of(STORED_QUESTIONS["slice_wide"](star))
    lines = plan.splitlines()
    fact_at = next(i for i, line in enumerate(lines) if "fact_trip" in line)
    above = lines[:fact_at]
    partial = max(i for i, line in enumerate(above) if "partial_sum" in line)
    assert not any("Exchange" in line or "Join" in line for line in above[partial:])
    sums = ops.wide_sums(star, "start_district", "end_district", "day_type")
    assert sums.agg(F.sum("trips")).first()[0] == star.fact.count()
    with pytest.raises(ValueError, match="no_such"):
        ops.wide_sums(star, "no_such")


def test_files_are_known_by_what_they_hold(spark, rides, folder):
    files, ledger = f"{folder}/in", f"{folder}/ledger"
    _write_ride_files(rides(ride("a"), ride("b")).coalesce(1), files)
    first = new_content_only(spark, files, ledger)
    assert first.count() == 1
    append_ledger(first, ledger)
    assert new_content_only(spark, files, ledger).count() == 0
    _write_ride_files(rides(ride("b"), ride("a")).coalesce(1), files)  # a copy in another order
    assert new_content_only(spark, files, ledger).count() == 0
    for _ in range(2):
        _write_ride_files(rides(ride("a"), ride("a"), ride("b")).coalesce(1), files)  # twice a new one
    found = new_content_only(spark, files, ledger)
    assert found.columns == ["path", "digest"] and found.count() == 1
    digests = [row.digest for row in file_digests(spark, files).collect()]
    assert len(digests) == 4 and len(set(digests)) == 2
