"""What the plans must look like to hold at scale."""

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from ridemart import fixtures
from ridemart.operators import star as ops
from ridemart.operators.clean import clean_rides
from ridemart.plans import gold, report
from ridemart.queries import STORED_QUESTIONS, fact_trip, parse_lines, registered, silver_union, stored_star


@pytest.fixture(scope="module")
def star(spark):
    return stored_star(spark, "/root/testdata/sf0.001")


def test_no_python_between_source_and_star(spark, sf):
    for query in (parse_lines, silver_union, fact_trip, registered()["dim_geography"], registered()["dim_date"]):
        assert "EvalPython" not in plan_of(query(spark, sf))


def test_cleaning_is_one_generated_stage(spark, sf):
    plan = plan_of(clean_rides(fixtures.rides_events(spark, sf)))
    assert "Exchange" not in plan
    nodes = [line for line in plan.splitlines() if line.strip()]
    assert all(re.match(r"^[\s:+\-]*(\*\(1\)|FileScan|\+- FileScan)", node) or "FileScan" in node for node in nodes)


def test_only_needed_columns_are_read(star):
    scan = re.search(r"FileScan.*?ReadSchema: (\S+)", plan_of(report.trips_by_hour(star))).group(1)
    assert scan == "struct<time_key:int,trip_count:int>"


def test_the_fact_is_summed_before_any_join(star):
    for name in ("trips_by_hour", "trips_by_bucket", "trips_by_start_cell", "pivot_totals", "top_routes_role_join"):
        lines = plan_of(STORED_QUESTIONS[name](star)).splitlines()
        fact_at = next(i for i, line in enumerate(lines) if "fact_trip" in line)
        above = "\n".join(lines[:fact_at])
        assert above.rindex("partial_sum") > above.rindex("Join"), name


def test_routes_need_no_join(star):
    plan = plan_of(report.top_routes(star))
    assert "Join" not in plan and "TakeOrderedAndProject" in plan


def test_no_question_multiplies_rows(star):
    for name, ask in STORED_QUESTIONS.items():
        plan = plan_of(ask(star))
        assert "CartesianProduct" not in plan and "EvalPython" not in plan, name
        assert "Cross" not in plan, name


def test_date_conditions_prune_months(spark, star):
    sliced = report.sliced_trips(star, {"year": ["1996"], "month": ["7"]}, "hour")
    assert "dynamicpruning" in plan_of(sliced)
    direct = star.fact.filter(F.col("month_key") == 199607).agg(F.sum("trip_count"))
    assert "PartitionFilters: [isnotnull(month_key" in plan_of(direct)


def test_key_filters_reach_the_files(star):
    plan = plan_of(star.fact.filter(F.col("date_key") == 19960704).select("trip_id"))
    assert "EqualTo(date_key,19960704)" in plan


def test_dimension_keys_are_combined_before_the_shuffle(star):
    plan = plan_of(gold.new_cells(star.fact, star.geography))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "HashAggregate" in below and "Generate explode" in below


def test_wide_joins_are_not_python(star):
    assert "EvalPython" not in plan_of(ops.wide(star))
