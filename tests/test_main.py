import pytest
from conftest import as_set, ride
from pyspark.errors import PySparkException

from ridemart.__main__ import main
from ridemart.operators.serve import register_exports
from ridemart.plans.mart import MartPaths
from ridemart.schemas import FEED
from ridemart.sources.tables import read_table


def test_stages_from_the_command_line(spark, rides, folder, capsys):
    rides(ride("a"), ride("a"), ride("b", start_lat=None)).write.option("header", True).csv(f"{folder}/in")
    base = f"{folder}/mart"
    files = ["files", "--base", base, "--checkpoint", f"{folder}/cp", "--source", "f1", "--input", f"{folder}/in"]
    main([*files, "--once"])
    assert as_set(read_table(spark, MartPaths(base).batch_output, FEED), "trip_id") == {("a",)}
    for stage, printed in (("union", "1"), ("gold", "1"), ("export", "'gold_fact_trip': 1"), ("run", "'gold_dim_time': 24")):
        main([stage, "--base", base])
        assert printed in capsys.readouterr().out
    main(["sql", "--base", base, "--text", "SELECT 1 AS one; SELECT COUNT(*) AS total_trips FROM gold_fact_trip"])
    out = capsys.readouterr().out
    assert "one" in out and "total_trips" in out

    names = register_exports(spark, base, "ride_exports")
    assert len(names) == 6
    stored = read_table(spark, f"{base}/gold/dim_date", spark.table("ride_exports.gold_dim_date").schema)
    assert as_set(spark.table("ride_exports.gold_dim_date")) == as_set(stored)
    exported = read_table(spark, f"{base}/export/gold_dim_date", stored.schema, fmt="csv")
    assert as_set(exported) == as_set(stored)
    assert spark.table("ride_exports.gold_fact_trip").columns[-1] == "is_same_cell"


def test_topics_are_asked_of_the_connector(spark, folder):
    topic = ["--topic", "rides", "--bootstrap-servers", "broker:9092", "--max-offsets", "100"]
    for stage in (
        ["lines", "--base", folder, "--checkpoint", folder, "--source", "l1"],
        ["land", "--output", folder, "--checkpoint", folder],
    ):
        with pytest.raises(PySparkException, match="kafka"):
            main([*stage, *topic])


def test_a_stage_needs_its_options():
    for argv in ([], ["union"], ["files", "--base", "x"], ["sql", "--base", "x"]):
        with pytest.raises(SystemExit):
            main(argv)
