from types import SimpleNamespace

import pytest

from conftest import plan_of, ride

from ridemart.operators import serve
from ridemart.plans import gold, silver
from ridemart.plans.mart import MartPaths, refresh_mart
from ridemart.session import new_folder, shared_folder, small_tasks
from ridemart.streaming.feeds import merge_new


def session(folder=None, master="local[2]", app="app-1"):
    conf = SimpleNamespace(get=lambda name, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_the_cluster_names_the_folder():
    assert shared_folder(session("hdfs:///scratch/", "yarn")) == "hdfs:///scratch"
    assert new_folder(session("hdfs:///scratch", "yarn"), "mart").startswith("hdfs:///scratch/ridemart/mart-")


def test_a_cluster_must_name_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(master="spark://host:7077"))


def test_a_local_session_gets_one_of_its_own():
    folder = shared_folder(session())
    assert folder == shared_folder(session()) != shared_folder(session(app="app-2"))
    assert new_folder(session(), "x") != new_folder(session(), "x")


def test_the_running_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_small_tasks_end_with_the_block(spark):
    def fine():
        return ", 512)" in plan_of(spark.range(9).selectExpr("id % 3 as k").groupBy("k").count())

    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(name) for name in names]
    with pytest.raises(KeyError):
        with small_tasks(spark), small_tasks(spark):
            assert fine() and [spark.conf.get(name) for name in names] == ["33554432b"] * 2
            raise KeyError
    assert not fine() and [spark.conf.get(name) for name in names] == before


def test_bulk_steps_run_in_small_tasks(spark, rides, folder, monkeypatch):
    paths, seen = MartPaths(folder), []
    for module in (silver, gold):
        def replace(rows, path, columns, write=module.replace_partitions):
            seen.append(plan_of(rows))
            return write(rows, path, columns)

        monkeypatch.setattr(module, "replace_partitions", replace)
    merge_new(rides(ride("a"), ride("b"), ride("a")), 0, paths.feed("x", audit=False, dedup="union"))
    assert refresh_mart(spark, paths)["fact"] == 2
    union, fact = seen
    assert ", 512)" in union and ", 512)" in fact
    # The rides move without the columns that the fact adds to them.
    assert "is_same_cell" not in fact[fact.index("Exchange"):] and "is_same_cell" in fact
    assert serve.export_mart(spark, folder)["gold_fact_trip"] == 2
