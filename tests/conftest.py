import sys
import tempfile
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from ridemart.schemas import RAW  # noqa: E402
from ridemart.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(
        8, "ridemart-tests",
        **{"spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.checkpoint.dir": f"{folder}/shared"},
    )
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def at(text):
    return datetime.fromisoformat(text)


def ride(trip_id, start="2024-01-05 10:00:00", end="2024-01-05 10:10:00", **changes):
    """One valid raw ride; named fields replace its values."""
    row = {
        "trip_id": trip_id, "start_lat": 40.7, "start_lon": -74.0, "end_lat": 40.75, "end_lon": -73.95,
        "start_time": at(start) if start else None, "end_time": at(end) if end else None, "distance": 2.5,
    }
    return {**row, **changes}


@pytest.fixture
def rides(spark):
    def build(*rows):
        return spark.createDataFrame([[row[name] for name in RAW.names] for row in rows], RAW)

    return build


def as_set(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return {tuple(row) for row in frame.collect()}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
