"""The ids of a growing table, in tables bucketed by id: looking some up never moves the history."""

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ridemart.operators.incremental import KeySize, measure_keys
from ridemart.schemas import ID_LEDGER
from ridemart.sources.commits import create_once, file_names, read_text
from ridemart.sources.live import covered_through, read_runs
from ridemart.sources.tables import delete_path, new_rows_only, staged

KEY = "trip_id"
# Ids of one bucket, and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 5_000_000, 8
# Keys of one bucket of a batch that a task may hold as a hash table; beyond that it sorts and spills.
HASHED_KEYS = 2_000_000
KEPT_VERSIONS = 5


@dataclass(frozen=True)
class History:
    """Ids to look in, and into how many buckets they are cut by id; None for a few recent ones that are not."""

    rows: DataFrame
    buckets: int | None = None


@dataclass(frozen=True)
class IdLedger:
    """Ids with the feed's batch that they came in, as some runs: tables bucketed by id, each of its own size.

    One writer at a time adds a run; it takes the smaller runs with it, so that their number grows with the
    logarithm of the ids, and every id is rewritten as many times. Readers follow a version file that names
    the live runs. Runs that it no longer names stay until the next addition, for readers on their way.
    """

    path: str

    def _versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(name[1:]) for name in file_names(spark, f"{self.path}/log") if name[:1] == "v" and name[1:].isdigit())

    def state(self, spark: SparkSession) -> dict | None:
        """The live runs, the retired ones, and the last run number of the table that the ids are from."""
        versions = self._versions(spark)
        text = read_text(spark, f"{self.path}/log/v{versions[-1]:012d}") if versions else None
        return text and json.loads(text)

    def _table(self, spark: SparkSession, run: dict) -> str:
        """The run as a table of the catalog, which knows its buckets. Named by a number that is used once."""
        name = f"ridemart_ids_{run['name']}"
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in ID_LEDGER)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) INTO {run['buckets']} BUCKETS "
                f"LOCATION '{self.path}/runs/{run['name']}'"
            )
        return name

    def histories(self, spark: SparkSession, own: tuple[str, int] | None = None) -> list[History]:
        """The live runs, without the ids of a batch that may be a replay."""
        state = self.state(spark) or {"runs": []}
        found = []
        for run in state["runs"]:
            rows = spark.table(self._table(spark, run))
            if own is not None:
                rows = rows.filter((F.col("source") != own[0]) | (F.col("batch_id") != own[1]))
            found.append(History(rows.select(KEY), run["buckets"]))
        return found

    def add(self, spark: SparkSession, rows: DataFrame, through: int) -> None:
        """Add ids (trip_id, source, batch_id): those of all runs of the table up to ``through`` are in then.

        For one writer at a time. Ids that a crash kept out are added by the next call with the same rows.
        """
        before = self.state(spark) or {"runs": [], "retired": [], "through": 0}
        for name in before["retired"]:
            spark.sql(f"DROP TABLE IF EXISTS ridemart_ids_{name}")
            delete_path(spark, f"{self.path}/runs/{name}")
        total, taken = rows.count(), []
        if total == 0:
            self._publish(spark, before["runs"], [], through)
            return
        for run in sorted(before["runs"], key=lambda run: run["rows"]):
            if run["rows"] > 2 * total:
                break
            total += run["rows"]
            taken.append(run)
        run = {"name": uuid.uuid4().hex, "rows": total, "buckets": buckets_for(total)}
        parts = [rows.select(*ID_LEDGER.names), *(spark.table(self._table(spark, old)) for old in taken)]
        whole = reduce(DataFrame.unionByName, parts).repartition(run["buckets"], KEY)
        whole.write.insertInto(self._table(spark, run))
        kept = [old for old in before["runs"] if old not in taken]
        self._publish(spark, [*kept, run], [old["name"] for old in taken], through)

    def _publish(self, spark: SparkSession, runs: list[dict], retired: list[str], through: int) -> None:
        versions = self._versions(spark)
        state = json.dumps({"runs": runs, "retired": retired, "through": through})
        create_once(spark, f"{self.path}/log/v{(versions[-1] if versions else 0) + 1:012d}", state)
        for old in versions[:-KEPT_VERSIONS]:
            delete_path(spark, f"{self.path}/log/v{old:012d}")


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, 1 << (max(1, -(-rows // BUCKET_ROWS)) - 1).bit_length())


def unseen(rows: DataFrame, histories: Sequence[History], wanted: DataFrame, size: KeySize) -> DataFrame:
    """The rows whose id is in none of the histories. ``wanted`` has the ids of the rows.

    A history is only scanned. A few wanted ids are sent to its tasks; many are shuffled into its buckets and
    meet it there. Only histories without buckets, which are small by their nature, may move.
    """
    if not histories:
        return rows
    ids = wanted.select(KEY)
    if size.fits_broadcast:
        known = [history.rows.join(F.broadcast(ids), KEY, "left_semi") for history in histories]
        return new_rows_only(rows, F.broadcast(reduce(DataFrame.unionByName, known)), [KEY])
    for history in histories:
        own, asked = rows, ids
        if history.buckets:
            own, asked = own.repartition(history.buckets, KEY), asked.repartition(history.buckets, KEY)
        hint = "shuffle_hash" if history.buckets and size.rows <= HASHED_KEYS * history.buckets else "merge"
        rows = new_rows_only(own, history.rows.join(asked.hint(hint), KEY, "left_semi"), [KEY])
    return rows


def write_unseen(
    rows: DataFrame, histories: Sequence[History], write: Callable[[DataFrame], int], raw: DataFrame, size: KeySize | None = None,
) -> int:
    """Write the rows whose id is in none of the histories. ``rows`` are unique by id, ``raw`` is what they came from.

    A large batch is set down once as a table, so that its ids are unique and cheap to read again.
    """
    if not histories:
        return write(rows)
    size = size or measure_keys(raw, KEY)
    if size.fits_broadcast:
        return write(unseen(rows, histories, raw, size))
    with staged(rows) as unique:
        return write(unseen(unique, histories, unique, size))


# --- batches that the union has not taken yet ---

def open_folder(progress: str) -> str:
    """Where a feed notes its batches until the union has taken them: next to the union's ledger."""
    return f"{progress.rstrip('/')}_open"


def note_open(spark: SparkSession, progress: str, source: str, batch_id: int, folder: str) -> None:
    create_once(spark, f"{open_folder(progress)}/{source}~{batch_id}", folder)


def open_batches(spark: SparkSession, progress: str) -> dict[tuple[str, int], str]:
    """Folders of the batches that were written and not yet taken by the union, by (source, batch_id).

    As many as came in since the last union, however many there have ever been.
    """
    found = {}
    for name in file_names(spark, open_folder(progress)):
        source, _, batch_id = name.rpartition("~")
        if batch_id.isdigit():
            folder = read_text(spark, f"{open_folder(progress)}/{name}")
            if folder:
                found[source, int(batch_id)] = folder
    return found


def close_batches(spark: SparkSession, progress: str, batches: Iterable[tuple[str, int]]) -> None:
    """Take back the notes of these batches."""
    taken = {f"{source}~{batch_id}" for source, batch_id in batches}
    for name in taken.intersection(file_names(spark, open_folder(progress))):
        delete_path(spark, f"{open_folder(progress)}/{name}")


def catch_up(spark: SparkSession, ledger: IdLedger, unified: str, runs: dict[int, str], schema) -> None:
    """Add the ids of the unified table's runs that the ledger does not hold: all of them to a new ledger.

    ``runs`` are partitions; runs that segments stand for are looked up there.
    """
    state = ledger.state(spark)
    through = state["through"] if state else 0
    missing = {run for run in runs if state is None or run > through} | set(range(through + 1, covered_through(spark, unified) + 1))
    rows = read_runs(spark, unified, schema, missing.__contains__) if missing else None
    if rows is not None:
        ledger.add(spark, rows.select(*ID_LEDGER.names), max(missing))
