"""Several writers on one file system: leases that heal, and tables that grow by published versions.

Everything rests on one step: a file that only one writer can create, with its content. HDFS and local file
systems have it (a rename or a link that fails when the target is there).
"""

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

LEASE_SECONDS = 120.0
# Published versions that are kept for a look back; only the last one matters.
KEPT_VERSIONS = 20
RETRIES = 100


class TableBusy(RuntimeError):
    """Another run is writing the table."""


class LeaseLost(TableBusy):
    """This run was taken for dead, and another one may be writing the table."""


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, none if it is not there."""
    files, folder = hadoop_path(spark, path)
    if not files.exists(folder):
        return []
    return [status.getPath().getName() for status in files.listStatus(folder)]


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is no such file."""
    files, name = hadoop_path(spark, path)
    try:
        stream = files.open(name)
    except Py4JJavaError:
        return None
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, name = hadoop_path(spark, path)
    stream = files.create(name, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    files, name = hadoop_path(spark, path)
    files.delete(name, True)


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Whether this call moved the file: false when it is gone or the target is there."""
    files, old = hadoop_path(spark, source)
    try:
        return bool(files.rename(old, hadoop_path(spark, target)[1]))
    except Py4JJavaError:
        return False


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this content, unless it is there: of several writers exactly one gets True."""
    files, name = hadoop_path(spark, path)
    files.mkdirs(name.getParent())
    draft = f"{path}.draft-{uuid.uuid4().hex}"
    _write_text(spark, draft, text)
    try:
        if files.getScheme() != "file":
            return not files.exists(name) and _rename(spark, draft, path)
        # A local rename replaces its target, a link does not.
        nio = spark._jvm.java.nio.file
        as_local = lambda p: nio.Path.of(hadoop_path(spark, p)[0].makeQualified(hadoop_path(spark, p)[1]).toUri())
        try:
            nio.Files.createLink(as_local(path), as_local(draft))
            return True
        except Py4JJavaError as failed:
            if failed.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
    finally:
        _delete(spark, draft)


# --- leases ---

class Lease:
    """Claims that hold for as long as their holder lives: one file per claim below ``folder``, and a heartbeat.

    A claim's file holds the token of its holder and is created once. The heartbeat rewrites a file of the
    holder's own, whose time is the file system's, so that clocks of different machines do not matter.
    """

    def __init__(self, spark: SparkSession, folder: str, seconds: float = LEASE_SECONDS) -> None:
        self.spark, self.folder, self.seconds = spark, folder.rstrip("/"), seconds
        self.token, self.names = uuid.uuid4().hex, []
        self._stop = threading.Event()
        self._beat = threading.Thread(target=self._keep_alive, daemon=True)

    def _file(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _beat_file(self, token: str) -> str:
        return f"{self.folder}/beat-{token}"

    def _time_of(self, path: str) -> int | None:
        files, name = hadoop_path(self.spark, path)
        try:
            return files.getFileStatus(name).getModificationTime()
        except Py4JJavaError:
            return None

    def _now(self) -> int:
        probe = f"{self.folder}/now-{uuid.uuid4().hex}"
        _write_text(self.spark, probe, "")
        try:
            return self._time_of(probe)
        finally:
            _delete(self.spark, probe)

    def age(self, path: str) -> float | None:
        """Seconds since a file was written, by the file system's clock; None if it is not there."""
        written = self._time_of(path)
        return None if written is None else (self._now() - written) / 1000

    def _is_dead(self, claim: str, holder: str) -> bool:
        seen = [when for when in map(self._time_of, (claim, self._beat_file(holder))) if when is not None]
        return bool(seen) and self._now() - max(seen) > self.seconds * 1000

    def claim(self, name: str) -> bool:
        """Whether this holder has the claim now: it was free, or its former holder has no heartbeat any more."""
        path = self._file(name)
        for _ in range(RETRIES):
            if create_once(self.spark, path, self.token):
                self.names.append(name)
                if not self._beat.is_alive():
                    self._beat.start()
                return True
            holder = read_text(self.spark, path)
            if holder is None:
                continue
            if not self._is_dead(path, holder):
                return False
            # Only one of several can move the dead holder's file away.
            grave = f"{path}.dead-{uuid.uuid4().hex}"
            if _rename(self.spark, path, grave):
                if read_text(self.spark, grave) != holder:
                    _rename(self.spark, grave, path)  # a new holder's: it came between the look and the move
                    return False
                _delete(self.spark, grave)
        return False

    def _keep_alive(self) -> None:
        while not self._stop.wait(self.seconds / 4):
            try:
                _write_text(self.spark, self._beat_file(self.token), self.token)
            except Exception:  # noqa: BLE001  the next beat may succeed; if none does, check() tells the holder
                continue

    def check(self) -> None:
        """Fail unless all claims are still this holder's: to be called before what others will see."""
        for name in self.names:
            if read_text(self.spark, self._file(name)) != self.token:
                raise LeaseLost(f"the claim {self._file(name)} went to another run")

    def release(self) -> None:
        self._stop.set()
        if self._beat.is_alive():
            self._beat.join()
        for name in self.names:
            if read_text(self.spark, self._file(name)) == self.token:
                _delete(self.spark, self._file(name))
        _delete(self.spark, self._beat_file(self.token))


@contextmanager
def leased(spark: SparkSession, folder: str, seconds: float = LEASE_SECONDS) -> Iterator[Lease]:
    """A lease without claims yet; they are given back at the end."""
    lease = Lease(spark, folder, seconds)
    try:
        yield lease
    finally:
        lease.release()


@contextmanager
def exclusive(spark: SparkSession, path: str, seconds: float = LEASE_SECONDS) -> Iterator[Lease]:
    """Keep other runs from writing the table at ``path``; TableBusy when one does.

    A run that died is found by its heartbeat, ``seconds`` after the last one, and its place is taken.
    """
    with leased(spark, f"{path.rstrip('/')}.running", seconds) as lease:
        if not lease.claim("writer"):
            raise TableBusy(f"another run is writing {path}")
        yield lease


# --- tables that grow ---

def _versions(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(name[1:]) for name in file_names(spark, log) if name[:1] == "v" and name[1:].isdigit())


def _version_file(log: str, version: int) -> str:
    return f"{log}/v{version:012d}"


def finish_growth(spark: SparkSession, path: str, log: str) -> int:
    """Bring the files of the last published version to the table, whoever published it; returns its number."""
    versions = _versions(spark, log)
    if not versions:
        return 0
    entry = json.loads(read_text(spark, _version_file(log, versions[-1])) or "{}")
    staged = f"{log}/{entry.get('staged')}"
    waiting = set(file_names(spark, staged)) & set(entry.get("files", ()))
    if waiting:
        files, folder = hadoop_path(spark, path)
        files.mkdirs(folder)
        for name in sorted(waiting):
            # Another run may be doing the same: the file is in one of the two places.
            if not _rename(spark, f"{staged}/{name}", f"{path}/{name}") and name in file_names(spark, staged):
                raise OSError(f"cannot move {staged}/{name} to {path}")
        _delete(spark, staged)
    for old in versions[:-KEPT_VERSIONS]:
        _delete(spark, _version_file(log, old))
    return versions[-1]


def grow_table(
    spark: SparkSession, path: str, log: str, schema: T.StructType, new_rows: Callable[[DataFrame | None], DataFrame],
) -> int:
    """Add to a table what ``new_rows`` finds missing in it; returns the number of rows added.

    The rows are written aside, then published as the next version, which only one run can do. A run that finds
    its version taken throws its rows away, looks at the grown table and tries again: what several runs find
    missing at the same time is added once. A published version names its files; whoever comes next brings
    them to the table if the run that published them died.
    """
    for _ in range(RETRIES):
        version = finish_growth(spark, path, log)
        files, folder = hadoop_path(spark, path)
        stored = spark.read.schema(schema).parquet(path) if files.exists(folder) else None
        staged, counted = f"staged-{uuid.uuid4().hex}", Observation()
        rows = new_rows(stored).observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.parquet(f"{log}/{staged}")
        added = counted.get["rows"]
        if not added:
            _delete(spark, f"{log}/{staged}")
            return 0
        parts = [name for name in file_names(spark, f"{log}/{staged}") if name.startswith("part-")]
        if create_once(spark, _version_file(log, version + 1), json.dumps({"staged": staged, "files": parts})):
            finish_growth(spark, path, log)
            return added
        _delete(spark, f"{log}/{staged}")
        time.sleep(0.01)
    raise TableBusy(f"{path} grew under every one of {RETRIES} attempts")
