"""Sessions for tests and benchmarks, and the shared folder for intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Into how many parts a bulk step's rows are shuffled before AQE joins small ones.
FINE_PARTITIONS = 512
# Bytes of shuffled rows or of files that one of its tasks takes, about.
FINE_BYTES = 32 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SIZES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
_local_folders: dict[str, str] = {}


def local_session(cpus: int | str = 8, name: str = "ridemart", **config: object) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in config.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets one folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="ridemart-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder. Nothing is created yet."""
    return f"{shared_folder(spark)}/ridemart/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Plan what runs inside in tasks that sort in memory: AQE gets many parts to join up to its size, scans short splits.

    A number of partitions that does not grow with the rows makes tasks that do, and every sort spills from some size on.
    """
    before = {name: spark.conf.get(name, None) for name in (_INITIAL, *_SIZES)}
    parts = int(before[_INITIAL] or spark.conf.get("spark.sql.shuffle.partitions"))
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    wanted = {name: f"{FINE_BYTES}b" for name in _SIZES if in_bytes(spark.conf.get(name)) > FINE_BYTES}
    if parts < FINE_PARTITIONS:
        wanted[_INITIAL] = str(FINE_PARTITIONS)
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name in wanted:
            if before[name] is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before[name])
