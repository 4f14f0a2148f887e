"""Unbounded de-duplication against what is already stored."""

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ridemart.sources.tables import new_rows_only, staged

# A batch's keys are broadcast only when their measured size stays under this.
BROADCAST_KEY_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD_BYTES = 64
# Beyond that, a Bloom filter of the keys still pays off up to this many of them.
BLOOM_FILTER_KEYS = 30_000_000
_BITS_PER_KEY = 10
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class KeySize:
    """How many keys a batch has, repeated ones included, and what they take as a hash table."""

    rows: int
    bytes: int

    @property
    def fits_broadcast(self) -> bool:
        return self.bytes <= BROADCAST_KEY_BYTES


def dedup_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, ties broken by the remaining columns.

    This is an aggregate, so every task keeps a single row per key before the shuffle and a key that
    holds a third of all rows costs the reducer no more than any other.
    """
    rest = [name for name in rows.columns if name not in keys and name not in order]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*rows.columns)


def distinct_keys(rows: DataFrame, *columns: str, name: str) -> DataFrame:
    """The distinct non-NULL values of one column, or of several of one type, in one pass."""
    one = len(columns) == 1
    values = F.col(columns[0]) if one else F.explode(F.array(*columns))
    return rows.select(values.alias(name)).filter(F.col(name).isNotNull()).distinct()


def key_bytes(key: str) -> Column:
    """Aggregate: what a key column would take as a broadcast hash table."""
    return F.coalesce(F.sum(F.octet_length(F.col(key)) + F.lit(_ROW_OVERHEAD_BYTES)), F.lit(0))


def measure_keys(rows: DataFrame, key: str) -> KeySize:
    return KeySize(*rows.agg(F.count(F.col(key)), key_bytes(key)).first())


def seen_keys(stored: DataFrame, wanted: DataFrame, key: str, broadcast: bool) -> DataFrame:
    """Those of the wanted (string) keys that are stored: never more than were wanted.

    The history is only scanned when the wanted keys are broadcast. Otherwise it is a join by key, for
    which Spark can put a Bloom filter of the wanted keys into the scan, see ``bloom_filter``.
    """
    history, wanted = stored.select(key), wanted.select(key)
    if broadcast:
        return F.broadcast(history.join(F.broadcast(wanted), key, "left_semi").distinct())
    # The comparison holds for every key but NULL. Spark looks for one before it makes the filter.
    return history.join(wanted.filter(F.col(key) >= ""), key, "left_semi")


@contextmanager
def bloom_filter(spark: SparkSession, keys: int) -> Iterator[None]:
    """Let the joins planned inside use a Bloom filter made for this many keys."""
    if keys > BLOOM_FILTER_KEYS:
        yield
        return
    bits = max(keys, 1) * _BITS_PER_KEY
    wanted = {
        "enabled": "true", "creationSideThreshold": "1t", "expectedNumItems": keys, "maxNumItems": keys,
        "numBits": bits, "maxNumBits": bits,
    }
    before = {name: spark.conf.get(f"{_BLOOM}.{name}") for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(f"{_BLOOM}.{name}", str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(f"{_BLOOM}.{name}", value)


def write_new(
    rows: DataFrame, stored: DataFrame | None, key: str, write: Callable[[DataFrame], int],
    raw: DataFrame, size: KeySize | None = None,
) -> int:
    """Write the rows whose key is not stored yet, in the way that suits their number.

    ``rows`` are unique by key and ``raw`` is the batch they came from, with the same keys. The
    history, which may be far larger than any batch, is never shuffled up to ``BLOOM_FILTER_KEYS``. A
    large batch is set down once as a table, so that its keys are unique and cheap to read twice.
    """
    if stored is None:
        return write(rows)
    size = size or measure_keys(raw, key)
    if size.fits_broadcast:
        return write(new_rows_only(rows, seen_keys(stored, raw, key, broadcast=True), [key]))
    with staged(rows) as unique, bloom_filter(rows.sparkSession, size.rows):
        return write(new_rows_only(unique, seen_keys(stored, unique, key, broadcast=False), [key]))


def dedup_stream(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """De-duplicate inside one streaming query for as long as it lives, without any time bound.

    The state holds every key the query has seen, spread over the executors. It must be RocksDB's, on
    their disks: the in-memory store, which is Spark's default, would grow with the history and is
    refused. A batch then costs lookups for its own keys only, however long the history is.
    """
    store = rows.sparkSession.conf.get(STATE_STORE)
    if not store.endswith(ROCKSDB.rpartition(".")[2]):
        raise ValueError(f"state without a time bound needs {STATE_STORE}={ROCKSDB}, not {store}")
    return rows.dropDuplicates(list(keys))
