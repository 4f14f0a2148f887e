"""Small helpers that several operators share."""

import ctypes
import gc
import pickle
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ridemart.session import new_folder, shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Code points besides A-Z that lower() may change. Capitals newer than the JVM's tables are unassigned to it.
_OTHER_CAPITALS = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}&&[^A-Z]]"


def whole_text(name: str) -> Column:
    """A text column, NULL as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    lower() does just that unless the text has other capitals, and is several times as fast as translate().
    """
    plain = F.octet_length(text) == F.char_length(text)
    return (
        F.when(plain, F.lower(text))
        .when(text.rlike(_OTHER_CAPITALS), F.translate(text, UPPER, LOWER))
        .otherwise(F.lower(text))
    )


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows as set down in the folder of ``spark.checkpoint.dir``, without their lineage."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(rows.sparkSession)}/ridemart")
    return rows.checkpoint()


def few(rows: DataFrame, limit: int) -> DataFrame:
    """The rows, to be broadcast when a count finds no more than ``limit`` of them."""
    return F.broadcast(rows) if rows.count() <= limit else rows


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table below the shared folder: for tables too wide for a checkpoint's rows."""
    spark = rows.sparkSession
    path = new_folder(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def fold(spark_id: Column, parts: int) -> Column:
    """The remainder by which labels are held out: CRC-32 of the id as text."""
    return F.crc32(F.coalesce(spark_id.cast("string"), F.lit("")).cast("binary")) % parts


def fold_of(value: object, parts: int) -> int:
    return zlib.crc32(str(value).encode()) % parts


def binary_values(column: pa.Array) -> Iterable[bytes]:
    """The values of a string or binary column as bytes, NULL as empty; no decoding."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, max_rows: int, max_bytes: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> list[tuple[bytes, int]]:
    """A bounded sample of labelled training texts: (text in UTF-8, label), for a fit on the driver.

    Rows of the held-out fold never get in. Each class gives the ``max_rows // 2`` texts with the smallest
    hash of the id, so the sample does not depend on how the tables are laid out. Texts over ``max_bytes``
    are left out of the sample (never of the scoring), which bounds what reaches the driver by
    ``max_rows * max_bytes``. The sample is chosen by ids alone; only its own texts leave their tasks.
    """
    name = F.col(id_col)
    known = (
        labels.filter(F.col(label).isNotNull() & name.isNotNull() & (fold(name, parts) != held_out))
        .groupBy(name.alias("_id")).agg(F.min(label).cast("int").alias("_label"))
    )
    text = whole_text(text_col).cast("binary")
    fitting = docs.filter(F.octet_length(text) <= max_bytes).select(name.alias("_id"), text.alias("_text"))
    rows = fitting.select("_id").join(known, "_id")
    found = []
    for value in (0, 1):
        first = rows.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(max_rows // 2)
        chosen = F.broadcast(checkpointed(first.select("_id")).distinct())
        ordered = fitting.join(chosen, "_id").orderBy(F.xxhash64("_id"), "_id", "_text")
        found += [(bytes(row["_text"]), value) for row in ordered.limit(max_rows // 2).collect()]
    return found


# Words are hashed as polynomials over random values of their bytes, modulo 2^64; an odd base has an inverse.
_BASE = 0x9E3779B97F4A7C15 | 3
_SEGMENT = 1 << 18


class _Once:
    """Remembers what a function gives. Travels to a worker empty, and without the function's module."""

    def __init__(self, make) -> None:
        self.make, self.made = make, None

    def __call__(self):
        if self.made is None:
            self.made = self.make()
        return self.made

    def __reduce__(self):
        return _Once, (self.make,)


def _make_hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    powers = np.full(_SEGMENT + 1, _BASE, np.uint64)
    inverse = np.full(_SEGMENT + 1, pow(_BASE, -1, 2**64), np.uint64)
    powers[0] = inverse[0] = 1
    return values, np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


_hash_tables = _Once(_make_hash_tables)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit of the input moves every bit of the output."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_places(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that ``inside`` (a table of 256) marks."""
    edge = np.diff(inside[data].view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes.

    Works through segments of bounded size, so a long text needs little memory besides itself. A word longer
    than a segment is hashed piece by piece.
    """
    values, powers, inverse = _hash_tables()
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        at = starts[first]
        last = int(np.searchsorted(ends, at + _SEGMENT, "right"))
        if last <= first:
            out[first] = _long_hash(folded[at:ends[first]])
            first += 1
            continue
        piece = folded[at:ends[last - 1]]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * powers[:len(piece)], out=total[1:])
        begin, end = starts[first:last] - at, ends[first:last] - at
        out[first:last] = (total[end] - total[begin]) * inverse[begin]
        first = last
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _long_hash(word: np.ndarray) -> np.uint64:
    """What the formula of ``word_hashes`` gives for a run longer than a segment."""
    values, powers, _ = _hash_tables()
    total, scale = 0, 1
    for first in range(0, len(word), _SEGMENT):
        piece = word[first:first + _SEGMENT]
        part = int(np.sum(values[piece] * powers[:len(piece)], dtype=np.uint64))
        total = (total + part * scale) % 2**64
        scale = scale * int(powers[_SEGMENT]) % 2**64
    return np.uint64(total)


def sent(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of a value whose class the workers may not have installed; ``received`` gives the value."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast) -> object:
    return pickle.loads(shared.value)


def give_back() -> None:
    """Return what Python, Arrow and the C library hold of freed memory to the system.

    A worker is used again by later stages, so what an earlier task needed would stay with it.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: nothing to return


def seeded(seed: int) -> np.random.Generator:
    return np.random.default_rng(seed)
