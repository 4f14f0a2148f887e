"""Line de-duplication: lines that many documents share go.

Every task puts the hashes of its lines into two Bloom filters, one for hashes seen in a document and one for
hashes seen in a second. The tasks' filters meet block by block: what two tasks both have was seen twice. A
block travels as the list of its bits while few are set, so it never takes more than some bytes per line. The
filter of twice-seen hashes, a bounded number of bits, then goes to every task; only lines that it suspects
are shuffled, by their whole text, to count their documents exactly and to choose a first occurrence. A third
pass rebuilds the texts.

The filters hold no false negative, whatever their size; a filter that is too small for its input only
suspects more lines.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from ridemart.llm.common import binary_values, stored, whole_text, word_hashes, word_places

# Documents that must share a line before it goes.
MIN_DOCS = 10
# Bits set per hash, bits of a filter per line, and its size within these bounds, whatever the input.
HASHES, BITS_PER_LINE, LEAST_BITS, MOST_BITS = 2, 16, 1 << 20, 1 << 29
# Bits of a block of a filter. A block with fewer set bits than this travels as their places.
BLOCK_BITS = 1 << 16
DENSE = BLOCK_BITS // 16
# Repeated lines that are sent to every task, in bytes; beyond that their places are joined.
BROADCAST_BYTES = 32 << 20
_PER_KEY = 64
# A repeated line may stand in a third of all documents: it meets its places in so many parts.
SALTS = 32

_BYTES = np.arange(256, dtype=np.uint8)
_INSIDE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


@dataclass(frozen=True)
class Lines:
    """The lines of some texts that have a key: the text and the number of each in it, and its hash."""

    folded: np.ndarray
    begins: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray
    number: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray

    def key(self, k: int) -> bytes:
        return self.folded[self.first[k]:self.last[k]].tobytes()


def lines_of(texts: list[bytes], min_chars: int) -> Lines:
    """Lines are cut at line feeds; a key is the line without white space at its ends, A-Z in lower case."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begins = np.cumsum([0, *(len(text) + 1 for text in texts)])[:-1]
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    text = np.searchsorted(begins, starts, "right") - 1
    counts = np.bincount(text, minlength=len(texts))
    number = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    # Runs of other bytes than white space never cross a line feed: the first and the last one bound the key.
    run, over = word_places(data, _INSIDE)
    a, b = np.searchsorted(run, starts), np.searchsorted(over, ends, "right") - 1
    some = np.flatnonzero(a <= b)
    first, last = run[a[some]], over[b[some]]
    folded = _FOLD[data]
    if min_chars > 1 and len(some):
        chars = np.append(0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64))
        long = chars[last] - chars[first] >= min_chars
        some, first, last = some[long], first[long], last[long]
    return Lines(folded, begins, first, last, text[some], number[some], word_hashes(folded, first, last), counts)


def _groups(batches: Iterator[pa.RecordBatch], size: int = 2 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """Rows without their text, and the texts (the last column), in groups of bounded size."""
    rows, texts, held = [], [], 0
    for batch in batches:
        names = list(zip(*(column.to_pylist() for column in batch.columns[:-1]))) or [()] * batch.num_rows
        for row, text in zip(names, binary_values(batch.columns[-1])):
            rows.append(row)
            texts.append(text)
            held += len(text)
            if held >= size:
                yield rows, texts
                rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


# --- filters ---

def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of each hash. A filter has a power of two of them."""
    mask, step = np.uint64(bits - 1), (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((hashes + np.uint64(k) * step * np.uint64(0x9E3779B97F4A7C15)) & mask).astype(np.int64)


def held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter holds each hash, perhaps wrongly; a hash that was put in is always held."""
    out = np.ones(len(hashes), bool)
    for place in _places(hashes, 8 * len(bitmap)):
        out &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 != 0
    return out


def put(bitmap: np.ndarray, hashes: np.ndarray) -> None:
    for place in _places(hashes, 8 * len(bitmap)):
        np.bitwise_or.at(bitmap, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))


def observe(once: np.ndarray, twice: np.ndarray, text: np.ndarray, hashes: np.ndarray) -> None:
    """Put the lines of some documents into both filters. A line counts once in each document."""
    order = np.lexsort((text, hashes))
    text, hashes = text[order], hashes[order]
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1]))[:len(hashes)]
    hashes = hashes[~again]
    new = np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)]
    several = hashes[~new]
    hashes = hashes[new]
    put(twice, np.concatenate([hashes[held(once, hashes)], several]))
    put(once, hashes)


def pack(block: np.ndarray) -> bytes:
    """A block as the places of its bits while they are few, else as it is. The two differ in length."""
    places = np.flatnonzero(np.unpackbits(block, bitorder="little"))
    return places.astype("<u2").tobytes() if len(places) < DENSE else block.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if len(data) == BLOCK_BITS // 8:
        return np.frombuffer(data, np.uint8)
    bits = np.zeros(BLOCK_BITS, np.uint8)
    bits[np.frombuffer(data, "<u2")] = 1
    return np.packbits(bits, bitorder="little")


def _filter_bits(lines: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_LINE * max(lines, 1) - 1).bit_length()))


def twice_seen(rows: DataFrame, min_chars: int) -> np.ndarray:
    """The filter of the hashes that stand in two documents or more, of rows (text in bytes).

    Its size follows the number of lines, up to MOST_BITS: 64 MB. A task holds two filters of that size.
    """
    text = F.col("_text")
    total = rows.agg(F.sum(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0]
    bits = _filter_bits(total or 0)
    size = BLOCK_BITS // 8

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for _, texts in _groups(batches):
            lines = lines_of(texts, min_chars)
            observe(once, twice, lines.text, lines.hashes)
        used = np.flatnonzero(once.reshape(-1, size).any(axis=1))
        for first in range(0, len(used), 256):
            some = used[first:first + 256]
            yield pa.RecordBatch.from_arrays([
                pa.array(some, pa.int32()), *(
                    pa.array([pack(bitmap[k * size:(k + 1) * size]) for k in some], pa.binary()) for bitmap in (once, twice)
                ),
            ], ["block", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, once, twice in zip(batch.column(0).to_pylist(), *(binary_values(x) for x in batch.columns[1:])):
                once, twice = unpack(once), unpack(twice)
                if block in seen:
                    before, again = seen[block]
                    once, twice = before | once, again | twice | (before & once)
                seen[block] = once, twice
        found = [(block, twice.tobytes()) for block, (_, twice) in seen.items() if twice.any()]
        blocks, data = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(data, pa.binary())], ["block", "twice"])

    built = rows.select(text.cast("binary").alias("_text")).mapInArrow(build, "block int, once binary, twice binary")
    out = np.zeros((bits // 8 // size, size), np.uint8)
    for row in built.repartition("block").mapInArrow(merge, "block int, twice binary").collect():
        out[row["block"]] = np.frombuffer(row["twice"], np.uint8)
    return out.ravel()


# --- exact confirmation ---

def _suspects(rows: DataFrame, suspected: np.ndarray, min_chars: int) -> DataFrame:
    """What each group of documents has of the suspected lines: key, docs, and the first place (no_id, id, line)."""
    shared = rows.sparkSession.sparkContext.broadcast(suspected)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, texts in _groups(batches):
            lines = lines_of(texts, min_chars)
            found: dict[bytes, list] = {}
            for k in np.flatnonzero(held(shared.value, lines.hashes)):
                name, text = names[lines.text[k]][0], lines.text[k]
                place = name is None, name or 0, int(lines.number[k])
                known = found.setdefault(lines.key(k), [0, -1, place])
                known[0] += known[1] != text
                known[1], known[2] = text, min(known[2], place)
            if found:
                docs, _, places = zip(*found.values())
                no_id, name, line = zip(*places)
                yield pa.RecordBatch.from_arrays([
                    pa.array(found, pa.binary()), pa.array(docs, pa.int64()), pa.array(no_id, pa.bool_()),
                    pa.array(name, pa.int64()), pa.array(line, pa.int32()),
                ], ["key", "docs", "no_id", "id", "line"])

    named = rows.select("_id", F.col("_text").cast("binary").alias("_text"))
    return named.mapInArrow(look, "key binary, docs bigint, no_id boolean, id bigint, line int")


def repeated_lines(
    rows: DataFrame, suspected: np.ndarray, min_docs: int = MIN_DOCS, min_chars: int = 1, keep_first: bool = False,
) -> DataFrame:
    """The keys that ``min_docs`` of the rows (_id, _text) or more have: key (bytes), docs, and with ``keep_first`` the first place."""
    if min_docs < 2:
        raise ValueError("a line that one document has is not repeated")
    suspects = _suspects(rows, suspected, min_chars)
    first = [F.min(F.struct("no_id", "id", "line")).alias("first")] if keep_first else []
    counted = suspects.groupBy("key").agg(F.sum("docs").alias("docs"), *first)
    return counted.filter(F.col("docs") >= min_docs)


# --- rebuilding ---

KEPT = T.StructType([
    T.StructField("text", T.BinaryType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
])


def _rebuild(texts: list[bytes], lines: Lines, dropped: dict[int, set[int]]) -> Iterator[tuple[bytes, int, int]]:
    """Each text without the lines of these numbers, its lines, and how many went."""
    for k, text in enumerate(texts):
        gone = dropped.get(k)
        if gone:
            text = b"\n".join([line for number, line in enumerate(text.split(b"\n")) if number not in gone])
        yield text, int(lines.counts[k]), len(gone or ())


def _answer(rows: list[tuple[bytes, int, int]]) -> pa.StructArray:
    text, total, gone = zip(*rows) if rows else ((), (), ())
    arrays = [pa.array(text, pa.binary()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
    return pa.StructArray.from_arrays(arrays, KEPT.names)


def _by_broadcast(rows: DataFrame, repeats: list, min_chars: int, keep_first: bool) -> Column:
    """The kept text of each row, by the repeated lines themselves."""
    firsts = {bytes(row["key"]): tuple(row["first"]) if keep_first else None for row in repeats}
    shared = rows.sparkSession.sparkContext.broadcast(firsts)

    @arrow_udf(KEPT)
    def keep(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        firsts = shared.value
        joined = np.frombuffer(b" ".join(firsts), np.uint8)
        ends = np.cumsum([len(key) + 1 for key in firsts], dtype=np.int64) - 1
        starts = np.append(0, ends[:-1] + 1)[:len(firsts)]
        known = np.sort(word_hashes(joined, starts, ends)) if len(firsts) else np.zeros(0, np.uint64)
        for names, column in batches:
            out = []
            batch = pa.RecordBatch.from_arrays([names, column], ["_id", "_text"])
            for rows, texts in _groups(iter([batch])):
                lines = lines_of(texts, min_chars)
                maybe = np.zeros(len(lines.hashes), bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, lines.hashes), len(known) - 1)
                    maybe = known[at] == lines.hashes
                dropped: dict[int, set[int]] = {}
                for k in np.flatnonzero(maybe):
                    # The hash only finds the line, its whole text decides.
                    first = firsts.get(lines.key(k), ())
                    name, number = rows[lines.text[k]][0], int(lines.number[k])
                    if first != () and first != (name is None, name or 0, number):
                        dropped.setdefault(int(lines.text[k]), set()).add(number)
                out += _rebuild(texts, lines, dropped)
            yield _answer(out)

    return keep(F.col("_id"), F.col("_text"))


def _places_of(rows: DataFrame, suspected: np.ndarray, min_chars: int) -> DataFrame:
    """Every place of a suspected line: key, row (what names the document), no_id, id, line."""
    shared = rows.sparkSession.sparkContext.broadcast(suspected)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, texts in _groups(batches):
            lines = lines_of(texts, min_chars)
            found = np.flatnonzero(held(shared.value, lines.hashes))
            name = [names[lines.text[k]] for k in found]
            yield pa.RecordBatch.from_arrays([
                pa.array([lines.key(k) for k in found], pa.binary()), pa.array([x[1] for x in name], pa.binary()),
                pa.array([x[0] is None for x in name], pa.bool_()), pa.array([x[0] or 0 for x in name], pa.int64()),
                pa.array(lines.number[found], pa.int32()),
            ], ["key", "row", "no_id", "id", "line"])

    named = rows.select("_id", "_name", F.col("_text").cast("binary").alias("_text"))
    return named.mapInArrow(look, "key binary, row binary, no_id boolean, id bigint, line int")


@arrow_udf(KEPT)
def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    some = list(binary_values(texts))
    dropped = {k: set(numbers) for k, numbers in enumerate(gone.to_pylist()) if numbers}
    return _answer(list(_rebuild(some, lines_of(some, 1), dropped)))


def _by_join(rows: DataFrame, repeats: DataFrame, suspected: np.ndarray, min_chars: int, keep_first: bool) -> DataFrame:
    """The rows with their kept text, by joining the places of repeated lines to their documents.

    Rows of one id and text have the same places, so they share them.
    """
    name = F.unhex(F.sha2(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(":"), F.col("_text")).cast("binary"), 256))
    rows = rows.withColumn("_name", name)
    places = _places_of(rows, suspected, min_chars).withColumn(
        "salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"),
    )
    salted = repeats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = places.join(salted, ["key", "salt"])
    if keep_first:
        met = met.filter(F.struct("no_id", "id", "line") != F.col("first"))
    gone = met.groupBy("row").agg(F.collect_set("line").alias("_gone")).withColumnRenamed("row", "_name")
    joined = rows.join(gone, "_name", "left")
    return joined.select("_row", "_id", _without(F.col("_text"), F.coalesce("_gone", F.array().cast("array<int>"))).alias("_kept"))


def _kept(
    docs: DataFrame, min_docs: int, min_chars: int, keep_first: bool, id_col: str, text_col: str, broadcast_bytes: int,
) -> DataFrame:
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(id_col).cast("bigint").alias("_id"), whole_text(text_col).alias("_text"),
    )
    suspected = twice_seen(rows, min_chars)
    repeats = stored(repeated_lines(rows, suspected, min_docs, min_chars, keep_first), "repeated-lines")
    size = repeats.agg(F.sum(F.octet_length("key") + _PER_KEY)).first()[0] or 0
    if size > broadcast_bytes:
        return _by_join(rows, repeats, suspected, min_chars, keep_first)
    return rows.select("_row", "_id", _by_broadcast(rows, repeats.collect(), min_chars, keep_first).alias("_kept"))


def mark_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, keep_first: bool = False,
    id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_lines, n_dropped and the text that stays.

    A text is cut at line feeds; NULL counts as empty, and an empty text is one empty line. A line's key is the line
    without white space (space, tab to carriage return) at its ends, A-Z in lower case. Keys of at least
    ``min_chars`` code points that ``min_docs`` rows or more have lose all their lines in every document, but
    with ``keep_first`` for the one in the smallest id and place. Other lines, blank ones among them, stay as they
    are. A key counts once in a row however often it stands there.

    Rows that repeat an id are documents each; those that share the id of the first occurrence keep it each.
    A NULL id comes after all others, and ids must be whole numbers. Other columns are ignored, so their names do
    not matter. An empty table gives an empty result.
    """
    kept = _kept(docs, min_docs, min_chars, keep_first, id_col, text_col, broadcast_bytes)
    return kept.select(F.col("_id").alias(id_col), "_kept.n_lines", "_kept.n_dropped", F.col("_kept.text").cast("string").alias(text_col))


def drop_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, keep_first: bool = False,
    id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, the text without its repeated lines. The same rules as ``mark_lines``."""
    kept = _kept(docs, min_docs, min_chars, keep_first, id_col, text_col, broadcast_bytes)
    return kept.select(*[
        F.col("_kept.text").cast("string").alias(name) if name == text_col else F.col("_row").getField(name).alias(name)
        for name in docs.columns
    ])
