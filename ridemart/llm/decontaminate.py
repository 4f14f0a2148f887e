"""Benchmark decontamination that also catches re-parameterised questions.

Texts are canonicalised: words are runs of letters and digits, lower-cased (ASCII and Latin-1 capitals);
numbers, units after numbers, and names inside a sentence become typed placeholders. Windows of canonical tokens are
hash-joined with those of the benchmark. Windows of one document and item that lie in a stretch of the document
little longer than the item form a match, whatever words were put in, left out or moved between them. It
counts when the slots are consistent (a name or long number of the item stands for one value of the document
at most of its places) and the matched windows cover enough of the item, or a long enough run of it. Short numbers and units may be equal
by chance, so they say nothing, and different values of the item may become equal. Windows of plain lower-cased words are joined in the same way, so that
copies in other capitals are found too.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ridemart.llm.common import binary_values, seeded, stored, word_hashes, word_places

WINDOW = 8
# Items with fewer words say too little to be recognised.
MIN_WORDS = 5
# Words of a template window that must not be placeholders.
MIN_LITERALS = 4
COVERAGE = 0.5
# So many tokens of an item in one run are a leak, whatever their share.
RUN = 20
# Numbers with fewer digits are often equal by chance.
CHANCE_DIGITS = 4
# Benchmark windows that are sent to every task as a filter: 8 bytes each. Beyond, every window is joined.
FILTER_WINDOWS = 4_000_000

# Units that make a slot when they follow a number.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons pound pounds lb oz ounce "
    "ounces ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours h day "
    "days week weeks month months year years percent cent cents dollar dollars euro euros degree degrees kmh mph "
    "meter meters metre metres kilometer kilometers".split()
)
# Letters and digits, and every byte of a character beyond ASCII.
_BYTES = np.arange(256, dtype=np.uint8)
_DIGIT, _CAPITAL = (_BYTES >= 48) & (_BYTES <= 57), (_BYTES >= 65) & (_BYTES <= 90)
_INSIDE = _DIGIT | _CAPITAL | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_FOLD = np.where(_CAPITAL, _BYTES + 32, _BYTES).astype(np.uint8)
_MARK = np.isin(_BYTES, np.frombuffer(b".!?", np.uint8))
PLACEHOLDERS = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_FACTORS = seeded(2024).integers(0, 2**63, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)

WINDOWS = "key bigint, place int, width int, slots array<string>, exact boolean"


@dataclass(frozen=True)
class View:
    """Hash per token, its first and last byte, the type of its slot or 0, and the number of its text."""

    codes: np.ndarray
    first: np.ndarray
    last: np.ndarray
    slot: np.ndarray
    text: np.ndarray

    def places(self) -> np.ndarray:
        """The number of each token in its text."""
        begin = np.flatnonzero(np.append(True, self.text[1:] != self.text[:-1])[:len(self.text)])
        return np.arange(len(self.text)) - np.repeat(begin, np.diff(np.append(begin, len(self.text))))


def fold_case(data: np.ndarray) -> np.ndarray:
    """ASCII capitals and those of Latin-1 (two bytes in UTF-8, the first 0xC3) in lower case."""
    folded = _FOLD[data]
    latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[1:][latin] += 32
    return folded


def _unit_codes() -> np.ndarray:
    data = np.frombuffer(" ".join(sorted(UNITS)).encode(), np.uint8)
    return np.sort(word_hashes(data, *word_places(data, _INSIDE)))


_GAP = b" . "


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Several texts as one array of bytes, with a full stop between them, and where each begins."""
    begins = np.cumsum([0, *(len(text) + len(_GAP) for text in texts)])[:-1]
    return np.frombuffer(_GAP.join(texts), np.uint8), begins


def views(data: np.ndarray, begins: np.ndarray, units: np.ndarray) -> tuple[View, View]:
    """The texts with placeholders, and the texts as lower-cased words."""
    first, last = word_places(data, _INSIDE)
    none = np.zeros(len(first), np.int8)
    text = np.searchsorted(begins, first, "right") - 1
    if not len(first):
        return (View(none.astype(np.uint64), first, last, none, text),) * 2
    code = word_hashes(fold_case(data), first, last)
    spans = np.column_stack([first, last]).ravel()[:-1]
    number = np.logical_and.reduceat(_DIGIT[data], spans)[::2]
    capitals = np.add.reduceat(_CAPITAL[data], spans, dtype=np.int32)[::2]
    capital = _CAPITAL[data[first]] & (capitals == 1) & (last - first > 1)
    opens = np.ones(len(first), bool)
    opens[1:] = text[1:] != text[:-1]
    after = opens.copy()  # a mark, or the start of the text, stands before the word
    after[1:] |= np.logical_or.reduceat(_MARK[data], spans)[1::2]
    slot = none.copy()
    slot[number] = 1
    maybe = np.flatnonzero(number[:-1] & ~number[1:] & ~opens[1:]) + 1
    place = np.minimum(np.searchsorted(units, code[maybe]), len(units) - 1)
    slot[maybe[units[place] == code[maybe]]] = 2
    slot[capital & ~after & (slot == 0)] = 3
    # Several words of one name, or parts of one number, are one slot.
    start = opens.copy()
    start[1:] |= (slot[1:] != slot[:-1]) | (slot[1:] == 0) | (slot[1:] == 2) | (after[1:] & (slot[1:] == 3))
    at = np.flatnonzero(start)
    codes = np.where(slot[at] > 0, PLACEHOLDERS[slot[at]], code[at])
    end = last[np.append(at[1:], len(first)) - 1]
    return View(codes, first[at], end, slot[at], text[at]), View(code, first, last, none, text)


def window_keys(codes: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hash of every run of ``size`` codes."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    total = np.full(n, (size * 31 + salt) * 0x9E3779B9, np.uint64)
    for k in range(size):
        total += codes[k:k + n] * _FACTORS[k]
    total ^= total >> np.uint64(29)
    return (total * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _enough_literals(view: View, size: int) -> np.ndarray:
    literal = np.append(0, np.cumsum(view.slot == 0))
    return literal[size:] - literal[:-size] >= min(MIN_LITERALS, size)


_PARTS = re.compile(rb"[^0-9a-z\x80-\xff]+")


def _slots(folded: np.ndarray, view: View, place: int, size: int) -> list[str]:
    """Offset, type and value of each slot of a window. What separates the parts of a value does not count."""
    out = []
    for k in range(place, place + size):
        if kind := view.slot[k]:
            value = _PARTS.sub(b"" if kind == 1 else b" ", folded[view.first[k]:view.last[k]].tobytes())
            out.append(f"{k - place}:{kind}:{value.decode('utf-8', 'replace')}")
    return out


def text_windows(texts: list[bytes], units: np.ndarray, sizes: list[int], wanted: "Filter | None") -> list[tuple]:
    """Windows as (number of the text, key, place, width, slots, exact), of every size, that the filter lets through."""
    data, begins = joined(texts)
    out, folded = [], None
    for exact, view in zip((False, True), views(data, begins, units)):
        places = None
        for size in sizes:
            keys = window_keys(view.codes, size, exact)
            if not len(keys):
                continue
            keep = view.text[:len(keys)] == view.text[size - 1:]
            if wanted is not None:
                keep &= wanted.holds(keys)
            if not keep.any():
                continue
            places = view.places() if places is None else places
            if not exact:
                keep &= _enough_literals(view, size)
                folded = fold_case(data) if folded is None else folded
            out += [
                (int(view.text[k]), int(keys[k]), int(places[k]), size, [] if exact else _slots(folded, view, k, size), exact)
                for k in np.flatnonzero(keep)
            ]
    return out


def _groups(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of (id, text) batches in groups of bounded size."""
    names, texts, held = [], [], 0
    for batch in batches:
        for name, text in zip(batch.column(0), binary_values(batch.column(1))):
            names.append(name.as_py())
            texts.append(text)
            held += len(text)
            if held >= size:
                yield names, texts
                names, texts, held = [], [], 0
    if names:
        yield names, texts


class Filter:
    """The sorted keys of all benchmark windows, behind a table of bits."""

    BITS = 22

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys)
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[self._slot(self.keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = self.bits[self._slot(keys)]
        maybe = np.flatnonzero(found)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            found[maybe] = self.keys[at] == keys[maybe]
        return found


def _windows(rows: DataFrame, id_col: str, text_col: str, sizes: list[int], wanted: np.ndarray | None) -> DataFrame:
    """One row per window of each text: _id, key, place, width, slots, exact."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(wanted)
    named = rows.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text"))
    schema = pa.schema([
        ("_id", pa.int64()), ("key", pa.int64()), ("place", pa.int32()), ("width", pa.int32()),
        ("slots", pa.list_(pa.string())), ("exact", pa.bool_()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, wanted = _unit_codes(), shared.value
        lookup = None if wanted is None else Filter(wanted)
        for names, texts in _groups(batches):
            found = [(names[k], *window) for k, *window in text_windows(texts, units, sizes, lookup)]
            if found:
                columns = [pa.array(values, field.type) for values, field in zip(zip(*found), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return named.filter(F.col("_id").isNotNull()).mapInArrow(cut, f"_id bigint, {WINDOWS}")


def _item_sizes(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Number of tokens of each item in both views: _id, exact, size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _unit_codes()
        for names, texts in _groups(batches):
            rows = [
                (names[k], exact, int(n)) for exact, view in zip((False, True), views(*joined(texts), units))
                for k, n in enumerate(np.bincount(view.text, minlength=len(texts)))
            ]
            name, exact, size = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name, pa.int64()), pa.array(exact, pa.bool_()), pa.array(size, pa.int32())],
                ["_id", "exact", "size"],
            )

    named = items.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text"))
    return named.filter(F.col("_id").isNotNull()).mapInArrow(count, "_id bigint, exact boolean, size int")


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE,
    filter_windows: int = FILTER_WINDOWS,
) -> DataFrame:
    """One row per document and benchmark item that it holds: id, item_id, coverage, exact, first_token.

    ``coverage`` is the share of the item's tokens under matched windows of the best stretch of the document, and
    below the limit where RUN tokens in a row match. ``exact`` says that it is a copy in plain words, ``first_token`` is where the match begins among the view's tokens.
    NULL texts and texts without words match nothing, as do items of fewer than MIN_WORDS words; rows without
    an id cannot be named and are left out. Repeated rows and items of equal text give one row per pair of
    ids. Other columns are ignored. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    sizes = stored(_item_sizes(benchmark, item_col, item_text_col).filter(F.col("size") >= MIN_WORDS)
                   .groupBy("_id", "exact").agg(F.max("size").alias("size")), "item-sizes")
    # Items below WINDOW words are one window of their own length.
    lengths = [row[0] for row in sizes.select(F.least("size", F.lit(WINDOW))).distinct().collect()]
    windows = _windows(benchmark, item_col, item_text_col, sorted(lengths), None).distinct().withColumnsRenamed(
        {"_id": "_item", "place": "_item_place", "slots": "_item_slots"},
    )
    sized = windows.join(sizes.withColumnsRenamed({"_id": "_item"}), ["_item", "exact"])
    items = stored(sized.filter(F.col("width") == F.least("size", F.lit(WINDOW))).drop("width"), "item-windows")
    keys = items.select("key").distinct()
    wanted = None
    if keys.count() <= filter_windows:
        wanted = np.array([row[0] for row in keys.collect()], np.int64)
    return _matched(_windows(docs, id_col, text_col, sorted(lengths), wanted), items, coverage).select(
        F.col("_id").alias(id_col), F.col("_item").alias(item_col), "coverage", "exact", "first_token",
    )


def consistent(found: list[tuple]) -> bool:
    """Whether these matched windows (place, item_place, slots, item_slots) may be one question with other values.

    Names and long numbers that the item has several times must stand for one value at more than half of these
    places. Each place of the item is read on the diagonal with the most windows.
    """
    weight = Counter(place - item_place for place, item_place, *_ in found)
    values = {}
    for place, item_place, slots, item_slots in sorted(found, key=lambda x: (weight[x[0] - x[1]], x[1] - x[0])):
        for own, other in zip(item_slots, slots):
            offset, kind, value = own.split(":", 2)
            if kind == "3" or kind == "1" and len(value) >= CHANCE_DIGITS:
                values[item_place + int(offset)] = (kind, value), other.split(":", 2)[2]
    stands_for = defaultdict(Counter)
    for own, other in values.values():
        stands_for[own][other] += 1
    repeated = [seen for seen in stands_for.values() if seen.total() > 1]
    return not repeated or 2 * sum(max(seen.values()) for seen in repeated) > sum(seen.total() for seen in repeated)


def _longest_run(found: list[tuple], width: int) -> int:
    """The most tokens in a row under windows of one diagonal."""
    best, ends = 0, {}
    for place, item_place, *_ in found:
        first, last = ends.get(place - item_place, (place, place))
        first = place if place > last else first
        ends[place - item_place] = first, place + width
        best = max(best, place + width - first)
    return best


def best_match(found: list[tuple], size: int, coverage: float) -> tuple[float, int] | None:
    """The largest share of an item of ``size`` tokens under consistent windows of one stretch, and its first place."""
    width, reach = min(size, WINDOW), size + max(WINDOW, size // 2)
    found = sorted(found, key=lambda x: x[:2])
    times, covered, end, best = [0] * size, 0, 0, None
    for begin, (first, item_place, *_) in enumerate(found):
        grown = end
        while end < len(found) and found[end][0] + width <= first + reach:
            for k in range(found[end][1], found[end][1] + width):
                covered += not times[k]
                times[k] += 1
            end += 1
        if end > grown and (best is None or covered / size > best[0]):
            part = found[begin:end]
            enough = covered >= coverage * size or covered >= RUN and _longest_run(part, width) >= RUN
            if enough and consistent(part):
                best = covered / size, first
        for k in range(item_place, item_place + width):
            times[k] -= 1
            covered -= not times[k]
    return best


def _matched(windows: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    both = windows.drop("width").distinct().join(items, ["key", "exact"]).filter(F.size("_item_slots") == F.size("slots"))
    grouped = both.groupBy("_id", "_item", "exact", "size").agg(
        F.collect_list(F.struct("place", "_item_place", "slots", "_item_slots")).alias("_found"),
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, item, exact, size, found in zip(*(column for column in batch.columns)):
                best = best_match([tuple(x.values()) for x in found.as_py()], size.as_py(), coverage)
                if best:
                    out.append((name.as_py(), item.as_py(), exact.as_py(), *best))
            if out:
                kinds = pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.int32()
                columns = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_item", "exact", "coverage", "first_token"])

    best = grouped.mapInArrow(match, "_id bigint, _item bigint, exact boolean, coverage double, first_token int")
    order = F.struct("coverage", "exact", -F.col("first_token"))
    return best.groupBy("_id", "_item").agg(F.max(order).alias("_best")).select(
        "_id", "_item", "_best.coverage", "_best.exact", (-F.col("_best.col3")).alias("first_token"),
    )


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    broadcast_rows: int = 1_000_000, **options: object,
) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns. Rows without an id stay."""
    leaks = stored(find_leaks(docs, benchmark, id_col, text_col, **options).select(id_col).distinct(), "leaks")
    small = leaks.count() <= broadcast_rows
    return docs.join(F.broadcast(leaks) if small else leaks, id_col, "left_anti").select(*docs.columns)
