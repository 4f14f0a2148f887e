"""Fill-in-middle: a text is cut into prefix, middle and suffix by code points and put together in another order.

Code points are found by a sparse exception index. Of a UTF-8 text it records the multibyte characters only:
where each stands and how many bytes beyond one all of them up to it take. Between two of them positions in
code points and in bytes differ by a constant, so ASCII spans need no table: a binary search among the
exceptions turns either kind of position into the other. Texts are worked on in groups of bounded size, all
cuts of a group at once.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from ridemart.llm.common import binary_values

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Of 100 texts, those from this draw on stay plain; of the others, those below this one are suffix first.
PLAIN_FROM, SPM_BELOW = 90, 20
# Bytes of the texts that are cut together.
GROUP_BYTES = 4 << 20


@dataclass(frozen=True)
class Exceptions:
    """The multibyte characters of UTF-8 bytes: where each begins, in bytes and in code points, and the bytes in
    excess of one per character before the k-th of them."""

    at_byte: np.ndarray
    at_char: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> "Exceptions":
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        extra = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        excess = np.concatenate([np.zeros(1, np.int64), np.cumsum(extra, dtype=np.int64)])
        return cls(lead, lead - excess[:-1], excess)

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """Byte positions of code-point positions."""
        return chars + self.excess[np.searchsorted(self.at_char, chars, "left")]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code-point positions of byte positions, which must lie between characters."""
        return places - self.excess[np.searchsorted(self.at_byte, places, "left")]


def draws(name: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 for each id: the first 8-digit groups of the hex SHA-256 of "seed:id"; NULL is an empty id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have GROUP_BYTES together, or a single row."""
    first, ends = 0, np.cumsum(sizes)
    while first < len(sizes):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + GROUP_BYTES, "right")))
        yield first, last
        first = last


def cut(texts: list[bytes], one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code-point and byte positions of each text's start, its two cuts in order, and its end: arrays of four columns.

    The cuts are the draws modulo the number of places between code points, both ends included.
    """
    begins = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    index = Exceptions.of(np.frombuffer(b"".join(texts), np.uint8))
    chars = index.to_chars(begins)
    n = np.diff(chars)
    cuts = np.sort(np.stack([one % (n + 1), two % (n + 1)], axis=1), axis=1)
    within = np.column_stack([np.zeros_like(n), cuts, n])
    return within, index.to_bytes(within + chars[:-1, None]) - begins[:-1, None]


def arrange(text: bytes, a: int, b: int, form: str) -> bytes:
    """The text in its form, cut at two byte positions."""
    if form == PLAIN:
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == PSM:
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def rearrange(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given. No part holds a mark, so the first of each kind is the mark itself."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    at, end = output.index(second), output.index(MIDDLE)
    one, two, middle = output[len(first):at], output[at + len(second):end], output[end + len(MIDDLE):]
    return b"".join((one, middle, two) if form == PSM else (two, middle, one))


def _holds_mark(text: bytes) -> bool:
    return PREFIX in text or SUFFIX in text or MIDDLE in text


RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
])
_ARROW = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


@arrow_udf(RESULT)
def _transform(texts: pa.Array, one: pa.Array, two: pa.Array, three: pa.Array, four: pa.Array) -> pa.Array:
    columns: list[list] = [[] for _ in _ARROW]
    numbers = [x.to_numpy(zero_copy_only=False) for x in (one, two, three, four)]
    sizes = np.array([value or 0 for value in pa.compute.binary_length(texts).to_pylist()], np.int64)
    for first, last in _groups(sizes):
        some = list(binary_values(texts.slice(first, last - first)))
        h1, h2, h3, h4 = (x[first:last] for x in numbers)
        chars, places = cut(some, h1, h2)
        plain, suffix_first = h3 % 100 >= PLAIN_FROM, h4 % 100 < SPM_BELOW
        for k, text in enumerate(some):
            form = PLAIN if not text or plain[k] or _holds_mark(text) else SPM if suffix_first[k] else PSM
            whole = form == PLAIN
            row = (
                int(chars[k, 3]), form, None if whole else int(chars[k, 1]),
                None if whole else int(chars[k, 2] - chars[k, 1]), arrange(text, places[k, 1], places[k, 2], form),
            )
            for column, value in zip(columns, row):
                column.append(value)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, _ARROW)]
    return pa.StructArray.from_arrays(arrays, RESULT.names)


@arrow_udf(T.StringType())
def _restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    rows = zip(binary_values(outputs), forms.to_pylist())
    return pa.array([rearrange(output, form or PLAIN) for output, form in rows], pa.string())


def fill_in_middle(text: Column, numbers: list[Column]) -> Column:
    """Struct of n (code points), form, prefix_chars, middle_chars and output, from four draws per row.

    The first two draws cut the text, the third keeps it plain or not, the fourth puts the suffix first or not.
    A NULL or empty text, and one that holds a mark, is plain: its output is the text and it has no cut, so
    both numbers of code points are NULL. Bytes that are no UTF-8 become U+FFFD first. Works row by row on
    whole texts of any length, so repeated rows, ties, other columns and empty tables need no rule. A NULL draw
    counts as 0.
    """
    whole = F.make_valid_utf8(F.coalesce(text.cast("string"), F.lit("")))
    return _transform(whole, *[F.coalesce(number, F.lit(0)).cast("bigint") for number in numbers])


def restore(output: Column, form: Column) -> Column:
    """The exact text of an output and its form. NULL output gives an empty text, NULL form is plain."""
    return _restore(F.coalesce(output, F.lit("")), form)
