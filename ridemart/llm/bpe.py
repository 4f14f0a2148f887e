"""Byte-level BPE: encoding and decoding with the ranks of a public vocabulary.

A text is cut by the vocabulary's pattern. What is not a vocabulary entry as a whole is merged in padded
numpy matrices, one row per distinct piece and one matrix per bucket of lengths. Each round, every row
merges its leftmost pair of minimum rank; pair ranks come from a hash table with open addressing, and rows
that are done leave the matrix, which shrinks with its longest row.
"""

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from ridemart.llm.common import give_back

# Ids must fit 16 bits, as two of them make a key. It also bounds what is broadcast: a few MB.
MAX_TOKENS = 1 << 16
NO_RANK = np.int32(2**31 - 1)
# Cells of one matrix, and distinct pieces whose ids a task remembers (some 200 bytes each) and their letters.
MATRIX_CELLS = 1 << 20
REMEMBERED_PIECES, REMEMBERED_LETTERS = 150_000, 8 << 20
# Bytes of the texts that are worked on together and handed on as one batch.
GROUP_BYTES = 1 << 20
# A piece from this length on is a row of its own, whose rounds touch one block of so many cells.
LONG_PIECE, LONG_BLOCK = 1 << 13, 1 << 10


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, and the rank of every pair of tokens that joins to a token."""

    tokens: list[bytes]
    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray

    @cached_property
    def whole(self) -> dict[bytes, int]:
        return {token: rank for rank, token in enumerate(self.tokens)}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NO_RANK where there is none or an id is below 0."""
        key = (left.astype(np.int64) << 16) | right
        key[(left < 0) | (right < 0)] = -2
        found = np.full(key.shape, NO_RANK, np.int32)
        open_at, slot = np.arange(key.size), _slots(key.ravel(), len(self.keys))
        flat, out = key.ravel(), found.ravel()
        while open_at.size:
            at = self.keys[slot]
            hit = at == flat[open_at]
            out[open_at[hit]] = self.ranks[slot[hit]]
            on = ~hit & (at != -1)
            open_at, slot = open_at[on], (slot[on] + 1) % len(self.keys)
        return out.reshape(key.shape)


    def pair_rank(self, left: int, right: int) -> int:
        """``pair_ranks`` of one pair."""
        key = left << 16 | right
        slot = (key * 0x9E3779B97F4A7C15 % 2**64) >> (64 - len(self.keys).bit_length() + 1)
        while (at := self.keys[slot]) != -1:
            if at == key:
                return int(self.ranks[slot])
            slot = (slot + 1) % len(self.keys)
        return int(NO_RANK)


    def parts(self) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """What it is made of: this can be broadcast to workers that do not have the class."""
        return self.tokens, self.byte_ids, self.keys, self.ranks


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - int(size).bit_length() + 1)).astype(np.int64)


def read_vocabulary(path: str) -> Vocabulary:
    """From a file of lines "base64(token) rank", ranks 0, 1, 2, ... in order of merging."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return make_vocabulary(ranks)


def make_vocabulary(ranks: dict[bytes, int]) -> Vocabulary:
    if len(ranks) > MAX_TOKENS or sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError(f"ranks must be 0, 1, 2, ... and at most {MAX_TOKENS}")
    if any(bytes([value]) not in ranks for value in range(256)):
        raise ValueError("every single byte must be a token")
    pairs = [
        (ranks[token[:cut]] << 16 | ranks[token[cut:]], rank)
        for token, rank in ranks.items() for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    size = 1 << max(4, (2 * len(pairs)).bit_length())
    keys, values = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    todo = np.array(pairs, np.int64).reshape(-1, 2)
    slot = _slots(todo[:, 0], size)
    while len(todo):
        free = keys[slot] == -1
        keys[slot[free]] = todo[free, 0]
        won = free & (keys[slot] == todo[:, 0])
        values[slot[won]] = todo[won, 1]
        todo, slot = todo[~won], (slot[~won] + 1) % size
    tokens = sorted(ranks, key=ranks.__getitem__)
    byte_ids = np.array([ranks[bytes([value])] for value in range(256)], np.int32)
    return Vocabulary(tokens, byte_ids, keys, values)


def merge_rows(vocabulary: Vocabulary, pieces: list[bytes]) -> list[np.ndarray]:
    """Ids of pieces of similar length, all merged together."""
    lengths = np.array([len(piece) for piece in pieces])
    width = int(lengths.max())
    ids = np.full((len(pieces), width + 1), -1, np.int32)
    filled = np.arange(width + 1) < lengths[:, None]
    ids[filled] = vocabulary.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    ranks = vocabulary.pair_ranks(ids[:, :-1], ids[:, 1:])
    row, done = np.arange(len(pieces)), [None] * len(pieces)
    while True:
        place = ranks.argmin(axis=1)
        best = ranks[np.arange(len(row)), place]
        over = best == NO_RANK
        if over.any():
            for k in np.flatnonzero(over):
                done[row[k]] = ids[k, :lengths[k]].copy()
            live = ~over
            if not live.any():
                return done
            row, lengths, place, best = row[live], lengths[live], place[live], best[live]
            width = int(lengths.max())
            ids, ranks = ids[live, :width + 1], ranks[live, :width]
        if len(row) == 1:
            k = int(place[0])
            ids[0, k + 1:-1] = ids[0, k + 2:].copy()
            ranks[0, k:-1] = ranks[0, k + 1:].copy()
            if lengths[0] < ids.shape[1] // 2:
                ids, ranks = ids[:, :lengths[0] + 1].copy(), ranks[:, :lengths[0]].copy()
        else:
            columns = np.arange(width + 1)
            moved = columns[None, :-1] > place[:, None]
            ids[:, :-1] = np.where(moved, ids[:, 1:], ids[:, :-1])
            moved = columns[None, :-2] >= place[:, None]
            ranks[:, :-1] = np.where(moved, ranks[:, 1:], ranks[:, :-1])
        ids[:, -1], ranks[:, -1] = -1, NO_RANK
        at = np.arange(len(row))
        ids[at, place] = best
        lengths = lengths - 1
        ranks[at, place] = vocabulary.pair_ranks(ids[at, place], ids[at, place + 1])
        inner = place > 0
        at, place = at[inner], place[inner]
        ranks[at, place - 1] = vocabulary.pair_ranks(ids[at, place - 1], ids[at, place])


def merge_long(vocabulary: Vocabulary, piece: bytes) -> np.ndarray:
    """Ids of one long piece: the same rounds, the leftmost pair of minimum rank at a time.

    The row is kept in blocks with the smallest rank of each, so a round looks at the blocks' minima and moves the
    cells of one block, not of the whole row.
    """
    start = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)]
    ranks = np.append(vocabulary.pair_ranks(start[:-1], start[1:]), NO_RANK)
    ids_of = [start[k:k + LONG_BLOCK].copy() for k in range(0, len(start), LONG_BLOCK)]
    ranks_of = [ranks[k:k + LONG_BLOCK].copy() for k in range(0, len(start), LONG_BLOCK)]
    sizes = [len(ids) for ids in ids_of]
    least = np.array([block.min() for block in ranks_of])
    after, before = list(range(1, len(sizes) + 1)), list(range(-1, len(sizes) - 1))

    def drop(b: int, k: int) -> None:
        """Take a cell out of a block; an empty block leaves the chain."""
        size = sizes[b]
        ids_of[b][k:size - 1] = ids_of[b][k + 1:size]
        ranks_of[b][k:size - 1] = ranks_of[b][k + 1:size]
        ranks_of[b][size - 1] = NO_RANK
        sizes[b] = size - 1
        if size == 1:
            if before[b] >= 0:
                after[before[b]] = after[b]
            if after[b] < len(sizes):
                before[after[b]] = before[b]

    def rank(b: int, k: int) -> int:
        """Rank of the pair that begins at a cell."""
        if k + 1 < sizes[b]:
            return vocabulary.pair_rank(int(ids_of[b][k]), int(ids_of[b][k + 1]))
        following = after[b]
        if following == len(sizes):
            return int(NO_RANK)
        return vocabulary.pair_rank(int(ids_of[b][k]), int(ids_of[following][0]))

    while True:
        b = int(least.argmin())
        best = least[b]
        if best == NO_RANK:
            return np.concatenate([ids[:size] for ids, size in zip(ids_of, sizes)])
        k = int(ranks_of[b].argmin())
        gone = b if k + 1 < sizes[b] else after[b]
        drop(gone, k + 1 if gone == b else 0)
        ids_of[b][k] = best
        ranks_of[b][k] = rank(b, k)
        left, at = (b, k - 1) if k else (before[b], sizes[before[b]] - 1 if before[b] >= 0 else 0)
        if left >= 0:
            ranks_of[left][at] = rank(left, at)
        for touched in {b, gone, left} - {-1}:
            least[touched] = ranks_of[touched].min()


def encode_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> list[np.ndarray]:
    """Ids of each piece: buckets of equal or nearly equal length, cut into matrices of bounded size."""
    whole = vocabulary.whole
    out: list = [None] * len(pieces)
    order = []
    for k, piece in enumerate(pieces):
        rank = whole.get(piece)
        if rank is not None:
            out[k] = np.array([rank], np.int32)
        elif len(piece) >= LONG_PIECE:
            out[k] = merge_long(vocabulary, piece)
        else:
            order.append(k)
    order.sort(key=lambda k: len(pieces[k]))
    first = 0
    while first < len(order):
        shortest, last = len(pieces[order[first]]), first + 1
        while (
            last < len(order) and len(pieces[order[last]]) <= shortest + shortest // 4
            and (last + 1 - first) * len(pieces[order[last]]) <= MATRIX_CELLS
        ):
            last += 1
        bucket = order[first:last]
        for k, ids in zip(bucket, merge_rows(vocabulary, [pieces[k] for k in bucket])):
            out[k] = ids
        first = last
    return out


class _Pieces(dict):
    """Number of each distinct piece, given out at first sight."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Encodes texts one batch after the other, and remembers the pieces it has seen up to a bound."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        import regex

        # White space is what Unicode calls so, without the four separators that Python adds.
        pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.vocabulary, self.cut = vocabulary, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.letters = _Pieces(), 0
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self, known: int) -> None:
        if len(self.numbers) == known:
            return
        new = [piece.encode() for piece in islice(self.numbers, known, None)]
        self.letters += sum(map(len, new))
        ids = encode_pieces(self.vocabulary, new)
        sizes = np.array([len(x) for x in ids], np.int64)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, *ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known, numbers = len(self.numbers), []
        for text in texts:
            pieces = self.cut(text)
            numbers.append(np.fromiter(map(self.numbers.__getitem__, pieces), np.int32, len(pieces)))
        self._learn(known)
        out = [self._gather(number) for number in numbers]
        if len(self.numbers) > REMEMBERED_PIECES or self.letters > REMEMBERED_LETTERS:
            self._forget()
        return out

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(self.starts[numbers] - ends + sizes, sizes)]


def _groups(texts: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of a batch whose texts have ``size`` bytes together, or a single row."""
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
        yield first, last
        first = last


def _encode_group(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    ids = encoder.encode([value.as_py() or "" for value in texts])
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *ids]))


def _encode_batch(encoder: Encoder, batch: pa.Array) -> pa.ListArray:
    groups = [_encode_group(encoder, batch.slice(first, last - first)) for first, last in _groups(batch)]
    return pa.concat_arrays(groups) if groups else pa.array([], pa.list_(pa.int32()))


def _decode_batch(tokens: list[bytes], batch: pa.ListArray) -> pa.Array:
    token, values = tokens.__getitem__, batch.values.to_numpy()
    if len(values) and values.min() < 0:
        raise IndexError("a token id is below 0")
    ends = batch.offsets.to_pylist()
    return pa.array([b"".join(map(token, values[a:b].tolist())) for a, b in zip(ends, ends[1:])], pa.binary())


def encode(spark: SparkSession, text: Column, vocabulary: Vocabulary, pattern: str) -> Column:
    """Array of token ids of each whole text, each match of the pattern on its own, no special tokens.

    NULL and empty texts give an empty array. Works row by row: repeated rows, other columns and empty
    tables need no rule. The vocabulary is broadcast; its size is bounded by MAX_TOKENS.
    """
    shared = spark.sparkContext.broadcast(vocabulary.parts())

    @arrow_udf(T.ArrayType(T.IntegerType()))
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(Vocabulary(*shared.value), pattern)
        for batch in batches:
            yield _encode_batch(encoder, batch)

    return encode_texts(F.coalesce(text.cast("string"), F.lit("")))


def decode(spark: SparkSession, ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that an array of ids stands for. NULL gives no bytes; an unknown id is an error."""
    shared = spark.sparkContext.broadcast(vocabulary.tokens)

    @arrow_udf(T.BinaryType())
    def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _decode_batch(shared.value, batch)

    return decode_ids(F.coalesce(ids, F.array().cast("array<int>")))


def encode_and_decode(spark: SparkSession, text: Column, vocabulary: Vocabulary, pattern: str) -> Column:
    """Struct of ids and of the bytes that these ids give, by ``encode`` and ``decode`` in one pass of one task."""
    shared = spark.sparkContext.broadcast(vocabulary.parts())

    @arrow_udf(T.StructType.fromDDL("ids array<int>, decoded binary"))
    def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(Vocabulary(*shared.value), pattern)
        for batch in batches:
            ids = _encode_batch(encoder, batch)
            yield pa.StructArray.from_arrays([ids, _decode_batch(encoder.vocabulary.tokens, ids)], ["ids", "decoded"])

    return there_and_back(F.coalesce(text.cast("string"), F.lit("")))


def encode_rows(
    docs: DataFrame, vocabulary: Vocabulary, pattern: str, text_col: str = "text",
) -> DataFrame:
    """The other columns of ``docs`` as a struct ``row``, the token ids of the text, and the bytes that these ids give.

    The rules of ``encode`` and ``decode``, in one pass of one task. A task holds some texts at a time and hands
    them on before it takes the next ones, so its memory does not grow with the batches that it is given. What
    other columns are called does not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.parts())
    # The text travels once, beside the other columns of its row.
    others = [F.col(name) for name in docs.columns if name != text_col] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder = Encoder(Vocabulary(*shared.value), pattern)
        for batch in batches:
            for first, last in _groups(batch.column(1)):
                part = batch.slice(first, last - first)
                ids = _encode_group(encoder, part.column(1))
                decoded = _decode_batch(encoder.vocabulary.tokens, ids)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, decoded], ["row", "ids", "decoded"])
        del encoder
        give_back()

    return rows.mapInArrow(there_and_back, T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.BinaryType()),
    ]))
