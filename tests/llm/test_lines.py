"""Line de-duplication against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemart.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))


def brute(rows, min_docs, min_chars=1, keep_first=False):
    where = {}
    for k, (name, text) in enumerate(rows):
        for number, line in enumerate((text or "").split("\n")):
            if len(key_of(line)) >= min_chars:
                where.setdefault(key_of(line), []).append((k, (name is None, name or 0, number)))
    repeated = {key: min(place for _, place in found) for key, found in where.items() if len({k for k, _ in found}) >= min_docs}
    out = []
    for name, text in rows:
        lines = (text or "").split("\n")
        stay = [
            line for number, line in enumerate(lines)
            if key_of(line) not in repeated or keep_first and repeated[key_of(line)] == (name is None, name or 0, number)
        ]
        out.append((name, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    common = ["Subscribe now!", "  subscribe NOW!\t", "É tous", "é tous", "All rights reserved \r", "x", "", "  "]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "once\nonce\nonce"), (5, "a" * 300_000 + "\nSubscribe now!"), (None, "x\nnull id"), (None, "x")]
    for k in range(10, 160):
        lines = [rng.choice(common) if rng.random() < 0.4 else f"line {rng.randrange(120)} 你好" for _ in range(rng.randrange(1, 9))]
        rows.append((k, "\n".join(lines)))
    return rows + [(50, "x\ntwo"), (50, "x\ntwo"), (50, "x\ntwo"), (200, " x "), (201, " ")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*row, "q") for row in rows], "doc_id long, text string, n_lines string").repartition(5)


@pytest.mark.parametrize("broadcast_bytes", [line_dedup.BROADCAST_BYTES, -1])
@pytest.mark.parametrize("options", [
    {"min_docs": 10}, {"min_docs": 2}, {"min_docs": 2, "keep_first": True}, {"min_docs": 3, "min_chars": 4},
])
def test_against_brute_force(docs, rows, options, broadcast_bytes):
    got = line_dedup.mark_lines(docs, **options, broadcast_bytes=broadcast_bytes)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, **options)


def test_other_columns_stay(docs, rows):
    left = line_dedup.drop_lines(docs)
    assert left.columns == docs.columns
    assert sorted((row.text for row in left.collect())) == sorted(text for *_, text in brute(rows, 10))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.mark_lines(empty).count() == 0 and line_dedup.drop_lines(empty, broadcast_bytes=-1).count() == 0
    with pytest.raises(ValueError):
        line_dedup.mark_lines(empty, min_docs=1)


def test_filters_hold_what_was_put_in_and_little_else():
    rng = np.random.default_rng(1)
    bitmap = np.zeros((1 << 20) // 8, np.uint8)
    known, other = rng.integers(0, 2**64, 40_000, np.uint64), rng.integers(0, 2**64, 40_000, np.uint64)
    line_dedup.put(bitmap, known)
    assert line_dedup.held(bitmap, known).all() and line_dedup.held(bitmap, other).mean() < 0.02
    block = bitmap[:line_dedup.BLOCK_BITS // 8]
    for part in (block, np.where(np.arange(len(block)) % 64 == 0, block, 0).astype(np.uint8), np.zeros_like(block), np.full_like(block, 255)):
        assert np.array_equal(line_dedup.unpack(line_dedup.pack(part)), part)


def test_twice_seen_needs_two_documents():
    once, twice = (np.zeros((1 << 20) // 8, np.uint8) for _ in range(2))
    hashes = np.array([5, 5, 6, 7, 7], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    line_dedup.observe(once, twice, np.array([0, 0, 0, 0, 1]), hashes)
    assert line_dedup.held(once, hashes).all() and list(line_dedup.held(twice, hashes)) == [False] * 3 + [True] * 2
    line_dedup.observe(once, twice, np.array([0]), hashes[:1])
    assert list(line_dedup.held(twice, hashes)) == [True, True, False, True, True]


def test_only_suspects_are_shuffled(spark, docs, rows):
    named = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    suspected = line_dedup.twice_seen(named, 1)
    keys = {bytes(row.key).decode() for row in line_dedup._suspects(named, suspected, 1).collect()}
    everywhere = [{key_of(line) for line in (text or "").split("\n")} - {""} for _, text in rows]
    repeated = {key for keys in everywhere for key in keys if sum(key in other for other in everywhere) > 1}
    assert repeated <= keys and len(keys - repeated) <= 2
