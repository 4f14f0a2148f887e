"""Fill-in-middle: positions, round trips, and the whole transformation against slices of Python strings."""

import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ridemart.llm import fill_middle as fim

TEXTS = st.text(alphabet=st.sampled_from("ab<>PSM\né你\U0001f600́"), max_size=40)


@given(st.lists(TEXTS, min_size=1, max_size=6), st.data())
@settings(max_examples=200, deadline=None)
def test_positions_against_python(texts, data):
    for text in texts:
        index = fim.Exceptions.of(np.frombuffer(text.encode(), np.uint8))
        chars = np.arange(len(text) + 1)
        places = np.array([len(text[:k].encode()) for k in chars])
        assert index.to_bytes(chars).tolist() == places.tolist() and index.to_chars(places).tolist() == chars.tolist()
        assert len(index.at_byte) == sum(ord(c) > 127 for c in text)
    one, two = (np.array(data.draw(st.lists(st.integers(0, 2**32 - 1), min_size=len(texts), max_size=len(texts)))) for _ in range(2))
    chars, places = fim.cut([text.encode() for text in texts], one, two)
    for k, text in enumerate(texts):
        a, b = sorted((one[k] % (len(text) + 1), two[k] % (len(text) + 1)))
        assert chars[k].tolist() == [0, a, b, len(text)]
        assert places[k].tolist() == [len(text[:x].encode()) for x in (0, a, b, len(text))]


@given(TEXTS, st.integers(0, 60), st.integers(0, 60), st.sampled_from([fim.PLAIN, fim.PSM, fim.SPM]))
@settings(max_examples=300, deadline=None)
def test_round_trip(text, a, b, form):
    data = text.encode()
    if fim._holds_mark(data):
        form = fim.PLAIN
    a, b = sorted((len(text[:a].encode()), len(text[:b].encode())))
    assert fim.rearrange(fim.arrange(data, a, b, form), form) == data


def expected(name, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if name is None else name}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return name, n, "plain", None, None, text, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    p, m, s = text[:a], text[a:b], text[b:]
    return name, n, form, a, b - a, f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}", text


def made(docs):
    rows = docs.select("doc_id", fim.fill_in_middle(F.col("text"), fim.draws(F.col("doc_id"))).alias("made")).select("doc_id", "made.*")
    return rows.withColumn("restored", fim.restore(F.col("output"), F.col("form")))


def test_against_slices(spark):
    rows = [(None, "null id é"), (1, None), (2, ""), (3, "has <M> inside"), (4, "\U0001f600" * 70_000), (5, "x" * 3_000_000), (6, "<"), (6, "<")]
    rows += [(k, f"number {k} 你好 and été < P> <S") for k in range(10, 200)]
    docs = spark.createDataFrame([(*row, "f") for row in rows], "doc_id long, text string, form string").repartition(3)
    got = sorted(map(tuple, made(docs).collect()), key=repr)
    assert got == sorted((expected(*row) for row in rows), key=repr)
    assert {row[2] for row in got} == {"plain", "psm", "spm"}


def test_bad_bytes_and_no_rows(spark):
    bad = spark.createDataFrame([(7, bytearray(b"a\xffb\xe4\xbd"))], "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
    assert made(bad).first()["restored"] == "a�b�"
    assert made(spark.createDataFrame([], "doc_id long, text string")).count() == 0
