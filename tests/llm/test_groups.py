"""The join's work on a group of near copies grows with the group, not with its square."""

import random

import pytest

from ridemart.llm import jaccard_join
from ridemart.llm.common import stored
from ridemart.llm.jaccard_join import Rule
from test_text import brute_components


def group(size, outsiders, seed=2):
    """Near copies of one text with a word changed, and texts that keep most of its words without linking to it."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for k in range(size + outsiders):
        text = list(base)
        for _ in range(1 if k < size else 5):
            text[rng.randrange(len(text))] = f"own{k}x{rng.randrange(99)}"
        rows.append((k, " ".join(text)))
    return rows


def work(spark, rows, rule=Rule()):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    read = jaccard_join._read(docs, "doc_id", "text")
    counts = jaccard_join._sketch(stored(jaccard_join._measure(read, rule), "m"))
    postings = jaccard_join._shared_postings(read, counts, rule)
    links = jaccard_join._verified(stored(jaccard_join._leaders(postings, rule), "l"), read, rule)
    labels = jaccard_join.components(links)
    known = jaccard_join._open_postings(postings, labels)
    return known.count(), jaccard_join._open_meetings(known, rule).count(), jaccard_join._open_pairs(postings, labels, rule).count()


def test_components_of_a_group(spark):
    rows = group(60, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(map(tuple, jaccard_join.link_components(docs).collect())) == brute_components(rows, Rule())


@pytest.mark.parametrize("outsiders", [30])
def test_work_is_in_proportion(spark, outsiders):
    small, large = (work(spark, group(size, outsiders)) for size in (100, 400))
    assert all(after <= 5 * max(before, 100) for before, after in zip(small, large)), (small, large)
