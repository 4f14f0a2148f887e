"""All links of the n-gram Jaccard join, not only what its components need."""

import random

import pytest
from test_text import shingles

from ridemart.llm import jaccard_join
from ridemart.llm.jaccard_join import Rule


@pytest.mark.parametrize("nodes, at_once", [(jaccard_join.BLOCK_NODES, jaccard_join.TOKENS_AT_ONCE), (7, 16)])
def test_every_link_against_brute_force(spark, monkeypatch, nodes, at_once):
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", nodes)
    monkeypatch.setattr(jaccard_join, "TOKENS_AT_ONCE", at_once)
    rng, rule = random.Random(8), Rule()
    base = [f"w{k}" for k in range(80)]
    rows = [(1000, None), (1001, ""), (1002, "a b c"), (1003, "A b  c"), (1004, " ".join(base)), (1004, " ".join(base))]
    for k in range(90):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            text[rng.randrange(len(text))] = f"z{rng.randint(0, 9)}"
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = [frozenset(shingles(text, rule)) for _, text in rows]

    def linked(a, b):
        return bool(a & b) and rule.scale * len(a & b) >= rule.share * len(a | b)

    want = sorted(
        (name, sum(linked(own, other) for j, other in enumerate(sets) if j != k))
        for k, ((name, _), own) in enumerate(zip(rows, sets))
    )
    counted = jaccard_join.count_links(docs, rule)
    assert sorted((r.doc_id, r.n_links) for r in counted.collect()) == want
    least = {}
    for (name, _), own in zip(rows, sets):
        least[own] = min(name, least.get(own, name))
    pairs = {(least[a], least[b], len(a & b)) for a in least for b in least if least[a] < least[b] and linked(a, b)}
    found = jaccard_join.link_pairs(docs, rule).collect()
    assert {(min(r.id_a, r.id_b), max(r.id_a, r.id_b), r.shared) for r in found} == pairs and len(found) == len(pairs)
    assert sum(r.rows_a * r.rows_b * 2 for r in found) + sum(sets.count(s) * (sets.count(s) - 1) for s in least if s) == sum(n for _, n in want)
    assert jaccard_join.count_links(docs.limit(0), rule).count() == 0
