"""Operators with numpy inside, against brute force, other libraries or held-out labels."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemart.llm import bpe, common, decontaminate, jaccard_join, license_scan, quality, secret_scan, toxicity
from ridemart.llm.jaccard_join import Rule


def shingles(text, rule):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    runs = {tuple(words[k:k + rule.words]) for k in range(len(words) - rule.words + 1)}
    return runs or ({tuple(words)} if words else set())


def brute_components(rows, rule):
    sets = [(name, shingles(text, rule)) for name, text in rows]
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and rule.scale * both >= rule.share * len(sets[a][1] | sets[b][1]) and group[a] != group[b]:
                group = [group[a] if g == group[b] else g for g in group]
    least = {g: min(sets[k][0] for k in range(len(sets)) if group[k] == g) for g in set(group)}
    return {(name, len(found), least[group[k]]) for k, (name, found) in enumerate(sets)}


@pytest.mark.parametrize("rule", [Rule(), Rule(words=5, share=80)])
def test_components_against_brute_force(spark, rule):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    base = [rng.choice(words) for _ in range(60)]
    rows = [(1000, None), (1001, ""), (1002, " \n"), (1003, "A b"), (1004, "a  B\n"), (1005, "a b c"), (1006, "q " * 5000)]
    for k in range(220):
        text = list(base) if k % 2 else [rng.choice(words) for _ in range(rng.randint(1, 50))]
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            text[rng.randrange(len(text))] = rng.choice([*words, f"z{rng.randint(0, 99)}"])
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).repartition(4)
    assert {tuple(r) for r in jaccard_join.link_components(docs, rule).collect()} == brute_components(rows, rule)


def test_components_of_nothing_and_of_rows_without_id(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.link_components(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b c d"), (4, "A b c d"), (4, "A b c d")], "doc_id long, text string")
    assert [tuple(r) for r in jaccard_join.link_components(rows).orderBy("doc_id").collect()] == [(None, 1, 4), (4, 1, 4), (4, 1, 4)]
    assert jaccard_join.keep_one(rows).count() == 3


def test_long_chains_have_one_root(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    labels = jaccard_join.components(edges)
    assert labels.count() == 301 and labels.select("root").distinct().count() == 1


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_ids_are_those_of_the_library(spark, vocabulary):
    import public_tokenizers
    import tiktoken

    rng = random.Random(1)
    texts = ["", "  \n\n x", "a" * 3000, "日本語" * 40, "🤖 é\x1c \x85\xa0", "can't WE'll 12 345", None]
    texts += ["".join(chr(rng.choice([32, 65, 97, 233, 0x4E00, 0x1F600, 10, 48]) + rng.randint(0, 9)) for _ in range(80)) for _ in range(40)]
    ranks = {token: k for k, token in enumerate(vocabulary.tokens)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    encoded = docs.withColumn("ids", bpe.encode(spark, F.col("text"), vocabulary, public_tokenizers.PATTERN))
    for row in encoded.withColumn("back", bpe.decode(spark, F.col("ids"), vocabulary)).collect():
        assert row.ids == library.encode_ordinary(row.text or "") and bytes(row.back) == (row.text or "").encode()
    both = bpe.encode_and_decode(spark, F.col("text"), vocabulary, public_tokenizers.PATTERN)
    for row in docs.select("text", both.alias("both")).collect():
        assert row.both.ids == library.encode_ordinary(row.text or "") and bytes(row.both.decoded) == (row.text or "").encode()
    assert encoded.limit(0).count() == 0


def test_bad_vocabularies():
    with pytest.raises(ValueError):
        bpe.make_vocabulary({b"a": 0})


ITEM = "In the year 1999 Maria Lopez went to the market with 35 apples and she sold 12 kg of them to Maria Lopez again."
DOCS = [
    (1, f"Intro here. {ITEM}"),
    (2, "Well. In the year 2005 Tom went to the market with 7 apples and she sold 900 kg of them to Tom again. More"),
    (3, "In the year 2005 Tom went to the market with 7 apples and she sold 900 kg of them to Jerry again."),
    (4, ITEM.upper()), (5, None), (None, ITEM), (6, "other words only stand here for a while and then they stop"), (1, ITEM),
]


@pytest.mark.parametrize("filter_windows", [decontaminate.FILTER_WINDOWS, 0])
def test_leaks(spark, filter_windows):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("size", F.lit(0))
    items = spark.createDataFrame([(9, ITEM), (8, "too short"), (7, "five words are in here"), (6, None)], "item_id long, text string")
    found = decontaminate.find_leaks(docs, items, filter_windows=filter_windows).collect()
    assert {(r.doc_id, r.item_id, r.exact) for r in found} == {(1, 9, True), (2, 9, False), (4, 9, True)}
    assert all(0 < r.coverage <= 1 for r in found)
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "5", "6", "None"]
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def test_license_blocks_against_every_block(spark):
    rng = random.Random(4)
    words = [w.decode() for w in license_scan.vocabulary(license_scan.PHRASES, license_scan.TEMPLATES)] + ["x", "y", "z"]
    texts = ["", None, "Under the MIT license!"] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 300))) for _ in range(30)]
    texts += [" ".join([*rng.choices("xyz", k=rng.randint(0, 60)), text, "end"]) for _, text, _ in license_scan.TEMPLATES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frequency = license_scan.count_words(docs, [w.encode() for w in words])
    index = license_scan.build_index(frequency)
    rows = docs.select("text", license_scan.scan(spark, F.col("text"), index).alias("s")).collect()
    for row in rows:
        own = (row.text or "").lower().replace("!", "").split()
        want = []
        for k, (label, text, names) in enumerate(license_scan.TEMPLATES):
            template, size = set(text.split()), 2 * len(text.split())
            for start in license_scan.block_starts(len(own), size):
                share = len(template & set(own[start:start + size])) / len(template)
                if share >= license_scan.THRESHOLD and set(names.split()) <= set(own[start:start + size]):
                    want.append((label, k, start, min(start + size, len(own)) - 1, share))
        assert [tuple(x) for x in row.s.blocks] == want and row.s.n_words == len(own)
    assert [tuple(x) for x in rows[2].s.base] == [("mit", 0)]


def _labels(index, text):
    look = license_scan._Numbers(index.numbers)
    return {block["label"] for block in license_scan.scan_text(index, look, text.encode())["blocks"]}


def test_a_notice_is_not_taken_for_that_of_another_licence():
    index = license_scan.build_index({})
    for text in (
        "Licensed under CC BY 4.0", "Released under the GPL license", "Licensed under the GPL License, Version 2.0",
        "This work is licensed under the GNU General Public License version 2", "Licensed under the Apache License Version 1 0",
    ):
        assert _labels(index, text) == set(), text
    assert _labels(index, "This work is licensed under a Creative Commons Attribution 4.0 International License.") == {"cc-by"}
    assert _labels(index, "Licensed under CC-BY-NC 4.0") == {"cc-by-nc"}
    assert _labels(index, "licensed under apache license, version 2.0") == {"apache-2"}  # a word is missing, but none of its names
    with pytest.raises(ValueError):
        license_scan.build_index({}, templates=[("a", "some words", "others")])


def test_license_blocks_of_a_thousand_templates_against_every_block():
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    templates = []
    for k in range(1000):
        text = rng.choices(words, k=rng.randint(1, 14))
        templates.append((f"l{k}", " ".join(text), rng.choice(["", text[-1]])))
    frequency = {word.encode(): rng.randint(0, 9) for word in words}
    index = license_scan.build_index(frequency, templates=templates)
    look = license_scan._Numbers(index.numbers)
    texts = [[], ["other"]]
    for _ in range(40):
        text = rng.choices([*words, "other"], k=rng.randint(0, 80))
        for _, notice, _ in rng.sample(templates, 4):
            kept = [word for word in notice.split() if rng.random() < 0.95]
            at = rng.randint(0, len(text))
            text[at:at] = kept
        texts.append(text)
    found = 0
    for text in texts:
        want = []
        for k, (label, notice, names) in enumerate(templates):
            size, own = 2 * len(notice.split()), set(notice.split())
            for start in license_scan.block_starts(len(text), size):
                block = set(text[start:start + size])
                if len(own & block) >= max(1, math.ceil(0.8 * len(own) - 1e-9)) and set(names.split()) <= block:
                    want.append((label, k, start, min(start + size, len(text)) - 1, len(own & block) / len(own)))
        blocks = license_scan.scan_text(index, look, " ".join(text).encode())["blocks"]
        assert [tuple(block.values()) for block in blocks] == want
        found += len(want)
    assert found > 500


def test_secrets(spark):
    rng = random.Random(2)
    rows = [(k, f'hello token = "{rng.randbytes(20).hex()}" and mail a.{k}@mail7.example.com 97.51.17.{k + 100}', "src/a.py") for k in range(40)]
    rows += [(98, None, None), (99, "", "x"), (None, 'key: "abcdef0123456789abcd"', None), (41, "a1" * 4000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("start", F.lit(1))
    found = secret_scan.find_candidates(docs, secret_scan.dictionary_of(docs), path_col="source").cache()
    scored = secret_scan.score(found, secret_scan.train(secret_scan.assigned_findings(found))).collect()
    assert {r.value for r in scored if r.is_secret} >= {r[1].split('"')[1] for r in rows[:40]}
    assert not any(r.is_secret for r in scored if "@" in r.value)
    assert all(r.start >= 0 and r.end - r.start == len(r.value) for r in scored)
    assert secret_scan.train(secret_scan.assigned_findings(found.limit(0))) is None
    assert {r.score for r in secret_scan.score(found, None).collect()} == {1.0}


def test_quality_learns_and_scores_whole_texts(spark):
    tables = [spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels")]
    network = quality.train(*tables, parts=4, held_out=2)
    scored = tables[0].join(tables[1], "doc_id").filter(common.fold(F.col("doc_id"), 4) == 2).select(
        "quality", (quality.score(spark, F.col("text"), network) >= quality.THRESHOLD).cast("int").alias("p"),
    ).collect()
    assert np.mean([r.quality == r.p for r in scored]) > 0.9
    odd = spark.createDataFrame([(None,), ("",), ("é" * 70_000,)], "text string").select(quality.score(spark, F.col("text"), network))
    assert all(0 <= r[0] <= 1 for r in odd.collect())
    assert quality.combine(quality.fit([]), np.ones((1, quality.FILTERS))) == pytest.approx(0.5)


def test_maxima_cover_every_byte():
    rng = np.random.default_rng(0)
    model = quality.fit([(rng.bytes(900), k % 2) for k in range(8)])
    tables = model.pair_tables()
    for size in (0, 1, 255, 256, 257, 700, quality.BLOCK + 5):
        data = np.frombuffer(text := rng.bytes(size), np.uint8)
        padded = np.append(data, np.zeros(quality.HALF + quality.WIDTH, np.uint8))
        starts = size if size > quality.HALF else quality.HALF
        each = [sum(model.filters[j][padded[k + j]] for j in range(quality.WIDTH)) for k in range(starts)]
        want = np.maximum(np.max(each, axis=0) + model.bias, 0)
        assert np.allclose(quality.chunk_maxima(tables, model.bias, text).max(axis=0), want, atol=1e-4)


def test_toxicity_finds_the_sentence(spark):
    rng = random.Random(6)
    calm = ["tree", "river", "stone", "house", "green", "walk", "bread", "light"]

    def sentence(extra=()):
        return " ".join([*rng.choices(calm, k=6), *extra]).capitalize() + "."

    sample = [(" ".join(sentence() for _ in range(8)).encode(), 0) for _ in range(60)]
    sample += [(" ".join([sentence(), sentence(["vermin"]), sentence()]).encode(), 1) for _ in range(60)]
    weights = toxicity.fit(sample)
    texts = [sentence() * 30, sentence() + " " + sentence(["vermin"]), "", None]
    found = spark.createDataFrame([(t,) for t in texts], "text string").select(toxicity.score(spark, F.col("text"), weights).alias("s")).collect()
    assert [r.s.score >= 0.5 for r in found] == [False, True, False, False]
    place = found[1].s.sentences[0]
    assert "vermin" in texts[1][place.start:place.end] and len(found[1].s.sentences) == 1


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.stored(stage(spark, docs, sf), name)
        assert docs.columns == columns and 0 < docs.count() <= before.count()
        assert docs.exceptAll(before).isEmpty()
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(tokens) == docs.count() and all(r.round_trip for r in tokens)
    texts = {shingle for r in docs.collect() for shingle in [r.text.lower()]}
    assert len(texts) == docs.count()


def test_long_runs_merge_like_short_ones():
    import public_tokenizers

    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(8)
    for piece in (b"a" * 20_000, bytes(rng.choice(b"abcdefgh") for _ in range(9_000)), b"\xe4\xbd\xa0" * 4_000, b"ab" * 5_000, bytes(9_000)):
        assert bpe.merge_long(vocabulary, piece).tolist() == bpe.merge_rows(vocabulary, [piece])[0].tolist()
    assert bpe.merge_long(vocabulary, b"xq").tolist() == bpe.merge_rows(vocabulary, [b"xq"])[0].tolist()
