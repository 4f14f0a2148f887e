"""Which values are candidates, and which of them serve as examples."""

import pytest
from pyspark.sql import functions as F

from ridemart.llm import secret_scan

ASSIGNED = [
    ('{"api_key": "abc123def456ghi"}', "abc123def456ghi"), ('os.environ["SECRET_KEY"] = "abc123def456ghi"', "abc123def456ghi"),
    ("password=abc123def456ghi", "abc123def456ghi"), ("  db_password: abc123def456ghi\n", "abc123def456ghi"),
    ("Authorization: Bearer abc123def456ghi", "abc123def456ghi"), ("run --token abc123def456ghi now", "abc123def456ghi"),
    ('secret = "correct horse!"', "correct horse!"), ("pwd=hunter2", "hunter2"), ("token: 'onlyletters'", "onlyletters"),
]


@pytest.mark.parametrize("text, value", ASSIGNED)
def test_assigned_values(text, value):
    found = {(c[2], c[4]) for c in secret_scan.candidates_of(text, "", frozenset())}
    assert (value, True) in found and all(text[c[0]:c[1]] == c[2] for c in secret_scan.candidates_of(text, "", frozenset()))


def test_other_values():
    text = "user=abc123def456ghi https://a.example/x1 password=zz99zz99zz99 mail me at bob.7@mail.example.com, the author: somebody"
    found = [(c[2], c[4]) for c in secret_scan.candidates_of(text, "", frozenset())]
    assert found == [
        ("abc123def456ghi", False), ("https://a.example/x1", False), ("zz99zz99zz99", True), ("bob.7@mail.example.com", False),
    ]


def test_labels(spark):
    texts = ["password=abc123def456ghi", "mail bob.7@mail.example.com", "at 197.151.117.100", f"sha1 {'ab12' * 10}", "see abc123def456ghi"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.find_candidates(docs, frozenset())
    labels = secret_scan.assigned_findings(found).select("label").withColumn("n", F.lit(1)).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in labels} == {1: 1, 0: 3, None: 1}


def test_nested_and_partial_values():
    def found(text):
        return [(c[2], c[4]) for c in secret_scan.candidates_of(text, "", frozenset())]

    assert found("key: password=abc123!def456ghi789") == [("abc123!def456ghi789", True)]
    assert found('secret = "see 4785380592391139x or not"') == [("see 4785380592391139x or not", True), ("4785380592391139x", False)]
    assert len(found("key:" * 50_000 + "x1")) == 1


def test_features_are_those_of_the_whole_value(monkeypatch):
    def features(value):
        return dict(zip(secret_scan.FEATURES, secret_scan.describe(value, "", "", "", frozenset(["word"]))))

    value = "a1" * 600 + "/word" * 80 + "/K9zQ@x.y."
    want, lower = features(value), value.lower()
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in value]
    assert want["length"] == len(value) == 1610 and want["at_sign"] == 1 and want["dots"] == 2 and want["longest_letters"] == 4
    assert want["dictionary"] == 80 * 4 / 1610 and want["capitals"] == 2 / 1610 and want["distinct"] == len(set(value)) / 1610
    assert want["class_changes"] == sum(a != b for a, b in zip(kinds, kinds[1:])) / 1609
    assert want["pair_repeats"] == 1 - len(set(zip(lower, lower[1:]))) / 1609
    vowels = [c in "aeiou" for c in lower]
    assert want["vowel_pairs"] == sum(a != b for a, b in zip(vowels, vowels[1:])) / 1610
    assert want["hex_digits"] == sum(c in "0123456789abcdef" for c in lower) / 1610
    monkeypatch.setattr(secret_scan, "DESCRIBED", 7)
    assert features(value) == want
