"""Leaks with colliding values and with edits."""

from ridemart.llm import decontaminate

SLOTS = "Then {} took {} apples to town and there sold {} kg of them to {} and {} friends for {} dollars."


def leaks_of(spark, item, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    return {r.doc_id: r for r in decontaminate.find_leaks(docs, items).collect()}


def test_values_may_collide(spark):
    item = SLOTS.format("Maria Lopez", 35, 12, "Maria Lopez", 3, 3)
    texts = [
        SLOTS.format("Tom", 7, 7, "Tom", 5, 5), SLOTS.format("Tom", 36, 11, "Tom", 5, 4),
        SLOTS.format("Ann\nLee", 36, 11, "Ann Lee", 5, 5), SLOTS.format("Tom", 36, 11, "Jerry", 5, 5),
    ]
    assert set(leaks_of(spark, item, texts)) == {0, 1, 2}


def test_edits_do_not_hide_a_copy(spark):
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(59)]
    item, short = " ".join(words), words[:45]
    split = " ".join([*short[:15], "extra", "more", *short[15:30], "added", "too", *short[30:]])
    dropped = " ".join(["before", *short[:14], *short[16:30], *short[32:], "behind"])
    assert set(leaks_of(spark, " ".join(short), [split, dropped, " ".join(short[:15])])) == {0, 1}
    assert leaks_of(spark, " ".join(short), [split])[0].coverage == 1
    found = leaks_of(spark, item, ["so " + " ".join(words[10:35]) + " end", " ".join(words[10:29]), " ".join([*words[:12], *["gap"] * 300, *words[40:52]])])
    assert set(found) == {0} and found[0].coverage < 0.5 and found[0].first_token == 1


def test_matches_of_repeated_windows():
    windows = [(place, item_place, [], []) for place in range(200) for item_place in range(23)]
    assert decontaminate.best_match(windows, 30, 0.5) == (1, 0)
    far = [(place + 1000 * (place > 4), place, [], []) for place in range(10)]
    assert decontaminate.best_match(far, 40, 0.5) is None
