"""License scans: places of fixed phrases, and an exact set-similarity join of text blocks with templates.

A template is a set of words. A block is a run of consecutive words, twice as long as the template, and
blocks start every half of their length, so each stretch as long as the template lies within one. A block matches
when it holds at least THRESHOLD of the template's words.

The join finds every such block. Template words are ordered by how often they occur in the whole corpus,
rarest first. A matching block must hold one of the first |T| - ceil(THRESHOLD * |T|) + 1 of them (prefix
filter), enough template words at all (length filter), and at the first shared word both sides must have
enough words left (positional filter). What passes is counted. The words of a text look the templates up in an
inverted index of their prefixes, so templates whose prefix words a text does not have cost it nothing.

The words that name a template's licence must all be in the block, whatever share of the others it holds:
notices of two licences often differ in one word only.
"""

import math
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from ridemart.llm.common import binary_values, received, sent

THRESHOLD = 0.8
# Lower-cased words: digits, a-z, and every byte of a character beyond ASCII.
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Label, notice, and the notice's words that name the licence. Several notices may have one label.
TEMPLATES = (
    ("mit", "released under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction", ""),
    ("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license", ""),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license",
     "creative commons attribution noncommercial"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
              "general public license as published by the free software foundation", "gnu"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ""),
)
RESULT = (
    "n_words bigint, base array<struct<label:string,word:bigint>>, "
    "blocks array<struct<label:string,template:int,first_word:bigint,last_word:bigint,containment:double>>"
)


@dataclass(frozen=True)
class Template:
    """Distinct words as numbers, the rarest first; how many and which of them a match needs; the length of a block."""

    label: str
    words: np.ndarray
    need: int
    block: int
    names: np.ndarray

    @property
    def prefix(self) -> np.ndarray:
        return self.words[:len(self.words) - self.need + 1]


@dataclass(frozen=True)
class Postings:
    """The templates of each word, one word after the other."""

    begin: np.ndarray
    template: np.ndarray

    @staticmethod
    def of(words: Sequence[np.ndarray], n_words: int) -> "Postings":
        word = np.concatenate([np.zeros(0, np.int64), *words])
        template = np.repeat(np.arange(len(words)), [len(own) for own in words])
        order = np.argsort(word, kind="stable")
        return Postings(np.searchsorted(word[order], np.arange(n_words + 1)), template[order])

    def meet(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every (index into ``words``, template) that meet in a word."""
        n = self.begin[words + 1] - self.begin[words]
        skipped = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(self.begin[words] - skipped, n)
        return np.repeat(np.arange(len(words)), n), self.template[at]


@dataclass(frozen=True)
class Index:
    numbers: dict[bytes, int]
    phrases: list[tuple[str, np.ndarray]]
    templates: list[Template]
    whole: Postings
    prefixes: Postings


class _Numbers(dict):
    """Numbers of the template words; -1 for others, remembered up to a bound."""

    def __init__(self, numbers: Mapping[bytes, int]) -> None:
        super().__init__(numbers)
        self.own = numbers

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
            self.update(self.own)
        number = self.own.get(word, -1)
        self[word] = number
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def vocabulary(phrases: Mapping[str, str], templates: Sequence[tuple[str, str, str]]) -> list[bytes]:
    texts = [*phrases, *(text for _, text, _ in templates)]
    return sorted({word.encode() for text in texts for word in text.split()})


def count_words(docs: DataFrame, words: list[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often each of a few words occurs in all documents. Each task gives one row per word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _Numbers({word: k for k, word in enumerate(words)})
        total = np.zeros(len(words) + 1, np.int64)
        for batch in batches:
            for text in binary_values(batch.column(0)):
                total += np.bincount(look.of(WORDS.findall(text.lower())) + 1, minlength=len(words) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(total[1:])], ["word", "n"])

    text = docs.select(F.col(text_col).cast("string").cast("binary").alias("_text"))
    counted = text.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = {row["word"]: row["n"] for row in counted.collect()}
    return {word: found.get(k, 0) for k, word in enumerate(words)}


def build_index(
    frequency: Mapping[bytes, int], phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD,
) -> Index:
    """Numbers follow the global order: fewest occurrences first, ties by the word itself.

    A template is its label, its words, and those of its words that must be in a match, all lower-cased.
    """
    order = sorted(vocabulary(phrases, templates), key=lambda word: (frequency.get(word, 0), word))
    numbers = {word: k for k, word in enumerate(order)}

    def numbered(text: str) -> np.ndarray:
        return np.array([numbers[word.encode()] for word in text.split()], np.int64)

    built = []
    for label, text, names in templates:
        if not set(names.split()) <= set(text.split()):
            raise ValueError(f"the words {names!r} do not all stand in the template {text!r}")
        words, named = np.unique(numbered(text)), np.unique(numbered(names))
        need = max(1, math.ceil(threshold * len(words) - 1e-9))
        built.append(Template(label, words, need, 2 * len(text.split()), named))
    whole = Postings.of([template.words for template in built], len(numbers))
    prefixes = Postings.of([template.prefix for template in built], len(numbers))
    return Index(numbers, [(label, numbered(phrase)) for phrase, label in phrases.items()], built, whole, prefixes)


def _phrase_places(index: Index, at: np.ndarray) -> list[tuple[int, str]]:
    found = []
    for label, words in index.phrases:
        here = np.ones(max(0, len(at) - len(words) + 1), bool)
        for k, word in enumerate(words):
            here &= at[k:k + len(here)] == word
        found += [(int(place), label) for place in np.flatnonzero(here)]
    return sorted(found)


def block_starts(n_words: int, block: int) -> np.ndarray:
    """Blocks start every half block; the last one is the first that reaches the end of the text."""
    half = block // 2
    return np.arange(0, max(1, n_words - half), half) if n_words else np.zeros(0, np.int64)


def _candidates(index: Index, at: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Templates that share enough words with the whole text, each with the places of its prefix words."""
    numbers = at[places]
    _, template = index.whole.meet(np.unique(numbers))
    shared = np.bincount(template, minlength=len(index.templates))
    enough = shared >= [template.need for template in index.templates]
    place, template = index.prefixes.meet(numbers)
    keep = np.flatnonzero(enough[template])
    keep = keep[np.argsort(template[keep], kind="stable")]
    place, template = places[place[keep]], template[keep]
    cuts = np.flatnonzero(np.diff(template)) + 1
    for own in np.split(np.arange(len(template)), cuts) if len(template) else ():
        yield int(template[own[0]]), place[own]


def _template_blocks(template: Template, at: np.ndarray, places: np.ndarray) -> list[tuple[int, int, float]]:
    """Blocks around these places that match: first and last word, and the share of the template's words."""
    size, need, half = len(template.words), template.need, template.block // 2
    starts = block_starts(len(at), template.block)
    last = np.minimum(places // half, len(starts) - 1)
    candidates = np.unique(np.concatenate([last, np.maximum(last - 1, 0)]))
    found = []
    for start in starts[candidates]:
        stop = min(start + template.block, len(at))
        block = np.unique(at[start:stop])
        block = block[block >= 0]
        if len(block) < need:
            continue
        place = np.searchsorted(template.words, block)
        shared = np.flatnonzero(template.words[np.minimum(place, size - 1)] == block)
        if not len(shared) or 1 + min(size - place[shared[0]] - 1, len(block) - shared[0] - 1) < need:
            continue
        if len(shared) >= need and np.isin(template.names, block).all():
            found.append((int(start), int(stop) - 1, len(shared) / size))
    return found


def scan_text(index: Index, look: _Numbers, text: bytes) -> dict:
    words = WORDS.findall(text.lower())
    at = look.of(words)
    base, blocks = [], []
    places = np.flatnonzero(at >= 0)
    if len(places):
        base = [{"label": label, "word": place} for place, label in _phrase_places(index, at)]
        blocks = [
            {"label": index.templates[k].label, "template": k, "first_word": a, "last_word": b, "containment": share}
            for k, own in _candidates(index, at, places) for a, b, share in _template_blocks(index.templates[k], at, own)
        ]
    return {"n_words": len(words), "base": base, "blocks": blocks}


def scan(spark: SparkSession, text: Column, index: Index) -> Column:
    """Struct of n_words, base (label, word) and blocks (label, template, first_word, last_word, containment).

    Works on each whole text by itself. NULL counts as empty, which has no words, places or blocks. Other
    columns, repeated rows and empty tables need no rule. Words count from 0; both lists are in order.
    """
    shared = sent(spark, index)
    fields = T.StructType.fromDDL(RESULT)
    base = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    blocks = pa.list_(pa.struct([
        ("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("containment", pa.float64()),
    ]))
    kind = pa.struct([("n_words", pa.int64()), ("base", base), ("blocks", blocks)])

    @arrow_udf(fields)
    def scan_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = received(shared)
        look = _Numbers(index.numbers)
        for batch in batches:
            yield pa.array([scan_text(index, look, text) for text in binary_values(batch)], kind)

    return scan_texts(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
