"""Toxicity by multiple-instance learning: only documents have labels, sentences get scores.

A sentence has the probability sigmoid(bias + sum of its words' weights), where each distinct word
adds what is known of it and of its beginnings, so that forms of an offending stem count too. A document is toxic unless none
of its sentences is: noisy-or, 1 - prod(1 - p). Weights are trained from document labels through that
formula; the same sentence probabilities then say where the offence is.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from ridemart.llm.common import fold, labelled_sample, received, sent

THRESHOLD = 0.5
# Bounds of the training sample and of the features that get a value.
TRAIN_ROWS, TRAIN_TEXT_BYTES, MAX_FEATURES = 3000, 1 << 16, 200_000
MIN_DOCS, STEPS, DECAY = 3, 250, 5e-5
# The share of toxic documents the fit weighs for, where the labels have fewer.
LEAST_PRIOR = 0.3
# Words, and the marks that end a sentence.
TOKENS = re.compile(r"[^\W_]+|[.!?\n]+")
ENDS = frozenset(".!?\n")
RESULT = "score double, sentences array<struct<start:int,end:int,score:double>>"


STEMS = (4, 5)
# Distinct words whose value a task remembers.
REMEMBERED = 500_000


@dataclass(frozen=True)
class Weights:
    """Values of features, which are words and beginnings of words."""

    values: dict[str, float]
    bias: float


def features(word: str) -> list[str]:
    return [word, *(f"{word[:size]}*" for size in STEMS if len(word) > size)]


class _Words(dict):
    """A number for each word at first sight, from 0, and -1 for marks that end a sentence."""

    def __init__(self, weights: Weights) -> None:
        self.known, self.new, self.values = weights.values, [], np.zeros(0)

    def __missing__(self, token: str) -> int:
        if token[0] in ENDS:
            self[token] = -1
            return -1
        self[token] = number = len(self.values) + len(self.new)
        value = self.known.get(token, 0.0)
        for size in STEMS:
            if len(token) > size:
                value += self.known.get(token[:size] + "*", 0.0)
        self.new.append(value)
        return number

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """Numbers of the tokens; ``values`` then holds what each word adds to its sentence."""
        if len(self) > REMEMBERED:
            self.clear()
            self.new, self.values = [], np.zeros(0)
        found = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if self.new:
            self.values, self.new = np.append(self.values, self.new), []
        return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def sentence_logits(bias: float, look: _Words, tokens: list[str]) -> np.ndarray:
    """One value per sentence that has a word; a text without words has one empty sentence."""
    number = look.numbers(tokens)
    word = number >= 0
    if not word.any():
        return np.array([bias])
    sentence = np.cumsum(word & ~np.append(False, word[:-1])) - 1
    total = len(look.values)
    distinct = np.unique(sentence[word] * total + number[word])
    return np.bincount(distinct // total, look.values[distinct % total]) + bias


def noisy_or(logits: np.ndarray) -> float:
    """1 - prod(1 - p): log(1 - sigmoid(x)) is -log(1 + exp(x))."""
    return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def fit(sample: list[tuple[bytes, int]], prior: float = 0.5) -> Weights:
    """Gradient steps on the documents' log likelihood. With one class only, every sentence scores low or high."""
    sample = list(dict.fromkeys(sample))
    texts = [TOKENS.findall(text.decode("utf-8", "replace").lower()) for text, _ in sample]
    labels = np.array([label for _, label in sample], float)
    if len(set(labels.tolist())) < 2:
        prior = min(max(prior, 0.01), 0.99)
        return Weights({}, float(np.log(prior / (1 - prior))))
    seen = Counter(
        name for tokens in texts
        for name in {name for word in set(tokens) if word[0] not in ENDS for name in features(word)}
    )
    kept = sorted((name for name, n in seen.items() if n >= MIN_DOCS), key=lambda name: (-seen[name], name))
    number = {name: k for k, name in enumerate(kept[:MAX_FEATURES])}
    known = {
        word: [number[name] for name in features(word) if name in number]
        for word in {word for tokens in texts for word in tokens if word[0] not in ENDS}
    }
    word, sentence, owner, count = [], [], [], 0
    for k, tokens in enumerate(texts):
        first, open_sentence = count, False
        for token in tokens:
            if token[0] in ENDS:
                open_sentence = False
                continue
            if not open_sentence:
                open_sentence, said, count = True, set(), count + 1
            if token not in said:
                said.add(token)
                word += known[token]
                sentence += [count - 1] * len(known[token])
        count = max(count, first + 1)
        owner += [k] * (count - first)
    word, sentence, owner = (np.array(x, np.int64) for x in (word, sentence, owner))
    prior = max(prior, LEAST_PRIOR)
    weight = np.where(labels == 1, prior / labels.mean(), (1 - prior) / (1 - labels.mean())) / len(labels)

    values, bias = np.zeros(len(number)), -4.0
    first, second = np.zeros(len(values) + 1), np.zeros(len(values) + 1)
    for step in range(1, STEPS + 1):
        logits = np.bincount(sentence, values[word], count) + bias
        clean = np.bincount(owner, np.logaddexp(0, logits), len(labels))  # -log P(no sentence offends)
        # d(-log likelihood) / d logit: p for clean documents, -p P(clean) / P(toxic) for toxic ones.
        factor = np.where(labels == 1, -1 / np.maximum(np.expm1(np.minimum(clean, 30)), 1e-6), 1.0)
        slope = _sigmoid(logits) * (weight * factor)[owner]
        grad = np.append(np.bincount(word, slope[sentence], len(values)) + DECAY * values, slope.sum())
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        change = 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        values, bias = values - change[:-1], bias - change[-1]
    return Weights({name: float(values[k]) for name, k in number.items() if abs(values[k]) > 0.01}, float(bias))


def train(
    docs: DataFrame, labels: DataFrame, parts: int, held_out: int, max_rows: int = TRAIN_ROWS,
    max_bytes: int = TRAIN_TEXT_BYTES, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
) -> Weights:
    """Fit on labelled texts outside the held-out fold: at most ``max_rows`` of at most ``max_bytes`` each."""
    sample = labelled_sample(docs, labels, label, parts, held_out, max_rows, max_bytes, id_col, text_col)
    known = labels.filter(F.col(label).isNotNull() & (fold(F.col(id_col), parts) != held_out))
    prior = known.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return fit(sample, 0.5 if prior is None else prior)


def offending_sentences(weights: Weights, text: str, threshold: float = THRESHOLD) -> list[dict]:
    """Sentences of at least that probability: start, end (in code points, end exclusive) and score."""
    spans, start, end = [], None, 0
    for token in [*TOKENS.finditer(text), None]:
        if token is not None and token.group()[0] not in ENDS:
            start, end = token.start() if start is None else start, token.end()
        elif start is not None:
            spans.append((start, end))
            start = None
    look = _Words(weights)
    scores = [
        float(_sigmoid(sentence_logits(weights.bias, look, TOKENS.findall(text[a:b].lower()))[0])) for a, b in spans
    ]
    return [{"start": a, "end": b, "score": p} for (a, b), p in zip(spans, scores) if p >= threshold]


def score(spark: SparkSession, text: Column, weights: Weights, threshold: float = THRESHOLD) -> Column:
    """Struct of score and sentences for each whole text.

    ``sentences`` locates those of at least ``threshold`` in documents that reach it themselves. NULL counts
    as empty; a text without words is one empty sentence and has a score like any other. Nothing but the
    text goes in, so other columns, ties and repeated rows need no rule.
    """
    shared = sent(spark, weights)
    kind = T.StructType.fromDDL(RESULT)
    sentences = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @arrow_udf(kind)
    def score_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = received(shared)
        look = _Words(model)
        for batch in batches:
            scores, found = [], []
            for value in batch:
                text = value.as_py() or ""
                scores.append(noisy_or(sentence_logits(model.bias, look, TOKENS.findall(text.lower()))))
                found.append(offending_sentences(model, text, threshold) if scores[-1] >= threshold else [])
            yield pa.StructArray.from_arrays(
                [pa.array(scores, pa.float64()), pa.array(found, sentences)], ["score", "sentences"],
            )

    return score_texts(F.coalesce(text.cast("string"), F.lit("")))
