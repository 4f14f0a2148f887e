"""Quality classifier: a byte-level convolutional network in numpy.

    bytes -> filters over windows of WIDTH bytes -> ReLU -> largest value in each chunk
          -> a small hidden layer per chunk -> mean over all chunks -> one probability

Chunks are 2 * HALF bytes long and overlap by HALF; they cover the whole text. A filter over one-hot bytes
is a sum of table rows, and two neighbouring bytes share one table, so scoring looks up WIDTH / 2 rows a byte.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from ridemart.llm.common import binary_values, labelled_sample, received, seeded, sent

WIDTH, FILTERS, HIDDEN, HALF = 6, 24, 12, 256
THRESHOLD = 0.7
# Bounds of the training sample: rows, bytes of a sampled text, chunks of a text that one pass looks at.
TRAIN_ROWS, TRAIN_TEXT_BYTES, TRAIN_CHUNKS = 2000, 1 << 16, 6
PASSES = 12
# Positions that are looked up at a time: bounds the memory of a task whatever the length of a text.
BLOCK = HALF * 64


@dataclass(frozen=True)
class Network:
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def pair_tables(self) -> np.ndarray:
        """For each two bytes, what they add to the filters: WIDTH / 2 x 65536 x FILTERS."""
        even, odd = self.filters[0::2], self.filters[1::2]
        return (even[:, :, None, :] + odd[:, None, :, :]).reshape(WIDTH // 2, 65536, -1)


def chunk_maxima(tables: np.ndarray, bias: np.ndarray, text: bytes) -> np.ndarray:
    """The largest response of each filter in each chunk of the whole text, at least 0."""
    data = np.frombuffer(text + bytes(max(WIDTH, HALF - len(text))), np.uint8)
    pairs = (data[:-1].astype(np.uint16) << 8) | data[1:]
    last = max(1, len(text)) if len(text) > HALF else HALF
    halves = []
    for start in range(0, last, BLOCK):
        stop = min(start + BLOCK, last, len(pairs) - WIDTH + 2)
        found = tables[0][pairs[start:stop]]
        for k in range(1, WIDTH // 2):
            found += tables[k][pairs[start + 2 * k:stop + 2 * k]]
        cuts = np.arange(0, stop - start, HALF)
        halves.append(np.maximum.reduceat(found, cuts, axis=0))
    half = np.maximum(np.concatenate(halves) + bias, 0)
    return half if len(half) == 1 else np.maximum(half[:-1], half[1:])


def combine(network: Network, maxima: np.ndarray) -> float:
    inner = np.tanh(maxima @ network.hidden + network.hidden_bias)
    logit = float(inner.mean(axis=0) @ network.out + network.out_bias)
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def fit(sample: list[tuple[bytes, int]], prior: float = 0.5, seed: int = 7) -> Network:
    """Train on (text, label) by Adam. ``prior`` is the share of label 1 that probabilities refer to.

    Without a sample, or with one class only, the network gives the prior for every text.
    """
    rng = seeded(seed)
    params = {
        "filters": rng.normal(0, 0.25, (WIDTH, 256, FILTERS)), "bias": np.zeros(FILTERS),
        "hidden": rng.normal(0, FILTERS ** -0.5, (FILTERS, HIDDEN)), "hidden_bias": np.zeros(HIDDEN),
        "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "out_bias": np.zeros(1),
    }
    params = {name: value.astype(np.float32) for name, value in params.items()}
    labels = np.array([label for _, label in sample], np.float32)
    prior = min(max(prior, 0.01), 0.99)
    if len(set(labels.tolist())) < 2:
        params["out"][:] = 0
        params["out_bias"][:] = np.log(prior / (1 - prior))
        return _network(params)
    weights = np.where(labels == 1, prior / labels.mean(), (1 - prior) / (1 - labels.mean()))
    state = {name: [np.zeros_like(value), np.zeros_like(value)] for name, value in params.items()}
    step = 0
    for _ in range(PASSES):
        order = rng.permutation(len(sample))
        for first in range(0, len(order), 32):
            batch = order[first:first + 32]
            grads = _gradients(params, [sample[k][0] for k in batch], labels[batch], weights[batch], rng)
            step += 1
            for name, grad in grads.items():
                mean, square = state[name]
                mean += 0.1 * (grad - mean)
                square += 0.01 * (grad * grad - square)
                scale = np.sqrt(square / (1 - 0.99 ** step)) + 1e-7
                params[name] -= 0.01 * (mean / (1 - 0.9 ** step)) / scale
    return _network(params)


def _network(params: dict[str, np.ndarray]) -> Network:
    return Network(**{name: value for name, value in params.items() if name != "out_bias"}, out_bias=float(params["out_bias"][0]))


def _training_chunks(text: bytes, rng: np.random.Generator) -> list[bytes]:
    """A few chunks of a text, anew in each pass. Only training looks at some; scoring takes all."""
    size = 2 * HALF
    if len(text) <= size:
        return [text]
    starts = np.arange(0, len(text) - HALF, HALF)
    chosen = rng.choice(starts, min(len(starts), TRAIN_CHUNKS), replace=False)
    return [text[start:start + size] for start in np.sort(chosen)]


def _gradients(
    params: dict[str, np.ndarray], texts: list[bytes], labels: np.ndarray, weights: np.ndarray,
    rng: np.random.Generator,
) -> dict[str, np.ndarray]:
    chunks = [_training_chunks(text, rng) for text in texts]
    owner = np.repeat(np.arange(len(texts)), [len(own) for own in chunks])
    data = np.zeros((len(owner), 2 * HALF + WIDTH), np.uint8)
    for row, chunk in enumerate(chunk for own in chunks for chunk in own):
        data[row, :len(chunk)] = np.frombuffer(chunk, np.uint8)
    # As in scoring, windows start within the text, and within the first half at least.
    starts = np.array([min(2 * HALF, max(HALF, len(chunk))) for own in chunks for chunk in own])
    response = sum(params["filters"][k][data[:, k:k + 2 * HALF]] for k in range(WIDTH))
    response[np.arange(2 * HALF) >= starts[:, None]] = -np.inf
    place = response.argmax(axis=1)
    best = np.take_along_axis(response, place[:, None, :], axis=1)[:, 0] + params["bias"]
    pooled = np.maximum(best, 0)
    inner = np.tanh(pooled @ params["hidden"] + params["hidden_bias"])
    share = 1.0 / np.bincount(owner, minlength=len(texts))
    mean = np.zeros((len(texts), HIDDEN), np.float32)
    np.add.at(mean, owner, inner * share[owner, None])
    logit = mean @ params["out"] + params["out_bias"][0]
    error = (weights * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / len(texts)).astype(np.float32)

    d_inner = error[owner, None] * share[owner, None] * params["out"] * (1 - inner * inner)
    d_pooled = (d_inner @ params["hidden"].T) * (best > 0)
    filters = np.zeros_like(params["filters"])
    row, column = np.arange(len(owner))[:, None], np.arange(FILTERS)[None, :]
    for k in range(WIDTH):
        np.add.at(filters[k], (data[row, place + k], column), d_pooled)
    grads = {
        "filters": filters, "bias": d_pooled.sum(axis=0), "hidden": pooled.T @ d_inner,
        "hidden_bias": d_inner.sum(axis=0), "out": mean.T @ error, "out_bias": error.sum(keepdims=True),
    }
    return {name: (grad + 1e-5 * params[name]).astype(np.float32) for name, grad in grads.items()}


def train(
    docs: DataFrame, labels: DataFrame, parts: int, held_out: int, max_rows: int = TRAIN_ROWS,
    max_bytes: int = TRAIN_TEXT_BYTES, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
) -> Network:
    """Fit on labelled texts outside the held-out fold: at most ``max_rows`` of at most ``max_bytes`` each."""
    sample = labelled_sample(docs, labels, label, parts, held_out, max_rows, max_bytes, id_col, text_col)
    from ridemart.llm.common import fold

    known = labels.filter(F.col(label).isNotNull() & (fold(F.col(id_col), parts) != held_out))
    prior = known.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return fit(sample, 0.5 if prior is None else prior)


def score(spark: SparkSession, text: Column, network: Network) -> Column:
    """The probability of label 1 for each whole text, as a column.

    NULL counts as empty; an empty text is one chunk of zero bytes and has a score like any other. Nothing
    but the text goes in, so other columns, ties and repeated rows need no rule.
    """
    shared = sent(spark, network)

    @arrow_udf(T.DoubleType())
    def score_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = received(shared)
        tables = model.pair_tables()
        for batch in batches:
            yield pa.array([
                combine(model, chunk_maxima(tables, model.bias, value)) for value in binary_values(batch)
            ], pa.float64())

    return score_texts(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
