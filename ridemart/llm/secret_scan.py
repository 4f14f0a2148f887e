"""Secret scans: candidates by their shape, false positives removed by a random forest.

A candidate is a run of at least MIN_LENGTH characters of tokens that holds a digit, without the name it is
assigned to, or any value that is assigned to a key word, whatever its length and characters. The forest (Spark's own) sees its length, character transitions, dictionary coverage, the path of its document and the words around
it. It is trained from labelled findings, which may come from anywhere; ``assigned_findings`` derives some
from the documents themselves, which are shown to the forest in and out of the context that they were found by.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ridemart.llm.common import checkpointed

MIN_LENGTH = 12
# Characters that are described at a time; the counts of all blocks are added up.
DESCRIBED = 1 << 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_\-.@:])[A-Za-z0-9+/=_\-.@:]{%d,}" % MIN_LENGTH)
NEAR = 48
WORD = re.compile(r"[^\W\d_]+")
# Bounds of the training sample and the dictionary.
TRAIN_ROWS, DICTIONARY_WORDS = 4000, 20_000
TREES, DEPTH, SEED = 40, 8, 11

# Words around a candidate that speak for or against a secret, and marks of test paths.
KEY_WORDS = ("key", "token", "secret", "password", "passwd", "pwd", "auth", "credential", "bearer", "api", "private")
HARMLESS_WORDS = ("example", "sample", "test", "dummy", "placeholder", "sha", "md5", "uuid", "commit", "checksum", "mail", "http")
TEST_PATHS = ("test", "example", "sample", "fixture", "mock", "doc")

FEATURES = (
    "length", "digits", "capitals", "hex_digits", "marks", "distinct", "class_changes", "pair_repeats", "vowel_pairs",
    "longest_letters", "dictionary", "test_path", "key_before", "harmless_before", "key_after", "harmless_after",
    "assigned", "quoted", "at_sign", "dots",
)
FOUND = "_row bigint, start int, end int, value string, features array<double>, assigned boolean"


_CODES = np.arange(128)
_KIND = np.select([(_CODES >= 48) & (_CODES <= 57), (_CODES >= 65) & (_CODES <= 90), (_CODES >= 97) & (_CODES <= 122)], [0, 1, 2], 3)
_FOLD = np.where(_KIND == 1, _CODES + 32, _CODES)
_HEX, _VOWEL = np.isin(_CODES, [*b"0123456789abcdef"]), np.isin(_CODES, [*b"aeiou"])


def shape(value: str) -> list[float]:
    """Shares of digits, capitals, hex digits, marks, distinct characters, class changes, repeated pairs and vowel pairs.

    The whole value counts, block by block; each block but the first begins with the last character of the one before.
    """
    n, kinds = len(value), np.zeros(4, np.int64)
    hexes = changes = vowels = 0
    seen, pairs = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for first in range(0, n, DESCRIBED):
        before = int(first > 0)
        codes = np.frombuffer(value[first - before:first + DESCRIBED].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        plain = np.where(codes < 128, codes, 127)
        kind, folded = _KIND[plain], np.where(codes < 128, _FOLD[plain], codes)
        kinds += np.bincount(kind[before:], minlength=4)
        hexes += int(_HEX[_FOLD[plain[before:]]].sum())
        changes += int((kind[1:] != kind[:-1]).sum())
        vowel = _VOWEL[_FOLD[plain]]
        vowels += int((vowel[1:] != vowel[:-1]).sum())
        seen = np.union1d(seen, codes)
        pairs = np.union1d(pairs, (folded[:-1] << 21) | folded[1:])
    return [
        kinds[0] / n, kinds[1] / n, hexes / n, kinds[3] / n, len(seen) / n, changes / (n - 1) if n > 1 else 0,
        1 - len(pairs) / max(1, n - 1), vowels / n,
    ]


def describe(value: str, before: str, after: str, path: str, dictionary: frozenset[str]) -> list[float]:
    """The features of one whole candidate, in the order of FEATURES."""
    n, known, longest = len(value), 0, 0
    for word in WORD.finditer(value):
        size = word.end() - word.start()
        longest = max(longest, size)
        known += size if word.group().lower() in dictionary else 0
    near, far = before.lower(), after.lower()
    return [float(x) for x in (
        n, *shape(value), longest, known / n, any(part in path.lower() for part in TEST_PATHS),
        any(word in near for word in KEY_WORDS), any(word in near for word in HARMLESS_WORDS),
        any(word in far for word in KEY_WORDS), any(word in far for word in HARMLESS_WORDS),
        bool(re.search(r"[=:]\s*[\"']?$", before)), before[-1:] in "\"'" and bool(before), "@" in value, value.count("."),
    )]


_KEYS = "|".join(KEY_WORDS)
# What stands before a value: key =, "key":, ["key"] =, key: and the like, a bearer mark, or an option of the command line.
ASSIGNS = re.compile(
    r"(?:%s)(?:s|\d+|[_-]\w{0,40})?[\"'\])]{0,3}[ \t]{0,8}(?::=|=>|=|:)[ \t]{0,8}(?:bearer[ \t]+|basic[ \t]+)?"
    r"|\bbearer[ \t]+|--[\w-]{0,40}?(?:%s)[\w-]{0,40}[ \t]+" % (_KEYS, _KEYS), re.IGNORECASE,
)
_QUOTED = re.compile(r"\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)'")
_PLAIN = re.compile(r"[^\s\"',;()\[\]{}]+")
_NAME = re.compile(r"[A-Za-z_][\w.\-]*=(?![=\s]|$)")


def _assigned_spans(text: str) -> list[tuple[int, int, bool]]:
    """Start, end and whether it looks like a value rather than a word of prose, of each value assigned to a key word."""
    found, plain_end, last_plain = [], 0, False
    for match in ASSIGNS.finditer(text):
        # What was taken for a plain value is the name of this assignment.
        if last_plain and match.start() < plain_end:
            found.pop()
        last_plain = False
        start = match.end()
        if quoted := _QUOTED.match(text, start):
            found.append((*quoted.span(quoted.lastindex), True))
            continue
        if start >= plain_end:
            plain = _PLAIN.match(text, start)
            plain_end = plain.end() if plain else start
        end = plain_end
        while end > start and text[end - 1] in ".:,":
            end -= 1
        if end > start:
            sure = end - start >= MIN_LENGTH or any(text[k].isdigit() for k in range(start, end))
            found.append((start, end, sure))
            last_plain = True
    return found


def _spans(text: str) -> list[tuple[int, int, bool]]:
    """Start, end and whether it is a value of a key word, of each candidate in order of its start."""
    values = _assigned_spans(text)
    out = {(start, end): sure for start, end, sure in values}
    # Runs inside a value of several words are candidates of their own.
    whole = [(start, end) for start, end, _ in values if not re.search(r"\s", text[start:end])]
    k = 0
    for match in CANDIDATE.finditer(text):
        begin, stop = match.span()
        while k < len(whole) and whole[k][1] <= begin:
            k += 1
        own, j = [], k
        while j < len(whole) and whole[j][0] < stop:
            own.append((max(begin, whole[j][0]), min(stop, whole[j][1])))
            j += 1
        names = (begin + name.end() for name in _NAME.finditer(match.group()))
        edges = sorted({begin, stop, *names, *(edge for span in own for edge in span)})
        at = 0
        for first, last in zip(edges, edges[1:]):
            while at < len(own) and own[at][1] <= first:
                at += 1
            if at < len(own) and own[at][0] <= first:
                continue
            value = text[first:last].rstrip(".:,")
            if len(value) >= MIN_LENGTH and any(c.isdigit() for c in value):
                out.setdefault((first, first + len(value)), False)
    return sorted((*span, sure) for span, sure in out.items())


def candidates_of(text: str, path: str, dictionary: frozenset[str]) -> Iterator[tuple]:
    """(start, end, value, features, assigned) of each candidate; places count code points."""
    for start, end, assigned in _spans(text):
        value, before, after = text[start:end], text[max(0, start - NEAR):start], text[end:end + NEAR]
        yield start, end, value, describe(value, before, after, path, dictionary), assigned


def dictionary_of(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> frozenset[str]:
    """The most frequent words of all documents, of four letters or more, counted as DataFrame operations."""
    word = F.explode(F.split(F.lower(F.col(text_col).cast("string")), r"[^\p{L}]+"))
    counted = docs.select(word.alias("word")).filter(F.length("word").between(4, 24)).groupBy("word").count()
    # Set down first: the driver then gets these words alone, not the first words of every task.
    top = checkpointed(counted.filter(F.col("count") > 1).orderBy(F.desc("count"), "word").limit(words).select("word"))
    return frozenset(row["word"] for row in top.collect())


def find_candidates(
    docs: DataFrame, dictionary: frozenset[str], id_col: str = "doc_id", text_col: str = "text",
    path_col: str | None = None,
) -> DataFrame:
    """One row per candidate of each whole text: id, start, end, value, features, assigned.

    NULL and empty texts have none, a NULL path is an empty one, a NULL id is kept. Repeated rows give
    repeated findings. Other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_row"), F.col(text_col).cast("string").alias("_text"), path.alias("_path"),
    )
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.float64()), pa.bool_()]
    names = ["_row", "start", "end", "value", "features", "assigned"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                found = [
                    (name.as_py(), *candidate)
                    for name, text, path in zip(*part.columns)
                    for candidate in candidates_of(text.as_py() or "", path.as_py() or "", shared.value)
                ]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)], names,
                    )

    return rows.mapInArrow(find, FOUND).withColumnRenamed("_row", id_col)


# Known harmless shapes: mail, numbers (addresses, dates, phones), web addresses without a sign-in, checksums that say so.
HARMLESS_SHAPES = (
    r"^[\w.+\-]+@[\w\-]+(\.[\w\-]+)+$", r"^[\d.:/T+\-]+Z?$", r"^https?://[^@=]+$",
)
# Shapes of keys and tokens as their issuers document them.
ISSUER_SHAPES = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$", r"^gh[pousr]_[0-9A-Za-z]{36,}$", r"^github_pat_\w{22,}$", r"^glpat-[\w-]{20,}$",
    r"^xox[abprs]-[0-9A-Za-z-]{10,}$", r"^AIza[\w-]{35}$", r"^[rs]k_(live|test)_[0-9A-Za-z]{16,}$", r"^SG\.[\w-]{16,}\.[\w-]{16,}$",
    r"^npm_[0-9A-Za-z]{36}$", r"^eyJ[\w-]+\.eyJ[\w-]+\.[\w-]+$",
)
CHECKSUM = r"^((md5|sha\d*)[:=\-])?([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"


def assigned_findings(candidates: DataFrame) -> DataFrame:
    """Labelled findings by distant supervision: what is assigned to a key word or has an issuer's shape is a secret,
    known harmless shapes are not.

    Findings of which neither or both is true have no label and serve no training. A checksum, or a finding in a test
    path, is harmless only by the words around it or the path.
    """
    value, feature = F.col("value"), lambda name: F.col("features")[FEATURES.index(name)] > 0
    shape = F.lit(False)
    for pattern in HARMLESS_SHAPES:
        shape = shape | value.rlike(pattern)
    context = feature("test_path") | (F.lower(value).rlike(CHECKSUM) & feature("harmless_before"))
    issued = F.lit(False)
    for pattern in ISSUER_SHAPES:
        issued = issued | value.rlike(pattern)
    label = F.when((F.col("assigned") | issued) & ~shape, 1).when(~F.col("assigned") & ~issued & (shape | context), 0)
    return candidates.select("features", label.cast("int").alias("label"))


# The features that say what ``assigned_findings`` makes its labels from.
TELLING = ("key_before", "key_after", "assigned", "quoted")


def blanked(features: Column) -> Column:
    """The features of a candidate as if nothing around it said that it is a value of a key word."""
    places = F.array(*[F.lit(FEATURES.index(name)) for name in TELLING])
    return F.transform(features, lambda x, k: F.when(F.array_contains(places, k), F.lit(0.0)).otherwise(x))


def in_and_out_of_context(labelled: DataFrame) -> DataFrame:
    """Each labelled finding as it stands and once more blanked.

    Labels that come from the context would teach the forest the context alone. From the blanked findings it has
    to learn what secrets look like, so that it finds those that no key word stands before.
    """
    return labelled.unionByName(labelled.withColumn("features", blanked(F.col("features"))))


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest from rows of ``features`` and ``label``: at most ``max_rows``, half of each label.

    The sample is the rows with the smallest hash of their features, each once, in one order and one
    partition, so equal findings give an equal forest. Rows with a NULL in either column serve no training, and
    other columns are ignored. None when a label is missing altogether, as in an empty table.
    """
    rows = labelled.filter(F.col("features").isNotNull() & F.col("label").isNotNull()).distinct()
    order = (F.xxhash64("features"), F.col("features"))
    # Set down first: the driver then gets the sample alone, not the first rows of every task.
    parts = [checkpointed(rows.filter(F.col("label") == value).orderBy(*order).limit(max_rows // 2)) for value in (0, 1)]
    sample = [row for part in parts for row in part.collect()]
    if len({row["label"] for row in sample}) < 2:
        return None
    sample = labelled.sparkSession.createDataFrame(sample, "features array<double>, label int").coalesce(1)
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8,
    )
    return forest.fit(sample.select(array_to_vector("features").alias("vector"), F.col("label").cast("double")))


def score(candidates: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """The candidates with the forest's probability as ``score`` and ``is_secret`` from one half on.

    All columns stay; candidates of an empty table, repeated ones and NULL ids need no rule. Without a model every candidate keeps the score 1: nothing is removed on no evidence.
    """
    if model is None:
        return candidates.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_probability")
    scored = model.transform(candidates.withColumn("vector", array_to_vector("features")))
    probability: Column = vector_to_array("_probability")[1]
    return scored.withColumn("score", probability).withColumn("is_secret", F.col("score") >= 0.5).drop("_probability", "vector")
