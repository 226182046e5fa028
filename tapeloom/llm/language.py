"""Language of texts: sparse multinomial logistic regression on TF-IDF character n-grams.

Bigrams and trigrams of lower-cased letters (anything else is a blank) are
hashed into a fixed number of features, weighted by inverse document frequency
and scaled to a fixed sum per text. Weights are learned one text at a time with
follow-the-regularised-leader and an elastic net: coordinates whose gradients never
add up to more than the first penalty stay exactly zero. A temperature, fitted on
labelled texts that the weights have not seen, calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import bounded_sample, held_out, shipped
from tapeloom.llm.text import chunks, mix64
from tapeloom.plans.staging import stage

FEATURES = 1 << 14
# the labelled texts that a fit looks at; a fifth of them sets the temperature
LABELLED_ROWS = 5_000
EPOCHS = 3
ALPHA, BETA, LASSO, RIDGE = 0.5, 1.0, 0.02, 0.05
# the sum of a text's feature values
MASS = 16.0
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
# texts counted together: bounds the dense table of a slice
SLICE = 32


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@dataclass
class Grams:
    """Hashed n-grams of some texts: feature and text of each, and which texts have a letter."""

    feature: np.ndarray
    text: np.ndarray
    lettered: np.ndarray


def grams(texts: pa.Array, features: int = FEATURES) -> Iterator[tuple[int, int, Grams]]:
    """Per chunk of texts: first and last row, and their n-grams."""
    for chunk in chunks(pc.utf8_lower(texts.cast(pa.large_string()))):
        count = len(chunk.lengths)
        points = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        upto = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])[chunk.offsets]
        text = np.repeat(np.arange(count), np.diff(upto))
        letter = _letters()[points]
        lettered = np.bincount(text[letter], minlength=count) > 0
        c = np.where(letter, points, 0).astype(np.uint64)
        pair = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:]
        two = (text[:-1] == text[1:]) & (letter[:-1] | letter[1:])
        three = (text[:-2] == text[2:]) & letter[1:-1]
        code = np.concatenate(
            [pair[two], pair[:-1][three] * np.uint64(0xC2B2AE3D27D4EB4F) + c[2:][three] + np.uint64(1)]
        )
        owner = np.concatenate([text[:-1][two], text[:-2][three]])
        feature = (mix64(code) & np.uint64(features - 1)).astype(np.int64)
        yield chunk.first, chunk.last, Grams(feature, owner, lettered)


def _counts(found: Grams, texts: int, features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, feature and count of each distinct n-gram, some texts at a time."""
    order = np.argsort(found.text, kind="stable")
    text, feature = found.text[order], found.feature[order]
    for low in range(0, texts, SLICE):
        a, b = np.searchsorted(text, [low, low + SLICE])
        table = np.bincount((text[a:b] - low) * features + feature[a:b], minlength=1)
        at = np.flatnonzero(table)
        yield low + at // features, at % features, table[at]


def _frequencies(features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features, dtype=np.int64)
        for batch in batches:
            for first, last, found in grams(batch.column("text"), features):
                for _, feature, _ in _counts(found, last - first, features):
                    total += np.bincount(feature, minlength=features)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "texts"])

    return run


def _vectors(features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found in grams(batch.column("text"), features):
                rows: list = [[] for _ in range(last - first)]
                for text, feature, count in _counts(found, last - first, features):
                    for t in np.unique(text):
                        own = text == t
                        rows[t] = [feature[own].astype(np.int32).tobytes(), count[own].astype(np.float32).tobytes()]
                at = [t for t, r in enumerate(rows) if r]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").take(pa.array([first + t for t in at], pa.int64())),
                        pa.array([rows[t][0] for t in at], pa.binary()),
                        pa.array([rows[t][1] for t in at], pa.binary()),
                    ],
                    ["lang", "features", "counts"],
                )

    return run


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]], features: int, classes: int, epochs: int = EPOCHS
) -> np.ndarray:
    """Weights (features x classes) from ``(feature, value, class)`` examples."""
    z = np.zeros((features, classes))
    n = np.zeros((features, classes))

    def weights(z, n):
        shrunk = np.sign(z) * LASSO - z
        return np.where(np.abs(z) > LASSO, shrunk / ((BETA + np.sqrt(n)) / ALPHA + RIDGE), 0.0)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            at, value, label = examples[k]
            w = weights(z[at], n[at])
            error = _softmax(value @ w)
            error[label] -= 1
            gradient = value[:, None] * error
            grown = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden sections of its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t):
        p = _softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def vector(self, feature: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = count * self.idf[feature]
        return feature, value * (MASS / max(value.sum(), 1e-12))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for first, last, found in grams(texts, len(self.idf)):
            count = last - first
            mass = np.bincount(found.text, self.idf[found.feature], minlength=count)
            weighted = self.idf[:, None] * self.weights
            logits = np.stack(
                [np.bincount(found.text, weighted[found.feature, k], minlength=count) for k in range(len(self.languages))],
                axis=1,
            ) if self.languages else np.zeros((count, 1))
            p = _softmax(logits * (MASS / np.maximum(mass, 1e-12))[:, None] / self.temperature)
            known = found.lettered & bool(self.languages)
            best = p.argmax(axis=1)
            names += [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            scores.append(np.where(known, p.max(axis=1), 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def fit_language(docs: DataFrame, rows: int = LABELLED_ROWS, features: int = FEATURES) -> LanguageModel:
    """Learn from the documents outside the held-out fold that have an id and a language.

    Document frequencies count all of them; weights and temperature come from at most
    ``rows`` distinct ones, drawn by a hash of id and text.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id", FOLDS, HELD_OUT)
    )
    frequency = np.zeros(features)
    counted = known.select("text").mapInArrow(_frequencies(features), "feature long, texts long")
    # at most ``features`` rows
    for row in counted.groupBy("feature").agg(F.sum("texts").alias("texts")).collect():
        frequency[row["feature"]] = row["texts"]
    texts = max(known.count(), 1)
    idf = np.log((1 + texts) / (1 + frequency)) + 1

    name = F.xxhash64("doc_id", "text")
    chosen = stage(bounded_sample(stage(known.select(name.alias("name")).distinct()), F.col("name"), rows))
    # bounded by ``rows``
    sample = known.withColumn("name", name).join(F.broadcast(chosen), "name").dropDuplicates(["name"])
    found = sample.select("text", "lang").mapInArrow(_vectors(features), "lang string, features binary, counts binary")
    read = [
        (r["lang"], np.frombuffer(r["features"], np.int32), np.frombuffer(r["counts"], np.float32).astype(np.float64))
        for r in found.collect()
    ]
    read.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    languages = sorted({r[0] for r in read})
    model = LanguageModel(languages, idf, np.zeros((features, max(len(languages), 1))), 1.0)
    examples = [(*model.vector(f, c), languages.index(lang)) for lang, f, c in read]
    apart = np.random.default_rng(12).random(len(examples)) < 0.2
    model.weights = train_ftrl([e for e, a in zip(examples, apart) if not a], features, max(len(languages), 1))
    unseen = [e for e, a in zip(examples, apart) if a]
    if unseen:
        logits = np.stack([value @ model.weights[at] for at, value, _ in unseen])
        model.temperature = temperature(logits, np.array([label for _, _, label in unseen]))
    return model


@shipped
def languages(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row of ``docs``, from whole texts alone.

    ``und`` with score 0 for a null text, one without any letter, and for all texts
    when nothing is labelled. Rows that repeat are all predicted; other columns are
    not read; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_language(docs, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.value.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "lang_pred", "score"],
            )

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
    return found.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score")
