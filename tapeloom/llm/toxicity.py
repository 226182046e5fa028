"""Toxicity of texts after undoing obfuscation with a noisy-channel model.

**Channel.** A suspicious stretch of text (symbols or digits that stand for
letters, single letters set apart, letters repeated three times or more) is a
lattice: every character may stand for itself or for the letter it imitates, a
separator may be noise or a word end, a repeated letter may be one. Each way
costs a fixed penalty; a character trigram model of the corpus says how likely
the letters are. The cheapest path (Viterbi) replaces the stretch.

**Score.** Evidence comes from the starts of restored words. Every start of 3 to 7
bytes and every whole word is weighted by the lower bound of its log odds of occurring in toxic against other labelled documents, so a start seen in
a few texts says little. A text's strongest words and their number enter a logistic
regression fitted to the labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from tapeloom.llm.common import bounded_sample, held_out, numbered, shipped, with_added
from tapeloom.llm.text import Chunk, chunks, eight_bytes, hash_words, mix64, spans
from tapeloom.plans.staging import stage

# the labelled rows that a fit may look at
LABELLED_ROWS = 20_000
# the strongest word starts that a model keeps
FEATURES = 20_000
STARTS = range(3, 8)
SMOOTHING = 0.5
BOUND_SIGMAS = 2.0
LEAST_EVIDENCE = 1.0
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2

# Letters that symbols and digits imitate.
LEET = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
}
SEPARATORS = " .-_*"

# longer stretches are read without the cache of readings
REMEMBERED = 64

# costs in nats
IMITATE, DROP, SQUEEZE, KEEP_SYMBOL = 0.5, 0.4, 0.4, 8.0

_LETTER = "a-zA-Z\\u00c0-\\u024f"
_MARK = re.escape("".join(LEET))
# a letter and an imitating mark side by side; letters set apart one by one; a letter three times
SUSPICIOUS = re.compile(
    rf"(?<!\S)(?=[^\s]*[{_LETTER}][{_MARK}]+[{_LETTER}]|[{_MARK}]+[{_LETTER}]{{2}})[{_LETTER}{_MARK}]{{3,}}(?![^\s.,;:?])"
    rf"|(?<![^\s])[{_LETTER}{_MARK}](?:[ .\-_*]{{1,2}}[{_LETTER}{_MARK}]){{2,}}(?![^\s.,;:?!])"
    rf"|(?<![{_LETTER}])[{_LETTER}]*([{_LETTER}])\1\1[{_LETTER}]*"
)
ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
_SYMBOL = {c: i + 1 for i, c in enumerate(ALPHABET)}
SYMBOLS = len(ALPHABET) + 1


class CharacterModel:
    """Trigram costs over ``ALPHABET`` and the word boundary (0), from counts of trigrams."""

    def __init__(self, counts: np.ndarray):
        counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        single = counts.sum((0, 1)) + 0.1
        single /= single.sum()
        double = counts.sum(0)
        double = (double + 5 * single) / (double.sum(1, keepdims=True) + 5)
        triple = (counts + 5 * double[None]) / (counts.sum(2, keepdims=True) + 5)
        self.cost = -np.log(triple)
        self.restore = lru_cache(maxsize=100_000)(self._restore)

    def __reduce__(self):
        return _model_from_costs, (self.cost.astype(np.float32),)

    def _restore(self, stretch: str) -> str:
        """The cheapest reading of a suspicious stretch, by Viterbi over pairs of symbols."""
        cost = self.cost
        # (last two symbols, letter that may be squeezed) -> (cost, reading); readings are linked lists
        # of what was added last, which share their beginnings: a stretch of any length takes linear time
        beams: dict[tuple[int, int, str], tuple[float, tuple]] = {(0, 0, ""): (0.0, ())}
        for c in stretch.lower():
            grown: dict[tuple[int, int, str], tuple[float, tuple]] = {}

            def offer(key, total, text):
                if key not in grown or total < grown[key][0]:
                    grown[key] = (total, text)

            for (a, b, last), (total, text) in beams.items():
                if c in _SYMBOL:
                    s = _SYMBOL[c]
                    offer((b, s, c), total + cost[a, b, s], (text, c))
                    if c == last:
                        offer((a, b, c), total + SQUEEZE, text)
                for letter in LEET.get(c, ""):
                    s = _SYMBOL[letter]
                    offer((b, s, letter), total + IMITATE + cost[a, b, s], (text, letter))
                    if letter == last:
                        offer((a, b, letter), total + IMITATE + SQUEEZE, text)
                if c in SEPARATORS:
                    offer((a, b, ""), total + DROP, text)
                    if b:
                        offer((b, 0, ""), total + cost[a, b, 0], (text, " "))
                if c not in _SYMBOL and c not in SEPARATORS:
                    offer((b, 0, ""), total + KEEP_SYMBOL + cost[a, b, 0], (text, c))
            beams = grown
        ends = [(total + cost[a, b, 0], text) for (a, b, _), (total, text) in beams.items()]
        least = min(total for total, _ in ends)
        return min(_spelled(text) for total, text in ends if total == least)

    def deobfuscate(self, text: str) -> str:
        return SUSPICIOUS.sub(lambda m: self.restore(m[0]) if len(m[0]) <= REMEMBERED else self._restore(m[0]), text)


def _spelled(reading: tuple) -> str:
    letters = []
    while reading:
        reading, letter = reading
        letters.append(letter)
    return "".join(reversed(letters))


def _model_from_costs(cost: np.ndarray) -> CharacterModel:
    model = CharacterModel.__new__(CharacterModel)
    model.cost = cost
    model.restore = lru_cache(maxsize=100_000)(model._restore)
    return model


# symbols of single bytes and of two-byte letters with lead bytes 0xC3 and 0xC5; other bytes end words
_ASCII = np.zeros(256, dtype=np.int64)
_AFTER_C3 = np.zeros(256, dtype=np.int64)
_AFTER_C5 = np.zeros(256, dtype=np.int64)
for _c, _i in _SYMBOL.items():
    _b = _c.encode()
    if len(_b) == 1:
        _ASCII[_b[0]] = _i
    elif _b[0] == 0xC3:
        _AFTER_C3[_b[1]] = _i
    elif _b[0] == 0xC5:
        # upper case stands before lower case
        _AFTER_C5[_b[1]] = _AFTER_C5[_b[1] - 1] = _i
# upper case of the same letters: 0xC3 0x80-0x9E without the multiplication sign
for _x in range(0x80, 0x9F):
    if _x != 0x97 and not _AFTER_C3[_x]:
        _AFTER_C3[_x] = _AFTER_C3[_x + 0x20]


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for chunk in chunks(batch.column("text")):
            data = chunk.lowered().data
            symbol = _ASCII[data]
            second = np.zeros(len(data), dtype=bool)
            for first, after in ((0xC3, _AFTER_C3), (0xC5, _AFTER_C5)):
                lead = np.flatnonzero(data[:-1] == first)
                symbol[lead] = after[data[lead + 1]]
                second[lead + 1] = True
            # two word boundaries between texts: no trigram reaches from one into the next
            edges = np.concatenate([[0], np.cumsum(~second)])[chunk.offsets]
            s = np.insert(symbol[~second], np.repeat(edges, 2), 0)
            if len(s) > 2:
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["trigram", "count"])


@shipped
def character_model(docs: DataFrame) -> CharacterModel:
    """Trigram counts of all texts; at most SYMBOLS ** 3 numbers reach the driver."""
    found = docs.select("text").mapInArrow(_trigrams, "trigram long, count long")
    counts = np.zeros(SYMBOLS**3)
    for row in found.groupBy("trigram").agg(F.sum("count").alias("count")).collect():
        counts[row["trigram"]] = row["count"]
    return CharacterModel(counts)


_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[48:58] = _TOKEN[97:123] = True
_TOKEN[128:] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(c) for c in LEET]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
AROUND = 48
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[ord(c) for c in SEPARATORS]] = True


def _restored(texts: pa.Array, model: CharacterModel) -> Iterator[Chunk]:
    """Chunks of lower-cased texts with their suspicious stretches replaced."""
    for chunk in chunks(texts):
        data = chunk.data
        if not len(data):
            yield chunk
            continue
        letter = data > 64
        hint = np.zeros(len(data), dtype=bool)
        # three equal letters, a mark before a letter, two lone letters in a row
        hint[2:] |= (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letter[2:]
        if (data >= 0xC3).any():
            hint[5:] |= (data[5:] == data[3:-2]) & (data[3:-2] == data[1:-4]) & (data[5:] >= 0x80)
        mark = _MARKS[data]
        hint[1:] |= mark[:-1] & letter[1:]
        apart = _SEPARATOR[data]
        if len(data) > 4:
            hint[4:] |= apart[:-4] & ~apart[1:-3] & apart[2:-2] & ~apart[3:-1] & apart[4:]
        at = np.flatnonzero(hint)
        if not len(at):
            yield chunk.lowered()
            continue
        yield _replaced(chunk, at, model)


def _replaced(chunk: Chunk, at: np.ndarray, model: CharacterModel) -> Chunk:
    """The chunk in lower case with stretches around the positions ``at`` restored.

    What is searched reaches ``AROUND`` bytes past each position and on to white space.
    """
    low, data = chunk.lowered().data, chunk.data
    owner = chunk.owner(at)
    begin, end = chunk.offsets[owner], chunk.offsets[owner + 1]
    blank = np.concatenate([[-1], np.flatnonzero(_BLANK[data]), [len(data)]])
    left = blank[np.searchsorted(blank, np.maximum(at - AROUND, 0), side="right") - 1] + 1
    right = blank[np.searchsorted(blank, np.minimum(at + AROUND, len(data) - 1))]
    left, right = np.maximum(left, begin), np.minimum(right, end)
    # windows of one text that touch become one
    apart = np.ones(len(at), dtype=bool)
    apart[1:] = (left[1:] > np.maximum.accumulate(right)[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(apart)
    left, right, owner = left[first], np.maximum.reduceat(right, first), owner[first]
    parts, before, change = [], 0, np.zeros(len(chunk.offsets), dtype=np.int64)
    for a, b, i in zip(left.tolist(), right.tolist(), owner.tolist()):
        new = model.deobfuscate(data[a:b].tobytes().decode("utf-8", "replace")).lower().encode()
        parts += [low[before:a].tobytes(), new]
        change[i + 1] += len(new) - (b - a)
        before = b
    parts.append(low[before:].tobytes())
    out = np.frombuffer(b"".join(parts), dtype=np.uint8)
    return Chunk(chunk.first, chunk.last, out, chunk.offsets + np.cumsum(change))


def _features(chunk: Chunk) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Owners of the words of a lower-cased chunk, and per kind of feature (words, codes)."""
    starts, ends, owner = spans(chunk, _TOKEN[chunk.data])
    size = ends - starts
    ahead = eight_bytes(chunk.data)

    def kinds() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for length in STARTS:
            long = np.flatnonzero(size > length)
            mask = np.uint64((1 << 8 * length) - 1)
            yield long, mix64((ahead[starts[long]] & mask) + np.uint64(length))
        long = np.flatnonzero(size >= STARTS[0])
        yield long, hash_words(chunk.data, starts[long], ends[long], ahead)

    return owner, kinds()


def _presence(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for chunk in _restored(batch.column("text"), model.value):
                owner, kinds = _features(chunk)
                pairs = [(owner[words], code) for words, code in kinds]
                owner_, code = (np.concatenate(c) for c in zip(*pairs))
                once = np.unique(mix64(code + owner_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
                owner_, (code, place) = owner_[once], np.unique(code[once], return_inverse=True)
                bad = toxic[chunk.first + owner_] > 0
                with_bad = np.bincount(place, bad, minlength=len(code)).astype(np.int64)
                all_ = np.bincount(place, minlength=len(code))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.view(np.int64)), pa.array(with_bad), pa.array(all_ - with_bad)],
                    ["code", "bad", "good"],
                )

    return run


@dataclass
class ToxicityModel:
    characters: CharacterModel
    codes: np.ndarray
    weights: np.ndarray
    coefficients: np.ndarray

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Per text: the strongest word's evidence, the log of one plus the sum over words, a constant."""
        rows = []
        bits = 1 << 20
        filter_ = np.zeros(bits, dtype=bool)
        filter_[(self.codes & np.uint64(bits - 1)).astype(np.int64)] = True
        for chunk in _restored(texts, self.characters):
            owner, kinds = _features(chunk)
            best = np.zeros(len(owner))
            for long, code in kinds:
                likely = filter_[(code & np.uint64(bits - 1)).astype(np.int64)]
                long, code = long[likely], code[likely]
                if not len(long):
                    continue
                place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                weight = np.where(self.codes[place] == code, self.weights[place], 0.0)
                np.maximum.at(best, long, weight)
            texts_here = len(chunk.lengths)
            strongest = np.zeros(texts_here)
            strong = np.flatnonzero(best)
            np.maximum.at(strongest, owner[strong], best[strong])
            total = np.bincount(owner[strong], best[strong], minlength=texts_here)
            rows.append(np.stack([strongest, np.log1p(total), np.ones(texts_here)], axis=1))
        return np.concatenate(rows) if rows else np.zeros((0, 3))

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) @ self.coefficients, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the constant."""
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        # nothing to tell apart: one score for every text
        w[-1] = math.log(len(y) + 1) if y.sum() else -30.0
        return w
    keep = np.full(x.shape[1], ridge * len(y) / 100)
    keep[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - keep * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(hessian, gradient)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


@shipped
def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, features: int = FEATURES) -> ToxicityModel:
    """Learn from at most ``rows`` labelled documents outside the held-out fold.

    The sample is drawn by a hash of the ids. The character model counts
    all texts. A document with several labels is toxic if one of them says so.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id", FOLDS, HELD_OUT))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    # bounded by ``rows``: small enough for every task
    chosen = stage(bounded_sample(stage(known), F.col("doc_id"), rows))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    sample = stage(sample.dropDuplicates(["doc_id", "text"]).select("text", "toxic"))
    characters = character_model(docs)
    shared = spark.sparkContext.broadcast(characters)
    counts = sample.mapInArrow(_presence(shared), "code long, bad long, good long")
    counts = counts.groupBy("code").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    size = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    bad, good = (size[0] or 0), size[1] - (size[0] or 0)
    a, b = F.col("bad") + SMOOTHING, F.col("good") + SMOOTHING
    odds = F.log(a / (bad + 2 * SMOOTHING)) - F.log(b / (good + 2 * SMOOTHING))
    bound = odds - BOUND_SIGMAS * F.sqrt(1 / a + 1 / b)
    best = counts.select("code", bound.alias("weight")).where(F.col("weight") > LEAST_EVIDENCE)
    best = best.orderBy(F.desc("weight"), "code").limit(features).collect()
    codes = np.array([r["code"] for r in best], dtype=np.int64).view(np.uint64)
    weights = np.array([r["weight"] for r in best], dtype=np.float64)
    order = np.argsort(codes)
    if not len(codes):
        codes, weights, order = np.zeros(1, np.uint64), np.zeros(1), np.zeros(1, np.int64)
    model = ToxicityModel(characters, codes[order], weights[order], np.zeros(3))
    scorer = spark.sparkContext.broadcast(model)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = scorer.value.evidence(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(e[:, 0]), pa.array(e[:, 1]), batch.column("toxic")], ["best", "total", "toxic"]
            )

    seen_rows = sample.mapInArrow(seen, "best double, total double, toxic int").collect()
    x = np.array([(r["best"], r["total"], 1.0) for r in seen_rows]).reshape(-1, 3)
    y = np.array([r["toxic"] for r in seen_rows], dtype=np.float64)
    model.coefficients = _logistic(x, y)
    return model


_SCORE = "score"


def _with_score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Numbered columns of ``docs`` and the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.score(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, _SCORE])

    return with_added(numbered(docs), run, [StructField(_SCORE, DoubleType())])


@shipped
def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``, whole texts, null like empty.

    Only the texts are scored. Without a toxic label to learn from every text scores
    near zero, without any other label near one. Rows that repeat are all scored; other
    columns are not read; an empty table gives no rows.
    """
    model = fit_toxicity(docs, labels, **options)
    scored = _with_score(docs.select("doc_id", "text"), model)
    doc_id = F.col("0")
    return scored.select(
        doc_id.alias("doc_id"),
        held_out(doc_id, FOLDS, HELD_OUT).alias("held_out"),
        F.col(_SCORE).alias("score"),
        (F.col(_SCORE) >= threshold).cast("int").alias("predicted"),
    )


@shipped
def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more.

    A null text is scored like the empty one; a null id is no obstacle; rows that repeat share their fate; other
    columns, whatever their names, are kept as they are; an empty table stays empty.
    """
    model = fit_toxicity(docs, labels, **options)
    return _with_score(docs, model).where(F.col(_SCORE) < threshold).drop(_SCORE).toDF(*docs.columns)
