"""Log-bilinear language model with noise-contrastive estimation, over exact corpus counts.

**Counts.** Every training token is counted: per task in numpy, then by Spark. The
most frequent words (a bounded table) travel to the tasks; other words of a document
meet their counts in a join, so nothing unbounded is broadcast.

**Model.** The ``MODELLED`` most frequent words have vectors. The first ``OWN`` of them are classes of
their own, the others share ``BINS`` classes of words of like frequency; the words beyond share one more class, within
which a word's probability is its smoothed share. The classes of the two tokens before are mapped by one matrix per
position and added; the prediction meets each class vector in a dot product plus a bias, and, inside a shared
class, each word vector in another.

**Training** is noise-contrastive on both levels: classes are told apart from classes drawn from the unigram
distribution, words from words drawn from that of their class, so the model is never normalised
while it learns. Texts are dealt to shards by a hash of their tokens, so many that a shard holds ``SHARD_TOKENS`` on average;
every shard trains on all its tokens in a fixed order from the shared parameters, and the results are averaged by tokens.
Nothing depends on how the rows are partitioned.

**Scores.** The exact normalisers of every context, over the classes and inside every class, come from batched
matrix products once the parameters are final.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import held_out, shipped
from tapeloom.llm.text import chunks, hash_words, ragged
from tapeloom.llm.text import words as word_runs
from tapeloom.plans.staging import stage

FOLDS, HELD_OUT = 7, 2
# the last two classes are that of the words without vectors and the end of a text
CLASSES = 256
OTHER, END, BEGIN = CLASSES - 2, CLASSES - 1, CLASSES
OWN = 126
BINS = OTHER - OWN
# words with vectors, by rank; the number of all others fits two bytes as well
MODELLED = (1 << 16) - 1
NONE = MODELLED
DIMENSION = 16
NOISE = 32
ROUNDS = 2
RATE = 0.05
STEPS = 120
# contexts that a step looks at, and noise classes that it draws for all of them
CONTEXTS = 1024
DRAWN = 4096
# inside a class: tokens of a step, noise words drawn for each, step size
WORD_STEP = 8192
WORD_NOISE = 2
WORD_RATE = 0.3
# tokens of a shard; longer texts are cut for training
SHARD_TOKENS = 4_000_000
PIECE_TOKENS = 1 << 16
# words of a row of parameters, tokens of a slice of scores
BLOCK_WORDS = 1024
SLICE_TOKENS = 200_000
# words whose counts travel to the tasks
HEAD_WORDS = 1 << 18
SEED = 5


def _hashed(column: pa.Array):
    """Per chunk: number of texts, word hashes (in lower case), owners."""
    for chunk in chunks(column):
        low = chunk.lowered()
        starts, ends, owner = word_runs(low)
        yield len(chunk.lengths), hash_words(low.data, starts, ends).view(np.int64), owner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [h for _, h, _ in _hashed(batch.column("text"))]
        word, count = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(count.astype(np.int64))], ["word", "count"])


@dataclass
class Head:
    """The most frequent words by hash, their counts and ranks (``NONE``: without a vector), and the totals.

    By rank: ``rank_counts``, and ``class_of`` with one entry more, for ``NONE``.
    """

    words: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray
    rank_counts: np.ndarray
    class_of: np.ndarray
    documents: int
    tokens: int
    distinct: int
    other_tokens: int
    other_words: int

    @property
    def base_total(self) -> float:
        return float(self.tokens + self.distinct + 1)

    @property
    def other_total(self) -> float:
        return float(self.other_tokens + self.other_words + 1)


def _head(counts: DataFrame, documents: int, head_words: int) -> Head:
    total = counts.agg(F.sum("count"), F.count(F.lit(1))).first()
    tokens, distinct = int(total[0] or 0), int(total[1])
    # the least count that at most ``head_words`` words reach: from one histogram, never by sorting
    bucket = F.when(F.col("count") <= 1024, F.col("count")).otherwise((64 * F.log2("count") + 384).cast("long"))
    histogram = counts.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("words"), F.min("count").alias("least"))
    least, room = None, head_words
    for row in sorted(histogram.collect(), key=lambda r: -r["bucket"]):
        room -= row["words"]
        if room < 0:
            break
        least = row["least"]
    # bounded by ``head_words``
    top = counts.where(F.col("count") >= least if least is not None else F.lit(False)).toArrow()
    word, count = top.column("word").to_numpy(), top.column("count").to_numpy()
    ranked = np.lexsort((word, -count))[:MODELLED]
    ranks = np.full(len(word), NONE, dtype=np.uint16)
    ranks[ranked] = np.arange(len(ranked))
    order = np.argsort(word)
    own = count[ranked].astype(np.float64)
    return Head(
        word[order], count[order].astype(np.float64), ranks[order], own, class_of_ranks(own), documents,
        tokens + documents, distinct + (documents > 0), tokens - int(own.sum()), distinct - len(own),
    )


def class_of_ranks(counts: np.ndarray) -> np.ndarray:
    """Class of each rank, and ``OTHER`` for ``NONE``: neighbours in rank share a class, alike in the sum of roots of counts."""
    out = np.full(MODELLED + 1, OTHER, dtype=np.int16)
    out[: min(OWN, len(counts))] = np.arange(min(OWN, len(counts)))
    mass = np.cumsum(np.sqrt(counts[OWN:]))
    if len(mass):
        out[OWN : len(counts)] = OWN + np.minimum((mass - mass[0]) / mass[-1] * BINS, BINS - 1).astype(np.int16)
    return out


_DIGEST = (
    "doc_id long, row long, held_out boolean, n_tokens long, known long, base double, inside double, "
    "ranks binary, rare array<long>, rare_count array<int>"
)


def _digests(shared):
    """Per text: tokens, what its frequent words add to both scores, its words by rank, its other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: Head = shared.value
        base, other = np.log10(head.base_total), np.log10(head.other_total)
        end_known = int(head.documents > 0)
        end_base = np.log10(head.documents + 1) - base
        gain = np.log10(head.counts + 1)
        for batch in batches:
            at = 0
            for texts, hashes, owner in _hashed(batch.column("text")):
                if len(head.words):
                    place = np.minimum(np.searchsorted(head.words, hashes), len(head.words) - 1)
                    frequent = head.words[place] == hashes
                else:
                    place, frequent = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), dtype=bool)
                ranks = np.full(len(hashes), NONE, dtype="<u2")
                ranks[frequent] = head.ranks[place[frequent]]
                logs = np.zeros(len(hashes))
                logs[frequent] = gain[place[frequent]]
                count = np.bincount(owner, minlength=texts)
                shared_class = ranks == NONE
                per_text = lambda weights: np.bincount(owner, weights, minlength=texts)
                inside = per_text(np.where(shared_class, logs - other, 0.0))
                ends = 2 * np.cumsum(count)
                raw, cuts = ranks.tobytes(), [0, *ends.tolist()]
                # words that need a join, once per text
                rare = np.flatnonzero(~frequent)
                order = np.lexsort((hashes[rare], owner[rare]))
                rare_word, rare_text = hashes[rare][order], owner[rare][order]
                new = np.flatnonzero((np.diff(rare_word, prepend=0) != 0) | (np.diff(rare_text, prepend=-1) != 0))
                if len(rare_word) and (not len(new) or new[0] != 0):
                    new = np.concatenate([[0], new])
                times = np.diff(np.append(new, len(rare_word))).astype(np.int32)
                offsets = pa.array(np.searchsorted(rare_text[new], np.arange(texts + 1)).astype(np.int32))
                part = batch.slice(at, texts)
                at += texts
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row"),
                        part.column("held_out"),
                        pa.array(count + 1),
                        pa.array(per_text(frequent).astype(np.int64) + end_known),
                        pa.array(per_text(logs) - count * base + end_base),
                        pa.array(inside),
                        pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(rare_word[new])),
                        pa.ListArray.from_arrays(offsets, pa.array(times)),
                    ],
                    [f.split()[0] for f in _DIGEST.split(", ")],
                )

    return run


@dataclass
class Tokens:
    """Classes two and one before, class, rank and text of every token; each text ends with ``END``."""

    far: np.ndarray
    near: np.ndarray
    kind: np.ndarray
    rank: np.ndarray
    text: np.ndarray

    @property
    def context(self) -> np.ndarray:
        return self.far * (CLASSES + 1) + self.near


def tokens_of(column: pa.Array, class_of: np.ndarray) -> Tokens:
    """The tokens of texts given as ranks."""
    sizes = np.asarray(pc.binary_length(column)).astype(np.int64) // 2
    count = len(sizes)
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype="<u2")
    text = np.repeat(np.arange(count), sizes + 3)
    first = np.cumsum(sizes + 3) - (sizes + 3)
    last = first + sizes + 2
    inner = np.ones(len(text), dtype=bool)
    inner[first] = inner[first + 1] = inner[last] = False
    rank = np.full(len(text), NONE, dtype=np.int64)
    rank[inner] = flat
    kind = np.full(len(text), BEGIN, dtype=np.int64)
    kind[inner] = class_of[flat]
    kind[last] = END
    token = np.ones(len(text), dtype=bool)
    token[first] = token[first + 1] = False
    at = np.flatnonzero(token)
    return Tokens(kind[at - 2], kind[at - 1], kind[at], rank[at], text[at])


def _slices(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Texts given as ranks, so many at a time that they have about ``SLICE_TOKENS`` tokens (one text at least)."""
    ends = np.cumsum(np.asarray(pc.binary_length(column)).astype(np.int64) // 2 + 3)
    low = 0
    while low < len(column):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + SLICE_TOKENS, side="right")))
        yield low, column.slice(low, high - low)
        low = high


def _own(a: np.ndarray) -> np.ndarray:
    """A copy with numpy's own type object: an unpickled array brings another, and ``np.add.at`` is ten times slower on it."""
    return a.astype(a.dtype.type)


@dataclass
class LogBilinear:
    """Context vectors, one matrix per context position, class vectors and biases."""

    context: np.ndarray
    far: np.ndarray
    near: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, unigram: np.ndarray) -> LogBilinear:
        random = np.random.default_rng(SEED)
        small = lambda *shape: random.normal(0, 0.1, shape)
        eye = np.eye(DIMENSION)
        return cls(small(CLASSES + 1, DIMENSION), 0.5 * eye, eye.copy(), small(CLASSES, DIMENSION), np.log(unigram))

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.far, self.near, self.target, self.bias]

    def copy(self) -> LogBilinear:
        return LogBilinear(*[_own(a) for a in self.arrays()])

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def filled(self, flat: np.ndarray) -> LogBilinear:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at : at + a.size].reshape(a.shape))
            at += a.size
        return LogBilinear(*out)

    def predicted(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        return self.context[far] @ self.far + self.context[near] @ self.near

    def normalisers(self) -> np.ndarray:
        """Log of the sum over classes for each context (far, near), in batches of one far class."""
        out = np.empty((CLASSES + 1, CLASSES + 1))
        near = np.arange(CLASSES + 1)
        for far in range(CLASSES + 1):
            s = self.predicted(np.full(CLASSES + 1, far), near) @ self.target.T + self.bias
            top = s.max(axis=1, keepdims=True)
            out[far] = top[:, 0] + np.log(np.exp(s - top).sum(axis=1))
        return out

    def train(self, far: np.ndarray, near: np.ndarray, word: np.ndarray, weight: np.ndarray, unigram: np.ndarray) -> None:
        """Noise-contrastive steps over weighted trigrams, with adaptive moments.

        Each context meets its classes as data and ``NOISE`` times as much noise. A step draws ``DRAWN`` noise
        classes from the unigram distribution, and all its contexts meet them, weighted by their own tokens.
        """
        context, of, size = np.unique(far * (CLASSES + 1) + near, return_inverse=True, return_counts=True)
        order = np.argsort(of, kind="stable")
        word, weight, begin = word[order], weight[order] / weight.sum(), np.cumsum(size) - size
        far, near = np.divmod(context, CLASSES + 1)
        share = np.add.reduceat(weight, begin)
        log_noise = np.log(NOISE * unigram)
        random = np.random.default_rng(SEED)
        # every step sees the heaviest contexts, and others in turn with their weights scaled up
        ranked = np.argsort(-share, kind="stable")
        heavy, others = ranked[: CONTEXTS // 4], ranked[CONTEXTS // 4 :]
        turn = CONTEXTS - CONTEXTS // 4
        first = [np.zeros_like(a) for a in self.arrays()]
        second = [np.zeros_like(a) for a in self.arrays()]
        queue = np.zeros(0, dtype=np.int64)
        for step in range(1, STEPS + 1):
            if len(queue) < min(turn, len(others)):
                queue = np.concatenate([queue, random.permutation(others)])
            now, queue = queue[:turn], queue[turn:]
            at = np.concatenate([heavy, now])
            scale = np.repeat([1.0, len(others) / max(len(now), 1)], [len(heavy), len(now)])
            row = np.repeat(np.arange(len(at)), size[at])
            cell = ragged(begin[at], size[at])
            data = np.bincount(row * CLASSES + word[cell], weight[cell] * scale[row], minlength=len(at) * CLASSES)
            data = data.reshape(len(at), CLASSES)
            drawn = random.multinomial(DRAWN, unigram) / DRAWN
            noise = NOISE * drawn * (share[at] * scale)[:, None]
            f, n = far[at], near[at]
            q = self.predicted(f, n)
            p = _sigmoid(q @ self.target.T + self.bias - log_noise)
            push = data * (1 - p) - noise * p
            grad_q = push @ self.target
            grads = [np.zeros_like(a) for a in self.arrays()]
            np.add.at(grads[0], f, grad_q @ self.far.T)
            np.add.at(grads[0], n, grad_q @ self.near.T)
            grads[1] += self.context[f].T @ grad_q
            grads[2] += self.context[n].T @ grad_q
            grads[3] += push.T @ q
            grads[4] += push.sum(axis=0)
            rate = RATE * (1 - (step - 1) / STEPS)
            for a, g, m, v in zip(self.arrays(), grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Words:
    """Vectors and biases of the words in shared classes, in the order of ranks from ``OWN`` on."""

    vectors: np.ndarray
    bias: np.ndarray
    log_share: np.ndarray
    first: np.ndarray

    @classmethod
    def start(cls, head: Head) -> Words:
        """Every word with its share of its class: the unigram model."""
        counts, classes = head.rank_counts[OWN:] + 0.5, head.class_of[OWN : len(head.rank_counts)] - OWN
        first = np.searchsorted(classes, np.arange(BINS + 1))
        log_share = np.log(counts) - np.log(np.maximum(np.bincount(classes, counts, minlength=1), 0.5))[classes]
        return cls(np.zeros((len(counts), DIMENSION)), log_share.copy(), log_share, first)

    def copy(self) -> Words:
        return Words(*[_own(a) for a in (self.vectors, self.bias, self.log_share, self.first)])

    def train(self, predicted, word: np.ndarray, kind: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Noise-contrastive steps over tokens; returns the weight of tokens of each word.

        ``predicted`` gives the predictions of some tokens by their numbers. Step sizes adapt by word. Noise words are drawn from the shares of the token's class.
        """
        random = np.random.default_rng(SEED)
        ends = np.cumsum(np.exp(self.log_share))
        begin = np.concatenate([[0.0], ends])[self.first]
        seen, spent = np.bincount(word, weight, minlength=len(self.bias)), np.full(len(self.bias), 1e-6)
        order = random.permutation(len(word))
        for low in range(0, len(order), WORD_STEP):
            at = order[low : low + WORD_STEP]
            c = kind[at]
            draw = begin[c][:, None] + random.random((len(at), WORD_NOISE)) * (begin[c + 1] - begin[c])[:, None]
            noise = np.clip(np.searchsorted(ends, draw), self.first[c][:, None], self.first[c + 1][:, None] - 1)
            ids, q = np.concatenate([word[at][:, None], noise], axis=1), predicted(at)
            s = np.einsum("bd,bkd->bk", q, self.vectors[ids]) + self.bias[ids]
            push = -_sigmoid(s - self.log_share[ids] - np.log(WORD_NOISE))
            push[:, 0] += 1
            push *= np.minimum(weight[at], 16.0)[:, None]
            flat, push = ids.ravel(), push.ravel()
            np.add.at(spent, flat, push * push)
            step = WORD_RATE * push / np.sqrt(spent[flat])
            # one flat index: numpy adds along it several times faster than row by row
            cells = (flat[:, None] * DIMENSION + np.arange(DIMENSION)).ravel()
            np.add.at(self.vectors.reshape(-1), cells, (step.reshape(len(at), -1, 1) * q[:, None, :]).ravel())
            np.add.at(self.bias, flat, 0.1 * step)
        return seen

    def normalisers(self, q: np.ndarray) -> np.ndarray:
        """Log of the sum over the words of each shared class for each prediction."""
        out = np.full((len(q), BINS), -np.inf, dtype=np.float32)
        filled = np.flatnonzero(np.diff(self.first))
        if len(filled):
            s = q.astype(np.float32) @ self.vectors.T.astype(np.float32) + self.bias.astype(np.float32)
            # scores stay small: the bias is a log share, vectors are bounded by their steps
            top = s.max(axis=1, keepdims=True)
            np.exp(np.subtract(s, top, out=s), out=s)
            out[:, filled] = np.log(np.maximum(np.add.reduceat(s, self.first[filled], axis=1), 1e-37)) + top
        return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as ranks, long ones cut."""
    for batch in batches:
        out = []
        for raw in batch.column("ranks").to_pylist():
            out += [raw[a : a + 2 * PIECE_TOKENS] for a in range(0, len(raw), 2 * PIECE_TOKENS)] or [raw]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ranks"])


def _sharded(ranks: DataFrame, shards: int) -> DataFrame:
    """``(shard, ranks, copies)``: equal texts counted, dealt by a hash of their tokens, in a fixed order."""
    pieces = ranks.mapInArrow(_pieces, "ranks binary").groupBy("ranks").agg(F.count(F.lit(1)).alias("copies"))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("ranks"), F.lit(shards)))
    return stage(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "ranks"))


@dataclass
class Shard:
    """Tokens of a shard in narrow types (12 bytes a token), with the copies of their texts."""

    far: np.ndarray
    near: np.ndarray
    kind: np.ndarray
    rank: np.ndarray
    weight: np.ndarray

    def trigrams(self) -> tuple[np.ndarray, ...]:
        """Different class trigrams (far, near, class) and their weights."""
        code = (self.far.astype(np.int32) * (CLASSES + 1) + self.near) * CLASSES + self.kind
        order = np.argsort(code, kind="stable")
        code, weight = code[order], self.weight[order].astype(np.float64)
        new = np.flatnonzero(np.diff(code, prepend=-1))
        rest, kind = np.divmod(code[new].astype(np.int64), CLASSES)
        return (*np.divmod(rest, CLASSES + 1), kind, np.add.reduceat(weight, new))


def _shards(batches: Iterator[pa.RecordBatch], class_of: np.ndarray) -> Iterator[tuple[int, Shard]]:
    """Each shard with its tokens in order."""
    held: list[tuple[np.ndarray, ...]] = []
    name = None

    def joined():
        return name, Shard(*[np.concatenate(parts) for parts in zip(*held)])

    for batch in batches:
        shard = batch.column("shard").to_numpy()
        edges = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1)) if len(shard) else []
        for low, high in zip(edges, [*edges[1:], len(shard)]):
            if held and shard[low] != name:
                yield joined()
                held = []
            name = int(shard[low])
            part = batch.slice(low, high - low)
            for first, texts in _slices(part.column("ranks")):
                found = tokens_of(texts, class_of)
                copies = part.column("copies").slice(first, len(texts)).to_numpy().astype(np.float32)
                narrow = [a.astype(np.int16) for a in (found.far, found.near, found.kind)]
                held.append((*narrow, found.rank.astype(np.uint16), copies[found.text]))
    if held:
        yield joined()


def _class_round(shared, unigram: np.ndarray, class_of):
    """Train the classes on every shard from the shared parameters; parameters weighted by tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in _shards(batches, class_of.value):
            model = shared.value.copy()
            far, near, kind, weight = shard.trigrams()
            tokens = weight.sum()
            model.train(far, near, kind, weight, unigram)
            value = model.flat() * tokens
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(value))), pa.array(value), pa.array(np.full(len(value), tokens))],
                ["place", "value", "tokens"],
            )

    return run


_BLOCK_TYPE = "block int, part int, numbers binary"


def _word_round(shared, class_of):
    """Train the words in shared classes on every shard; blocks of parameters weighted by the words' tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, start = shared.value
        far_part, near_part = model.context @ model.far, model.context @ model.near
        for name, shard in _shards(batches, class_of.value):
            at = np.flatnonzero((shard.kind >= OWN) & (shard.kind < OTHER)).astype(np.int32)
            words = start.copy()
            predicted = lambda n: far_part[shard.far[at[n]]] + near_part[shard.near[at[n]]]
            seen = words.train(predicted, shard.rank[at].astype(np.int32) - OWN, shard.kind[at] - OWN, shard.weight[at])
            rows = np.concatenate([words.vectors * seen[:, None], (words.bias * seen)[:, None], seen[:, None]], axis=1)
            blocks = [rows[a : a + BLOCK_WORDS].tobytes() for a in range(0, len(rows), BLOCK_WORDS)]
            n = np.arange(len(blocks), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(n), pa.array(np.full(len(n), name % 64, dtype=np.int32)), pa.array(blocks, pa.binary())],
                ["block", "part", "numbers"],
            )

    return run


def _added_up(keys: list[str]):
    """Blocks in the order of ``keys`` to the sum of each key's blocks, one block in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = None, None

        def written():
            return pa.RecordBatch.from_arrays(
                [pa.array([name[0]], pa.int32()), pa.array([name[-1]], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                ["block", "part", "numbers"],
            )

        for batch in batches:
            for key, raw in zip(zip(*(batch.column(k).to_pylist() for k in keys)), batch.column("numbers")):
                numbers = np.frombuffer(raw.as_py(), dtype=np.float64)
                if key == name:
                    total += numbers
                    continue
                if name is not None:
                    yield written()
                name, total = key, numbers.copy()
        if name is not None:
            yield written()

    return run


def _averaged(blocks: DataFrame, start: Words) -> Words:
    """The mean of the shards' words; a word that no shard has seen keeps its start. Sums go through two levels."""
    for keys in (["block", "part"], ["block"]):
        blocks = blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_added_up(keys), _BLOCK_TYPE)
    # bounded: one row per block of MODELLED words
    found = blocks.select("block", "numbers").toArrow().sort_by("block")
    raw = b"".join(found.column("numbers").to_pylist())
    if not raw:
        return start
    rows = np.frombuffer(raw, dtype=np.float64).reshape(-1, DIMENSION + 2)
    seen = np.maximum(rows[:, -1:], 1e-300)
    new = rows[:, -1] > 0
    vectors = np.where(new[:, None], rows[:, :DIMENSION] / seen, start.vectors)
    return Words(vectors, np.where(new, rows[:, DIMENSION] / seen[:, 0], start.bias), start.log_share, start.first)


def _inner_normalisers(shared):
    """For each far class: the normalisers inside every shared class, for all near classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value
        near = np.arange(CLASSES + 1)
        for batch in batches:
            for far in batch.column("id").to_pylist():
                z = words.normalisers(model.predicted(np.full(len(near), far), near))
                yield pa.RecordBatch.from_arrays([pa.array([far]), pa.array([z.tobytes()], pa.binary())], ["id", "z"])

    return run


def _scores(shared, class_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words, normaliser, inner = shared.value
        far_part, near_part = model.context @ model.far, model.context @ model.near
        for batch in batches:
            out = []
            for _, part in _slices(batch.column("ranks")):
                t = tokens_of(part, class_of.value)
                q = far_part[t.far] + near_part[t.near]
                s = np.einsum("ij,ij->i", q, model.target[t.kind]) + model.bias[t.kind] - normaliser[t.far, t.near]
                at = np.flatnonzero((t.kind >= OWN) & (t.kind < OTHER))
                word = t.rank[at] - OWN
                s[at] += np.einsum("ij,ij->i", q[at], words.vectors[word]) + words.bias[word]
                s[at] -= inner[t.context[at], t.kind[at] - OWN]
                out.append(np.bincount(t.text, s, minlength=len(part)) / np.log(10))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["row", "model"]
            )

    return run


@shipped
def score_texts(
    docs: DataFrame, rounds: int = ROUNDS, head_words: int = HEAD_WORDS, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Texts are whole, null like empty; every text ends with one end token, so the
    empty text has one token. Learned from the rows outside the held-out fold (a
    null id is never held out). Rows that repeat are all counted and scored; other
    columns are not read; an empty table gives no rows. Without training rows all
    counts are zero and the model is uniform over its classes. How the rows are
    partitioned changes nothing; ``shard_tokens`` belongs to the model's parameters.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
        "text",
    )
    training = rows.where("not held_out")
    counts = stage(
        training.select("text").mapInArrow(_count, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))
    )
    head = _head(counts, training.count(), head_words)
    digest = stage(rows.mapInArrow(_digests(spark.sparkContext.broadcast(head)), _DIGEST))

    context = spark.sparkContext
    class_of = context.broadcast(head.class_of)
    unigram = np.full(CLASSES, 0.5)
    np.add.at(unigram, head.class_of[: len(head.rank_counts)], head.rank_counts)
    unigram[OTHER] = head.other_tokens + 0.5
    unigram[END] += head.documents
    unigram /= unigram.sum()
    model = LogBilinear.start(unigram)
    learned = _sharded(digest.where("not held_out").select("ranks"), max(1, -(-head.tokens // shard_tokens)))
    for _ in range(rounds):
        trained = learned.mapInArrow(
            _class_round(context.broadcast(model), unigram, class_of), "place long, value double, tokens double"
        )
        # one row per parameter
        mean = trained.groupBy("place").agg((F.sum("value") / F.sum("tokens")).alias("value")).toArrow()
        if mean.num_rows:
            flat = np.zeros(mean.num_rows)
            flat[mean.column("place").to_numpy()] = mean.column("value").to_numpy()
            model = model.filled(flat)
    words = Words.start(head)
    if len(words.bias):
        words = _averaged(learned.mapInArrow(_word_round(context.broadcast((model, words)), class_of), _BLOCK_TYPE), words)

    # bounded: a row per class
    shared = context.broadcast((model, words))
    rows_of_z = spark.range(0, CLASSES + 1, 1, min(CLASSES + 1, 4 * context.defaultParallelism))
    rows_of_z = rows_of_z.mapInArrow(_inner_normalisers(shared), "id long, z binary").toArrow().sort_by("id")
    inner = np.frombuffer(b"".join(rows_of_z.column("z").to_pylist()), dtype=np.float32).reshape(-1, BINS)
    scored = stage(
        digest.select("row", "ranks").mapInArrow(
            _scores(context.broadcast((model, words, model.normalisers(), inner)), class_of), "row long, model double"
        )
    )
    rare = digest.select("row", F.explode(F.arrays_zip("rare", "rare_count")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("word"), F.col("w.rare_count").alias("times"))
    met = rare.join(counts, "word", "left")
    log = F.log10(F.coalesce("count", F.lit(0)) + 1)
    found = met.groupBy("row").agg(
        F.sum(F.col("times") * log).alias("logs"),
        F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("known_rare"),
    )
    zero = F.lit(0.0)
    logs = F.coalesce("logs", zero)
    return (
        digest.drop("ranks", "rare", "rare_count")
        .join(scored, "row")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
            F.lit(head.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + logs).alias("base_score"),
            (F.col("model") + F.col("inside") + logs).alias("score"),
        )
    )
