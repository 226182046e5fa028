"""SentencePiece models on the tokenizers library, checked against SentencePiece itself.

The model file is parsed from its protobuf wire format and rebuilt: normaliser,
space marker, piece scores (unigram scores, or merge ranks derived from the scores
of a BPE model) and byte fallback. No piece has a marker after another character
(asserted when the model is loaded), so a text is the sequence of its units - a run
of spaces with what follows it - and pieces never cross units. A task encodes each distinct unit
once, in multithreaded batches, decodes it again, encodes it with SentencePiece too to verify parity,
and puts texts together from their units. All ids are those of the rebuilt tokenizer.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from tapeloom.llm.common import shipped, with_added
from tapeloom.llm.text import Chunk, chunks, hash_words, ragged

MARK = "▁"
THREADS = 2
CHUNK_BYTES = 2 << 20
# units encoded at a time, and units a worker remembers between chunks (a cache: results do not depend on it)
BATCH_UNITS = 20_000
REMEMBERED = 500_000

# Kinds of pieces and models in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protobuf message (varints as int, the rest as bytes)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield number, message[at : at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True
    space_as_suffix: bool = False

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)


def parse_model(content: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(content):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append(piece)
            model.scores.append(score)
            model.kinds.append(kind)
        elif number == 2:
            spec = dict(_fields(value))
            model.kind = spec.get(3, UNIGRAM)
            model.space_as_suffix = bool(spec.get(24, 0))
            model.byte_fallback = bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix = bool(spec.get(3, 1))
            model.squeeze_spaces = bool(spec.get(4, 1))
            model.escape_spaces = bool(spec.get(5, 1))
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs whose join is a piece, best piece first; of one piece, shortest left part first."""
    usable = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k in (NORMAL, USER_DEFINED)}
    ranked = sorted((p for p in usable if len(p) > 1), key=lambda p: -usable[p])
    return [(p[:i], p[i:]) for p in ranked for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable]


def build_tokenizer(model: PieceModel):
    """A tokenizers pipeline for units: the space marker is set, no prefix is added."""
    from tokenizers import Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        backend = models.Unigram(list(zip(model.pieces, model.scores)), model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        backend = models.BPE(
            {p: i for i, p in enumerate(model.pieces)},
            _merges(model),
            unk_token=model.pieces[model.unknown],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            cache_capacity=0,
        )
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(backend)
    tokenizer.normalizer = normalizers.Replace(" ", MARK)
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


@dataclass
class Units:
    """Units in the order of their hashes: ids one after the other, flags, and in how many chunks each was met."""

    names: np.ndarray
    count: np.ndarray
    differ: np.ndarray
    broken: np.ndarray
    met: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls) -> Units:
        return cls(*[np.zeros(0, kind) for kind in (np.uint64, np.int32, bool, bool, np.int32, np.int32)])

    @property
    def begin(self) -> np.ndarray:
        return np.cumsum(self.count, dtype=np.int64) - self.count

    def take(self, at: np.ndarray) -> Units:
        columns = [a[at] for a in (self.names, self.count, self.differ, self.broken, self.met)]
        return Units(*columns, self.ids[ragged(self.begin[at], columns[1])])

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of names, and which of them are there."""
        if not len(self.names):
            return np.zeros(len(names), np.int64), np.zeros(len(names), dtype=bool)
        place = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return place, self.names[place] == names

    def merged(self, more: Units) -> Units:
        both = [np.concatenate([getattr(self, f), getattr(more, f)]) for f in self.__dataclass_fields__]
        return Units(*both).take(np.argsort(both[0], kind="stable"))

    def bounded(self, most: int) -> Units:
        """Half of ``most`` units, those met in most chunks, if there are more than ``most``."""
        if len(self.names) <= most:
            return self
        left = self.take(np.sort(np.argsort(-self.met, kind="stable")[: most // 2]))
        left.met //= 2
        return left


class Codec:
    """Both libraries over one model, and the units a worker has seen."""

    def __init__(self, content: bytes, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        from sentencepiece import SentencePieceProcessor
        from tokenizers import normalizers

        self.model = parse_model(content)
        inner = [p for p in self.model.pieces if MARK in p.lstrip(MARK)]
        if inner or self.model.space_as_suffix or not (self.model.dummy_prefix and self.model.escape_spaces):
            raise ValueError("units need markers in front of words and a dummy prefix")
        self.tokenizer = build_tokenizer(self.model)
        self.reference = SentencePieceProcessor(model_proto=content)
        steps = [normalizers.Precompiled(self.model.charsmap)] if self.model.charsmap else []
        if self.model.squeeze_spaces:
            from tokenizers import Regex

            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        self.normalizer = normalizers.Sequence(steps) if steps else None
        self.seen = Units.none()

    def normalized(self, texts: pa.Array) -> pa.Array:
        """Texts with the marker character as a space and the model's own normalisation."""
        texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
        if self.normalizer is None:
            return texts
        return pa.array([self.normalizer.normalize_str(t) for t in texts.to_pylist()], pa.large_string())

    def learn(self, names: np.ndarray, units: list[str]) -> Units:
        """Ids of units (each with its leading space), whether the libraries differ and whether it decodes to something else."""
        count, differ, broken, ids = [], [], [], []
        for low in range(0, len(units), BATCH_UNITS):
            part = units[low : low + BATCH_UNITS]
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            decoded = self.tokenizer.decode_batch(encoded, skip_special_tokens=False)
            # SentencePiece adds the leading space itself, but not to nothing
            wanted = self.reference.encode([u[1:] for u in part], num_threads=THREADS)
            same = np.fromiter(map(eq, encoded, wanted), bool, len(part))
            differ.append(~(same | np.fromiter(map(" ".__eq__, part), bool, len(part))))
            broken.append(~np.fromiter(map(eq, decoded, part), bool, len(part)))
            count.append(np.fromiter(map(len, encoded), np.int32, len(part)))
            ids.append(np.fromiter(chain.from_iterable(encoded), np.int32, int(count[-1].sum())))
        if not units:
            return Units.none()
        count, differ, broken, ids = (np.concatenate(a) for a in (count, differ, broken, ids))
        return Units(names, count, differ, broken, np.zeros(len(names), np.int32), ids)


def _units(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts of a chunk with a space in front of each; starts, ends and owners of their units."""
    size = chunk.lengths
    filled = size > 0
    place = chunk.offsets[:-1] + np.cumsum(filled) - filled
    data = np.full(len(chunk.data) + int(filled.sum()), 0x20, dtype=np.uint8)
    data[ragged(place + filled, size)] = chunk.data
    space = data == 0x20
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[place[filled]] = True
    starts = np.flatnonzero(cut)
    return data, starts, np.append(starts[1:], len(data)), np.repeat(np.arange(len(size)), np.diff(np.searchsorted(starts, np.append(place, len(data)))))


_codecs: dict[bytes, Codec] = {}


def _codec(content: bytes) -> Codec:
    if content not in _codecs:
        _codecs.clear()
        _codecs[content] = Codec(content)
    return _codecs[content]


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """Byte ranges as strings."""
    size = ends - starts
    cuts = pa.py_buffer(np.concatenate([[0], np.cumsum(size)]))
    return pa.LargeStringArray.from_buffers(len(size), cuts, pa.py_buffer(data[ragged(starts, size)])).to_pylist()


def encode_texts(codec: Codec, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: flat ids, ids per text, parity and round trip per text."""
    for chunk in chunks(codec.normalized(texts), CHUNK_BYTES):
        data, starts, ends, owner = _units(chunk)
        names, first, place = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        _, there = codec.seen.find(names)
        new = first[~there]
        codec.seen = codec.seen.merged(codec.learn(names[~there], _strings(data, starts[new], ends[new])))
        at, _ = codec.seen.find(names)
        codec.seen.met[at] += 1
        place = at[place]
        count = codec.seen.count[place].astype(np.int64)
        ids = codec.seen.ids[ragged(codec.seen.begin[place], count)]
        texts_here = len(chunk.lengths)
        per_text = np.bincount(owner, count, minlength=texts_here).astype(np.int64)
        differ, broken = codec.seen.differ[place], codec.seen.broken[place]
        codec.seen = codec.seen.bounded(REMEMBERED)
        yield (
            ids,
            per_text,
            np.bincount(owner[differ], minlength=texts_here) == 0,
            np.bincount(owner[broken], minlength=texts_here) == 0,
        )


def read_model(spark, path: str) -> bytes:
    """The bytes of one model file that Spark can read."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


@shipped
def encode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens``, ``parity`` and ``round_trip``.

    Null counts as the empty text, which has no tokens. ``token_ids`` are those of the rebuilt
    tokenizer; ``parity`` tells whether SentencePiece agrees on every unit
    of the text, ``round_trip`` whether the ids decode to the (normalised) text. Rows that repeat are all
    encoded; columns of ``docs`` with the names of added ones are replaced, all others are kept; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(docs.sparkSession, model))
    kinds = [ArrayType(IntegerType()), LongType(), BooleanType(), BooleanType()]
    added = [StructField(n, k) for n, k in zip(["token_ids", "n_tokens", "parity", "round_trip"], kinds)]
    text = [c for c in docs.columns if c not in {f.name for f in added}].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            at = 0
            for ids, count, parity, round_trip in encode_texts(codec, batch.column(text)):
                ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                part = batch.slice(at, len(count))
                at += len(count)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, pa.array(count), pa.array(parity), pa.array(round_trip)],
                    [*part.schema.names, *[f.name for f in added]],
                )

    return with_added(docs, run, added)


@shipped
def encode_digest(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, parity, round_trip)`` per row of ``docs``; see ``encode``.

    ``ids_crc32`` is the CRC-32 of the ids as little-endian 32-bit numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(docs.sparkSession, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            at = 0
            for ids, count, parity, round_trip in encode_texts(codec, batch.column("text")):
                raw, ends = memoryview(ids.astype("<i4").tobytes()), (4 * np.cumsum(count)).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(count)),
                        pa.array(count),
                        pa.array(crc, pa.int64()),
                        pa.array(parity),
                        pa.array(round_trip),
                    ],
                    ["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"],
                )
                at += len(count)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"
    )


@shipped
def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``text`` decoded from ``token_ids`` (null: null); an existing ``text`` is replaced."""
    shared = rows.sparkSession.sparkContext.broadcast(read_model(rows.sparkSession, model))
    ids = [c for c in rows.columns if c != "text"].index("token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = codec.tokenizer.decode_batch([x or [] for x in lists], skip_special_tokens=False)
            # the prefix goes again
            texts = [None if x is None else t.removeprefix(" ") for x, t in zip(lists, texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"]
            )

    return with_added(rows, run, [StructField("text", StringType())])
