"""Whole texts of an Arrow batch as one byte array, and words inside it.

The operators that walk bytes run in ``mapInArrow`` tasks. They see a batch's
string column as the contiguous UTF-8 bytes that Arrow already holds, cut into
chunks of about ``CHUNK_BYTES`` so that working arrays stay small whatever the
batch size (a single longer text forms a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 1 << 18
# words longer than this are hashed one by one instead of in lockstep
LOCKSTEP_BYTES = 256

_WORD_BREAK = np.zeros(256, dtype=bool)
_WORD_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Chunk:
    """Rows ``first`` to ``last`` of a batch; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Which text each byte position lies in."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def lowered(self) -> Chunk:
        """With A-Z in lower case; other bytes stay."""
        return Chunk(self.first, self.last, _LOWER[self.data], self.offsets)


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a string column (null: empty) in order."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    count = len(column)
    if count == 0:
        return
    _, ends, bytes_ = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + count + 1]
    data = np.frombuffer(bytes_, dtype=np.uint8) if bytes_ is not None and bytes_.size else np.zeros(0, np.uint8)
    first = 0
    # what earlier batches have left in Arrow's pool goes back to the system
    pa.default_memory_pool().release_unused()
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        low, high = int(offsets[first]), int(offsets[last])
        yield Chunk(first, last, data[low:high], offsets[first : last + 1] - low)
        first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a little-endian number, zeros past the end."""
    n = len(data)
    padded = np.zeros(n + 16, dtype=np.uint8)
    padded[:n] = data
    out = np.empty(n, dtype=np.uint64)
    for shift in range(min(8, n)):
        lane = out[shift::8]
        lane[:] = np.frombuffer(padded, dtype="<u8", count=len(lane), offset=shift)
    return out


def spans(chunk: Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that stay within a text: starts, ends, owners."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = chunk.offsets[:-1]
    before[edges[edges < n]] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    edges = chunk.offsets[1:]
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, chunk.owner(starts)


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than space and 0x09-0x0D: starts, ends, owners."""
    return spans(chunk, ~_WORD_BREAK[chunk.data])


def hash_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ahead: np.ndarray | None = None
) -> np.ndarray:
    """A 64-bit hash of each byte range, a function of its bytes alone.

    ``ahead`` may pass ``eight_bytes(data)`` if the caller has it already.
    """
    ahead = eight_bytes(data) if ahead is None else ahead
    size = (ends - starts).astype(np.int64)
    out = mix64(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    active = np.flatnonzero((size > 0) & (size <= LOCKSTEP_BYTES))
    step = 0
    while len(active):
        left = size[active] - step
        keep = np.where(left >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (np.minimum(left, 7) * 8).astype(np.uint64)) - np.uint64(1))
        out[active] = mix64((out[active] ^ (ahead[starts[active] + step] & keep)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step + 1))
        step += 8
        active = active[size[active] > step]
    for i in np.flatnonzero(size > LOCKSTEP_BYTES):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 7)
    return out


def hash_word(word: bytes) -> int:
    """``hash_words`` of one word as a signed 64-bit number."""
    data = np.frombuffer(word, dtype=np.uint8)
    value = hash_words(data, np.array([0]), np.array([len(word)]))
    return int(value.view(np.int64)[0])


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + counts[i] - 1`` for every i, one after the other."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(first - starts, counts)
