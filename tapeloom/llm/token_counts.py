"""Greedy word-piece counts with a linear longest-match automaton.

The vocabulary is a trie of byte strings. A node without the wanted child falls
back along its failure link: the node reached by the rest after the longest
pieces at its front have been popped. The number of popped pieces is stored with
the link, so counting never builds a piece and each byte is read once. All words
of a batch advance together, one byte at a step, as numpy arrays.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import shipped
from tapeloom.llm.text import chunks, words

# longer words are walked alone: in lockstep they would keep the step count of a batch high
LOCKSTEP_BYTES = 512
SPACE = 0x20
NONE = -1


class LongestMatch:
    """Trie with failure links and popped-piece counts over a byte-complete vocabulary."""

    def __init__(self, pieces: list[bytes]):
        """``pieces`` must hold every single byte, so that any text can be cut."""
        pieces = sorted(set(pieces) - {b""})
        children: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                child = children[node].get(byte)
                if child is None:
                    child = children[node][byte] = len(children)
                    children.append({})
                    whole.append(False)
                node = child
            whole[node] = True
        if len(children[0]) < 256 or not all(whole[c] for c in children[0].values()):
            raise ValueError("the vocabulary must contain all 256 single bytes")
        count = len(children)
        fail = np.zeros(count, dtype=np.int32)
        pops = np.zeros(count, dtype=np.int32)
        level = [(0, byte, child) for byte, child in children[0].items()]
        while level:
            following = []
            for parent, byte, node in level:
                if whole[node]:
                    # the whole node is one piece: popped, nothing is left
                    fail[node], pops[node] = 0, 1
                else:
                    # pieces of the parent are popped until the rest can go on with this byte
                    at, popped = int(fail[parent]), int(pops[parent])
                    while byte not in children[at]:
                        popped += int(pops[at])
                        at = int(fail[at])
                    fail[node], pops[node] = children[at][byte], popped
                following += [(node, b, c) for b, c in children[node].items()]
            level = following
        self.fail, self.pops = fail, pops
        self.next = np.full((count, 256), NONE, dtype=np.int32)
        for node, own in enumerate(children):
            if own:
                self.next[node, list(own)] = list(own.values())
        # pieces in the string of a node: what its failure links pop on the way to the root
        self.rest = np.zeros(count, dtype=np.int32)
        order = np.argsort(self._depths(children), kind="stable")
        for node in order[1:]:
            self.rest[node] = pops[node] + self.rest[fail[node]]

    @staticmethod
    def _depths(children: list[dict[int, int]]) -> np.ndarray:
        depth = np.zeros(len(children), dtype=np.int32)
        for node, own in enumerate(children):
            for child in own.values():
                depth[child] = depth[node] + 1
        return depth

    def count(self, word: bytes) -> int:
        """Pieces of one word."""
        node = total = 0
        following, fail, pops = self.next, self.fail, self.pops
        for byte in word:
            child = following[node, byte]
            while child == NONE:
                total += int(pops[node])
                node = fail[node]
                child = following[node, byte]
            node = child
        return total + int(self.rest[node])

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: int = SPACE) -> np.ndarray:
        """Pieces of each word ``data[start:end]`` with the byte ``lead`` before it."""
        size = ends - starts
        total = np.zeros(len(starts), dtype=np.int64)
        node = np.full(len(starts), self.next[0, lead], dtype=np.int32)
        long = np.flatnonzero(size > LOCKSTEP_BYTES)
        for i in long:
            total[i] = self.count(bytes([lead]) + data[starts[i] : ends[i]].tobytes())
        order = np.argsort(-np.where(size > LOCKSTEP_BYTES, 0, size), kind="stable")
        shorter = size[order]
        shorter[size[order] > LOCKSTEP_BYTES] = 0
        # words in falling length: those still running are a prefix
        running = np.searchsorted(-shorter, -np.arange(1, (shorter.max() if len(shorter) else 0) + 1), side="right")
        begin, state, done = starts[order], node[order], np.zeros(len(order), dtype=np.int64)
        for step, n in enumerate(running):
            byte = data[begin[:n] + step]
            child = self.next[state[:n], byte]
            stuck = np.flatnonzero(child == NONE)
            while len(stuck):
                done[stuck] += self.pops[state[stuck]]
                state[stuck] = self.fail[state[stuck]]
                child[stuck] = self.next[state[stuck], byte[stuck]]
                stuck = stuck[child[stuck] == NONE]
            state[:n] = child
        short = order[size[order] <= LOCKSTEP_BYTES]
        total[short] = (done + self.rest[state])[size[order] <= LOCKSTEP_BYTES]
        return total


def read_ranks(lines: list[str]) -> list[bytes]:
    """Pieces of a byte vocabulary in lines of ``base64 rank``."""
    return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@lru_cache(maxsize=2)
def _automaton(pieces: tuple[bytes, ...]) -> LongestMatch:
    return LongestMatch(list(pieces))


@shipped
def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_bytes, n_words, n_tokens)`` per row of ``docs``, whole texts, null like empty.

    ``vocabulary`` is the path of a file with lines ``base64 rank`` that Spark can
    read. Words are runs of bytes other than space and 0x09-0x0D; each is matched
    with a space before it, longest piece first. A text without words has no tokens.
    Rows that repeat are all counted; other columns are not read; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    # bounded: one vocabulary
    pieces = read_ranks([row[0] for row in spark.read.text(vocabulary).collect()])
    shared = spark.sparkContext.broadcast(tuple(sorted(set(pieces))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared.value)
        for batch in batches:
            sizes, n_words, n_tokens = [], [], []
            for chunk in chunks(batch.column("text")):
                starts, ends, owner = words(chunk)
                pieces_ = automaton.counts(chunk.data, starts, ends)
                sizes.append(chunk.lengths)
                n_words.append(np.bincount(owner, minlength=len(chunk.lengths)))
                n_tokens.append(np.bincount(owner, pieces_, minlength=len(chunk.lengths)).astype(np.int64))
            number = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), number(sizes), number(n_words), number(n_tokens)],
                ["doc_id", "n_bytes", "n_words", "n_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_words long, n_tokens long"
    )
