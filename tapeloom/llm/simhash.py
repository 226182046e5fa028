"""SimHash near-duplicates by an inverted index over the bytes of fingerprints.

Fingerprints at 3 or fewer differing bits differ in at most 3 of their 8 bytes,
so they share at least 5 positional bytes. Single bytes are far too common to
list their holders at scale, so the index keys are positional byte triples
inside each half: five shared bytes put three into one half, hence every pair that
reaches the guaranteed count meets in at least one list. There the shared
positional bytes of each pair are tallied, pairs below the count are dropped
and the rest verified by their differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.blocks import BLOCK, Forest, block_groups, group_pairs, whole_groups
from tapeloom.llm.common import numbered, shipped
from tapeloom.llm.components import components
from tapeloom.llm.text import Chunk, chunks, ragged, words
from tapeloom.plans.staging import stage

BITS = 64
BYTES = 8
SEED = 42


def _shingles(chunk: Chunk, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Space-joined words of a chunk, and starts, ends, owners of its shingles in them."""
    low = chunk.lowered()
    starts, ends, owner = words(low)
    length = ends - starts
    place = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()), 0x20, dtype=np.uint8)
    joined[ragged(place, length)] = low.data[ragged(starts, length)]
    count = np.bincount(owner, minlength=len(low.lengths))
    first = np.cumsum(count) - count
    shingle_count = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = ragged(first, shingle_count)
    owners = np.repeat(np.arange(len(count)), shingle_count)
    last = begin + np.minimum(count[owners], size) - 1
    return joined.tobytes(), place[begin], place[last] + length[last], owners


def fingerprints_of(chunk: Chunk, size: int) -> np.ndarray:
    """The 64-bit fingerprint of each text of a chunk (no word: zero)."""
    joined, starts, ends, owners = _shingles(chunk, size)
    out = np.zeros(len(chunk.lengths), dtype=np.uint64)
    if not len(owners):
        return out
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts)
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
    first = np.flatnonzero(np.diff(owners, prepend=-1))
    set_bits = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    total = np.diff(np.append(first, len(owners)))
    majority = (2 * set_bits > total[:, None]).astype(np.uint8)
    out[owners[first]] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return out


@shipped
def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, text_key, fp)`` per row of ``docs``: whole texts, null like empty.

    A-Z are lower-cased, words are runs of bytes other than space and 0x09-0x0D; a
    text with fewer than ``size`` words is one shingle, one without words gets 0.
    ``text_key`` tells rows apart that repeat an id with another text.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprints_of(chunk, size) for chunk in chunks(batch.column("text"))]
            fp = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fp.view(np.int64))],
                ["doc_id", "text_key", "fp"],
            )

    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _link_in_groups(max_bits: int, guaranteed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            fp = rows.column("id").to_numpy()
            prints = fp.view(np.uint64)
            by_byte = prints.view(np.uint8).reshape(-1, BYTES)
            forest = Forest(len(fp))
            for i, j in group_pairs(rows):
                shared = (by_byte[i] == by_byte[j]).sum(axis=1)
                enough = shared >= guaranteed
                i, j = i[enough], j[enough]
                near = np.bitwise_count(prints[i] ^ prints[j]) <= max_bits
                forest.link(i[near], j[near])
            child, root = forest.edges()
            if len(child):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[child]), pa.array(fp[root])], ["src", "dst"]
                )

    return run


def near_fingerprints(prints: DataFrame, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """Links ``(src, dst)`` that connect all distinct ``fp`` at ``max_bits`` or fewer bits.

    A group that links n fingerprints yields at most n - 1 links, which connect
    the same fingerprints as all its pairs would.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("byte triples guarantee a shared list only up to 3 bits")
    guaranteed = BYTES - max_bits
    byte = lambda k: f"(shiftrightunsigned(fp, {8 * k}) & 255L)"
    triples = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
    keys = [
        f"{n}L * 16777216L + {byte(a)} * 65536L + {byte(b)} * 256L + {byte(c)}"
        for n, (a, b, c) in enumerate(triples)
    ]
    entries = prints.select(F.explode(F.expr(f"array({', '.join(keys)})")).alias("list"), F.col("fp").alias("id"))
    return block_groups(entries, block).mapInArrow(_link_in_groups(max_bits, guaranteed), "src long, dst long")


def _grouped(docs: DataFrame, size: int, max_bits: int, block: int) -> DataFrame:
    """``(doc_id, text_key, fp, root, component_id)``; ``root`` names the group by a fingerprint."""
    prints = stage(fingerprints(docs, size))
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    member = components(near_fingerprints(distinct, max_bits, block))
    rooted = distinct.join(member.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # a hot fingerprint is one row of the smaller side: its rows can be split
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


@shipped
def simhash_groups(docs: DataFrame, size: int = 3, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of ``max_bits`` or
    fewer differing bits, the row itself included; null ids never win over others,
    a group of null ids only has a null component. Equal fingerprints are collapsed
    before the search, so copies never form pairs. Rows that repeat are all
    returned; an empty table gives no rows; other columns of ``docs`` are not read.
    """
    return _grouped(docs, size, max_bits, block).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@shipped
def keep_one(docs: DataFrame, size: int = 3, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id.

    Of rows that share this id, the one with the least text key stays, once. A
    group of null ids keeps the row with the least text key. A null text counts as empty; rows that
    repeat are one row; other columns, whatever their names, are kept as they are; an empty table stays empty.
    """
    stays = (
        _grouped(docs, size, max_bits, block)
        .where("doc_id <=> component_id")
        .groupBy("root")
        .agg(F.min("text_key").alias("_key"), F.min("doc_id").alias("_id"))
        .select(F.coalesce("_id", F.lit(0)).alias("_id"), F.col("_id").isNull().alias("_null"), "_key")
    )
    rows = numbered(docs)
    doc_id, text = (F.col(str(docs.columns.index(c))) for c in ("doc_id", "text"))
    keyed = rows.withColumns(
        {"_id": F.coalesce(doc_id.cast("long"), F.lit(0)), "_null": doc_id.isNull(), "_key": F.xxhash64(text)}
    )
    names = ["_id", "_null", "_key"]
    return keyed.join(stays, names).dropDuplicates(names).select(*rows.columns).toDF(*docs.columns)
