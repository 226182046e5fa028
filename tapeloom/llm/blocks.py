"""Pairs inside the lists of an inverted index, with long lists cut into blocks.

A list of n entries is dealt into ceil(n / block) blocks by a hash of the id;
every two blocks (and every block with itself) form one group, so no task holds
a whole long list and no pair is missed. Groups of a partition are walked in
order and all their pairs compared as numpy arrays, a bounded slice at a time:
pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
SLICE = 1 << 20
GROUP = ["list", "low", "high"]


def block_groups(entries: DataFrame, block: int = BLOCK, payload: DataFrame | None = None) -> DataFrame:
    """``entries(list, id, ...)`` dealt to groups and sorted for ``whole_groups``.

    Lists with one entry have no pairs and are left out. Adds ``low``, ``high``
    (the blocks that meet in the group) and ``own`` (the entry's block).
    ``payload(id, ...)`` is joined to the entries that are left.
    """
    sizes = entries.groupBy("list").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.expr(f"cast((_n + {block - 1}) div {block} as int)")
    dealt = (
        entries.join(sizes, "list")
        .withColumn("_blocks", blocks)
        .withColumn("own", F.pmod(F.hash("id"), F.col("_blocks")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("low", F.least("own", "_other"))
        .withColumn("high", F.greatest("own", "_other"))
        .drop("_n", "_blocks", "_other")
    )
    if payload is not None:
        dealt = dealt.join(payload, "id")
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP, "id")


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str] = tuple(GROUP)) -> Iterator[pa.Table]:
    """Tables that never end inside a group of equal ``keys`` (rows arrive sorted by them)."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        if rows.num_rows == 0:
            continue
        same = None
        for key in keys:
            column = rows.column(key)
            equal = pc.equal(column, column[-1])
            same = equal if same is None else pc.and_(same, equal)
        inside = same.combine_chunks().to_numpy(zero_copy_only=False)
        other = np.flatnonzero(~inside)
        start = int(other[-1]) + 1 if len(other) else 0
        if start:
            yield rows.slice(0, start).combine_chunks()
        held = rows.slice(start)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def group_starts(rows: pa.Table, keys: Sequence[str] = tuple(GROUP)) -> np.ndarray:
    """First row of each group, and the number of rows at the end."""
    n = rows.num_rows
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), n)


def group_pairs(rows: pa.Table, limit: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i < j) of all pairs that a group owns, in slices of about ``limit`` pairs.

    Two rows of one block meet in the block's own group only.
    """
    bounds = group_starts(rows)
    sizes = np.diff(bounds)
    row = np.arange(rows.num_rows)
    later = np.repeat(bounds[1:], sizes) - row - 1
    own = rows.column("own").to_numpy()
    within = rows.column("low").to_numpy() == rows.column("high").to_numpy()
    upto = np.cumsum(later)
    first = 0
    while first < len(row):
        done = upto[first - 1] if first else 0
        last = max(int(np.searchsorted(upto, done + limit, side="right")), first + 1)
        counts = later[first:last]
        i = np.repeat(row[first:last], counts)
        j = np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts) + i + 1
        keep = within[i] | (own[i] != own[j])
        yield i[keep], j[keep]
        first = last


class Forest:
    """Union-find over row numbers, fed with arrays of pairs."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            if not len(i):
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = root[root]
                if np.array_equal(jumped, root):
                    break
                root[:] = jumped

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """A link from every row that is not a root to its root."""
        rows = np.flatnonzero(self.root != np.arange(len(self.root)))
        return rows, self.root[rows]
