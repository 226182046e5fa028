"""How the term use of each source differs from the other sources of its language.

**Counts.** Terms are counted per (lang, source) inside the tasks that read the texts, a few megabytes of text
at a time, and summed by one shuffle with map-side combination. A language keeps the terms of at least
``min_docs`` of its documents; they are its columns, the commonest first, and its sources are its rows.

**Quadtree.** The matrix of a language is cut into tiles of ``k ** levels`` rows and columns. The cells of a
tile form a k-squared tree: every level has one bit for each of the k*k quadrants of the quadrants that are
not empty, and the last level holds k*k prices. The rows of two tiles are compared by walking both
trees at once over the same columns: where both quadrants are empty the walk ends, and the difference there
is the difference of the two prices of an absent term times the columns passed over, added
once per pair at the end. Only quadrants where one side has cells are walked to their leaves.

**Scale.** A task sees one tile (two for a pair of row tiles) at a time and adds up one matrix of differences. The number
of results is the square of a language's sources, by definition; no pairs of documents or terms are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.blocks import whole_groups
from tapeloom.llm.common import shipped
from tapeloom.llm.text import chunks, spans
from tapeloom.plans.ordering import with_position
from tapeloom.plans.staging import stage

SCALE = 1_000_000_000
SMOOTHING = 5
MIN_DOCS = 30
TOP = 50
# texts counted together in a task
COUNT_BYTES = 1 << 22

# letters A-Z, a-z and every byte of a character beyond ASCII
_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_COUNT_TYPE = "lang string, source string, term string, n long, docs long"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), a chunk of texts at a time."""
    for batch in batches:
        langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        wide = max(len(sources.dictionary), 1)
        group = langs.indices.to_numpy().astype(np.int64) * wide + sources.indices.to_numpy()
        for chunk in chunks(batch.column("text"), COUNT_BYTES):
            inside = _TERM[chunk.data]
            starts, ends, owner = spans(chunk, inside)
            if not len(starts):
                continue
            letters = np.ascontiguousarray(chunk.lowered().data[inside])
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
            coded = terms.dictionary_encode()
            size = len(coded.dictionary)
            in_doc, times = np.unique(owner * size + coded.indices.to_numpy(), return_counts=True)
            found, where = np.unique(group[chunk.first + in_doc // size] * size + in_doc % size, return_inverse=True)
            total = np.zeros(len(found), dtype=np.int64)
            np.add.at(total, where, times)
            of = found // size
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(of // wide)),
                    sources.dictionary.take(pa.array(of % wide)),
                    coded.dictionary.take(pa.array(found % size)).cast(pa.string()),
                    pa.array(total),
                    pa.array(np.bincount(where, minlength=len(found)).astype(np.int64)),
                ],
                ["lang", "source", "term", "n", "docs"],
            )


def price(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 5) / (total + 5 * terms))`` in whole numbers."""
    share = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE)
    return F.call_function("div", share, total + SMOOTHING * terms) + 1


class QuadTree:
    """A k-squared tree over cells (row, col, price) of a square of side ``k ** levels``.

    ``bits[l]`` has k*k bits for each nonempty quadrant of level l, ``child[l]`` the number of the quadrant that
    a set bit leads to. Quadrants of the last level are the leaves: k*k prices, 0 where there is no cell.
    """

    def __init__(self, row: np.ndarray, col: np.ndarray, price: np.ndarray, k: int, levels: int):
        self.k, self.levels, square = k, levels, k * k
        digits = np.zeros((levels, len(row)), dtype=np.int64)
        for level in range(levels):
            side = k ** (levels - 1 - level)
            digits[level] = row // side % k * k + col // side % k
        path = np.zeros(len(row), dtype=np.int64)
        parent = np.zeros(len(row), dtype=np.int64)
        quadrants = 1 if len(row) else 0
        self.child: list[np.ndarray] = []
        for level in range(levels - 1):
            bits = np.zeros(quadrants * square, dtype=bool)
            path = parent * square + digits[level]
            bits[path] = True
            child = np.where(bits, np.cumsum(bits) - 1, -1)
            self.child.append(child)
            parent, quadrants = child[path], int(bits.sum())
        self.leaves = np.zeros((quadrants, square), dtype=np.int64)
        self.leaves[parent, digits[-1]] = price
        self.leaves = self.leaves.reshape(-1, k, k)

    @property
    def root(self) -> int:
        return 0 if len(self.leaves) else -1

    def below(self, level: int, quadrant: np.ndarray, i: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Number of child (i, c) of each quadrant, -1 where it is empty."""
        if not len(self.leaves):
            return np.full(len(quadrant), -1)
        found = self.child[level][np.maximum(quadrant, 0) * self.k**2 + i * self.k + c]
        return np.where(quadrant >= 0, found, -1)


def joint_walk(a: QuadTree, b: QuadTree, absent_a: np.ndarray, absent_b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Differences of all rows of ``a`` and ``b`` over the leaves that the walk reaches, and the columns of those.

    ``absent_a`` and ``absent_b`` are the prices of an absent term by row. ``same``: a is b, rows i <= j suffice.
    """
    k, levels = a.k, a.levels
    side = k**levels
    total, seen = np.zeros((side, side), dtype=np.int64), np.zeros((side, side), dtype=np.int64)
    at_a, at_b = np.array([a.root]), np.array([b.root])
    row_a, row_b = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    if a.root < 0 and b.root < 0:
        return total, seen
    i, j, c = (x.ravel() for x in np.meshgrid(range(k), range(k), range(k), indexing="ij"))
    for level in range(levels - 1):
        n = len(at_a)
        many_i, many_j, many_c = np.tile(i, n), np.tile(j, n), np.tile(c, n)
        at_a = a.below(level, np.repeat(at_a, k**3), many_i, many_c)
        at_b = b.below(level, np.repeat(at_b, k**3), many_j, many_c)
        row_a, row_b = np.repeat(row_a, k**3) * k + many_i, np.repeat(row_b, k**3) * k + many_j
        go = (at_a >= 0) | (at_b >= 0)
        if same:
            go &= row_a <= row_b
        at_a, at_b, row_a, row_b = at_a[go], at_b[go], row_a[go], row_b[go]

    def prices(tree: QuadTree, at: np.ndarray, rows: np.ndarray, absent: np.ndarray) -> np.ndarray:
        own = np.broadcast_to(absent[rows][:, :, None], (len(at), k, k))
        if not len(tree.leaves):
            return own
        cells = tree.leaves[np.maximum(at, 0)]
        return np.where((at >= 0)[:, None, None] & (cells > 0), cells, own)

    # a bounded number of leaves at a time
    for low in range(0, len(at_a), 1 << 14):
        part = slice(low, low + (1 << 14))
        rows_a = row_a[part, None] * k + np.arange(k)
        rows_b = row_b[part, None] * k + np.arange(k)
        left, right = prices(a, at_a[part], rows_a, absent_a), prices(b, at_b[part], rows_b, absent_b)
        apart = np.abs(left[:, :, None, :] - right[:, None, :, :]).sum(axis=3)
        np.add.at(total, (rows_a[:, :, None], rows_b[:, None, :]), apart)
        np.add.at(seen, (rows_a[:, :, None], rows_b[:, None, :]), k)
    return total, seen


_TILE = ["base", "low", "high", "cols"]
_PAIR_TYPE = "base long, a int, b int, apart long, seen long"


def _pairs(k: int, levels: int):
    """Tiles in order to differences of row pairs: one row per pair and stretch of tiles of two row tiles."""
    side = k**levels

    def written(name: tuple, total: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        base, low, high = name
        a, b = np.nonzero(seen)
        if low == high:
            a, b = a[a < b], b[a < b]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(a), base)),
                pa.array((low * side + a).astype(np.int32)),
                pa.array((high * side + b).astype(np.int32)),
                pa.array(total[a, b]),
                pa.array(seen[a, b]),
            ],
            ["base", "a", "b", "apart", "seen"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total, seen = None, None, None
        for rows in whole_groups(batches, _TILE):
            fields = {c: rows.column(c).to_numpy() for c in rows.column_names}
            edges = np.flatnonzero(np.any([np.diff(fields[c], prepend=fields[c][0] - 1) != 0 for c in _TILE], axis=0))
            for first, last in zip(edges, [*edges[1:], rows.num_rows]):
                one = {c: v[first:last] for c, v in fields.items()}
                of = tuple(int(one[c][0]) for c in _TILE[:3])
                if of != name:
                    if name is not None:
                        yield written(name, total, seen)
                    name = of
                    total, seen = np.zeros((side, side), dtype=np.int64), np.zeros((side, side), dtype=np.int64)
                sides = []
                for tile in of[1:]:
                    mine = one["row"] // side == tile
                    head, cell = mine & (one["col"] < 0), mine & (one["col"] >= 0)
                    absent = np.zeros(side, dtype=np.int64)
                    absent[one["row"][head] % side] = one["price"][head]
                    tree = QuadTree(one["row"][cell] % side, one["col"][cell], one["price"][cell], k, levels)
                    sides.append((tree, absent))
                more, columns = joint_walk(sides[0][0], sides[1][0], sides[0][1], sides[1][1], of[1] == of[2])
                # rows without a group are no rows
                there = (sides[0][1] > 0)[:, None] & (sides[1][1] > 0)[None, :]
                total += np.where(there, more, 0)
                seen += np.where(there, columns, 0)
        if name is not None:
            yield written(name, total, seen)

    return run


def _in_tiles(rows: DataFrame, side: int) -> DataFrame:
    """``rows(base, row, tiles, cols, col, price)`` once for each row tile that theirs is compared with."""
    own = F.expr(f"row div {side}")
    return (
        rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("low", F.least(own, "other").cast("int"))
        .withColumn("high", F.greatest(own, "other").cast("int"))
        .select("base", "low", "high", "cols", "row", "col", "price")
    )


@shipped
def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, k: int = 4, levels: int = 4
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each source differs inside its language.

    Terms are runs of letters (A-Z in lower case) and characters beyond ASCII; a language keeps those of
    ``min_docs`` documents or more. With p the price of a term (``price``), part ``pair`` gives for every other source the
    sum of ``|p - p'|`` over all kept terms, part ``term`` the ``top`` terms of the source with the
    largest p above the language's own. Ranks count from 1, value descending, then item ascending in UTF-8.

    Null ``text``, ``lang`` and ``source`` read as empty text. Rows that repeat count again; documents without terms still
    make their group occur; a language without kept terms gives value 0. Other columns are not
    read; an empty table gives no rows.
    """
    side = k**levels
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stage(
        read.mapInArrow(_counts, _COUNT_TYPE)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
    kept = stage(with_position(kept.where(F.col("docs") >= min_docs), ["lang", F.desc("docs"), "term"], "place"))
    langs = kept.groupBy("lang").agg(
        F.min("place").alias("start"), F.count(F.lit(1)).alias("terms"), F.sum("all").alias("lang_total")
    )
    kept = kept.join(langs, "lang").select(
        "lang", "term", (F.col("place") - F.col("start")).alias("column"),
        price(F.col("all"), F.col("lang_total"), F.col("terms")).alias("lang_price"),
    )

    held = stage(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = with_position(read.select("lang", "source").distinct(), ["lang", "source"], "place")
    first = groups.groupBy("lang").agg(F.min("place").alias("base"), F.count(F.lit(1)).alias("sources"))
    groups = groups.join(first, "lang").join(langs.select("lang", "terms"), "lang", "left")
    groups = groups.join(totals, ["lang", "source"], "left").select(
        "lang",
        "source",
        "base",
        (F.col("place") - F.col("base")).cast("int").alias("row"),
        F.expr(f"cast((sources + {side - 1}) div {side} as int)").alias("tiles"),
        F.coalesce("terms", F.lit(0)).alias("terms"),
        F.coalesce("total", F.lit(0)).alias("total"),
    )
    # a language without kept terms has no prices
    absent = F.when(F.col("terms") > 0, price(F.lit(0), F.col("total"), F.col("terms")))
    groups = stage(groups.withColumn("absent", absent))

    cells = stage(
        held.join(groups, ["lang", "source"]).withColumn("price", price(F.col("n"), F.col("total"), F.col("terms")))
    )
    heads = groups.where("terms > 0").select(
        "base", "row", "tiles",
        F.explode(F.expr(f"sequence(0, cast((terms - 1) div {side} as int))")).alias("cols"),
        F.lit(-1).alias("col"), F.col("absent").alias("price"),
    )
    body = cells.select(
        "base", "row", "tiles",
        F.expr(f"cast(column div {side} as int)").alias("cols"),
        F.expr(f"cast(column % {side} as int)").alias("col"), "price",
    )
    tiles = _in_tiles(heads.union(body), side).repartition(*_TILE).sortWithinPartitions(*_TILE)
    apart = tiles.mapInArrow(_pairs(k, levels), _PAIR_TYPE).groupBy("base", "a", "b").agg(
        F.sum("apart").alias("apart"), F.sum("seen").alias("seen")
    )

    one = lambda name: groups.select(
        "lang", "base", "terms", F.col("row").alias(name), F.col("source").alias(f"source_{name}"), F.col("absent").alias(f"absent_{name}")
    )
    # the quadrants that no walk has entered
    passed = F.col("terms") - F.coalesce("seen", F.lit(0))
    value = F.coalesce("apart", F.lit(0)) + passed * F.abs(F.col("absent_a") - F.col("absent_b"))
    both = (
        one("a")
        .join(one("b").drop("lang", "terms"), "base")
        .where("a < b")
        .join(apart, ["base", "a", "b"], "left")
        .withColumn("value", F.coalesce(value, F.lit(0)))
    )
    end = lambda x, y: F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item"))
    ends = F.explode(F.array(end("a", "b"), end("b", "a")))
    pairs = both.select("lang", ends.alias("end"), "value").select(
        "lang", "end.source", F.lit("pair").alias("part"), "end.item", "value"
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.withColumn("rank", rank)
    more = cells.where("price > lang_price").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("price") - F.col("lang_price")).alias("value"),
    )
    terms = more.withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.union(terms)
