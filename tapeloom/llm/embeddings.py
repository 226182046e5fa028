"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

A table of the index quantises several Gaussian projections of the normalised
vector, ``floor((a . v + b) / width)``, into one bucket key. Vectors at cosine
0.95 are at Euclidean distance 0.316; with width 2 one projection puts such a
pair into one cell with probability 0.874, fourteen do with 0.151, and one of
24 tables does with 0.98 (0.998 at cosine 0.97). Orthogonal vectors share a
bucket of a table with probability 4e-5, so ``projections`` should grow with
the logarithm of the table. The candidates of a bucket are checked by their
cosine in double precision; a pair that meets in several tables counts in the
first of them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.blocks import BLOCK, Forest, block_groups, group_pairs, whole_groups
from tapeloom.llm.common import shipped
from tapeloom.llm.components import components
from tapeloom.llm.text import mix64
from tapeloom.plans.staging import stage

TABLES = 24
PROJECTIONS = 14
WIDTH = 2.0
SEED = 20
# numbers compared at once: bounds the memory of a slice whatever the dimension
SLICE_NUMBERS = 1 << 22


def _usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(
        vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def bucket_keys(vectors: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """One key per row and table; keys of different tables or dimensions differ."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    dimension = vectors.shape[1]
    random = np.random.default_rng([SEED, dimension])
    a = random.standard_normal((dimension, tables * projections))
    b = random.uniform(0, width, tables * projections)
    cells = np.floor((unit @ a + b) / width).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(vectors), tables, projections)
    key = mix64(np.arange(tables, dtype=np.uint64) + np.uint64(dimension << 20))[None, :].repeat(len(vectors), 0)
    for k in range(projections):
        key = mix64((key ^ cells[:, :, k]) * np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _by_dimension(column: pa.Array) -> Iterator[np.ndarray]:
    sizes = np.asarray(column.value_lengths())
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def _keys(tables: int, projections: int, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            for rows in _by_dimension(vectors):
                keys = bucket_keys(_matrix(vectors.take(pa.array(rows))), tables, projections, width)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32)), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), lists], ["id", "keys"])

    return run


def _linked(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            # buckets hold one dimension each, a partition may hold several
            for rows in _by_dimension(table.column("vector").combine_chunks()):
                part = table.take(pa.array(rows))
                vectors = _matrix(part.column("vector"))
                norms = np.linalg.norm(vectors, axis=1)
                keys = part.column("keys").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
                here = np.argmax(keys == part.column("list").to_numpy()[:, None], axis=1)
                copies = part.column("copies").to_numpy()
                links = np.zeros(len(rows), dtype=np.int64)
                forest = Forest(len(rows))
                for i, j in group_pairs(part, max(SLICE_NUMBERS // vectors.shape[1], 1)):
                    near = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= threshold * norms[i] * norms[j]
                    i, j = i[near], j[near]
                    first = np.argmax(keys[i] == keys[j], axis=1) == here[i]
                    i, j = i[first], j[first]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    forest.link(i, j)
                found = np.flatnonzero(links)
                if len(found):
                    ids = part.column("id").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[found]), pa.array(ids[forest.root[found]]), pa.array(links[found])],
                        ["src", "dst", "links"],
                    )

    return run


@shipped
def vector_groups(
    vectors: DataFrame,
    threshold: float = 0.95,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors(vec_id, embedding)``.

    Equal vectors are collapsed first and only their class representative is
    indexed: copies link with each other and share the links of the class, without
    ever forming pairs. Null, zero and non-finite vectors link with nothing, nor do
    vectors of different dimensions. Rows that repeat an id are rows of their own;
    a null id never names a component of others and is never kept. Other columns
    are not read; an empty table gives no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        # adding zero makes both zeros one value
        F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
    )
    usable = rows.where(_usable(F.col("vector"))).withColumn("hash", F.xxhash64("vector"))
    classes = stage(
        usable.groupBy("hash", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    keys = stage(classes.select("id", "vector").mapInArrow(_keys(tables, projections, width), "id long, keys array<long>"))
    entries = keys.select(F.explode("keys").alias("list"), "id")
    payload = classes.select("id", "vector", "copies").join(keys, "id")
    found = stage(
        block_groups(entries, block, payload)
        .select("list", "low", "high", "own", "id", "vector", "copies", "keys")
        .mapInArrow(_linked(threshold), "src long, dst long, links long")
    )
    links = found.groupBy(F.col("src").alias("id")).agg(F.sum("links").alias("others"))
    member = components(found.select("src", "dst")).withColumnRenamed("node", "id")
    known = classes.join(links, "id", "left").join(member, "id", "left").select(
        "hash", "vector", "copies", "least", "others", F.coalesce("component", "id").alias("component")
    )
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select(
        "hash", "vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = usable.join(known, ["hash", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~_usable(F.col("vector"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
