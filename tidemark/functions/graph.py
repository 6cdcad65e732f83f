"""Connected components by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, ship_package

BLOCK_EDGES = 200_000  # edges that a task contracts at once


def _codes(values: pa.Array) -> np.ndarray:
    """Numbers in the order of the values; equal values share one, nulls come last."""
    found = values.dictionary_encode(null_encoding="encode")
    place = np.empty(len(found.dictionary), dtype=np.int64)
    place[pc.sort_indices(found.dictionary).to_numpy()] = np.arange(len(found.dictionary))
    return place[found.indices.to_numpy(zero_copy_only=False)]


def _least_linked(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of ``n`` numbered nodes that each can reach over the edges ``a, b``."""
    least = np.arange(n)
    while True:
        x, y = least[a], least[b]
        if (x == y).all():
            return least
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least = least[least]


def _contracted(keys: Sequence[str]):
    """Edges of a block as one star for each of the block's components: the same nodes are linked."""

    def stars(block: pa.Table) -> pa.RecordBatch:
        block = block.combine_chunks()
        size = block.num_rows
        group = np.zeros(size, dtype=np.int64)
        for key in keys:
            codes = _codes(block.column(key).combine_chunks())
            group = np.unique(group * (int(codes.max()) + 1) + codes, return_inverse=True)[1]
        ends = pa.chunked_array([*block.column("a").chunks, *block.column("b").chunks]).combine_chunks()
        both = _codes(ends)
        # nodes are numbered group by group, in the order of their values
        _, at, node = np.unique(np.tile(group, 2) * (int(both.max()) + 1) + both, return_index=True, return_inverse=True)
        least = _least_linked(node[:size], node[size:], len(at))
        linked = np.flatnonzero(least != np.arange(len(at)))
        rows = pa.array(at[linked] % size)
        columns = [block.column(key).take(rows).combine_chunks() for key in keys]
        columns += [ends.take(pa.array(at[linked])), ends.take(pa.array(at[least[linked]]))]
        return pa.RecordBatch.from_arrays(columns, names=[*keys, "a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= BLOCK_EDGES:
                yield stars(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield stars(pa.Table.from_batches(held))

    return work


def _settled(edges: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the edges are stars: no node points to two others, or to one that points further."""
    ends = edges.select(*keys, F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(*keys, F.col("b").alias("node"), F.lit(0).alias("up"))
    )
    counted = ends.groupBy(*keys, "node").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
    return counted.filter("up > 1 OR (up = 1 AND low = 0)").isEmpty()


def _large_star(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every node offers its smallest neighbour to its larger neighbours."""
    both = edges.select(*keys, "a", "b").unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(*keys, "a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.join(least, [*keys, "a"])
        .filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
        .select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the smallest of them.  Edges
    point from the larger node ``a`` to the smaller ``b``."""
    least = edges.groupBy(*keys, "a").agg(F.min("b").alias("m"))
    moved = edges.join(least, [*keys, "a"]).filter(F.col("b") != F.col("m")).select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(*keys, "a", F.col("m").alias("b"))).distinct()


def star_components(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``*keys, node, component`` for undirected edges ``*keys, a, b``: the component is the
    smallest node that can be reached.  Only nodes with an edge to another node appear.

    First each task replaces its edges, a block at a time, by one star for each component of the
    block; links that lie together are then settled before anything moves.  Large-star and
    small-star steps (Kiveris and others) alternate until the edges are stars.  Each round at
    least contracts neighbouring minima into one, so the number of rounds grows with the
    logarithm of the longest path, whatever the order of its nodes; there is no cap.  Each round
    is written out, which cuts the lineage.  Minima are taken by aggregates that combine on the
    map side, and the joins bring one row per node to its edges, which a skew join can split.
    Edges with a null end, and loops, are ignored.
    """
    ship_package(edges.sparkSession)
    ends = edges.filter(F.col("a") != F.col("b")).select(*keys, "a", "b")
    current = materialize(ends.mapInArrow(_contracted(keys), ends.schema).distinct(), "edges")
    while not _settled(current, keys):
        current = materialize(_small_star(_large_star(current, keys), keys), "edges")
    return current.select(*keys, F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(*keys, F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
