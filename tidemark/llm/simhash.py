"""Near-duplicates by SimHash, linked through a Gray-order hierarchical index.

The upper nodes of the index are masked bit patterns: the 64 bits are cut into blocks, and
every choice of all but ``limit`` blocks is a mask.  Fingerprints within ``limit`` bits agree in
at least one mask's bits, so they meet below at least one upper node.  Below it the fingerprints
are sorted by Gray rank across the cluster and cut into nodes of bounded size; pairs of nodes
are pruned by their shared patterns before any fingerprint is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.graph import star_components
from tidemark.llm.common import unused
from tidemark.llm.gray_index import Forest, forest_between, forest_within
from tidemark.session import materialize, ship_package

NODE = 4096  # fingerprints of a node at most
SMALL = 48  # groups up to this size are compared without a tree
FLUSH = 1 << 17  # rows a task gathers before it looks at their groups
BIT_ROWS = 1 << 15


def fingerprint_of(text: str | None, width: int = 4, seed: int = 42) -> int:
    """SimHash over the shingles of a text, as an unsigned number.  No words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    # bytes.lower() changes A-Z alone, and bytes.split() cuts at the six white-space characters
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist())],
            dtype=np.uint64,
        )
    ones = np.zeros(64, dtype=np.int64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for s in range(0, len(octets), BIT_ROWS):
        ones += np.unpackbits(octets[s : s + BIT_ROWS], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, width: int = 4, seed: int = 42) -> Column:
    """The fingerprint as a long; the highest bit is the sign."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint_of(t, width, seed) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(values.view(np.int64))

    return hashed(text)


def _gray_rank(value: Column) -> Column:
    """The place of a pattern in the Gray code, as a long in signed order."""
    rank = value
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def masks_for(n: int, limit: int, target: int = 256) -> list[int]:
    """Masks of all but ``limit`` of equal blocks, with as few blocks as keep the mean group
    under ``target`` of ``n`` fingerprints.  Any number of blocks is exact."""
    blocks = limit + 1
    while blocks < limit + 5 and n / 2 ** (64 * (blocks - limit) / blocks) > target:
        blocks += 1
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    return [sum(kept) for kept in combinations(parts, blocks - limit)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _longs(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


OUT = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("mask", pa.int32()), ("key", pa.int64()), ("node", pa.int64())]
    + [("shared", pa.int64()), ("pattern", pa.int64()), ("members", pa.binary())]
)


def _edges(values: np.ndarray, child: np.ndarray, parent: np.ndarray) -> pa.RecordBatch:
    n = len(child)
    nothing = [pa.nulls(n, f.type) for f in list(OUT)[2:]]
    return pa.RecordBatch.from_arrays(
        [pa.array(values[child].view(np.int64)), pa.array(values[parent].view(np.int64)), *nothing], schema=OUT
    )


def _nodes(mask: int, key: int, first: int, runs: list[np.ndarray]) -> pa.RecordBatch:
    every = [np.bitwise_and.reduce(r) for r in runs]
    shared = [~(e ^ np.bitwise_or.reduce(r)) for e, r in zip(every, runs)]
    n = len(runs)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.int64()),
            pa.array([mask] * n, pa.int32()),
            pa.array([key] * n, pa.int64()),
            pa.array([first + i for i in range(n)], pa.int64()),
            pa.array(np.array(shared, dtype=np.uint64).view(np.int64)),
            pa.array(np.array(every, dtype=np.uint64).view(np.int64)),
            pa.array([r.tobytes() for r in runs], pa.binary()),
        ],
        schema=OUT,
    )


def _link_groups(limit: int):
    """Rows ``mask, key, value`` sorted by mask, key and Gray rank -> edges inside nodes, and
    the nodes of groups that have several nodes or touch an end of the partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        held = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)]
        first = True

        def cut(arrays, final):
            """Handles all complete groups; the last group stays unless it fills a node."""
            nonlocal first, serial
            masks, keys, values = arrays
            new = np.nonzero((np.diff(masks) != 0) | (np.diff(keys) != 0))[0] + 1
            bounds = np.concatenate(([0], new, [len(values)]))
            ready = len(bounds) - 1 if final else len(bounds) - 2
            end = bounds[ready]
            sizes = np.diff(bounds[: ready + 1])
            out = []
            open_ends = ({0} if first else set()) | ({ready - 1} if final else set())
            group = np.repeat(np.arange(ready), sizes)
            plain = sizes <= SMALL
            if end:
                forest = Forest(end)
                rows = plain[group]
                for o in range(1, int(sizes[plain].max(initial=0))):
                    both = (group[o:] == group[:-o]) & rows[o:]
                    i = np.nonzero(both)[0]
                    i = i[np.bitwise_count(values[i] ^ values[i + o]) <= limit]
                    if len(i):
                        forest.merge(i, i + o)
                child, parent = forest.edges()
                if len(child):
                    out.append(_edges(values, child, parent))
            for g in sorted(set(np.nonzero(~plain)[0].tolist()) | {x for x in open_ends if 0 <= x < ready}):
                members = values[bounds[g] : bounds[g + 1]]
                runs = [members[s : s + NODE] for s in range(0, len(members), NODE)]
                if len(members) > SMALL:
                    for run in runs:
                        child, parent = forest_within(run, limit)
                        if len(child):
                            out.append(_edges(run, child, parent))
                if len(runs) > 1 or g in open_ends:
                    out.append(_nodes(int(masks[bounds[g]]), int(keys[bounds[g]]), serial, runs))
                    serial += len(runs)
            if ready > 0:
                first = False
            return out, [x[end:] for x in arrays]

        for batch in batches:
            held[0] = np.concatenate((held[0], batch.column(0).to_numpy(zero_copy_only=False)))
            held[1] = np.concatenate((held[1], batch.column(1).to_numpy(zero_copy_only=False)))
            held[2] = np.concatenate((held[2], _longs(batch.column(2))))
            if len(held[2]) >= FLUSH:
                out, held = cut(held, False)
                yield from out
                if len(held[2]) >= FLUSH:
                    # one group fills the buffer: hand it out as nodes and go on with the rest
                    members = held[2][: len(held[2]) // NODE * NODE]
                    runs = [members[s : s + NODE] for s in range(0, len(members), NODE)]
                    for run in runs:
                        child, parent = forest_within(run, limit)
                        if len(child):
                            yield _edges(run, child, parent)
                    yield _nodes(int(held[0][0]), int(held[1][0]), serial, runs)
                    serial += len(runs)
                    held = [x[len(members) :] for x in held]
                    first = True  # what follows of this group is part of it
        if len(held[2]):
            out, _ = cut(held, True)
            yield from out

    return work


def _link_nodes(limit: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                first = np.frombuffer(x.as_py(), dtype=np.uint64)
                second = np.frombuffer(y.as_py(), dtype=np.uint64)
                child, parent = forest_between(first, second, limit)
                if len(child):
                    values = np.concatenate((first, second)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(values[child]), pa.array(values[parent])], names=["a", "b"])

    return work


def fingerprint_links(values: DataFrame, limit: int = 4, rows_per_task: int = 100_000) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints ``value`` that connect exactly those
    within ``limit`` bits: a spanning forest for each node and pair of nodes, not all pairs."""
    ship_package(values.sparkSession)
    values = materialize(values.select("value").distinct(), "values")
    n = values.count()
    masks = masks_for(n, limit)
    routed = values.select(
        F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask", "bits"), "value"
    ).select("mask", F.col("value").bitwiseAND(F.col("bits")).alias("key"), "value", _gray_rank(F.col("value")).alias("rank"))
    spark = values.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * len(masks) // rows_per_task))
    sorted_ = routed.repartitionByRange(parts, "mask", "key", "rank").sortWithinPartitions("mask", "key", "rank")
    found = materialize(
        sorted_.select("mask", "key", "value").mapInArrow(
            _link_groups(limit),
            "a long, b long, mask int, key long, node long, shared long, pattern long, members binary",
        ),
        "links",
    )
    heads = found.filter("node IS NOT NULL").select("mask", "key", "node", "shared", "pattern")
    left = heads.select("mask", "key", F.col("node").alias("x"), F.col("shared").alias("sx"), F.col("pattern").alias("px"))
    right = heads.select("mask", "key", F.col("node").alias("y"), F.col("shared").alias("sy"), F.col("pattern").alias("py"))
    differ = F.col("px").bitwiseXOR(F.col("py")).bitwiseAND(F.col("sx")).bitwiseAND(F.col("sy"))
    near = left.join(right, ["mask", "key"]).filter((F.col("x") < F.col("y")) & (F.bit_count(differ) <= limit))
    members = found.filter("node IS NOT NULL").select("node", "members")
    pairs = (
        near.select("x", "y")
        .join(members.toDF("x", "mx"), "x")
        .join(members.toDF("y", "my"), "y")
        .select("mx", "my")
    )
    across = pairs.mapInArrow(_link_nodes(limit), "a long, b long")
    return found.filter("a IS NOT NULL").select("a", "b").unionByName(across)


def near_duplicates(
    docs: DataFrame, limit: int = 4, width: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document.

    Words are lower-cased (A-Z) runs between ASCII white space; shingles are ``width`` words
    joined by a space, with repeats; a bit is set if more than half of the shingle hashes (XXH64
    with ``seed``) have it.  Documents whose fingerprints differ in at most ``limit`` bits are
    linked, and the smallest id that can be reached names the component.

    A null, empty or blank text has fingerprint 0 and is linked like any other; a text of fewer
    words is one shingle.  Equal fingerprints are one node, however many copies there are.
    Repeated rows come back as often.  A document without an id joins no group: its component
    is null.  An empty table gives no rows.  Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    rows = materialize(
        docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), width, seed).alias("value")), "simhash"
    )
    named = rows.filter("doc_id IS NOT NULL")
    classes = materialize(named.groupBy("value").agg(F.min("doc_id").alias("least")), "simhash-classes")
    labels = star_components(fingerprint_links(classes, limit))
    linked = labels.withColumnRenamed("node", "value").join(classes, "value")
    components = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    of_value = linked.select("value", "component").join(components, "component").select("value", "component_id")
    # written out, so that the join below deals both sides itself and can split a frequent value
    named_by = materialize(
        classes.join(of_value, "value", "left").select("value", F.coalesce("component_id", "least").alias("component_id")),
        "simhash-names",
    )
    return rows.join(named_by, "value", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("value")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def representatives(
    docs: DataFrame, limit: int = 4, width: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Documents without an id belong to no group and stay.  Of rows that repeat an id one stays;
    only those rows are compared, on the id alone.
    """
    groups = near_duplicates(docs, limit, width, seed, id_col, text_col)
    named, times = unused(docs, "id", "times")
    first = materialize(
        groups.filter(F.col("doc_id") == F.col("component_id"))
        .groupBy(F.col("doc_id").alias(named))
        .agg(F.count(F.lit(1)).alias(times)),
        "representatives",
    )
    same = F.col(id_col) == F.col(named)
    # the list of ids grows with the documents: it is dealt with them, never broadcast
    once = first.filter(F.col(times) == 1).hint("merge")
    kept = docs.join(once, same, "left_semi").unionByName(docs.filter(F.col(id_col).isNull()))
    repeated = first.filter(F.col(times) > 1)
    if repeated.isEmpty():
        return kept
    return kept.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates([id_col]))
