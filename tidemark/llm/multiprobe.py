"""Nearest neighbours by multiprobe p-stable hashing.

The measure is the inner product.  With one more component, ``sqrt(M**2 - |x|**2)`` for the
indexed vectors (``M``: the largest norm) and 0 for the queries, the nearest vectors by distance
are those with the largest inner products, whatever their norms.  A table hashes a vector to the
cell ``floor((a . x + b) / w)`` of ``K`` Gaussian projections.  A query visits its own cell and
those cells one step away, in the order of their estimated success: the squared distances from
the query's projections to the borders that have to be crossed, smallest sum first.  How
many cells are visited is fitted on a bounded sample of the vectors, whose neighbours are farther
apart than those among all vectors.  The sample's best vectors for a query are its first
candidates: what scores below all of them cannot be among the nearest and goes no further.  The candidates of all tables are merged and ranked by their
exact inner products.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, ship_package

TABLES, PROJECTIONS, WIDTH = 3, 6, 2.5
RECALL = 0.95  # share of the neighbours within a sample that the number of probes has to reach
SAMPLE, SAMPLE_QUERIES = 4_096, 256  # vectors and queries of the sample, expected and at most
CELLS = 1 << 16  # cells are folded into so many for each table, which bounds their statistics
VECTORS, QUERIES = 4_096, 1_024  # rows of a block of candidates and of queries, expected
HELD = 1 << 18  # candidates that a task holds before it keeps the best of each query
SEED = 11


def _steps(projections: int) -> np.ndarray:
    return np.array(list(product((-1, 0, 1), repeat=projections)), dtype=np.int64)


def _matrix(column) -> np.ndarray:
    """Rows of equal length as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class Hashes:
    """The hash functions for vectors of ``size`` components; equal in every task."""

    def __init__(self, size: int, norm: float, tables: int, projections: int, width: float, probes: int | None = None):
        rng = np.random.default_rng([SEED, size])
        self.a = rng.normal(size=(tables, projections, size + 1))
        self.b = rng.random(size=(tables, projections))
        self.norm, self.width, self.size = norm, width * norm, size
        self.mix = rng.integers(1, 1 << 62, size=projections, dtype=np.int64) | 1
        self.steps = _steps(projections)
        self.probes = min(probes or len(self.steps), len(self.steps))

    def _fold(self, cell: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (cell * self.mix).sum(axis=-1)
        return (mixed >> 20) & (CELLS - 1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector in each table."""
        rest = np.sqrt(np.maximum(0.0, self.norm**2 - (x * x).sum(axis=1)))
        own = np.column_stack((x, rest))
        return np.stack(
            [self._fold(np.floor(own @ a.T / self.width + b).astype(np.int64)) for a, b in zip(self.a, self.b)], axis=1
        )

    def probed(self, q: np.ndarray) -> np.ndarray:
        """The cells that each query visits, by table and order of estimated success."""
        out = np.empty((len(q), len(self.a), self.probes), dtype=np.int64)
        for t, (a, b) in enumerate(zip(self.a, self.b)):
            at = q @ a[:, : self.size].T / self.width + b
            cell = np.floor(at).astype(np.int64)
            down = at - cell
            # squared distance to the border below and above, for every projection
            cost = np.stack((down**2, np.zeros_like(down), (1 - down) ** 2), axis=2)
            total = sum(cost[:, k, self.steps[:, k] + 1] for k in range(cell.shape[1]))
            first = np.argsort(total, axis=1, kind="stable")[:, : self.probes]
            out[:, t] = self._fold(cell[:, None, :] + self.steps[first])
        return out


def fit_probes(x: np.ndarray, hashes: Hashes, k: int, recall: float) -> int:
    """The number of probes that reaches ``recall`` among the vectors ``x`` alone, or all."""
    q = x[:SAMPLE_QUERIES]
    k = min(k, len(x) - 1)
    if k < 1:
        return hashes.probes
    near = q @ x.T
    np.fill_diagonal(near, -np.inf)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    cells = hashes.cells(x)
    needed = np.full(best.shape, len(hashes.steps))
    for s in range(0, len(q), 64):
        part = slice(s, s + 64)
        order = hashes.probed(q[part])
        for t in range(order.shape[1]):
            for i, row in enumerate(order[:, t], start=s):
                first = {c: n for n, c in reversed(list(enumerate(row.tolist())))}
                at = [first.get(c, len(hashes.steps)) for c in cells[best[i], t].tolist()]
                needed[i] = np.minimum(needed[i], at)
    ranked = np.sort(needed.ravel())
    return min(len(hashes.steps), int(ranked[int(np.ceil(recall * len(ranked))) - 1]) + 1)


def _first_candidates(ids: np.ndarray, x: np.ndarray, asked: np.ndarray, q: np.ndarray, k: int) -> list[list]:
    """For each query the ``k`` best vectors of the sample, as ids and exact scores."""
    out: list[list] = [[] for _ in asked]
    if not len(ids):
        return out
    place = {int(a): i for i, a in enumerate(asked.tolist())}
    for a, v, s in zip(*_best(*_block(ids, x, asked, q, np.full(len(q), -np.inf), k), k)):
        out[place[int(a)]].append({"vec_id": int(v), "score": float(s)})
    return out


def _placing(norms: dict[int, float], visited: dict[int, int], samples, k: int, settings: tuple):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Hashes] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.nonzero(sizes == size)[0]))
                if size not in known:
                    known[size] = Hashes(size, norms[size], *settings, visited[size])
                x, asks = _matrix(part.column("vector")), part.column("asks").to_numpy(zero_copy_only=False)
                cells = known[size].cells(x)
                probes: list = [None] * len(x)
                best: list = [None] * len(x)
                rows = np.nonzero(asks)[0]
                ids = part.column("vec_id").to_numpy()
                for s in range(0, len(rows), 256):
                    some = rows[s : s + 256]
                    for r, p in zip(some.tolist(), known[size].probed(x[some])):
                        # a folded cell may come up twice: it is visited once
                        probes[r] = [list(dict.fromkeys(t.tolist())) for t in p]
                    # a repeated id has one set of first candidates
                    single = some[np.unique(ids[some], return_index=True)[1]]
                    found = dict(zip(ids[single].tolist(), _first_candidates(*samples.value[size], ids[single], x[single], k)))
                    for r in some.tolist():
                        best[r] = found[int(ids[r])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        part.column("size"),
                        part.column("vector"),
                        pa.array(cells.tolist(), pa.list_(pa.int64())),
                        pa.array(probes, pa.list_(pa.list_(pa.int64()))),
                        pa.array(best, pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())]))),
                    ],
                    names=["vec_id", "size", "vector", "cells", "probes", "best"],
                )

    return work


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best distinct candidates of each query."""
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    # equal pairs have equal scores, so they stand together
    fresh = np.ones(len(query), dtype=bool)
    fresh[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    query, vec, score = query[fresh], vec[fresh], score[fresh]
    new = np.ones(len(query), dtype=bool)
    new[1:] = query[1:] != query[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(query)), 0))
    keep = np.arange(len(query)) - first < k
    return query[keep], vec[keep], score[keep]


def _block(
    ids: np.ndarray, x: np.ndarray, asked: np.ndarray, q: np.ndarray, least: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    """Candidates that may be among the ``k`` best of the queries, with exact scores.  ``least``
    is the score that ``k`` vectors are known to reach."""
    rough = q @ x.T
    border = least
    distinct, first, times = np.unique(ids, return_index=True, return_counts=True)
    if len(distinct) > k + 1:
        # different ids alone count: the best row of each, the query itself may be one of them
        top = rough[:, first]
        if len(distinct) < len(ids):
            # only ids that repeat have more than the one score
            order = np.argsort(ids, kind="stable")
            starts = np.cumsum(times) - times
            for at in np.nonzero(times > 1)[0].tolist():
                top[:, at] = rough[:, order[starts[at] : starts[at] + times[at]]].max(axis=1)
        border = np.maximum(border, np.partition(top, len(distinct) - k - 1, axis=1)[:, len(distinct) - k - 1])
    # the margin covers the order of summation
    margin = 1e-9 * np.maximum(1.0, np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max())
    row, at = np.nonzero(rough >= (border - margin)[:, None])
    other = asked[row] != ids[at]
    row, at = row[other], at[other]
    score = np.empty(len(row))
    for s in range(0, len(row), 1 << 16):
        p = slice(s, s + (1 << 16))
        # a product and a sum for each pair alone: equal vectors get equal scores in any block
        score[p] = (q[row[p]] * x[at[p]]).sum(axis=1)
    return asked[row], ids[at], score


def _ranking(k: int):
    """Rows of blocks, candidates before queries -> the best candidates found in the task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, asked, q, least = None, [], [], [], [], []
        held: list[tuple[np.ndarray, ...]] = []
        n_held = n_asked = 0

        def ask() -> None:
            nonlocal asked, q, least, n_asked, n_held, held
            if n_asked and ids:
                found = _block(*(np.concatenate(part) for part in (ids, rows, asked, q, least)), k)
                held.append(found)
                n_held += len(found[0])
                if n_held >= HELD:
                    held = [_best(*(np.concatenate(c) for c in zip(*held)), k)]
                    n_held = len(held[0][0])
            asked, q, least, n_asked = [], [], [], 0

        def packed() -> pa.RecordBatch:
            a, v, s = _best(*(np.concatenate(c) for c in zip(*held)), k)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            block = np.column_stack([batch.column(c).to_numpy() for c in ("size", "t", "cell", "vs", "qs")])
            kind, vec = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool), batch.column("vec_id").to_numpy()
            change = np.nonzero((np.diff(block, axis=0) != 0).any(axis=1) | (np.diff(kind.astype(np.int8)) != 0))[0] + 1
            for a, z in zip([0, *change.tolist()], [*change.tolist(), len(vec)]):
                if a == z:
                    continue
                now = tuple(block[a].tolist())
                if now != key:
                    ask()
                    key, ids, rows = now, [], []
                    if n_held >= HELD // 2:
                        # what is best so far still fills the task's share: hand it on
                        yield packed()
                        held, n_held = [], 0
                x = _matrix(batch.column("vector").slice(a, z - a))
                if kind[a]:
                    asked.append(vec[a:z])
                    q.append(x)
                    least.append(batch.column("least").to_numpy(zero_copy_only=False)[a:z])
                    n_asked += z - a
                    if n_asked >= 512:
                        ask()
                else:
                    ids.append(vec[a:z])
                    rows.append(x)
        ask()
        if held:
            yield packed()

    return work


def nearest(
    vectors: DataFrame,
    asks: Column,
    k: int = 20,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    probes: int | None = None,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``asks``, the ``k`` nearest found of
    all other rows, by inner product in double precision, ties to the smaller id.

    ``probes`` cells are visited in each table; if not given, as many as reach ``recall`` on a
    sample of about ``SAMPLE`` vectors.  Every row is indexed.  Cells that hold many vectors or get many queries are cut into blocks
    by a hash of the ids, so a task meets blocks of bounded size, and a cell's statistics, of
    which there are ``tables * CELLS`` at most, are all that is broadcast.

    Vectors that are null, empty or zero, or hold a null or a non-finite component, and rows
    without an id, take no part.  Vectors of different lengths are not compared.  Equal vectors
    are ranked by id.  Repeated ids are one candidate if their vectors are equal; of different
    vectors under one id the better is reported.  A query with fewer than ``k`` candidates in
    reach gets those; an empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), asks.alias("asks")
    ).filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", odd))
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    rows = rows.withColumns({"size": F.size("vector"), "square": square}).filter("square > 0")
    # equal rows are one candidate and one query; the aggregate combines them on the map side
    rows = rows.groupBy("vec_id", "vector", "size", "square").agg(F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    rows = materialize(rows, "vectors")
    # one row for each length of vectors
    sizes = rows.groupBy("size").agg(F.max("square").alias("most"), F.count(F.lit(1)).alias("n")).collect()
    norms, visited, samples = {}, {}, {}
    place = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    for r in sizes:
        norms[r["size"]] = float(np.sqrt(r["most"]))
        visited[r["size"]] = probes
        sample = rows.filter((F.col("size") == r["size"]) & (place < F.lit(SAMPLE / r["n"]))).select("vec_id", "vector")
        # one vector for each id, so that ``k`` of them are ``k`` candidates
        held = sorted({x["vec_id"]: x["vector"] for x in sample.collect()}.items())
        ids = np.array([i for i, _ in held], dtype=np.int64)
        x = np.array([v for _, v in held], dtype=np.float64).reshape(len(held), r["size"])
        samples[r["size"]] = (ids, x)
        if probes is None:
            hashes = Hashes(r["size"], norms[r["size"]], tables, projections, width)
            visited[r["size"]] = fit_probes(np.random.default_rng(SEED).permutation(x), hashes, k, recall)
    kind = vectors.schema[vector_col].dataType.simpleString()
    placed = materialize(
        rows.select("vec_id", "size", "vector", F.coalesce("asks", F.lit(False)).alias("asks")).mapInArrow(
            _placing(norms, visited, spark.sparkContext.broadcast(samples), k, (tables, projections, width)),
            f"""vec_id long, size int, vector {kind}, cells array<long>, probes array<array<long>>,
            best array<struct<vec_id:long,score:double>>""",
        ),
        "cells",
    )
    index = placed.select("vec_id", "size", "vector", F.posexplode("cells").alias("t", "cell"))
    asking = placed.filter("probes IS NOT NULL")
    # with fewer first candidates than ``k`` nothing can be left out
    known = F.when(F.size("best") >= k, F.element_at("best", k)["score"]).otherwise(F.lit(float("-inf")))
    by_table = asking.select("vec_id", "size", "vector", known.alias("least"), F.posexplode("probes").alias("t", "visits"))
    visits = by_table.select("vec_id", "size", "vector", "least", "t", F.explode("visits").alias("cell"))
    held = index.groupBy("size", "t", "cell").agg(F.ceil(F.count(F.lit(1)) / VECTORS).cast("int").alias("n_vs"))
    wanted = visits.groupBy("size", "t", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("n_qs"))
    # at most tables * CELLS rows of five numbers for each length; cells nobody visits are left out
    cuts = F.broadcast(materialize(held.join(wanted, ["size", "t", "cell"]), "cell-cuts"))
    # the vector spreads the rows of an id that still repeats
    piece = lambda n, salt: F.pmod(F.xxhash64("vec_id", "vector", F.lit(salt)), F.col(n)).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    order = ["size", "t", "cell", "vs", "qs"]
    columns = [*order, "asks", "vec_id", "vector", "least"]
    candidates = (
        index.join(cuts, ["size", "t", "cell"])
        .withColumns({"vs": piece("n_vs", "v"), "asks": F.lit(False), "least": F.lit(None).cast("double")})
        .withColumn("qs", other("n_qs"))
        .select(*columns)
    )
    queries = (
        visits.join(cuts, ["size", "t", "cell"])
        .withColumns({"qs": piece("n_qs", "q"), "asks": F.lit(True)})
        .withColumn("vs", other("n_vs"))
        .select(*columns)
    )
    blocks = candidates.unionByName(queries).repartition(*[F.col(c) for c in order]).sortWithinPartitions(*order, "asks", "vec_id")
    found = blocks.mapInArrow(_ranking(k), "query_id long, vec_id long, score double").unionByName(
        asking.select(F.col("vec_id").alias("query_id"), F.explode("best").alias("first")).select("query_id", "first.*")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
