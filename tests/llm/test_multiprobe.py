import numpy as np
import pytest
from helpers import SF, read
from pyspark.sql import functions as F

from tidemark.llm import multiprobe

SCHEMA = "vec_id long, embedding array<double>, size int, cells string, vs int"


def exact(ids, x, k=20, mod=20):
    best = {}
    for i in np.nonzero(ids % mod == 0)[0]:
        s = x @ x[i]
        order = sorted((-round(s[j], 12), ids[j], j) for j in range(len(ids)) if ids[j] != ids[i])[:k]
        best[int(ids[i])] = [(int(v), float(s[j])) for _, v, j in order]
    return best


def recall(got, want):
    return np.mean([len({v for v, _ in want[q]} & {r.vec_id for r in got if r.query_id == q}) / max(1, len(want[q])) for q in want])


def check(got, ids, x):
    """Ranks, order and scores are right for what was found."""
    at = {int(i): x[j] for j, i in enumerate(ids)}
    by_query: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r)
    for q, rows in by_query.items():
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
        assert all(r.vec_id != q and r.score == pytest.approx(float(at[q] @ at[r.vec_id]), abs=1e-12) for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)


def test_embeddings(spark):
    table = read("embeddings").sort_values("vec_id")
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding).astype(np.float64)
    got = multiprobe.nearest(spark.read.parquet(f"{SF}/embeddings.parquet"), F.pmod("vec_id", F.lit(20)) == 0).collect()
    check(got, ids, x)
    want = exact(ids, x)
    assert recall(got, want) >= 0.9
    assert len(got) == 20 * len(want)


def test_all_probes_are_exact(spark, monkeypatch):
    """Norms differ, a third of the vectors are equal, and blocks are small."""
    monkeypatch.setattr(multiprobe, "VECTORS", 16)
    monkeypatch.setattr(multiprobe, "QUERIES", 4)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) * rng.uniform(0.1, 5, size=(300, 1))
    x[100:200] = x[100]
    ids = rng.permutation(300)
    rows = [(int(i), v.tolist(), 1, "x", 2) for i, v in zip(ids, x)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = multiprobe.nearest(df, F.pmod("vec_id", F.lit(20)) == 0, tables=2, projections=2, width=50.0, probes=9).collect()
    check(got, ids, x)
    want = exact(ids, x)
    for q, best in want.items():
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [v for v, _ in best]


def test_cells_are_visited_in_order_of_success():
    hashes = multiprobe.Hashes(8, 2.0, 3, 4, 2.5, 81)
    q = np.random.default_rng(0).normal(size=(5, 8))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    first = hashes.probed(q)[:, :, 0]
    for t in range(3):
        own = np.floor(q @ hashes.a[t][:, :8].T / hashes.width + hashes.b[t]).astype(np.int64)
        assert (first[:, t] == hashes._fold(own)).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (None, [1.0, 1.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]), (20, [1.0, 1.0, 1.0]), (21, [1.0, 0.0, 0.0]),
        (40, [1.0, 0.0]), (40, [1.0, 0.0]), (60, None),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = multiprobe.nearest(df, F.pmod("vec_id", F.lit(20)) == 0, width=50.0).collect()
    found = {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 20, 40, 60)}
    assert found[0] == [(8, 2.0), (9, 2.0), (40, 1.0), (1, 0.5)]
    assert found[40] == [(8, 2.0), (9, 2.0), (0, 1.0), (1, 0.5)]
    assert found[20] == [(21, 1.0)] and found[60] == []
    assert multiprobe.nearest(df.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize("equal", [True, False])
def test_an_id_stored_many_times_is_one_candidate(spark, monkeypatch, equal):
    """A high-scoring id is stored 60 times; the sample is smaller than the table."""
    monkeypatch.setattr(multiprobe, "SAMPLE", 10)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    hot = [20.0 * sum(x[q] for q in (20, 40, 60)) / 3 * (1 if equal else 1 - j / 1000) for j in range(60)]
    rows += [(1000, v.tolist()) for v in hot] + [(20, x[20].tolist())] * 3
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = multiprobe.nearest(df, F.pmod("vec_id", F.lit(20)) == 0, tables=2, projections=2, width=50.0, probes=9).collect()
    for q in range(0, 300, 20):
        scores = {i: float(x[i] @ x[q]) for i in range(300) if i != q}
        scores[1000] = max(float(v @ x[q]) for v in hot)
        want = sorted(scores, key=lambda i: (-scores[i], i))[:20]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want
