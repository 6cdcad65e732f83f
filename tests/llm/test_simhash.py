from collections import defaultdict

import numpy as np
import pytest
import xxhash
from helpers import ODD, SF, documents, read
from pyspark.sql import functions as F

from tidemark.functions.graph import star_components
from tidemark.llm import gray_index, simhash


def plain_fingerprint(text) -> int:
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, values, limit=4) -> dict:
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    distinct = sorted(label)
    array = np.array(distinct, dtype=np.uint64)
    for i, v in enumerate(distinct):
        for j in np.nonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= limit)[0]:
            label[root(distinct[i + 1 + j])] = root(v)
    least = defaultdict(lambda: 1 << 70)
    for i, v in zip(ids, values):
        least[root(v)] = min(least[root(v)], i)
    return {i: least[root(v)] for i, v in zip(ids, values)}


def gray(values: np.ndarray) -> np.ndarray:
    rank = values.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return values[np.argsort(rank, kind="stable")]


def planted(n: int, seed: int, copies: int = 5, bits: int = 3) -> np.ndarray:
    """Random fingerprints, and for some of them a family that differs in a few bits."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
    out = [base]
    for _ in range(copies):
        some = base[: n // 4].copy()
        for _ in range(bits):
            some ^= np.uint64(1) << rng.integers(0, 64, len(some), dtype=np.uint64)
        out.append(some)
    return np.unique(np.concatenate(out))


@pytest.mark.parametrize("n, limit", [(1, 4), (15, 4), (16, 0), (300, 4), (700, 6)])
def test_index_finds_every_pair(n, limit):
    values = gray(planted(n, n))
    tree = gray_index.GrayIndex(values)
    got = {(int(a), int(b)) for i, j in gray_index.close_pairs(tree, tree, limit) for a, b in zip(i, j)}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= limit
    assert got == {(a, b) for a, b in zip(*np.nonzero(near)) if a < b}
    other = gray(planted(n // 2 + 1, n + 1))
    got = {(int(a), int(b)) for i, j in gray_index.close_pairs(tree, gray_index.GrayIndex(other), limit) for a, b in zip(i, j)}
    assert got == set(zip(*np.nonzero(np.bitwise_count(values[:, None] ^ other[None, :]) <= limit)))


@pytest.mark.parametrize("node, small, flush", [(4096, 48, 1 << 17), (8, 3, 20), (16, 5, 64)])
def test_links_connect_what_is_close(spark, monkeypatch, node, small, flush):
    for name, value in (("NODE", node), ("SMALL", small), ("FLUSH", flush)):
        monkeypatch.setattr(simhash, name, value)
    values = planted(250, 3)
    # one family so large that it fills several nodes under each of its patterns
    rng = np.random.default_rng(5)
    family = np.uint64(1 << 40) ^ np.unique(rng.integers(0, 1 << 9, 300, dtype=np.uint64))
    values = np.unique(np.concatenate((values, family)))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "value long")
    limits = (node, small, flush)
    links = _links_with(spark, df, limits)
    got = {r.node: r.component for r in star_components(links).collect()}
    ids = values.view(np.int64).tolist()
    want = plain_components(ids, values.tolist())
    assert {i: got.get(i, i) for i in ids} == want


def _links_with(spark, df, limits):
    """The kernels run in workers, where module constants are as imported; so they are handed
    over by running the link step on the driver's plan with the constants bound in."""
    work = simhash._link_groups(4)

    def bound(batches):
        simhash.NODE, simhash.SMALL, simhash.FLUSH = limits
        yield from work(batches)

    original = simhash._link_groups
    simhash._link_groups = lambda limit: bound
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
        return simhash.fingerprint_links(df, 4, rows_per_task=200).cache()
    finally:
        simhash._link_groups = original
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_masks_keep_every_close_pair_together():
    rng = np.random.default_rng(1)
    for n in (10, 10**7, 10**9, 10**12):
        masks = np.array(simhash.masks_for(n, 4), dtype=np.uint64)
        for _ in range(200):
            bits = rng.choice(64, 4, replace=False)
            flipped = np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64))
            assert ((masks & flipped) == 0).any()


def test_fingerprints_agree_with_spark_hashes(spark):
    text = "one Two three four five"
    got = spark.range(1).select(F.xxhash64(F.lit("one two three four")).alias("h")).first().h
    assert got & ((1 << 64) - 1) == xxhash.xxh64_intdigest(b"one two three four", 42)
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)
    assert simhash.fingerprint_of(None) == simhash.fingerprint_of(" \n") == 0


def test_components_of_documents(spark):
    docs = read("documents")
    got = simhash.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    values = [plain_fingerprint(t) for t in docs.text]
    want = plain_components(docs.doc_id.tolist(), values)
    prints = dict(zip(docs.doc_id.tolist(), values))
    assert len(got) == len(docs)
    assert all(int(r.fingerprint, 16) == prints[r.doc_id] and len(r.fingerprint) == 16 for r in got)
    assert {r.doc_id: r.component_id for r in got} == want


def test_components_of_odd_rows(spark):
    df = documents(spark, ODD, clashing=True)
    got = simhash.near_duplicates(df).collect()
    found = {r.doc_id: r.component_id for r in got}
    assert len(got) == len(ODD)
    assert found[1] == found[2] == found[3] == 1 and found[7] == found[8] == 7 and found[None] is None
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 9]
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.representatives(documents(spark, [])).collect() == []
