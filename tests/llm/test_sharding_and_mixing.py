import zlib
from collections import Counter, defaultdict

import pytest
from helpers import ODD, SF, documents, read
from pyspark.sql import functions as F

from tidemark.llm import mixing, sharding


def jump(key: int, shards: int) -> int:
    """The published algorithm, in plain integers."""
    key &= (1 << 64) - 1
    shard, nxt = -1, 0
    while nxt < shards:
        shard = nxt
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        nxt = int((shard + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return shard


@pytest.mark.parametrize("shards", [1, 2, 24, 1000, 100_000])
def test_jumps(spark, shards):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), 123456789, *range(1000, 1100)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = df.select("k", sharding.jump_shards(F.col("k"), shards).alias("s")).select("k", "s.*").collect()
    assert [(r.shard, r.grown) for r in got] == [(jump(r.k, shards), jump(r.k, shards + 1)) for r in got]


def check_shards(rows, texts):
    slots = defaultdict(list)
    for r in rows:
        assert r.shard == jump(r.doc_id or 0, 24) and r.grown_shard == jump(r.doc_id or 0, 25)
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected


def test_shards_of_documents(spark):
    docs = read("documents")
    got = sharding.shard_documents(spark.read.parquet(f"{SF}/documents.parquet"), 24, rows_per_piece=10)
    check_shards(got.collect(), list(zip(docs.doc_id.tolist(), docs.text)))


def test_shards_of_odd_rows(spark):
    rows = ODD + [(11, "copy", "en", "a")] * 300
    got = sharding.shard_documents(documents(spark, rows, clashing=True), 24, rows_per_piece=5)
    check_shards(got.collect(), [(r[0], r[1]) for r in rows])
    assert sharding.shard_documents(documents(spark, []), 24).collect() == []


def targets(sizes: dict, weights, most: float) -> dict:
    order = sorted((s for s in sizes), key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, target, left = set(order), {}, float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def words(text) -> int:
    return len((text or "").encode().split())


@pytest.mark.parametrize("weights, most", [((5, 2, 1), 3.0), ((1,), 1.0), ((50, 1), 2.0)])
def test_mix(spark, weights, most):
    docs = read("documents")
    got = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"), weights, 1.0, most, rows_per_piece=7).toPandas()
    size, source = dict(zip(docs.doc_id, map(words, docs.text))), dict(zip(docs.doc_id, docs.source))
    sizes = Counter()
    for i in size:
        sizes[source[i]] += size[i]
    want, taken = targets(sizes, weights, most), Counter()
    for r in got.itertuples():
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= most * r.size
        taken[source[r.doc_id]] += r.taken
    assert len(got) == len(docs)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)


def test_mix_of_odd_rows(spark):
    rows = ODD + [(100 + i, "one two three", "en", "hot") for i in range(400)] + [(50, "same row", "en", "d")] * 300
    df = documents(spark, rows, clashing=True)
    got = mixing.mix(df, rows_per_piece=5).collect()
    sizes, by_id = Counter(), {}
    for i, text, _, source in rows:
        sizes[source] += words(text)
        by_id[i] = source
    want, taken = targets(sizes, (5, 2, 1), 3.0), Counter()
    for r in got:
        taken[by_id[r.doc_id]] += r.taken
        assert r.taken <= 3 * r["size"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    mixed = mixing.mixed_documents(df, rows_per_piece=5)
    assert mixed.columns == df.columns
    drawn = Counter()
    for r in mixed.collect():
        drawn[r.source] += words(r.text)
    # sources of which no text is longer than their target come near it
    assert abs(drawn["hot"] - want["hot"]) <= 3
    assert mixing.mix(documents(spark, [])).collect() == mixing.mixed_documents(documents(spark, [])).collect() == []


def test_mix_repeats(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(mixing.mix(df).collect()) == sorted(mixing.mix(df.repartition(5)).collect())
