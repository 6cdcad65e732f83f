import math
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, SF, documents, read

from tidemark.llm import ngram_lm


def split(text):
    return (text or "").encode().lower().split()


def grams_of(words, size):
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def brute_force(texts, order=3, backoff=0.4):
    docs = [split(t) for t in texts]
    counts = [Counter(g for d in docs for g in grams_of(d, k)) for k in range(1, order + 1)]
    out = []
    for d in docs:
        own = [Counter(grams_of(d, k)) for k in range(1, order + 1)]
        elsewhere = lambda g: counts[len(g) - 1][g] - own[len(g) - 1][g]
        rest = sum(counts[0].values()) - len(d)
        seen, score = [0] * order, 0.0
        for i in range(len(d)):
            ending = [tuple(d[i - k + 1 : i + 1]) for k in range(1, min(order, i + 1) + 1)]
            for k, g in enumerate(ending):
                seen[k] += elsewhere(g) > 0
            steps = 0
            for g in reversed(ending):
                if elsewhere(g):
                    score += math.log(elsewhere(g) / (elsewhere(g[:-1]) if len(g) > 1 else rest))
                    break
                steps += 1
            else:
                score -= math.log(rest + 1)
            score += steps * math.log(backoff)
        out.append((len(d), *seen, score))
    return out


def check(got, ids, texts, order=3):
    names = ngram_lm._seen_columns(order)
    want = sorted(zip([(i is None, i or 0) for i in ids], brute_force(texts, order)))
    found = sorted(
        ((r.doc_id is None, r.doc_id or 0), (r.n_words, *[r[c] for c in names], r.log_score)) for r in got
    )
    assert len(found) == len(want)
    for f, w in zip(found, want):
        assert f[0] == w[0] and f[1][:-1] == w[1][:-1] and f[1][-1] == pytest.approx(w[1][-1], rel=1e-9, abs=1e-9)
    assert all((r.mean_score is None) == (r.n_words == 0) for r in got)


@pytest.mark.parametrize("block_bytes, bucket_grams", [(16 << 20, 2_000_000), (50_000, 20_000)])
def test_documents(spark, block_bytes, bucket_grams):
    docs = read("documents")
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = ngram_lm.backoff_scores(df, block_bytes=block_bytes, bucket_grams=bucket_grams).collect()
    check(got, docs.doc_id.tolist(), docs.text)


@pytest.mark.parametrize("block_bytes, bucket_grams", [(16 << 20, 2_000_000), (300, 50)])
def test_odd_rows(spark, block_bytes, bucket_grams):
    df = documents(spark, ODD, clashing=True)
    got = ngram_lm.backoff_scores(df, block_bytes=block_bytes, bucket_grams=bucket_grams).collect()
    check(got, [r[0] for r in ODD], [r[1] for r in ODD])
    assert ngram_lm.backoff_scores(documents(spark, [])).collect() == []
    alone = ngram_lm.backoff_scores(documents(spark, [(1, "only one text", "en", "a")])).collect()
    check(alone, [1], ["only one text"])


@pytest.mark.parametrize("order", [1, 2, 5])
def test_other_orders(spark, order):
    texts = ["a b c d e a b c", "x a b c d e", "", None, "b c", "a", "a b c d e f"]
    df = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = ngram_lm.backoff_scores(df, order=order, block_bytes=20, bucket_grams=7).collect()
    check(got, range(len(texts)), texts, order)
    with pytest.raises(ValueError):
        ngram_lm.backoff_scores(df, order=0)


@pytest.mark.parametrize("at_once", [1, 3, 1000])
def test_own_counts_of_each_document(monkeypatch, at_once):
    monkeypatch.setattr(ngram_lm, "OWN_WORDS", at_once)
    texts = ["a b a b a", None, "", "b", "a a a a", "c d c d a b " * 3]
    grams = ngram_lm.Grams(texts)
    docs = [split(t) for t in texts]
    want = [own[g] for k in (1, 2, 3) for d in docs for own in [Counter(grams_of(d, k))] for g in grams_of(d, k)]
    assert grams.own().tolist() == want
    assert grams.counts().sum() == len(want)


@pytest.mark.parametrize("values", [[], [0], [2**64 - 1], [0, 1, 2**63, 2**64 - 1], list(range(0, 10**7, 999))])
def test_packed_numbers(values):
    keys = np.array(values, dtype=np.uint64)
    assert ngram_lm._unpack_sorted(ngram_lm._pack_sorted(keys), len(keys)).tolist() == values
    counts = np.array([v >> 1 for v in values], dtype=np.int64)
    assert ngram_lm._unpack(ngram_lm._pack(counts), len(counts)).tolist() == counts.tolist()
