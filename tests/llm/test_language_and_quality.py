import math
import zlib

import numpy as np
import pandas as pd
from helpers import ODD, SF, documents, read

from tidemark.llm import language, quality


def plain_bits(text: bytes, training: list[bytes], order: int) -> float:
    """Method C with escapes, one byte at a time, from plain dictionaries."""
    tree: dict = {}
    for t in training:
        padded = bytes(order) + t
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts = tree.setdefault(padded[i - k : i], {})
                counts[padded[i]] = counts.get(padded[i], 0) + 1
    padded, bits = bytes(order) + text, 0.0
    for i in range(order, len(padded)):
        for k in range(order, -1, -1):
            counts = tree.get(padded[i - k : i])
            if counts is None:
                continue
            whole = sum(counts.values()) + len(counts)
            if padded[i] in counts:
                bits -= math.log2(counts[padded[i]] / whole)
                break
            bits -= math.log2(len(counts) / whole)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    training = {"x": [b"abracadabra", b"abba"], "y": [b"banana bandana", b"ban"]}
    order = 3
    counts = {k: np.unique(language.grams(v, order), return_counts=True) for k, v in training.items()}
    trees = language.grow(counts, order)
    texts = [b"abracadabra", b"bandana", b"a", b"zzz", "é".encode(), b"abba banana" * 5]
    got = trees.bits(texts)
    want = [[plain_bits(t, training[k], order) for k in trees.languages] for t in texts]
    assert np.allclose(got, want, rtol=1e-5)


def test_long_texts_are_scored_whole(monkeypatch):
    counts = {k: np.unique(language.grams(v, 4), return_counts=True) for k, v in {"x": [b"abcabd"], "y": [b"dcba"]}.items()}
    trees = language.grow(counts, 4)
    raw = b"abcabdcba" * 40
    whole = trees.bits([raw])[0]
    monkeypatch.setattr(language, "POSITIONS", 50)
    lang, _ = language._long(trees, raw)
    assert lang == trees.languages[int(whole.argmin())]


def test_language_of_held_out_documents(spark):
    docs = read("documents").set_index("doc_id")
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(df, language.train(df)).toPandas()
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred.to_numpy() == docs.lang[held.doc_id].to_numpy()).mean() >= 0.97


def test_language_of_odd_rows(spark):
    df = documents(spark, ODD, clashing=True)
    got = language.identify(df, language.train(df)).collect()
    found = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == len(ODD)
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, 9))
    assert found[5][0] in ("en", "de", "fr") and found[4][1] > 0
    nothing = documents(spark, [(1, "text", None, "a"), (2, None, "en", "a")])
    assert language.train(nothing) is None
    assert {r.lang_pred for r in language.identify(nothing, None).collect()} == {"und"}
    assert language.identify(documents(spark, []), None).collect() == []


def test_pairwise_ranking_prefers_what_the_labels_prefer():
    rng = np.random.default_rng(0)
    label = (rng.random(800) < 0.8).astype(int)
    x = rng.normal(size=(800, len(quality.FEATURES)))
    x[:, 3] += 3 * label
    model = quality.fit(x, label)
    assert model.weights[3] > 1 and abs(np.delete(model.weights, 3)).max() < 0.5
    predicted = model.score(x) >= quality.CUT
    assert (predicted == label).mean() > 0.9


def test_quality_of_held_out_documents(spark):
    df, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(df, quality.train(df, labels)).toPandas().set_index("doc_id")
    known = read("labels").set_index("doc_id").quality
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    held = got[got.held_out & got.index.isin(known.index)]
    assert (held.predicted.to_numpy() == known[held.index].to_numpy()).mean() >= 0.95


def test_quality_of_odd_rows(spark):
    df = documents(spark, ODD, clashing=True)
    labels = spark.createDataFrame(
        [(4, 1), (5, 0), (5, 0), (6, 1), (7, 1), (8, 0), (8, 1), (None, 1), (99, 0), (2, None)], "doc_id long, quality int"
    )
    got = quality.classify(df, quality.train(df, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    # without two kinds of labels everything is accepted
    model = quality.train(df, labels.filter("quality = 1"))
    assert {r.predicted for r in quality.classify(df, model).collect()} == {1}
    assert quality.accepted(df, model).columns == df.columns
    assert quality.classify(documents(spark, []), model).collect() == []


def test_features_of_any_text():
    for text in [None, "", " ", "x", "\n" * 50, "!" * 10_000, "a b " * 50_000, "é" * 100, "\ud800"]:
        assert np.isfinite(quality.features(text)).all()
    assert pd.Series(quality.features("a a a a " * 20), index=quality.FEATURES).worst_repeat > 0.5
