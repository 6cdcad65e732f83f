"""Near-duplicates of long texts, where no key tells texts apart, and the number of keys of short ones."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_near_duplicates import brute_force
from test_similarity import variants

from tidemark.functions import signatures
from tidemark.functions.block_pairs import Block, close_pairs
from tidemark.functions.similarity import jaro_winkler
from tidemark.operators import near_duplicates as operator
from tidemark.session import materialize

ALPHABET = "eeeeettttaaaooiinnsshhrrdlu  "


def titles(seed, n, longest=60):
    return sorted({v for p in variants(seed, n, ALPHABET, longest) for v in p if v.strip(" ") == v})


def scrambled(seed, n, length):
    """Texts, copies with neighbours swapped, some after a common start: close by order, not by characters alone."""
    draw, found = random.Random(seed), set()
    for _ in range(n):
        text = [draw.choice(ALPHABET) for _ in range(length)]
        found.add("".join(text))
        for start in (0, 4):
            copy = list(text)
            for _ in range(draw.randint(1, length // 4)):
                at = draw.randrange(start, length - 1)
                copy[at], copy[at + 1] = copy[at + 1], copy[at]
            found.add("".join(copy))
        found.add("".join(text[:4] + draw.sample(text[4:], length - 4)))
    return sorted(v for v in found if v.strip(" ") == v)


@pytest.mark.parametrize("threshold", [0.85, 0.9, 0.97])
@pytest.mark.parametrize("longest", [30, 64, 200])
def test_blocks_find_every_close_pair(threshold, longest):
    texts = sorted({*titles(longest, 120, longest), *scrambled(longest + 1, 30, longest), "a", "日本", "é\0", "é"})
    left = [a for i, a in enumerate(texts) for _ in texts[i + 1 :]]
    right = [b for i in range(len(texts)) for b in texts[i + 1 :]]
    expected = {frozenset(p) for p, s in zip(zip(left, right), jaro_winkler(left, right)) if s >= threshold - 1e-9}
    assert len(expected) > 50
    whole = Block(np.arange(len(texts)), texts)
    one, other = Block(np.arange(0, len(texts), 2), texts[::2]), Block(np.arange(1, len(texts), 2), texts[1::2])
    for sides in ([(whole, whole, True)], [(one, one, True), (one, other, False), (other, other, True)]):
        found = [
            frozenset((texts[i], texts[j]))
            for a, b, same in sides
            for x, y in close_pairs(a, b, threshold, same)
            for i, j in zip(x.tolist(), y.tolist())
        ]
        assert len(found) == len(set(found)) and set(found) == expected


def keys_of(spark, monkeypatch, values, threshold, **options):
    written = {}

    def kept(df, label):
        written[label] = materialize(df, label)
        return written[label]

    monkeypatch.setattr(operator, "materialize", kept)
    pairs = operator.near_duplicates(spark.createDataFrame([(v,) for v in values], "v string"), ["v"], threshold, **options)
    found = sorted((r.value_a, r.count_a, r.value_b, r.count_b) for r in pairs.collect())
    return found, written["blocking-keys"].count()


def test_long_texts_make_no_keys_that_most_of_them_share(spark, monkeypatch):
    draw = random.Random(5)
    values = {"".join(draw.choice(ALPHABET) for _ in range(60)) for _ in range(800)}
    values = sorted(v for v in {*values, *scrambled(6, 20, 60)} if v.strip(" ") == v)
    # pairs of blocks that are smaller than the bucket
    monkeypatch.setattr(operator, "_BLOCK_TEXTS", 300)
    found, n_keys = keys_of(spark, monkeypatch, values, 0.9)
    assert found == brute_force(values, 0.9) and len(found) > 20
    assert n_keys <= 10 * len(values)


def test_short_texts_share_their_keys_among_prefixes():
    draw = random.Random(7)
    values = ["".join(draw.choice("abcdefghijklmnop") for _ in range(10)) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.ones(50, dtype=np.int32)), pa.array(np.arange(50)), pa.array(values)], names=["column", "id", "value"]
    )
    made = sum(part.num_rows for part in signatures.blocking_keys(0.97, 16, "abc")(iter([batch])))
    assert made <= 8 * 50


def test_short_texts_without_a_common_prefix_are_not_compared_in_blocks(spark):
    draw = random.Random(8)
    values = {"".join(draw.choice("abcdefghijklmnopqrst") for _ in range(draw.choice((8, 9)))) for _ in range(4000)}
    df = spark.createDataFrame([(0, i, v, 1) for i, v in enumerate(sorted(values))], "column int, id long, value string, count long")
    among, _, blocks = operator._plan(df, 0.97, 16, "abcdefgh")
    assert (0, 8, 9) not in among and not blocks
