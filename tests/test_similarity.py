import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions import signatures
from tidemark.functions.similarity import code_points, jaro_winkler

# Pairs with their published similarity (3 decimals).
GOLDEN = [
    ("MECHANIC", "MECHANICS", 0.978),
    ("MEDICINE", "MEDICINES", 0.978),
    ("DONT KNOW", "DON'T KNOW", 0.977),
    ("ELECTRICAL  ENGINEER", "ELECTRICAL ENGINEERING", 0.963),
    ("ELECTRICAL  ENGINEER", "ELECTRICAL ENGEENIER", 0.959),
    ("SOCIAL WORKERS", "SOCIAL WORK", 0.957),
    ("Dont know", "Dont no", 0.956),
    ("MEDICINE", "MEDINCINE", 0.953),
    ("BUSINESD", "BUSINESS", 0.95),
    ("POLICER OFFICER", "POLICE OFFICER", 0.987),
    ("TAXI DRIVER", "TAXI DRIIVER", 0.983),
    ("SALESPERSON", "SALES PERSON", 0.983),
    ("STORE CLERK", "STORES CLERK", 0.983),
    ("DON'T KNOW", "DONT KNOW", 0.977),
    ("LAB TECHNICIAN", "LAB TECHNICION", 0.971),
    ("CATTERER", "CATERER", 0.971),
    ("BUS CONDUCTER", "BUS CONDUCTOR", 0.969),
    ("STREET VENDOR", "STREET VENDER", 0.969),
    ("SALESGIRL", "SALES GIRLS", 0.964),
    ("BARBER", "BARER", 0.961),
    ("SALES REPRESENTATIVE", "SALE REPRESENTATIVE", 0.958),
]


def variants(seed, n, alphabet="abcde ", longest=24):
    """Random texts and copies of them with a few edits."""
    draw = random.Random(seed)
    pairs = []
    for _ in range(n):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(1, longest)))
        copy = list(text)
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(copy) + 1)
            if draw.random() < 0.5:
                copy.insert(at, draw.choice(alphabet))
            elif len(copy) > 1:
                copy.pop(at - 1)
        pairs.append((text, "".join(copy)))
    return pairs


def test_golden_pairs():
    scores = jaro_winkler([a for a, _, _ in GOLDEN], [b for _, b, _ in GOLDEN])
    assert [round(float(s), 3) for s in scores] == [s for _, _, s in GOLDEN]


def test_agrees_with_an_independent_implementation():
    pairs = variants(1, 20_000)
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    given = pa.table({"a": left, "b": right, "s": jaro_winkler(left, right)})  # noqa: F841
    worst = duckdb.connect().execute(
        "SELECT max(abs(s - jaro_winkler_similarity(a, b))) FROM given"
    ).fetchall()
    assert worst[0][0] < 1e-12


def test_degenerate_pairs():
    scores = jaro_winkler(["", "", "a", "a", "ab"], ["", "x", "a", "b", "ba"])
    assert scores.tolist()[:4] == [1.0, 0.0, 1.0, 0.0]


def _keys(values, threshold, budget, plain=frozenset()):
    """Keys of every value on the shorter and on the longer side."""
    n = len(values)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.ones(n, dtype=np.int32)), pa.array(np.arange(n)), pa.array(values)], names=["column", "id", "value"]
    )
    shorter, longer = {v: set() for v in values}, {v: set() for v in values}
    for part in signatures.blocking_keys(threshold, budget, "e tabcd", plain)(iter([batch])):
        for at, key, side in zip(*(part.column(c).to_pylist() for c in ("id", "key", "side"))):
            if side != signatures.LONGER:
                shorter[values[at]].add(key)
            if side != signatures.SHORTER:
                longer[values[at]].add(key)
    return shorter, longer


@pytest.mark.parametrize("threshold", [0.85, 0.95, 0.98])
@pytest.mark.parametrize("budget", [1, 16, 64])
def test_no_qualifying_pair_without_a_common_key(threshold, budget):
    pairs = variants(2, 4000) + variants(3, 300, "abcdefghijklmnopqrstuvwxyz ", 90)
    pairs += variants(4, 12, "abcdefghijklmnopqrstuvwxyz ", 500)
    pairs += [(a, b) for a, b, _ in GOLDEN]
    scores = jaro_winkler([a for a, _ in pairs], [b for _, b in pairs])
    close = [p for p, s in zip(pairs, scores) if s >= threshold and p[0] != p[1]]
    assert len(close) > 50
    values = sorted({v for p in close for v in p})
    classes = signatures.class_keys(threshold, budget, sorted({signatures.length_bucket(len(v)) for v in values}))
    mixed = [frozenset(classes), frozenset(c for c in classes if c[0] in (0, 3, 4))] if budget == 16 and threshold == 0.95 else []
    for plain in [frozenset(), *mixed]:
        shorter, longer = _keys(values, threshold, budget, plain)
        assert all(shorter[a] & longer[b] or shorter[b] & longer[a] for a, b in close)


@settings(max_examples=150, deadline=None)
@given(st.text("abcdeé日 ", min_size=1, max_size=40), st.text("abcdeé日 ", min_size=1, max_size=40))
def test_signatures_never_differ_in_more_bits_than_the_texts_in_characters(a, b):
    width = max(len(a), len(b))
    chars = code_points([a, b], width)
    inside = np.arange(width)[None, :] < np.array([[len(a)], [len(b)]])
    one, two = signatures.bit_signatures(chars, inside)
    bits = sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(one, two))
    differing = sum(abs(a.count(c) - b.count(c)) for c in set(a + b))
    assert bits <= differing


@given(st.integers(0, 100_000))
def test_length_buckets_cover_every_length_once(length):
    low, high = signatures.bucket_range(signatures.length_bucket(length))
    assert low <= length <= high


def test_long_texts_are_planned_from_few_lengths():
    assert signatures.bucket_plan(0.95, signatures.length_bucket(20_000), 16)
    for n, m in ((150, 150), (150, 163), (300, 340), (999, 1000)):
        buckets = sorted((signatures.length_bucket(n), signatures.length_bucket(m)))
        for prefix in range(5):
            exact = signatures.most_differences(0.95, prefix, n, m)
            if exact is not None:
                assert signatures._bucket_pair(0.95, prefix, *buckets) >= exact


@pytest.mark.parametrize("threshold", [0.85, 0.9, 0.95, 0.98])
def test_the_plan_reaches_every_admissible_partner_length(threshold):
    for n in range(1, 70):
        mine = signatures.bucket_plan(threshold, signatures.length_bucket(n), 64)
        reached = {(prefix, partner) for prefix, partner, _, _ in mine}
        for m in range(1, 140):
            for prefix in range(0, min(4, n, m) + 1):
                if signatures.most_differences(threshold, prefix, min(n, m), max(n, m)) is not None:
                    assert (prefix, signatures.length_bucket(m)) in reached
