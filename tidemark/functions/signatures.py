"""Blocking keys for the Jaro-Winkler self-join.

A pair that reaches the threshold with a common prefix of ``l`` characters (capped at 4)
has a Jaro score of at least ``(t - 0.1 l) / (1 - 0.1 l)``.  That bounds how many characters
the two texts share as multisets, and so the number ``d`` of characters in which their
multisets differ.  Deal all characters into ``g > d`` groups: at most ``d`` groups can
differ, so at least one choice of ``g - d`` groups agrees completely.  Each text therefore
emits one key per choice (the partition-and-enumerate scheme of Arasu, Ganti and Kaushik,
"Efficient exact set-similarity joins", VLDB 2006), and every qualifying pair shares a key.
Hash collisions can only add candidates, which are scored afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa

from tidemark.functions.similarity import code_points

PREFIX_WEIGHT = 0.1
PREFIX_CAP = 4
SIGNATURE_WORDS = 4
_ROUNDING = 1e-9
_ROWS_PER_BLOCK = 2048


def least_jaro(threshold: float, prefix: int) -> float:
    boost = PREFIX_WEIGHT * prefix
    return (threshold - boost) / (1.0 - boost)


def most_differences(threshold: float, prefix: int, shorter: int, longer: int) -> int | None:
    """Largest multiset difference of a qualifying pair of these lengths, or ``None`` if no
    pair of these lengths qualifies."""
    needed = ceil((3 * least_jaro(threshold, prefix) - 1) * shorter * longer / (shorter + longer) - _ROUNDING)
    return None if needed > shorter else shorter + longer - 2 * needed


# Texts shorter than this have a bucket for each length; above, buckets widen with length.
# Narrow buckets bound the differences of a class more tightly, at the cost of more classes.
_EXACT_LENGTHS = 16


def length_bucket(length: int) -> int:
    """Texts of like length share a bucket: width 1 up to 16, then 2, 4, 8, ..."""
    if length < _EXACT_LENGTHS:
        return length
    half = _EXACT_LENGTHS // 2
    step = length.bit_length() - half.bit_length()
    return _EXACT_LENGTHS + half * (step - 1) + ((length >> step) - half)


def bucket_range(bucket: int) -> tuple[int, int]:
    if bucket < _EXACT_LENGTHS:
        return bucket, bucket
    half = _EXACT_LENGTHS // 2
    step, offset = divmod(bucket - _EXACT_LENGTHS, half)
    low = (half + offset) << (step + 1)
    return low, low + (1 << (step + 1)) - 1


@lru_cache(maxsize=None)
def _bucket_pair(threshold: float, prefix: int, one: int, other: int) -> int | None:
    """Largest difference of any two lengths of two buckets (``one`` <= ``other``)."""
    (low, high), (other_low, other_high) = bucket_range(one), bucket_range(other)
    if (high - low) * (other_high - other_low) <= 64:
        found = [
            most_differences(threshold, prefix, min(n, m), max(n, m))
            for n in range(max(low, prefix, 1), high + 1)
            for m in range(max(other_low, prefix, 1), other_high + 1)
        ]
        return max((d for d in found if d is not None), default=None)
    # wide buckets: the nearest lengths decide whether any pair qualifies, and the bound
    # before rounding is convex in each length, so a corner holds its maximum
    nearest = (high, high) if one == other else (high, other_low)
    if most_differences(threshold, prefix, *nearest) is None:
        return None
    share = 3 * least_jaro(threshold, prefix) - 1
    corners = [(n, m) for n in (low, high) for m in (other_low, other_high)]
    return int(max(n + m - 2 * share * n * m / (n + m) for n, m in corners) + _ROUNDING)


def bits_allowed(threshold: float, prefix: int, low: int, high: int, other_low: int, other_high: int) -> int:
    """Largest multiset difference of a qualifying pair with lengths in these two ranges, or -1 if none
    qualifies.  The bound is convex in each length, so a corner holds its maximum."""
    share = 3 * least_jaro(threshold, prefix) - 1
    nearest = (max(low, other_low),) * 2 if max(low, other_low) <= min(high, other_high) else (
        (high, other_low) if high < other_low else (low, other_high)
    )
    if most_differences(threshold, prefix, min(nearest), max(nearest)) is None:
        return -1
    corners = [(n, m) for n in (low, high) for m in (other_low, other_high)]
    return int(max(n + m - 2 * share * n * m / (n + m) for n, m in corners) + _ROUNDING)


@lru_cache(maxsize=None)
def _groups(differences: int, key_budget: int) -> int:
    """Number of groups: as many as give long, selective keys within the key budget."""
    groups = differences + 1
    while groups < 3 * differences and comb(groups + 1, differences) <= key_budget:
        groups += 1
    return groups


@lru_cache(maxsize=None)
def bucket_plan(threshold: float, bucket: int, key_budget: int) -> list[tuple[int, int, int, int]]:
    """``(prefix, partner bucket, differences, groups)`` for texts of one length bucket."""
    longest = bucket_range(bucket)[1]
    plan = []
    for prefix in range(PREFIX_CAP + 1):
        ratio = max(3 * least_jaro(threshold, prefix) - 2, 0.05)
        for partner in range(length_bucket(max(1, int(longest * ratio) - 8)), length_bucket(int(longest / ratio) + 8) + 1):
            differences = _bucket_pair(threshold, prefix, min(bucket, partner), max(bucket, partner))
            if differences is not None:
                plan.append((prefix, partner, differences, _groups(differences, key_budget)))
    return plan


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the public splitmix64 generator, on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seed(*numbers: int) -> np.uint64:
    state = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)
    for number in numbers:
        state = _mix(state + np.uint64(number + 1))
    return state[0]


def bit_signatures(chars: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """256 parity bits per text.  Each (character, occurrence) flips one bit, so two
    signatures differ in at most as many bits as the multisets differ in characters."""
    ordered = np.sort(np.where(inside, chars, np.uint32(0xFFFFFFFF)), axis=1)
    width = ordered.shape[1]
    at = np.arange(width)
    new_run = np.ones(ordered.shape, dtype=bool)
    new_run[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    run_start = np.maximum.accumulate(np.where(new_run, at[None, :], 0), axis=1)
    occurrence = (at[None, :] - run_start).astype(np.uint64)
    bit = _mix(ordered.astype(np.uint64) * np.uint64(4096) + occurrence + np.uint64(77)) % np.uint64(256)
    present = at[None, :] < inside.sum(axis=1)[:, None]
    flips = np.where(present, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
    words = [
        np.bitwise_xor.reduce(np.where((bit >> np.uint64(6)) == w, flips, np.uint64(0)), axis=1)
        for w in range(SIGNATURE_WORDS)
    ]
    return np.stack(words, axis=1)


# What travels for each key: never the text, only what the exact tests need.
KEY_SCHEMA = (
    "key bigint, id bigint, side tinyint, prefix tinyint, length int, next bigint, "
    "s0 bigint, s1 bigint, s2 bigint, s3 bigint"
)
# texts up to this length bring one word of parity bits, which tells as few characters apart well enough
_ONE_WORD = 24
_PACKED = 3  # characters of 21 bits in one number
SHORTER, LONGER, BOTH = 0, 1, 2
_NUMBERS_PER_BLOCK = 1 << 21  # numbers in the largest array that a block of texts needs


def _deal_order(chars: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Number by which characters are dealt: their rank among the frequent ones (most
    frequent first), so that no group is left with rare characters only, whose counts agree
    between most texts.  Other characters are dealt by hash.  Any dealing keeps the keys
    lossless; a balanced one keeps them selective."""
    hashed = _mix(chars.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)
    if not len(frequent):
        return hashed
    by_code = np.argsort(frequent)
    at = np.searchsorted(frequent[by_code], chars).clip(max=len(frequent) - 1)
    listed = frequent[by_code][at] == chars
    return np.where(listed, by_code[at].astype(np.uint64), hashed)


def class_keys(threshold: float, key_budget: int, buckets: Sequence[int]) -> dict[tuple[int, int, int], int]:
    """``(prefix, bucket, bucket) -> keys of a text`` for all classes between these buckets."""
    found = {}
    for bucket in buckets:
        for prefix, partner, differences, groups in bucket_plan(threshold, bucket, key_budget):
            if partner in buckets:
                found[(prefix, min(bucket, partner), max(bucket, partner))] = comb(groups, differences)
    return found


def chance_of_a_common_key(texts: list[str], differences: int, groups: int, frequent_chars: str) -> float:
    """How many keys two of these texts share on average, prefixes aside."""
    lengths = np.array([len(t) for t in texts])
    chars = code_points(texts, int(lengths.max()))
    inside = np.arange(chars.shape[1])[None, :] < lengths[:, None]
    dealt = (_deal_order(chars, np.array([ord(c) for c in frequent_chars], dtype=np.uint32)) % np.uint64(groups)).astype(np.int64)
    sums = np.zeros((len(texts), groups), dtype=np.uint64)
    np.add.at(sums, (np.arange(len(texts))[:, None], dealt), np.where(inside, _mix(chars.astype(np.uint64) + np.uint64(1)), np.uint64(0)))
    sums = _mix(sums + np.arange(groups, dtype=np.uint64)[None, :])
    pairs = 0
    for choice in combinations(range(groups), groups - differences):
        alike = np.unique(sums[:, list(choice)].sum(axis=1, dtype=np.uint64), return_counts=True)[1]
        pairs += int((alike * (alike - 1)).sum())
    return pairs / max(len(texts) * (len(texts) - 1), 1)


def class_runs(
    threshold: float, bucket: int, key_budget: int, plain: frozenset[tuple[int, int, int]]
) -> list[tuple[int, int, int, int, int, bool]]:
    """``(lowest prefix, highest prefix, partner, differences, groups, plain)``: the classes of a bucket, those
    of consecutive prefixes as one where one set of keys serves them all, made with the lowest prefix."""
    runs: list[list] = []
    for prefix, partner, differences, groups in sorted(bucket_plan(threshold, bucket, key_budget), key=lambda c: (c[1], c[0])):
        one_key = (prefix, min(bucket, partner), max(bucket, partner)) in plain
        last = runs[-1] if runs else None
        if (
            last
            and (last[1], last[2], last[5]) == (prefix - 1, partner, one_key)
            and (one_key or last[3:5] == [differences, groups])
        ):
            last[1], last[3] = prefix, differences
        else:
            runs.append([prefix, prefix, partner, differences, groups, one_key])
    return [tuple(run) for run in runs]


def _packed(chars: np.ndarray, inside: np.ndarray, low: int, high: int) -> np.ndarray | None:
    """The characters at ``low`` to ``high`` as one number, the end of a text as 0; ``None`` where no test of
    them is needed or they do not fit.  The pair is then found by a longer prefix as well, if it shares one."""
    if high == PREFIX_CAP or high - low >= _PACKED:
        return None
    packed = np.zeros(len(chars), dtype=np.int64)
    for at in range(low, high + 1):
        code = np.where(inside[:, at], chars[:, at].astype(np.int64) + 1, 0) if at < chars.shape[1] else 0
        packed = (packed << 21) | code
    return packed


def blocking_keys(
    threshold: float,
    key_budget: int,
    frequent_chars: str,
    plain: frozenset[tuple[int, int, int]] = frozenset(),
    among: frozenset[tuple[int, int, int]] | None = None,
):
    """A ``mapInArrow`` function: (column, id, value) -> one row per blocking key.

    In a class of two length buckets the texts of the lower bucket belong to the shorter
    side and those of the upper one to the longer side; in a class of one bucket they belong
    to both.  Joining one side with the other never compares texts that only share a class
    with a third length.  In a ``plain`` class the prefix itself is the one key.  Only the classes ``among``
    those given get keys, if they are given.  Blocks of texts are cut by what their arrays hold, so that long
    texts and many choices take no more memory than short ones.
    """
    frequent = np.array([ord(c) for c in frequent_chars], dtype=np.uint32)

    def one_block(column: int, ids: np.ndarray, texts: list[str], bucket: int):
        lengths = np.array([len(t) for t in texts])
        chars = code_points(texts, int(lengths.max()))
        inside = np.arange(chars.shape[1])[None, :] < lengths[:, None]
        signature = bit_signatures(chars, inside).view(np.int64)
        char_hash = np.where(inside, _mix(chars.astype(np.uint64) + np.uint64(1)), np.uint64(0))
        deal = _deal_order(chars, frequent)
        prefix_hash = [np.full(len(texts), _seed(column), dtype=np.uint64)]
        for i in range(min(PREFIX_CAP, chars.shape[1])):
            prefix_hash.append(_mix(prefix_hash[-1] * np.uint64(31) + chars[:, i].astype(np.uint64)))
        group_hash: dict[int, np.ndarray] = {}
        folded = np.zeros_like(signature)
        folded[:, 0] = np.bitwise_xor.reduce(signature, axis=1)
        for prefix, highest, partner, differences, groups, one_key in class_runs(threshold, bucket, key_budget, plain):
            long_enough = np.flatnonzero(lengths >= prefix)
            if prefix >= len(prefix_hash) or not len(long_enough):
                continue
            if among is not None and (prefix, min(bucket, partner), max(bucket, partner)) not in among:
                continue
            if groups not in group_hash and not one_key:
                # sums wrap around, which keeps them independent of the order of characters
                sums = np.zeros((len(texts), groups), dtype=np.uint64)
                dealt = (deal % np.uint64(groups)).astype(np.int64)
                np.add.at(sums, (np.arange(len(texts))[:, None], dealt), char_hash)
                seeds = np.array([_seed(groups, j) for j in range(groups)], dtype=np.uint64)
                group_hash[groups] = _mix(sums + seeds[None, :])
            chosen = np.array([[0]] if one_key else list(combinations(range(groups), groups - differences)))
            class_seed = _seed(prefix, min(bucket, partner), max(bucket, partner))
            choice_seed = _mix(np.arange(len(chosen), dtype=np.uint64) + class_seed)
            side = BOTH if partner == bucket else SHORTER if bucket < partner else LONGER
            following = _packed(chars, inside, prefix, highest)
            bits = folded if bucket_range(max(bucket, partner))[1] <= _ONE_WORD else signature
            step = max(1, _NUMBERS_PER_BLOCK // chosen.size)
            for at in range(0, len(long_enough), step):
                some = long_enough[at : at + step]
                per_choice = np.zeros((len(some), 1), dtype=np.uint64)
                if not one_key:
                    per_choice = group_hash[groups][some][:, chosen].sum(axis=2, dtype=np.uint64)
                keys = _mix(per_choice + choice_seed[None, :] + prefix_hash[prefix][some][:, None])
                source = np.repeat(some, len(chosen))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.reshape(-1).view(np.int64)),
                        pa.array(ids[source]),
                        pa.array(np.full(len(source), side, dtype=np.int8)),
                        pa.array(np.full(len(source), highest, dtype=np.int8)),
                        pa.array(lengths[source].astype(np.int32)),
                        pa.nulls(len(source), pa.int64()) if following is None else pa.array(following[source]),
                        *[pa.array(bits[source, w]) for w in range(SIGNATURE_WORDS)],
                    ],
                    names=["key", "id", "side", "prefix", "length", "next", "s0", "s1", "s2", "s3"],
                )

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("value").to_pylist(), batch.column("id").to_numpy()
            columns = batch.column("column").to_numpy()
            lengths = np.array([len(t) for t in texts])
            buckets = np.array([length_bucket(n) for n in lengths.tolist()])
            for column, bucket in sorted(set(zip(columns.tolist(), buckets.tolist()))):
                rows = np.flatnonzero((buckets == bucket) & (columns == column))
                step = max(1, min(_ROWS_PER_BLOCK, _NUMBERS_PER_BLOCK // int(lengths[rows].max())))
                for at in range(0, len(rows), step):
                    block = rows[at : at + step]
                    yield from one_block(column, ids[block], [texts[i] for i in block], bucket)

    return generate
