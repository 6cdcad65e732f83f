"""Jaro-Winkler similarity over batches of string pairs.

One call scores a whole Arrow batch: the only Python loop runs over character positions,
each step comparing that position of every pair at once.
"""

from __future__ import annotations

import numpy as np

_PAIRS_PER_BLOCK = 4096


def code_points(texts: list[str], width: int) -> np.ndarray:
    """Texts as a (n, width) matrix of code points, padded with 0."""
    return np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width)


def _score_block(left: list[str], right: list[str], prefix_weight: float, boost_above: float) -> np.ndarray:
    n = len(left)
    len_l = np.fromiter(map(len, left), dtype=np.int64, count=n)
    len_r = np.fromiter(map(len, right), dtype=np.int64, count=n)
    width_l = max(int(len_l.max()), 1)
    width_r = max(int(len_r.max()), 1)
    chars_l = code_points(left, width_l)
    chars_r = code_points(right, width_r)
    pos_l = np.arange(width_l)
    inside_l = pos_l[None, :] < len_l[:, None]

    reach = np.maximum(np.maximum(len_l, len_r) // 2 - 1, 0)
    widest = int(reach.max())
    free_l = inside_l.copy()
    hit_l = np.zeros((n, width_l), dtype=bool)
    hit_r = np.zeros((n, width_r), dtype=bool)
    rows = np.arange(n)
    for j in range(width_r):
        start, stop = max(0, j - widest), min(width_l, j + widest + 1)
        if start >= stop:
            break
        near = np.abs(pos_l[start:stop] - j)[None, :] <= reach[:, None]
        usable = (chars_l[:, start:stop] == chars_r[:, j : j + 1]) & free_l[:, start:stop] & near
        usable &= (j < len_r)[:, None]
        first = usable.argmax(axis=1)
        found = usable[rows, first]
        taken = first[found] + start
        free_l[rows[found], taken] = False
        hit_l[rows[found], taken] = True
        hit_r[:, j] = found

    common = hit_r.sum(axis=1)
    most = int(common.max())
    order_l = np.argsort(~hit_l, axis=1, kind="stable")[:, :most]
    order_r = np.argsort(~hit_r, axis=1, kind="stable")[:, :most]
    matched_l = np.take_along_axis(chars_l, order_l, axis=1)
    matched_r = np.take_along_axis(chars_r, order_r, axis=1)
    out_of_order = (matched_l != matched_r) & (np.arange(most)[None, :] < common[:, None])
    swaps = out_of_order.sum(axis=1) // 2

    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (common / len_l + common / len_r + (common - swaps) / common) / 3.0
    jaro = np.where(common > 0, jaro, 0.0)
    jaro = np.where((len_l == 0) & (len_r == 0), 1.0, jaro)

    shared = min(4, width_l, width_r)
    same = (chars_l[:, :shared] == chars_r[:, :shared]) & inside_l[:, :shared]
    same &= np.arange(shared)[None, :] < len_r[:, None]
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > boost_above, jaro + prefix * prefix_weight * (1.0 - jaro), jaro)


def jaro_winkler(
    left: list[str], right: list[str], prefix_weight: float = 0.1, boost_above: float = 0.7
) -> np.ndarray:
    """Similarity of ``left[i]`` and ``right[i]`` for every i."""
    scores = np.empty(len(left), dtype=np.float64)
    # pairs of like length share a block, so one long pair does not widen every matrix
    order = np.argsort([len(a) + len(b) for a, b in zip(left, right)], kind="stable")
    for at in range(0, len(order), _PAIRS_PER_BLOCK):
        block = order[at : at + _PAIRS_PER_BLOCK]
        scores[block] = _score_block(
            [left[i] for i in block], [right[i] for i in block], prefix_weight, boost_above
        )
    return scores
