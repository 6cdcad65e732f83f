"""All pairs of two blocks of texts, without keys: for classes in which no key tells texts apart.

A long text at a low threshold may differ in so many characters that a key covers two or three of
them, which most texts share.  Then every pair is looked at, by tests that are necessary for the
threshold, the cheapest first, each for many pairs at once:

1. differing parity bits bound the characters that match (``bit_signatures``);
2. lengths and common prefix of the pair give the least number of matches ``m``;
3. of ``m`` matches with ``t`` swaps all but ``2 t + 1`` stand in the same order in both texts, which is a
   common subsequence of that length; unlike texts have no long one.

What is left is scored.
"""

from __future__ import annotations

import numpy as np

from tidemark.functions.signatures import PREFIX_CAP, PREFIX_WEIGHT, bit_signatures, bits_allowed
from tidemark.functions.similarity import code_points, jaro_winkler

_ROUNDING = 1e-9
_LEFT_ROWS, _RIGHT_ROWS = 32, 4096  # pairs looked at together: what they need stays in the cache
_PAIRS_AT_ONCE = 1 << 16
_CHARACTERS_AT_ONCE = 1 << 22
_CODES = 64


class Block:
    """Texts in the order of their first character, with what the tests need."""

    def __init__(self, ids: np.ndarray, texts: list[str]) -> None:
        order = sorted(range(len(texts)), key=lambda i: texts[i][:1])
        self.ids, self.texts = ids[order], [texts[i] for i in order]
        self.lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        width = max(int(self.lengths.max()), PREFIX_CAP)
        step = max(1, _CHARACTERS_AT_ONCE // width)
        chars, bits = [], []
        for at in range(0, len(order), step):
            some = code_points(self.texts[at : at + step], width)
            inside = np.arange(width)[None, :] < self.lengths[at : at + step, None]
            bits.append(bit_signatures(some, inside))
            # one more, so that no character is like the end of a text
            chars.append(np.where(inside, some + np.uint32(1), np.uint32(0)))
        self.head = np.concatenate([c[:, :PREFIX_CAP] for c in chars])
        self.bits = np.ascontiguousarray(np.concatenate(bits).T)
        # characters as codes from 1, those of a text's end 0
        width = int(self.lengths.max())
        self.codes = np.ascontiguousarray(np.concatenate([_code(c[:, :width]) for c in chars]).T)
        # for each text and code the places that hold it, in words of 64
        self.places = np.zeros((-(-width // 64), len(self.texts) * _CODES), dtype=np.uint64)
        rows = np.arange(len(self.texts)) * _CODES
        for at in range(width):
            self.places[at >> 6][rows + self.codes[at]] |= np.uint64(1) << np.uint64(at & 63)
        self.places[:, ::_CODES] = 0


def _code(chars: np.ndarray) -> np.ndarray:
    hashed = (chars * np.uint32(0x9E3779B1)) >> np.uint32(8)
    return np.where(chars > 0, hashed % np.uint32(_CODES - 1) + 1, 0).astype(np.uint8)


def _near_bits(left: Block, right: Block, alike: int, differ: int, same_block: bool):
    """Pairs of rows whose bits differ in at most ``differ`` places, or ``alike`` if the texts begin with
    the same character.  256 differing bits count as none, which lets such a pair pass."""
    first, starts = np.unique(left.head[:, 0], return_index=True)
    stops = [*starts[1:].tolist(), len(left.texts)]
    heads = right.head[:, 0]
    cap = np.iinfo(np.uint8).max
    for character, start, stop in zip(first.tolist(), starts.tolist(), stops):
        low, high = np.searchsorted(heads, character, "left"), np.searchsorted(heads, character, "right")
        for a in range(start, stop, _LEFT_ROWS):
            some = left.bits[:, a : min(a + _LEFT_ROWS, stop), None]
            for b in range(a if same_block else 0, len(heads), _RIGHT_ROWS):
                against = right.bits[:, None, b : b + _RIGHT_ROWS]
                differing = np.bitwise_count(some[0] ^ against[0])
                for w in range(1, len(some)):
                    differing += np.bitwise_count(some[w] ^ against[w])
                near = differing <= min(differ, cap)
                one, other = max(low - b, 0), max(high - b, 0)
                near[:, one:other] = differing[:, one:other] <= min(alike, cap)
                found = np.flatnonzero(near)
                if len(found):
                    x, y = np.divmod(found, near.shape[1])
                    x, y, bits = x + a, y + b, differing.ravel()[found]
                    keep = x < y if same_block else slice(None)
                    yield x[keep], y[keep], bits[keep].astype(np.int64)


def _matches_needed(threshold: float, prefix: np.ndarray, n: np.ndarray, m: np.ndarray):
    boost = PREFIX_WEIGHT * prefix
    jaro = (threshold - boost) / (1.0 - boost)
    return jaro, np.ceil((3 * jaro - 1) * n * m / (n + m) - _ROUNDING).astype(np.int64)


def _common_subsequence(left: Block, right: Block, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair, by the bit-vector recurrence of Crochemore,
    Iliopoulos, Pinzon and Reid ("A fast and practical bit-vector algorithm for the longest common
    subsequence problem", 2001): one step for each character of the right text, for all pairs at once.
    Characters that share a code can only make it longer."""
    words = len(left.places)
    rows = x * _CODES
    open_places = [np.full(len(x), ~np.uint64(0)) for _ in range(words)]
    for at in range(int(right.lengths[y].max())):
        entry = rows + right.codes[at][y]
        carry = None
        for w in range(words):
            before = open_places[w]
            hit = before & left.places[w][entry]
            total = before + hit
            # a carry out of one word goes into the next
            over = total < hit if w + 1 < words else None
            if carry is not None:
                total += carry
                if over is not None:
                    over |= total < carry
            open_places[w] = total | (before - hit)
            carry = None if over is None else over.astype(np.uint64)
    return 64 * words - sum(np.bitwise_count(w).astype(np.int64) for w in open_places)


def _may_qualify(left: Block, right: Block, x: np.ndarray, y: np.ndarray, differing: np.ndarray, threshold: float):
    n, m = left.lengths[x], right.lengths[y]
    same = (left.head[x] == right.head[y]) & (left.head[x] > 0)
    jaro, needed = _matches_needed(threshold, np.cumprod(same, axis=1).sum(axis=1), n, m)
    most = np.minimum((n + m - differing) // 2, np.minimum(n, m))
    keep = np.flatnonzero(most >= needed)
    if not len(keep):
        return x[keep], y[keep]
    x, y, n, m, jaro = x[keep], y[keep], n[keep], m[keep], jaro[keep]

    def of_same_rank(matches: np.ndarray) -> np.ndarray:
        return matches - 2 * matches * (matches / n + matches / m + 1 - 3 * jaro) - 1

    # concave in the number of matches, so that one of its ends is the least
    least = np.minimum(of_same_rank(np.maximum(needed[keep], 1)), of_same_rank(most[keep]))
    passed = _common_subsequence(left, right, x, y) >= least - 1e-6
    return x[passed], y[passed]


def close_pairs(left: Block, right: Block, threshold: float, same_block: bool = False):
    """Ids of the pairs of ``left`` and ``right`` that reach the threshold; within one block each pair once."""
    shape = (int(left.lengths.min()), int(left.lengths.max()), int(right.lengths.min()), int(right.lengths.max()))
    differ, alike = bits_allowed(threshold, 0, *shape), bits_allowed(threshold, PREFIX_CAP, *shape)
    if alike < 0:
        return
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n_waiting = 0

    def score():
        x, y, differing = (np.concatenate(part) for part in zip(*waiting))
        step = max(1, min(_PAIRS_AT_ONCE, _CHARACTERS_AT_ONCE // max(shape)))
        for at in range(0, len(x), step):
            part = slice(at, at + step)
            a, b = _may_qualify(left, right, x[part], y[part], differing[part], threshold)
            if len(a):
                scores = jaro_winkler([left.texts[i] for i in a], [right.texts[i] for i in b], PREFIX_WEIGHT)
                close = scores >= threshold - _ROUNDING
                yield left.ids[a[close]], right.ids[b[close]]

    for found in _near_bits(left, right, alike, differ, same_block):
        waiting.append(found)
        n_waiting += len(found[0])
        if n_waiting >= _PAIRS_AT_ONCE:
            yield from score()
            waiting, n_waiting = [], 0
    if waiting:
        yield from score()
