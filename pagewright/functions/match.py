"""difflib's matching blocks without junk, the same ones, for long texts too: stretches are looked for whole, not character by character."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Areas of more pairs of characters than this are searched by hashes of their stretches.
WIDE = 1 << 22
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse


def _length(a: str, b: str, area: tuple[int, int, int, int]) -> int:
    """Length of the longest stretch that both have; a's part is the shorter."""
    a0, a1, b0, b1 = area
    best = 0
    for i in range(a0, a1):
        if a1 - i <= best:
            break
        j = b.find(a[i : i + best + 1], b0, b1)
        while j >= 0:
            best += 1
            while i + best < a1 and j + best < b1 and a[i + best] == b[j + best]:
                best += 1
            j = b.find(a[i : i + best + 1], j, b1) if i + best < a1 else -1
    return best


class Pair:
    """Two texts whose longest common stretches are asked for, area by area."""

    def __init__(self, a: str, b: str):
        self.a, self.b = a, b
        self.sums: list[np.ndarray] = []

    def _windows(self, which: int, start: int, stop: int, n: int) -> np.ndarray:
        """Hashes of all stretches of n characters within start and stop."""
        if not self.sums:
            most = max(len(self.a), len(self.b)) + 1
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(most, x, np.uint64)])) for x in (_STEP, pow(_STEP, -1, 1 << 64)))
            for text in (self.a, self.b):
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
                self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * self.up[: len(codes)])]))
        s = self.sums[which]
        return (s[start + n : stop + 1] - s[start : stop - n + 1]) * self.down[start : stop - n + 1]

    def _first(self, area: tuple[int, int, int, int], n: int) -> int:
        """Where a's first stretch of n characters begins that b has too, or -1."""
        a0, a1, b0, b1 = area
        mine = self._windows(0, a0, a1, n)
        for i in np.flatnonzero(np.isin(mine, self._windows(1, b0, b1, n))).tolist():
            if self.b.find(self.a[a0 + i : a0 + i + n], b0, b1) >= 0:
                return a0 + i
        return -1

    def longest(self, area: tuple[int, int, int, int]) -> tuple[int, int, int]:
        """(i, j, n) of the longest common stretch; of equals the first in a, then in b, as find_longest_match() gives it."""
        a, b = self.a, self.b
        a0, a1, b0, b1 = area
        n_a, n_b = a1 - a0, b1 - b0
        if n_a * n_b > WIDE:
            low, high, i = 0, 8, a0
            while high <= min(n_a, n_b) and (found := self._first(area, high)) >= 0:
                low, high, i = high, 2 * high, found
            high = min(high, min(n_a, n_b) + 1)
            while high - low > 1:
                middle = (low + high) // 2
                found = self._first(area, middle)
                low, high, i = (middle, high, found) if found >= 0 else (low, middle, i)
            n = low
        elif n_a <= n_b:
            n = _length(a, b, area)
            i = next((i for i in range(a0, a1 - n + 1) if b.find(a[i : i + n], b0, b1) >= 0), a0) if n else a0
        else:
            n = _length(b, a, (b0, b1, a0, a1))
            i = min((x for x in (a.find(b[j : j + n], a0, a1) for j in range(b0, b1 - n + 1)) if x >= 0), default=a0) if n else a0
        return (i, b.find(a[i : i + n], b0, b1), n) if n else (a0, b0, 0)


def blocks(a: str, b: str) -> Iterator[tuple[int, int, int, int]]:
    """(i, j, n, left) of each matching block, the longest of an area first; left: characters that what is still to be searched may add at most."""
    pair, areas, left = Pair(a, b), [(0, len(a), 0, len(b))], min(len(a), len(b))
    while areas:
        area = areas.pop()
        a0, a1, b0, b1 = area
        left -= min(a1 - a0, b1 - b0)
        i, j, n = pair.longest(area)
        if n:
            for part in ((a0, i, b0, j), (i + n, a1, j + n, b1)):
                if (size := min(part[1] - part[0], part[3] - part[2])) > 0:
                    left += size
                    areas.append(part)
        yield i, j, n, left


@lru_cache(maxsize=256)
def _places(text: str) -> dict[str, int]:
    """Where a text has each of its characters, as bits."""
    out: dict[str, int] = {}
    for k, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << k
    return out


def in_order(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel: matching blocks are one, so they never have more characters."""
    places, full = _places(a), (1 << len(a)) - 1
    left = full
    for c in b:
        met = left & places.get(c, 0)
        if met:
            left = ((left + met) | (left - met)) & full
    return len(a) - left.bit_count()


def _may_reach(a: str, b: str, least: float) -> bool:
    """False if texts cannot have `least` characters in matching blocks, by their lengths, characters and, of similar lengths, their order."""
    short, long = sorted((len(a), len(b)))
    if short < least or sum((Counter(a) & Counter(b)).values()) < least:
        return False
    return long > 4 * short or short * long > WIDE or in_order(a, b) >= least


def matched_from(a: str, b: str, least: float) -> int:
    """Characters in matching blocks, 0 if they are fewer than `least`. Given up as soon as what is left cannot lift them so far."""
    if not _may_reach(a, b, least):
        return 0
    matched = 0
    for _, _, n, left in blocks(a, b):
        matched += n
        if matched + left < least:
            return 0
    return matched


def reaches(a: str, b: str, least: float) -> bool:
    """Whether `least` characters are in matching blocks."""
    if not _may_reach(a, b, least):
        return False
    matched = 0
    for _, _, n, left in blocks(a, b):
        matched += n
        if matched >= least or matched + left < least:
            break
    return matched >= least


def matching_blocks(a: str, b: str) -> list[tuple[int, int, int]]:
    """get_matching_blocks(): (i, j, n) in order, adjacent ones as one, the last one empty at both ends."""
    out: list[tuple[int, int, int]] = []
    for i, j, n in sorted((i, j, n) for i, j, n, _ in blocks(a, b) if n):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            i, j, n = out[-1][0], out[-1][1], out.pop()[2] + n
        out.append((i, j, n))
    return [*out, (len(a), len(b), 0)]
