"""Greedy pair merging (BPE) by rank: the reference procedure that the tokenizer operators prove their shortcuts with."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from itertools import pairwise

SHORT = 64
NONE = float("inf")


def merge(symbols: Sequence[str], rank: Callable[[tuple[str, str], float], float]) -> list[str]:
    """Merge adjacent symbols, the pair of lowest rank first and the leftmost one among equals, until none has a rank.

    ``rank(pair, default)`` is like ``dict.get``. Short inputs keep a list of ranks; long ones keep a heap over a linked
    list, so a word of 100,000 characters takes O(n log n).
    """
    parts = list(symbols)
    if len(parts) > SHORT:
        return _merge_long(parts, rank)
    ranks = [rank(p, NONE) for p in pairwise(parts)]
    while ranks:
        best = min(ranks)
        if best == NONE:
            break
        at = ranks.index(best)
        both = parts[at] + parts[at + 1]
        parts[at:at + 2] = [both]
        del ranks[at]
        if at:
            ranks[at - 1] = rank((parts[at - 1], both), NONE)
        if at < len(ranks):
            ranks[at] = rank((both, parts[at + 1]), NONE)
    return parts


def _merge_long(parts: list[str], rank: Callable[[tuple[str, str], float], float]) -> list[str]:
    n = len(parts)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive: list[str | None] = list(parts)
    heap: list[tuple[float, int, int, str, str]] = []

    def offer(i: int, j: int) -> None:
        if 0 <= i and j < n and (r := rank((alive[i], alive[j]), NONE)) != NONE:
            heapq.heappush(heap, (r, i, j, alive[i], alive[j]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, a, b = heapq.heappop(heap)
        if alive[i] != a or alive[j] != b or right[i] != j:
            continue
        alive[i], alive[j] = a + b, None
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        offer(left[i], i)
        offer(i, right[i])
    return [p for p in alive if p is not None]
