"""Byte-pair merging of one string."""

from collections.abc import Callable
from heapq import heapify, heappop, heappush


def merged(symbols: list[str], rank: Callable[[str, str], float | None]) -> list[str]:
    """Merge the adjacent pair of lowest rank, the leftmost of equals, until no pair has a rank. O(n log n)."""
    symbols, n = list(symbols), len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank(symbols[i], symbols[i + 1])) is not None]
    heapify(heap)
    while heap:
        _, i, left, right = heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = left + right, ""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank(symbols[i], symbols[k])) is not None:
                heappush(heap, (r, i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (r := rank(symbols[h], symbols[i])) is not None:
            heappush(heap, (r, h, symbols[h], symbols[i]))
    return [s for s in symbols if s]
