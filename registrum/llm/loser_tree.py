"""K-way merging by loser trees.

`merge` orders items by a key. `merge_front_coded` merges sorted runs of byte strings and knows, for
every waiting string, how long a prefix it shares with the last string given out; two strings whose
known prefixes differ in length are ordered without looking at a byte, others are compared from the end
of their known prefix on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any


def merge(runs: list[Iterable], key: Callable[[Any], Any]) -> Iterator[tuple[int, Any]]:
    """(run, item) in key order; equal keys in order of their runs. Each run is sorted."""
    sources = [iter(r) for r in runs]
    n = len(sources)
    if not n:
        return
    heads: list[tuple | None] = []
    for i, s in enumerate(sources):
        item = next(s, None)
        heads.append(None if item is None else (key(item), i, item))

    def wins(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    losers, winner = _build(n, wins)
    while heads[winner] is not None:
        _, run, item = heads[winner]
        yield run, item
        item = next(sources[run], None)
        heads[run] = None if item is None else (key(item), run, item)
        node, winner = (winner + n) >> 1, run
        while node:
            if wins(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node >>= 1


def _build(n: int, wins: Callable[[int, int], bool]) -> tuple[list[int], int]:
    """Play all matches once: node i > 0 keeps its loser; leaf r is node n + r."""
    losers = [0] * n
    best = [0] * n + list(range(n))
    for node in range(n - 1, 0, -1):
        a, b = best[2 * node], best[2 * node + 1]
        best[node], losers[node] = (a, b) if wins(a, b) else (b, a)
    return losers, best[1] if n > 1 else 0


def shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b, of which `at` bytes are known to agree."""
    end = min(len(a), len(b))
    while at < end:
        step = min(8, end - at)
        x, y = a[at : at + step], b[at : at + step]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return at + step - (differ.bit_length() + 7) // 8
        at += step
    return end


def merge_front_coded(runs: list[Iterable[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """(prefix shared with the string before, run, rest of the string) in order of the strings.

    A run gives (prefix shared with the run's string before, rest). What comes out is front-coded too.
    """
    sources = [iter(r) for r in runs]
    n = len(sources)
    texts: list[bytes | None] = [None] * n
    known = [0] * n  # shared with the last string given out, for strings that lost only to it

    def pull(run: int) -> None:
        item = next(sources[run], None)
        if item is None:
            texts[run] = None
        else:
            known[run], rest = item
            texts[run] = texts[run][: known[run]] + rest if known[run] else rest  # type: ignore[index]

    def wins(a: int, b: int) -> bool:
        """Whether a comes first; the loser's known prefix becomes the one shared with the winner."""
        x, y = texts[a], texts[b]
        if x is None or y is None:
            return x is not None
        if known[a] != known[b]:
            return known[a] > known[b]  # the loser's prefix is as long with the winner as with the last
        at = shared(x, y, known[a])
        first = len(x) == at or (len(y) > at and x[at] < y[at])
        if len(x) == at == len(y):
            first = a < b
        known[b if first else a] = at
        return first

    for r in range(n):
        pull(r)
    if not n:
        return
    losers, winner = _build(n, wins)
    while (text := texts[winner]) is not None:
        yield known[winner], winner, text[known[winner] :]
        run = winner
        pull(run)
        node = (run + n) >> 1
        while node:
            if wins(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node >>= 1
