"""Sorted runs of strings, front-coded for the exchange, and their merge by a loser tree that knows common prefixes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings of which ``known`` bytes are equal."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n
    while high - low > 16:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    while low < high and a[low] == b[low]:
        low += 1
    return low


def coded(strings: Sequence[bytes]) -> tuple[bytes, bytes, bytes]:
    """Prefix lengths, rest lengths and rests of strings in rising order."""
    prefix, rest, blob, before = [], [], [], b""
    for string in strings:
        n = common(before, string)
        prefix.append(n)
        rest.append(len(string) - n)
        blob.append(string[n:])
        before = string
    return np.array(prefix, "<u4").tobytes(), np.array(rest, "<u4").tobytes(), b"".join(blob)


def decoded(prefix: bytes, rest: bytes, blob: bytes) -> Iterator[tuple[int, bytes]]:
    """Each string of a run with the length of the prefix it shares with the one before."""
    at, before = 0, b""
    for n, more in zip(np.frombuffer(prefix, "<u4").tolist(), np.frombuffer(rest, "<u4").tolist()):
        before = before[:n] + blob[at : at + more]
        at += more
        yield n, before


def merged(runs: Sequence[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """All strings in rising order: run, length of the prefix shared with the string put out before, string.

    Each contender knows how much it shares with the last string put out. Of two, the one that shares more is the smaller;
    only at equal lengths are bytes compared, and only those beyond the known prefix. The loser keeps the length it
    shares with the winner.
    """
    size = 1
    while size < len(runs):
        size *= 2
    strings: list[bytes | None] = [None] * size
    shared = [0] * size
    for i, run in enumerate(runs):
        first = next(run, None)
        strings[i] = first[1] if first else None

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = strings[a], strings[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        n = common(x, y, shared[a])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    losers = [0] * size
    level = list(range(size))
    base = size // 2
    while len(level) > 1:
        winners = []
        for i in range(0, len(level), 2):
            won, lost = play(level[i], level[i + 1])
            losers[base + i // 2] = lost
            winners.append(won)
        level, base = winners, base // 2
    top = level[0]
    while strings[top] is not None:
        yield top, shared[top], strings[top]
        following = next(runs[top], None) if top < len(runs) else None
        strings[top], shared[top] = (following[1], following[0]) if following else (None, 0)
        node = (top + size) // 2
        while node:
            won, lost = play(top, losers[node])
            losers[node], top = lost, won
            node //= 2
