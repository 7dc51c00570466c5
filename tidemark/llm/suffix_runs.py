"""Sorted runs of strings, front-coded, and their merge by an LCP loser tree."""

from collections.abc import Iterator

import numpy as np


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    most = min(len(a), len(b))
    at = start
    while at < most and a[at : at + 32] == b[at : at + 32]:
        at += 32
    while at < most and a[at] == b[at]:
        at += 1
    return min(at, most)


def common_in_order(strings: list[bytes]) -> np.ndarray:
    """Common prefix of each sorted string with the one before it (0 for the first)."""
    found = np.zeros(len(strings), np.int32)
    width = max(map(len, strings), default=0)
    for begin in range(0, len(strings) - 1 if width else 0, 4_096):
        part = strings[begin : begin + 4_097]
        grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in part), np.uint8).reshape(len(part), width)
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(1), differ.argmax(1), width)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        found[begin + 1 : begin + len(part)] = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
    return found


def front_coded(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Common prefixes, lengths of the rest (16 bits each) and the rests of sorted strings."""
    shared = common_in_order(strings)
    rest = [s[k:] for s, k in zip(strings, shared.tolist())]
    sizes = np.fromiter(map(len, rest), np.uint16, len(rest))
    return shared.astype(np.uint16).tobytes(), sizes.tobytes(), b"".join(rest)


def decoded(shared: bytes, sizes: bytes, rest: bytes) -> Iterator[tuple[int, bytes]]:
    """(common prefix with the string before, string) of a front-coded run."""
    last, at = b"", 0
    for k, size in zip(np.frombuffer(shared, np.uint16).tolist(), np.frombuffer(sizes, np.uint16).tolist()):
        last = last[:k] + rest[at : at + size]
        at += size
        yield k, last


class LoserTree:
    """Merges sorted runs of (common prefix, string).

    A node holds the loser of its match and the prefix it has in common with the
    string that beat it. What is known is never compared again: of two candidates
    the one that shares more with the last output is the smaller, and only if both
    share as much are they compared, from there on.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        self.runs = runs
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.head: list[bytes | None] = [None] * self.size
        self.shared = [-1] * self.size  # an ended run loses against all
        for r, run in enumerate(runs):
            _, self.head[r] = next(run, (0, None))
            self.shared[r] = -1 if self.head[r] is None else 0
        self.loser = [-1] * self.size
        winners = list(range(self.size))
        level = self.size
        while level > 1:
            level //= 2
            winners = [self._match(level + k, winners[2 * k], winners[2 * k + 1]) for k in range(level)]
        self.winner = winners[0]

    def _match(self, node: int, a: int, b: int) -> int:
        shared = self.shared
        if shared[a] == shared[b] and shared[a] >= 0:
            x, y = self.head[a], self.head[b]
            at = common(x, y, shared[a])
            if x[at : at + 1] > y[at : at + 1]:
                a, b = b, a
            shared[b] = at
        elif shared[b] > shared[a]:
            a, b = b, a
        self.loser[node] = b
        return a

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        """(common prefix with the output before, string, run)."""
        while self.head[self.winner] is not None:
            w = self.winner
            yield self.shared[w], self.head[w], w
            self.shared[w], self.head[w] = next(self.runs[w], (-1, None))
            node = (self.size + w) // 2
            while node:
                w = self._match(node, w, self.loser[node])
                node //= 2
            self.winner = w
