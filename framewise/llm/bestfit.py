"""Best-fit decreasing over counts of equal pieces.

Pieces are integers from 1 to the capacity, so there are at most ``capacity`` different ones, and
open windows differ in what is left in them only. Equal pieces go into equal windows, many at a
time: the plan has one rule for each such step, its size depends on the capacity and not on how
many pieces there are, and it places every piece as one-at-a-time best-fit decreasing does.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """Pieces ``first .. first + pieces - 1`` among those of one length, ``each`` to a window."""

    length: int
    first: int
    pieces: int
    each: int
    window: int
    offset: int


class CapacityTree:
    """A segment tree over what is left in windows: which remainders have an open window."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self._used = [0] * (2 * self.leaves)
        self._runs: list[list[tuple[int, int]]] = [[] for _ in range(self.leaves)]

    def add(self, left: int, window: int, count: int) -> None:
        """``count`` windows from number ``window`` on have room for ``left`` more."""
        if count and left:
            self._runs[left].append((window, count))
            self._mark(left)

    def take(self, left: int) -> tuple[int, int]:
        run = self._runs[left].pop()
        self._mark(left)
        return run

    def tightest(self, length: int) -> int | None:
        """The smallest remainder of at least ``length`` that an open window has."""
        node = self.leaves + length
        if self._used[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self._used[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self._used[2 * node])
                return node - self.leaves
            node //= 2
        return None

    def _mark(self, left: int) -> None:
        node, used = self.leaves + left, int(bool(self._runs[left]))
        while node and self._used[node] != used:
            self._used[node] = used
            node //= 2
            used = int(self._used[2 * node] or self._used[2 * node + 1]) if node else 0


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Rule], int]:
    """Rules for ``counts[length]`` pieces of each length, and the number of windows."""
    tree, rules, windows = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        waiting, placed = counts[length], 0
        while waiting:
            left = tree.tightest(length)
            if left is None:
                left = capacity
                window, count = windows, -(-waiting // (capacity // length))
                windows += count
            else:
                window, count = tree.take(left)
            each = left // length
            full = min(count, waiting // each)
            if full:
                rules.append(Rule(length, placed, full * each, each, window, capacity - left))
                tree.add(left - each * length, window, full)
                placed, waiting = placed + full * each, waiting - full * each
            if waiting and full < count:
                rules.append(Rule(length, placed, waiting, waiting, window + full, capacity - left))
                tree.add(left - waiting * length, window + full, 1)
                tree.add(left, window + full + 1, count - full - 1)
                placed, waiting = placed + waiting, 0
            elif full < count:
                tree.add(left, window + full, count - full)
    return rules, windows
