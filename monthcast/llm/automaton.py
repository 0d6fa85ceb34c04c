"""A generalised suffix automaton over integer symbols, in memory bounded by
the strings that are added (at most two states a symbol)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class SuffixAutomaton:
    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, to: dict[int, int]) -> int:
        self.next.append(to)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for its strings of up to ``length[p] + 1`` symbols."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def extend(self, last: int, c: int) -> int:
        """The state of the string at ``last`` with ``c`` appended."""
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        p, link = last, self.link
        new = self._state(self.length[last] + 1, 0, {})
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def add(self, symbols: Sequence[int]) -> Iterator[int]:
        """Add a string; the state after each symbol."""
        last = 0
        for c in symbols:
            last = self.extend(last, c)
            yield last

    def statistics(self, symbols: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(state, match length) after each symbol: the longest run ending
        there that stands in an added string."""
        to, link, length = self.next, self.link, self.length
        v, n = 0, 0
        for c in symbols:
            w = to[v].get(c)
            while w is None and v:
                v = link[v]
                n = length[v]
                w = to[v].get(c)
            v, n = (w, n + 1) if w is not None else (0, 0)
            yield v, n
