"""A generalised suffix automaton over words, and matching statistics against it."""

from __future__ import annotations

from collections.abc import Hashable, Iterable


class SuffixAutomaton:
    """Accepts every substring of the sequences added so far.

    A separator that equals no word stands between sequences, so no match runs
    across two of them. Adding n words takes O(n) states and amortised steps.
    """

    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.last, self.separators = 0, 0

    def _append(self, symbol: Hashable) -> None:
        steps, link, length = self.next, self.link, self.length
        new = len(steps)
        steps.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        at = self.last
        while at >= 0 and symbol not in steps[at]:
            steps[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = steps[at][symbol]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(steps)
                steps.append(dict(steps[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and steps[at].get(symbol) == to:
                    steps[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        self.last = new

    def add(self, words: Iterable[Hashable]) -> None:
        """One more reference sequence; words are not integers, as separators are."""
        for word in words:
            self._append(word)
        self.separators += 1
        self._append(self.separators)

    def statistics(self, words: Iterable[Hashable]) -> list[int]:
        """For each word the length of the longest match that ends with it."""
        steps, link, length = self.next, self.link, self.length
        at, held, out = 0, 0, []
        for word in words:
            while at and word not in steps[at]:
                at = link[at]
                held = length[at]
            if word in steps[at]:
                at = steps[at][word]
                held += 1
            else:
                held = 0
            out.append(held)
        return out
