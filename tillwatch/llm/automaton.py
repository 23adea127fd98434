"""A suffix automaton over words that grows text by text."""

from __future__ import annotations


class SuffixAutomaton:
    """All runs of words of the texts added so far."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _state(self, size: int, arcs: dict[int, int], link: int) -> int:
        self.next.append(arcs)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A copy of state q for the runs no longer than p's with the word after them."""
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # known from an earlier text
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, q, word)
                continue
            new = self._state(self.size[last] + 1, {}, 0)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, word)
            last = new

    def matches(self, words: list[int]) -> list[int]:
        """For each word, how long a run that ends with it the automaton holds."""
        out, state, size = [], 0, 0
        arcs, link, sizes = self.next, self.link, self.size
        for word in words:
            to = arcs[state].get(word)
            while to is None and state:
                state = link[state]
                size = sizes[state]
                to = arcs[state].get(word)
            if to is not None:
                state, size = to, size + 1
            out.append(size)
        return out
