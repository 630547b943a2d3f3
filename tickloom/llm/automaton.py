"""Suffix automaton of several passages, built online, with matching statistics."""

from __future__ import annotations


class SuffixAutomaton:
    """Recognises every part of the passages added so far. State 0 is the start."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _clone(self, p: int, token, q: int) -> int:
        """A state for the shorter strings of q that also end elsewhere."""
        new = len(self.next)
        self.next.append(self.next[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, token) -> int:
        known = self.next[last].get(token)
        if known is not None:  # the passage so far is known already
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, token, known)
        state = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, token, q)
        return state

    def add(self, passage) -> None:
        last = 0
        for token in passage:
            last = self._extend(last, token)

    def matches(self, passage) -> list[int]:
        """For each place, the length of the longest known part that ends there."""
        out, state, n = [], 0, 0
        moves, link, length = self.next, self.link, self.length
        for token in passage:
            while state and token not in moves[state]:
                state = link[state]
                n = length[state]
            to = moves[state].get(token)
            if to is not None:
                state, n = to, n + 1
            out.append(n)
        return out
