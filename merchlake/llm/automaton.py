"""Suffix automata over words, and matching statistics of a text against them."""

from __future__ import annotations


class SuffixAutomaton:
    """All word runs of some texts. Words of one text never run into the next text."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[bytes]) -> None:
        """Takes a text in; runs that are known already add no states."""
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _extend(self, last: int, word: bytes) -> int:
        moves, link, length = self.next, self.link, self.length
        known = moves[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, word, known)
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and word not in moves[p]:
            moves[p][word] = state
            p = link[p]
        if p != -1:
            q = moves[p][word]
            link[state] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return state

    def _split(self, p: int, word: bytes, q: int) -> int:
        """A copy of q for its shorter runs only, those that end p's runs with the word."""
        moves, link = self.next, self.link
        copy = len(moves)
        moves.append(dict(moves[q]))
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        link[q] = copy
        while p != -1 and moves[p].get(word) == q:
            moves[p][word] = copy
            p = link[p]
        return copy

    def matches(self, words: list[bytes]) -> list[int]:
        """Matching statistics: for each word, the longest run ending there that the texts hold."""
        moves, link, length = self.next, self.link, self.length
        state = size = 0
        found = []
        for word in words:
            step = moves[state].get(word)
            while step is None and state:
                state = link[state]
                size = length[state]
                step = moves[state].get(word)
            if step is None:
                size = 0
            else:
                state = step
                size += 1
            found.append(size)
        return found


def spans(matches: list[int], least: int) -> list[tuple[int, int]]:
    """Maximal [start, end) ranges of words covered by runs of ``least`` matched words or more."""
    found: list[tuple[int, int]] = []
    for end, size in enumerate(matches, 1):
        if size >= least:
            start = end - size
            if found and start <= found[-1][1]:
                found[-1] = (min(found[-1][0], start), end)
            else:
                found.append((start, end))
    return found
