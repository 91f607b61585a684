"""Suffix automaton of a set of words: which of them end at each place of a text.

A state stands for all strings that end at the same places of the words; its link leads to the longest suffix that ends at
more of them. Nothing can stand before a whole word where the word itself ends, so a word is the longest string of its state,
and the words that end at a place of a text are found on the links from the state that the text has led to. States keep
the nearest such word, words the next shorter one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    """Automaton of `words`, pairs of bytes and a number. Equal words: the last one's number counts. Memory follows the
    number of distinct substrings' states, at most twice the bytes of all words."""

    def __init__(self, words: Iterable[tuple[bytes, int]]):
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        number: dict[int, int] = {}
        ends: list[tuple[bytes, int]] = []
        for word, value in words:
            if word:
                self._add(word)
                ends.append((word, value))
        # later words split states, so the words' own states are looked up when all are in
        for word, value in ends:
            state = 0
            for c in word:
                state = self.go[state][c]
            number[state] = value
        # links lead to shorter strings, so the nearest word of a link is known first
        self.nearest: list[tuple | None] = [None] * len(self.go)
        for state in sorted(range(1, len(self.go)), key=self.length.__getitem__):
            shorter = self.nearest[self.link[state]]
            self.nearest[state] = (self.length[state], number[state], shorter) if state in number else shorter

    def _state(self, length: int, go: dict[int, int], link: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.length.append(length)
        return len(self.go) - 1

    def _split(self, before: int, c: int) -> int:
        """The state of the string of `before` and c alone, apart from the longer ones it shared a state with."""
        go, link, shared = self.go, self.link, self.go[before][c]
        if self.length[shared] == self.length[before] + 1:
            return shared
        own = self._state(self.length[before] + 1, dict(go[shared]), link[shared])
        link[shared] = own
        while before >= 0 and go[before].get(c) == shared:
            go[before][c] = own
            before = link[before]
        return own

    def _add(self, word: bytes) -> None:
        go, link, last = self.go, self.link, 0
        for c in word:
            if c in go[last]:
                last = self._split(last, c)
                continue
            new, before = self._state(self.length[last] + 1, {}, 0), last
            while before >= 0 and c not in go[before]:
                go[before][c] = new
                before = link[before]
            if before >= 0:
                link[new] = self._split(before, c)
            last = new

    def ends(self, text: bytes) -> Iterator[tuple | None]:
        """For every prefix of text, its longest word at the end as (length, number, the next shorter one), or None."""
        go, link, length, nearest = self.go, self.link, self.length, self.nearest
        state = matched = 0
        for c in text:
            while state and c not in go[state]:
                state = link[state]
                matched = length[state]
            to = go[state].get(c)
            if to is None:
                yield None
                continue
            state, matched = to, matched + 1
            # shorter than its state's longest string: words begin at the link
            yield nearest[state if matched == length[state] else link[state]]
