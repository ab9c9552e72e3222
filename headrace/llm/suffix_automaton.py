"""A suffix automaton of many word sequences, each counted as often as it occurs."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """All substrings of the sequences added, with the number of places each of them occurs at.

    States are numbers. ``reach`` is the length of a state's longest string, ``link`` the state of the
    longest suffix that occurs at more places, ``places`` how many places a state's strings end at.
    """

    def __init__(self) -> None:
        self.step: list[dict[Hashable, int]] = [{}]
        self.link = [-1]
        self.reach = [0]
        self.places = [0]
        self._often: list[int] = []

    def __len__(self) -> int:
        return len(self.step)

    def _state(self, step: dict[Hashable, int], link: int, reach: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.reach.append(reach)
        self.places.append(0)
        return len(self.step) - 1

    def _split(self, at: int, word: Hashable, target: int) -> int:
        """A state for the strings of ``target`` that are no longer than what leads there from ``at``."""
        step, link = self.step, self.link
        twin = self._state(dict(step[target]), link[target], self.reach[at] + 1)
        link[target] = twin
        while at != -1 and step[at].get(word) == target:
            step[at][word] = twin
            at = link[at]
        return twin

    def add(self, words: Iterable[Hashable], times: int = 1) -> None:
        """Add a sequence that occurs ``times`` times; strings do not run from one sequence into another."""
        step, link, reach = self.step, self.link, self.reach
        last = 0
        for word in words:
            target = step[last].get(word)
            if target is not None:  # known from an earlier sequence
                last = target if reach[target] == reach[last] + 1 else self._split(last, word, target)
            else:
                at, last = last, self._state({}, 0, reach[last] + 1)
                while at != -1 and word not in step[at]:
                    step[at][word] = last
                    at = link[at]
                if at != -1:
                    target = step[at][word]
                    link[last] = target if reach[target] == reach[at] + 1 else self._split(at, word, target)
            self.places[last] += times

    def count(self, least: int = 2) -> None:
        """Sum up places once all is added; ``least`` is how often a string must occur to match."""
        order = sorted(range(1, len(self)), key=self.reach.__getitem__, reverse=True)
        for state in order:
            if self.link[state] > 0:
                self.places[self.link[state]] += self.places[state]
        self._often = [0] * len(self)  # the nearest state up the links that occurs often enough
        for state in reversed(order):
            self._often[state] = state if self.places[state] >= least else self._often[self.link[state]]

    def matching(self, words: Sequence[Hashable]) -> list[int]:
        """Matching statistics: per place, how many words up to it occur ``least`` times or more."""
        step, link, reach, often = self.step, self.link, self.reach, self._often
        state, length, found = 0, 0, []
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                length = reach[state]
            target = step[state].get(word)
            if target is not None:
                state, length = target, length + 1
            near = often[state]
            found.append(length if near == state else reach[near])
        return found
