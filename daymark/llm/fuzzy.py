"""A lexicon trie intersected with Levenshtein automata, made deterministic as words arrive."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

# Deterministic states kept before the tables are started anew.
MOST_STATES = 100_000


class Term(NamedTuple):
    text: str
    prefix: bool  # whether any continuation counts


def edits_allowed(term: Term) -> int:
    """Short terms must be exact; a stem may only be misspelled if it is long."""
    n = len(term.text)
    if term.prefix:
        return 1 if n >= 7 else 0
    return 2 if n >= 9 else 1 if n >= 5 else 0


class Lexicon:
    """Finds the term nearest to a word, within the term's own edit distance.

    A state of the product automaton is a set of (trie node, edits so far); a step on
    a letter follows the trie (match or substitution), stays (a letter too many) or
    skips trie letters (letters missing). Sets become numbered states when first met,
    so a word costs one table look-up per letter, and most words end in the dead state
    after three or four.
    """

    def __init__(self, terms: Iterable[Term]):
        self.terms = list(terms)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]  # most edits any term below a node allows
        for k, term in enumerate(self.terms):
            node, allowed = 0, edits_allowed(term)
            self.reach[0] = max(self.reach[0], allowed)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], allowed)
            self.ends[node].append(k)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.best: list[tuple[int, int] | None] = []
        self.first = self._state({(0, 0)}, frozenset())

    def _state(self, places: set[tuple[int, int]], held: frozenset) -> int:
        """The number of the state of these places, closed under missing letters."""
        least: dict[int, int] = {}
        todo = sorted(places, key=lambda p: p[1])
        while todo:
            node, edits = todo.pop()
            if edits > self.reach[node] or least.get(node, 99) <= edits:
                continue
            least[node] = edits
            todo += [(child, edits + 1) for child in self.children[node].values()]
        accepted = {}
        for node, edits in least.items():
            for k in self.ends[node]:
                if edits <= edits_allowed(self.terms[k]):
                    accepted[k] = edits
        kept = dict(held)
        for k, edits in accepted.items():
            if self.terms[k].prefix:
                kept[k] = min(edits, kept.get(k, 99))
        held = frozenset(kept.items())
        key = (frozenset(least.items()), held)
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append((least, held))
            self.steps.append({})
            found = {**accepted, **kept}
            self.best.append(min(((e, k) for k, e in found.items()), default=None))
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        least, held = self.sets[state]
        if not least:
            following = state
        else:
            places = set()
            for node, edits in least.items():
                places.add((node, edits + 1))
                for c, child in self.children[node].items():
                    places.add((child, edits + (c != letter)))
            following = self._state(places, held)
        self.steps[state][letter] = following
        return following

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, number of the term) nearest to the word, or None."""
        if len(self.sets) > MOST_STATES:
            self._reset()
        state, steps = self.first, self.steps
        for letter in word:
            following = steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if not self.sets[state][0]:
                break
        return self.best[state]
