"""Byte automata: regular expressions to minimal transition arrays."""

from __future__ import annotations

import re
from collections import deque

import numpy as np

_parser, _codes = re._parser, re._constants


def _either_case(mask: int) -> int:
    for low in range(97, 123):
        if mask >> low & 1 or mask >> (low - 32) & 1:
            mask |= 1 << low | 1 << (low - 32)
    return mask


class Nfa:
    """States with empty moves and moves on byte sets (256-bit masks)."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, pattern: str, at: int, backwards: bool = False, fold: bool = False) -> int:
        """Add a pattern over ASCII from a state; ``backwards`` reads its strings from their ends."""
        self.backwards, self.fold = backwards, fold
        return self._sequence(_parser.parse(pattern, re.ASCII), at)

    def _on(self, at: int, mask: int) -> int:
        to = self.state()
        self.moves[at].append((_either_case(mask) if self.fold else mask, to))
        return to

    def _set(self, items) -> int:
        mask, negated = 0, False
        for code, value in items:
            if code is _codes.NEGATE:
                negated = True
            elif code is _codes.LITERAL:
                mask |= 1 << value
            elif code is _codes.RANGE:
                mask |= sum(1 << b for b in range(value[0], value[1] + 1))
            else:
                raise ValueError(f"not supported in a set: {code}")
        return mask ^ (1 << 256) - 1 if negated else mask

    def _sequence(self, items, at: int) -> int:
        for code, value in reversed(list(items)) if self.backwards else items:
            if code is _codes.LITERAL:
                at = self._on(at, 1 << value)
            elif code is _codes.IN:
                at = self._on(at, self._set(value))
            elif code is _codes.SUBPATTERN:
                at = self._sequence(value[3], at)
            elif code is _codes.BRANCH:
                end = self.state()
                for branch in value[1]:
                    begin = self.state()
                    self.empty[at].append(begin)
                    self.empty[self._sequence(branch, begin)].append(end)
                at = end
            elif code is _codes.MAX_REPEAT:
                least, most, inner = value
                for _ in range(least):
                    at = self._sequence(inner, at)
                if most is _codes.MAXREPEAT:
                    loop = self.state()
                    self.empty[at].append(loop)
                    self.empty[self._sequence(inner, loop)].append(loop)
                    at = loop
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.empty[at].append(end)
                        at = self._sequence(inner, at)
                    self.empty[at].append(end)
                    at = end
            else:
                raise ValueError(f"not supported: {code}")
        return at

    def closure(self, states) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for to in self.empty[stack.pop()]:
                if to not in seen:
                    seen.add(to)
                    stack.append(to)
        return frozenset(seen)


class Dfa:
    """Minimal transition arrays of an automaton.

    ``moves[state * 256 + byte]`` is the next state times 256. Accepting states
    have the highest numbers, from ``edge`` on; ``accepts[state]`` has a bit for
    each end state reached. ``anywhere`` lets a match begin at any byte.
    """

    def __init__(self, nfa: Nfa, start: int, ends: list[int], anywhere: bool) -> None:
        masks = sorted({m for moves in nfa.moves for m, _ in moves})
        kinds: dict[tuple, list[int]] = {}
        for byte in range(256):
            kinds.setdefault(tuple(m >> byte & 1 for m in masks), []).append(byte)
        classes = list(kinds.values())
        first = nfa.closure([start])
        again = first if anywhere else frozenset()
        number, rows, queue = {first: 0}, [], deque([first])
        while queue:
            states = queue.popleft()
            row = []
            for members in classes:
                to = nfa.closure([t for s in states for m, t in nfa.moves[s] if m >> members[0] & 1]) | again
                if to not in number:
                    number[to] = len(number)
                    queue.append(to)
                row.append(number[to])
            rows.append(row)
        moves = np.array(rows)
        accepts = np.array([sum(1 << k for k, e in enumerate(ends) if e in s) for s in number], dtype=object)
        part = np.unique(accepts.astype(str), return_inverse=True)[1]
        while True:  # states stay together while all their moves lead to the same parts
            finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == part.max():
                break
            part = finer
        chosen = [int(np.flatnonzero(part == p)[0]) for p in range(part.max() + 1)]
        order = sorted(range(len(chosen)), key=lambda p: accepts[chosen[p]] != 0)
        place = np.empty(len(order), dtype=int)
        place[order] = np.arange(len(order))
        self.start = int(place[part[0]]) * 256
        self.accepts = [int(accepts[chosen[p]]) for p in order]
        self.edge = 256 * sum(a == 0 for a in self.accepts)
        table = np.empty((len(order), 256), dtype=int)
        for k, members in enumerate(classes):
            table[:, members] = place[part[moves[[chosen[p] for p in order], k]]][:, None] * 256
        self.moves = table.ravel().tolist()

    def longest(self, data: bytes, at: int) -> int:
        """The end of the longest match that begins at a byte, or -1."""
        state, found, edge, moves = self.start, at if self.start >= self.edge else -1, self.edge, self.moves
        dead = self.dead
        for i in range(at, len(data)):
            state = moves[state + data[i]]
            if state >= edge:
                found = i + 1
            elif state == dead:
                break
        return found

    @property
    def dead(self) -> int:
        """The state that cannot be left (an anchored automaton after a mismatch), or -1."""
        if not hasattr(self, "_dead"):
            size = len(self.accepts)
            stuck = [s for s in range(size) if not self.accepts[s] and set(self.moves[s * 256 : s * 256 + 256]) == {s * 256}]
            self._dead = stuck[0] * 256 if stuck else -1
        return self._dead


def anchored(pattern: str, fold: bool = False) -> Dfa:
    nfa = Nfa()
    start = nfa.state()
    return Dfa(nfa, start, [nfa.add(pattern, start, fold=fold)], anywhere=False)
