"""Counts of word sequences as minimal acyclic automata with weights on their arcs.

Sequences come sorted. While one is read, only its own states are open; states that the
next sequence leaves are closed and shared with equal ones (labels, weights, targets), so
the automaton is minimal at every step. Weights stand as near to the start as they can:
an arc carries the least of what lies beyond it, so that rests that differ by a
constant are the same state. A sequence's count is the sum along its path.

Sorted sequences of one length may come as a table: all that share everything but
the last word make one state at once.

``union`` adds up the weights of equal sequences of several automata;
``compose`` walks two automata side by side and gives both weights of each sequence they share.
"""

from __future__ import annotations

import struct
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np

Sequence = tuple[bytes, ...]
HEADER = struct.Struct("<QQQQ")


class Automaton:
    """States are numbers: arcs ``first[s]`` to ``first[s + 1]`` by ascending label, ``last[s]`` one more than the weight of ending there, or 0."""

    def __init__(self, words: list[bytes], root: int, first: array, last: array, labels: array, weights: array, targets: array) -> None:
        self.words, self.root, self.first, self.last = words, root, first, last
        self.labels, self.weights, self.targets = labels, weights, targets

    def __len__(self) -> int:
        return len(self.labels)

    def to_bytes(self) -> bytes:
        head = HEADER.pack(self.root, len(self.last), len(self.labels), len(self.words))
        sizes = array("I", map(len, self.words))
        parts = (self.first, self.last, self.labels, self.weights, self.targets, sizes)
        return head + b"".join([p.tobytes() for p in parts]) + b"".join(self.words)

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        root, states, arcs, count = HEADER.unpack_from(data)
        at, parts = HEADER.size, []
        for kind, length in (("I", states + 1), ("Q", states), ("I", arcs), ("Q", arcs), ("I", arcs), ("I", count)):
            part = array(kind)
            part.frombytes(data[at : at + length * part.itemsize])
            at += length * part.itemsize
            parts.append(part)
        words = []
        for size in parts.pop():
            words.append(data[at : at + size])
            at += size
        return cls(words, root, *parts)

    def items(self) -> Iterator[tuple[Sequence, int]]:
        """Sequences and counts, sorted."""
        words, first, last, labels, weights, targets = (
            self.words, self.first, self.last, self.labels, self.weights, self.targets,
        )
        stack: list[tuple[int, Sequence, int]] = [(self.root, (), 0)]
        while stack:
            state, said, total = stack.pop()
            if last[state]:
                yield said, total + last[state] - 1
            for arc in range(first[state + 1] - 1, first[state] - 1, -1):
                stack.append((targets[arc], (*said, words[labels[arc]]), total + weights[arc]))

    def table(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows of labels, counts) of the sequences of that length, sorted: all states of a depth are opened at once."""
        first, labels, weights, targets, last = (
            np.frombuffer(a, dtype=kind) if len(a) else np.empty(0, kind)
            for a, kind in ((self.first, "u4"), (self.labels, "u4"), (self.weights, "u8"), (self.targets, "u4"), (self.last, "u8"))
        )
        at, total = np.array([self.root], dtype=np.int64), np.zeros(1, dtype=np.int64)
        columns: list[np.ndarray] = []
        for _ in range(length):
            begin, size = first[at].astype(np.int64), (first[at + 1] - first[at]).astype(np.int64)
            before = np.cumsum(size) - size
            arcs = np.repeat(begin - before, size) + np.arange(int(size.sum()))
            columns = [np.repeat(c, size) for c in columns] + [labels[arcs].astype(np.int64)]
            total = np.repeat(total, size) + weights[arcs].astype(np.int64)
            at = targets[arcs].astype(np.int64)
        ends = last[at] > 0
        rows = np.stack(columns, axis=1) if columns else np.empty((len(at), 0), np.int64)
        return rows[ends], (total + last[at].astype(np.int64) - 1)[ends]

    def arc(self, state: int, label: int) -> int:
        """The arc with that label, or -1."""
        end = self.first[state + 1]
        at = bisect_left(self.labels, label, self.first[state], end)
        return at if at < end and self.labels[at] == label else -1


class Builder:
    """Reads sequences of labels in sorted order, each once."""

    def __init__(self) -> None:
        # A closed state: its own weight, and labels, weights and targets of its arcs as bytes.
        self.closed: dict[tuple[int, bytes, bytes, bytes], int] = {}
        # An open state: labels, weights and targets of its arcs (the last target may be open still), and its own weight.
        self.open: list[list] = [[[], [], [], 0]]
        self.before: tuple[int, ...] = ()

    def add(self, labels: tuple[int, ...], count: int, target: int | None = None) -> None:
        """A sequence and its count; or sequences that begin with these labels and go on from a closed state."""
        before, shared = self.before, 0
        for a, b in zip(before, labels):
            if a != b:
                break
            shared += 1
        self._close(shared)
        states = self.open
        for depth in range(shared):
            weights = states[depth][1]
            rest = weights[-1] - count
            if rest > 0:  # the arc keeps what both have; the rest moves on
                weights[-1] = count
                below = states[depth + 1]
                below[1][:] = [w + rest for w in below[1]]
                if below[3]:
                    below[3] += rest
                count = 0
            else:
                count -= weights[-1]
        for label in labels[shared:]:
            states[-1][0].append(label)
            states[-1][1].append(count)
            states.append([[], [], [], 0])
            count = 0
        if target is None:
            states[-1][3] = count + 1
        else:
            states.pop()
            states[-1][2].append(target)
        self.before = labels

    def add_table(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Sorted rows of labels, all of one length of two or more, and their counts."""
        if not len(rows):
            return
        end = self._number(1, b"", b"", b"")
        new = np.flatnonzero(np.r_[True, (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)])
        least = np.minimum.reduceat(counts, new)
        edges = [*new.tolist(), len(rows)]
        tails = rows[:, -1].astype(np.uint32)
        rests = (counts - np.repeat(least, np.diff(edges))).astype(np.uint64)
        ends = np.full(int(np.diff(edges).max()), end, dtype=np.uint32)
        for head, low, begin, stop in zip(map(tuple, rows[new, :-1].tolist()), least.tolist(), edges, edges[1:]):
            state = self._number(0, tails[begin:stop].tobytes(), rests[begin:stop].tobytes(), ends[: stop - begin].tobytes())
            self.add(head, low, state)

    def _number(self, *state) -> int:
        return self.closed.setdefault(state, len(self.closed))

    def _close(self, depth: int) -> None:
        states = self.open
        while len(states) > depth + 1:
            labels, weights, targets, last = states.pop()
            number = self._number(last, array("I", labels).tobytes(), array("Q", weights).tobytes(), array("I", targets).tobytes())
            states[-1][2].append(number)

    def finish(self, words: list[bytes]) -> Automaton:
        self._close(0)
        labels, weights, targets, last = self.open[0]
        root = self._number(last, array("I", labels).tobytes(), array("Q", weights).tobytes(), array("I", targets).tobytes())
        first, ends, parts = array("I", [0]), array("Q"), (array("I"), array("Q"), array("I"))
        for end, *arcs in self.closed:  # in order of their numbers
            for part, data in zip(parts, arcs):
                part.frombytes(data)
            first.append(len(parts[0]))
            ends.append(end)
        return Automaton(words, root, first, ends, *parts)


def build(items: Iterable[tuple[Sequence, int]], words: Iterable[bytes]) -> Automaton:
    """The automaton of sorted sequences over these words."""
    known = sorted(set(words))
    place = {w: i for i, w in enumerate(known)}
    builder = Builder()
    for said, count in items:
        builder.add(tuple([place[w] for w in said]), count)
    return builder.finish(known)


def ranked(columns: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sorted; the number of each given row's) of rows given by columns of numbers below 2 ** 31."""
    heads: list[tuple[np.ndarray, np.ndarray]] = []  # by length: the number of the row without its last, and its last
    keys = None
    for column in columns:
        pairs = column if keys is None else keys << 32 | column
        found, keys = np.unique(pairs, return_inverse=True)
        heads.append((found >> 32, found & 0xFFFFFFFF))
    back = np.arange(len(heads[-1][0]))
    rows = np.empty((len(back), len(heads)), np.int64)
    for i in range(len(heads) - 1, -1, -1):
        rows[:, i] = heads[i][1][back]
        back = heads[i][0][back]
    return rows, keys


def summed(automata: list[Automaton], length: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(rows, counts, words): the sequences of that length of all automata, sorted, with the sums of their counts."""
    words = sorted({w for a in automata for w in a.words})
    place = {w: i for i, w in enumerate(words)}
    tables, counts = [], []
    for automaton in automata:
        rows, found = automaton.table(length)
        tables.append(np.array([place[w] for w in automaton.words], dtype=np.int64)[rows])
        counts.append(found)
    rows, number = ranked(np.concatenate(tables).T)
    total = np.zeros(len(rows), dtype=np.int64)
    np.add.at(total, number, np.concatenate(counts))
    return rows, total, words


def of_table(rows: np.ndarray, counts: np.ndarray, words: list[bytes]) -> Automaton:
    """The automaton of a sorted table, over the words it uses."""
    used, number = np.unique(rows, return_inverse=True)
    builder = Builder()
    builder.add_table(number.reshape(rows.shape), counts)
    return builder.finish([words[i] for i in used.tolist()])


def union(automata: list[Automaton], length: int) -> Automaton:
    return of_table(*summed(automata, length))


def compose(asked: Automaton, counts: Automaton) -> Iterator[tuple[int, int]]:
    """The two weights of every sequence that both automata hold."""
    place = {w: i for i, w in enumerate(counts.words)}
    label = [place.get(w, -1) for w in asked.words]
    stack = [(asked.root, counts.root, 0, 0)]
    while stack:
        one, two, a, b = stack.pop()
        if asked.last[one] and counts.last[two]:
            yield a + asked.last[one] - 1, b + counts.last[two] - 1
        for arc in range(asked.first[one], asked.first[one + 1]):
            other = label[asked.labels[arc]]
            met = counts.arc(two, other) if other >= 0 else -1
            if met >= 0:
                stack.append((asked.targets[arc], counts.targets[met], a + asked.weights[arc], b + counts.weights[met]))
