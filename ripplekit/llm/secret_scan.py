"""Secrets in texts, found by one automaton for all rules.

The rules' expressions, read backwards, are joined into one automaton by subset
construction and minimised. One pass over a text's bytes, last to first, marks
every byte at which some rule's match begins. From the marked bytes alone,
leftmost first and never inside an earlier match of the same rule, each rule's
own small automaton finds the match's end.

Defined results: a null or empty text has no spans; repeated rows each get their
own result; texts of any length are scanned whole; columns other than the
document's key and text are ignored by ``scan_secrets`` and passed on by
``redact_secrets``; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.llm.automaton import Dfa, Nfa, anchored
from ripplekit.llm.common import map_rows


@dataclass(frozen=True)
class Rule:
    """A secret is ``head`` then ``tail`` (regular expressions over ASCII), each as long as can be.

    Matches whose tail has fewer than ``least`` characters take up their place but are dropped.
    ``fold`` lets letters of the head stand in either case.
    """

    kind: str
    tail: str
    least: int
    head: str = ""
    fold: bool = False


BASE = (
    Rule(
        "assign", r"[A-Za-z0-9+/_.=-]+", 8, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", True
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
RULES = BASE + (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 27),
)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        nfa = Nfa()
        start = nfa.state()
        ends = []
        for rule in rules:
            begin = nfa.state()
            nfa.empty[start].append(begin)
            tail = nfa.add(rule.tail, begin, backwards=True)
            ends.append(nfa.add(rule.head, tail, backwards=True, fold=rule.fold))
        self.starts = Dfa(nfa, start, ends, anywhere=True)
        self.heads = [anchored(r.head, r.fold) if r.head else None for r in rules]
        self.tails = [anchored(r.tail) for r in rules]

    def marks(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(byte, rules) where matches begin, first byte first; rules are bits."""
        moves, state, edge = self.starts.moves, self.starts.start, self.starts.edge
        places, states = array("q"), array("q")
        for i, byte in enumerate(data[::-1], 1):
            state = moves[state + byte]
            if state >= edge:
                places.append(i)
                states.append(state)
        for i, state in zip(reversed(places), reversed(states)):
            yield len(data) - i, self.starts.accepts[state >> 8]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then by the order of the rules."""
        data = text.encode()
        free = [0] * len(self.rules)
        spans = []
        for at, bits in self.marks(data):
            for k, rule in enumerate(self.rules):
                if bits >> k & 1 and at >= free[k]:
                    begin = self.heads[k].longest(data, at) if rule.head else at
                    end = self.tails[k].longest(data, begin)
                    free[k] = end
                    if end - begin >= rule.least:
                        spans.append((at, k, end))
        if len(data) != len(text):
            points = {}
            seen = count = 0
            for at in sorted({x for s in spans for x in (s[0], s[2])}):
                count += len(data[seen:at].decode())
                seen, points[at] = at, count
            spans = [(points[s], k, points[e]) for s, k, e in spans]
        return [(self.rules[k].kind, s, e) for s, k, e in sorted(spans)]


@functools.lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): every secret of every text; spans are sorted structs (kind, start, end) in code points, end exclusive."""

    def start():
        found = scanner(rules).spans

        def work(row_key, row_text):
            spans = found(row_text) if row_text else []
            yield row_key, [{"kind": k, "start": s, "end": e} for k, s, e in spans]

        return work

    kind = docs.schema[key].dataType.simpleString()
    ddl = f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return map_rows(docs.select(key, text), start, ddl)


def redact_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", size: str | None = None, mask: str = "[secret]"
) -> DataFrame:
    """The same rows and columns with each secret (spans that overlap count as one) replaced by ``mask``.

    ``size`` names a column to hold the new text's number of code points.
    """

    def clean(value):
        spans = scanner(rules).spans(value) if value else []
        out, at = [], 0
        for _, start, end in spans:
            if start >= at:
                out += [value[at:start], mask]
            at = max(at, end)
        return "".join([*out, value[at:]]) if spans else value

    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            field = batch.schema.field(place)
            column = pa.array([clean(v) for v in batch.column(place).to_pylist()], type=field.type)
            yield batch.set_column(place, field, column)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(size, F.char_length(text).cast(docs.schema[size].dataType)) if size else out
