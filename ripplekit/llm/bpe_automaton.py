"""Byte-pair encoding by an automaton over tokens, built from the merges one by one.

The automaton starts with one state and an arc for each byte. The gadget for the
merge of u and v into w makes an arc w wherever an arc u leads to a state with an
arc v, and then takes the arc v away behind u, so that no path spells u v. What is
left after the last merge has, for each word, exactly one path, and its labels are
the word's tokens.

A state is the token that led to it. The state behind w starts as the state
behind v was, and the arcs w stand where the arcs u stand, so a gadget needs to
store only its parents and the arc it takes away; whether a state has an arc is
then read from these tables, back to the youngest ancestors, and is kept.

Encoding walks the arcs from the start state, longest label first. Each place in
a word has one path that reaches it, so a place that leads nowhere is left for
good. Decoding emits the labels.

Defined results: a null text encodes like an empty one, to no tokens, and decodes
to the empty text. Repeated rows each get their result, texts of any length are
encoded whole, other columns are ignored, and an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import json
from array import array

import regex
from pyspark.sql import DataFrame

from ripplekit.llm.common import map_rows
from ripplekit.llm.words import Kept, SpacedWords, packed, plain

# How texts are split into words before merging (fixed by the byte-level vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ARCS_KEPT = 500_000


def byte_of_letter() -> dict[str, int]:
    """The vocabulary files write printable Latin-1 bytes as themselves and the others as letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TokenAutomaton:
    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]) -> None:
        """``labels[token]`` are its bytes; ``merges`` are (u, v, w) in the order they apply."""
        self.labels = labels
        size = len(labels)
        self.born = array("q", [-1]) * size  # the merge that made the token
        self.state_of = array("q", [-1]) * size  # whose state its state started as
        self.arc_of = array("q", [-1]) * size  # beside whose arcs its arcs stand
        self.taken: dict[int, int] = {}  # u * size + v: the merge that took arc v away behind u
        self.reached = bytearray(size)  # tokens that some word has by itself
        self.size = size
        for token, label in enumerate(labels):
            self.reached[token] = len(label) == 1
        for order, (u, v, w) in enumerate(merges):
            self._gadget(order, u, v, w)
        self.by_label = {labels[t]: t for t in range(size) if self.reached[t]}
        self.lengths = [len(label) for label in labels]
        self.longest = max(map(len, self.by_label), default=1)
        self.arcs: dict[int, bool] = {}
        self.tree: dict[int, dict | int] = {}
        for label, token in self.by_label.items():
            node = self.tree
            for byte in label:
                node = node.setdefault(byte, {})
            node[-1] = token

    def _gadget(self, order: int, u: int, v: int, w: int) -> None:
        if self.born[w] >= 0 or not (self.reached[u] and self.reached[v] and self._has(u, v, order - 1)):
            return  # no path spells u v, or an earlier merge made w
        self.born[w], self.state_of[w], self.arc_of[w] = order, v, u
        self.reached[w] = 1
        self.taken[u * self.size + v] = order

    def _has(self, x: int, y: int, upto: int) -> bool:
        """Whether the state behind x has an arc y after the gadgets up to a number."""
        born = self.born
        while True:
            gone = self.taken.get(x * self.size + y)
            if gone is not None and gone <= upto:
                return False
            a, b = born[x], born[y]
            if a < 0 and b < 0:
                return True
            if b > a:  # the arc y was made beside the arcs of its left part, after this gadget's cut
                y, upto = self.arc_of[y], min(upto, b)
            elif a > b:  # the state behind x was the one behind its right part, before this gadget's cut
                x, upto = self.state_of[x], min(upto, a - 1)
            else:
                x, y, upto = self.state_of[x], self.arc_of[y], min(upto, a - 1)

    def walk(self, word: bytes) -> list[int]:
        """The labels of the word's path."""
        whole = self.by_label.get(word)
        if whole is not None:
            return [whole]
        size, arcs, pairs, lengths = len(word), self.arcs, self.size, self.lengths
        if len(arcs) >= ARCS_KEPT:
            arcs.clear()
        tokens, at, last = [], 0, -1
        choices = [self._labels_at(word, 0)] + [None] * size
        while at < size:
            left = choices[at]
            if left is None:
                left = choices[at] = self._labels_at(word, at)
            while left:
                token = left.pop()
                if last < 0:
                    break
                key = last * pairs + token
                has = arcs.get(key)
                if has is None:
                    has = arcs[key] = self._has(last, token, 1 << 60)
                if has:
                    break
            else:  # this place leads nowhere: its choices stay empty, and nothing comes back to it
                token = tokens.pop()
                at -= lengths[token]
                last = tokens[-1] if tokens else -1
                continue
            tokens.append(token)
            at += lengths[token]
            last = token
        return tokens

    def _labels_at(self, word: bytes, at: int) -> list[int]:
        """The labels that the rest of the word starts with, shortest first."""
        node, found = self.tree, []
        for byte in word[at : at + self.longest]:
            node = node.get(byte)
            if node is None:
                break
            token = node.get(-1)
            if token is not None:
                found.append(token)
        return found

    def spell(self, ids: bytes) -> bytes:
        return b"".join(map(self.labels.__getitem__, array("I", ids)))


class Codec:
    """Words, special strings and the automaton of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_of_letter()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, number in vocabulary.items():
            labels[number] = bytes([letters[c] for c in token])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        merges = [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in pairs]
        self.automaton = TokenAutomaton(labels, merges)
        for content, number in self.special.items():
            labels[number] = content.encode()
        self.latin_split = regex.compile(SPLIT).findall
        self.library_split = plain(path).pre_tokenizer.pre_tokenize_str
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.words = Kept(lambda word: packed(self.automaton.walk(word.encode())))
        self.ids = SpacedWords(self._parts, tuple(self.special)).ids

    def split(self, text: str) -> list[str]:
        """Words; where editions of Unicode could differ on letters and numbers, as the library sees them."""
        if text.isascii() or max(text) < "\u0250":
            return self.latin_split(text)
        return [text[a:b] for _, (a, b) in self.library_split(text)]

    def _parts(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            return b"".join([self.words[w] for w in self.split(text)])
        return b"".join([packed([self.special[p]]) if p in self.special else self._parts(p) for p in self.cut(text) if p])

    def text(self, ids: bytes) -> str:
        return self.automaton.spell(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): token ids as bytes, four to an id, little-endian."""

    def start():
        ids = codec(path).ids
        return lambda row_key, row_text: [(row_key, ids(row_text or ""))]

    return map_rows(docs.select(key, text), start, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, text) from the result of ``encode``."""

    def start():
        spell = codec(path).text
        return lambda row_key, row_ids: [(row_key, row_ids, spell(row_ids or b""))]

    kind = encoded.schema[key].dataType.simpleString()
    return map_rows(encoded.select(key, ids), start, f"`{key}` {kind}, ids binary, text string")
