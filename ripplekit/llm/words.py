"""Texts to token ids by way of their pieces between spaces, each encoded once and kept.

A tokenizer that splits texts into words before it merges gives a word the same
ids wherever it stands, so the ids of a text are those of its pieces joined. Both
splits below cut only where the tokenizer's own rules always cut. Ids travel as
bytes, four to an id, little-endian.
"""

from __future__ import annotations

import functools
import re
import sys
from array import array
from collections.abc import Callable

from tokenizers import Tokenizer

# Entries a Python worker keeps; older ones go first, and come back when they are met again.
KEPT = 300_000
# Longer pieces (texts without spaces, encoded data) are made each time: what is kept is then bounded in bytes as well.
LONGEST = 64


class Kept(dict):
    """A bounded dict that makes missing values; two halves, of which the older is dropped. Long keys are not kept."""

    def __init__(self, make: Callable[[str], bytes], most: int = KEPT) -> None:
        super().__init__()
        self.make, self.most, self.older = make, most // 2, {}

    def __missing__(self, key: str) -> bytes:
        if len(key) > LONGEST:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class UnsafeCut(Exception):
    """A piece beside which a space may belong to a longer run of white space."""


class SpacedWords:
    """For byte-level BPE: words take the one space before them, so a single space starts a word.

    Texts are cut before each space that stands between two characters other
    than white space. A text with another space is encoded in one go, as are
    the parts beside the tokenizer's special strings, which the library reads
    in texts by default.
    """

    def __init__(self, encode: Callable[[str], bytes], special: tuple[str, ...]) -> None:
        self.encode, self.special = encode, special
        self.pieces = Kept(self._piece)

    def _piece(self, piece: str) -> bytes:
        if not piece or piece[-1].isspace():
            raise UnsafeCut
        return self.encode(" " + piece)

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.encode(text)
        first, *rest = text.split(" ")
        if not rest:
            return self.encode(text) if text else b""
        if not first or first[-1].isspace():
            return self.encode(text)
        try:
            return self.encode(first) + b"".join([self.pieces[p] for p in rest])
        except UnsafeCut:
            return self.encode(text)


class BareWords:
    """For the tokenizer that lower-cases and drops white space: any white space is a cut, and so is each change
    between letters, single digits and other signs.

    Runs of Latin letters, digits and ASCII signs but the apostrophe, which begins endings like 's, go straight to the
    merges, each different run once. Pieces with other characters go through the library whole.
    """

    # None of these letters changes under NFC, and each is one letter in lower case.
    RUN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
    OTHER = re.compile(r"[^A-Za-zÀ-ÖØ-öø-ÿ0-9 \t-\r!-&(-/:-@\[-`{-~]")

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.bytes = {ord(c): mapped for c, mapped in self._byte_letters().items()}
        self.words = Kept(self._word, 2 * KEPT)
        self.pieces = Kept(self._piece, KEPT // 10)

    def _byte_letters(self) -> dict[str, str]:
        from tokenizers.pre_tokenizers import ByteLevel

        level = ByteLevel(add_prefix_space=False, use_regex=False)
        return {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, [*range(33, 127), *range(0xC0, 0x100)])}

    def _word(self, word: str) -> bytes:
        return packed([t.id for t in self.tokenizer.model.tokenize(word.translate(self.bytes))])

    def _runs(self, text: str) -> bytes:
        return b"".join([self.words[run] for run in self.RUN.findall(text.lower())])

    def _piece(self, piece: str) -> bytes:
        return self.whole(piece) if self.OTHER.search(piece) else self._runs(piece)

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        if not self.OTHER.search(text):
            return self._runs(text)
        return b"".join([self.pieces[p] for p in text.replace("\n", " ").split(" ") if p])


def plain(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=2)
def library_spaced(path: str) -> SpacedWords:
    """The library's own ids, kept by piece (one object in each Python worker)."""
    tokenizer = plain(path)
    special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    return SpacedWords(lambda s: packed(tokenizer.encode(s, add_special_tokens=False).ids), special)


@functools.lru_cache(maxsize=2)
def library_bare(path: str) -> BareWords:
    return BareWords(path)
