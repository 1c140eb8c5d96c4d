"""Phrases whose words belong together, counted in weighted acyclic automata.

A phrase of a language occurs often enough only if every part of it does, so phrases are
counted by length, one pass over the texts each. A task reads its texts in shards of a bounded
number of words; the shard's phrases of that length are counted, sorted, built into an
automaton (``count_automaton``) for each range of first words, and only automata are shuffled.
A range's task merges them in sorted order, adding up their weights. Which phrases
are worth counting is asked of a filter of ``2 ** FILTER`` bits over the frequent phrases one
word shorter (the longest two lengths share a pass, and its filter): it may pass some that are not, whose counts then show it, and never holds one
back, so its size bounds what is broadcast and not what is found.

Parts of a candidate are frequent as well. They are looked up range by range: the parts asked for
are built into an automaton and composed with that of the range's frequent phrases.

Defined results: a null text has no words, a null language is ``und``; texts are read whole,
whatever their length; repeated rows count each; columns other than language and text are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import itertools
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplekit.llm.common import map_stream
from ripplekit.llm.count_automaton import Automaton, build, compose, of_table, ranked, summed, union
from ripplekit.session import settle

LONGEST = 5
LEAST = 100
TOP = 2000
SHARD = 2_000_000  # words
CHUNK = 1 << 20  # bytes of text split at once
KEPT = 1_000_000  # words a task keeps numbers for
STRIDE = 200  # frequent words in a range
ARCS = 2_000_000  # a range's automata are merged before they have more
FILTER = 26
SEED = 42

BREAK, NOTHING = 0, 1
SIGNS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
MIX, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


# Texts as numbers.


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Reader:
    """Turns texts into shards; words keep their numbers and hashes from shard to shard until they are too many."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.langs = Numbers({b"\n": BREAK, b"": NOTHING}), Numbers()
        self.words: list[bytes] = []
        self.hashes = np.empty(0, np.uint64)

    def ids(self, text: str) -> Iterator[np.ndarray]:
        data, at = text.encode().lower().translate(SIGNS), 0
        while at < len(data):
            end = at + CHUNK
            if end < len(data):
                ends = [p for p in (data.find(b" ", end), data.find(b"\n", end)) if p >= 0]
                end = min(ends, default=len(data))
            words = data[at:end].replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words))
            yield ids[ids != NOTHING]
            at = end
        yield np.zeros(1, np.uint32)

    def shards(self, rows: Iterator[tuple[str, str]]) -> Iterator[Shard]:
        shard = Shard(self)
        for lang, text in rows:
            shard.add(self.langs[lang.encode()], self.ids(text))
            if shard.size >= SHARD:
                yield shard
                if len(self.numbers) > KEPT:
                    self._forget()
                shard = Shard(self)
        if shard.size:
            yield shard

    def known(self) -> tuple[list[bytes], np.ndarray, list[bytes], np.ndarray]:
        """Words and their hashes, languages and theirs, by number."""
        more = list(itertools.islice(self.numbers, len(self.words), None))
        self.words += more
        self.hashes = np.concatenate([self.hashes, hashes(more)])
        langs = list(self.langs)
        return self.words, self.hashes, langs, hashes(langs)


class Shard:
    """Words of texts as numbers, with a break between pieces, and the languages of their places."""

    def __init__(self, reader: Reader) -> None:
        self.reader = reader
        self.parts: list[np.ndarray] = []
        self.of: list[tuple[int, int]] = []
        self.size = 0

    def add(self, lang: int, found: Iterator[np.ndarray]) -> None:
        parts = list(found)
        size = sum(map(len, parts))
        self.parts += parts
        self.of.append((lang, size))
        self.size += size

    def blocks(self, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, languages) of bounded parts, which overlap by what a phrase of that length needs."""
        ids = np.concatenate(self.parts)
        langs = np.repeat(*np.array(self.of, dtype=np.uint32).T)
        for at in range(0, len(ids), SHARD):
            yield ids[at : at + SHARD + length - 1], langs[at : at + SHARD + length - 1]


# The filter: a phrase's hash is made from its words' one after the other.


def _mixed(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    state = (state + words) * MIX
    return state ^ (state >> TURN)


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed=SEED) for w in words), np.uint64, len(words))


def _places(phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - FILTER)
    return phrases * MIX >> shift, (phrases ^ (phrases >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) >> shift


def passes(bits: np.ndarray, phrases: np.ndarray) -> np.ndarray:
    found = np.ones(len(phrases), dtype=bool)
    for place in _places(phrases):
        found &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def filter_bits(frequent: DataFrame) -> np.ndarray:
    """Two bits for each row (lang, phrase), ored in tasks; at most 2 ** (FILTER - 6) words reach the driver."""

    def run(rows):
        while some := list(itertools.islice(rows, 10_000)):
            split = [[lang.encode(), *phrase.encode().split(b" ")] for lang, phrase in some]
            columns = [hashes([s[i] for s in split]) for i in range(len(split[0]))]  # all of one length
            state = functools.reduce(_mixed, columns[1:], columns[0])
            for place in np.concatenate(_places(state)):
                yield int(place) >> 6, int(np.uint64(1 << (int(place) & 63)).view(np.int64))

    set_bits = map_stream(frequent.select("lang", "phrase"), run, "cell int, bits bigint")
    cells = set_bits.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER - 6), dtype=np.int64)
    bits[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return bits.view(np.uint64)


# Counting.


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, phrase, f) of single words, all of them."""

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for shard in Reader().shards(rows):
            words, _, langs, _ = shard.reader.known()
            for ids, of in shard.blocks(1):
                keys, counts = np.unique((of.astype(np.int64) << 32 | ids)[ids != BREAK], return_counts=True)
                for at in range(0, len(keys), 100_000):
                    some = keys[at : at + 100_000]
                    columns = [
                        pa.array([langs[i].decode() for i in (some >> 32).tolist()], pa.string()),
                        pa.array([words[i].decode() for i in (some & 0xFFFFFFFF).tolist()], pa.string()),
                        pa.array(counts[at : at + 100_000], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])

    found = texts.mapInArrow(run, "lang string, phrase string, f bigint")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def passing(ids: np.ndarray, of: np.ndarray, shard: Shard, length: int, bits: np.ndarray) -> np.ndarray:
    """For each place of a block, whether the filter lets the phrase of that length through that begins there."""
    _, word_hashes, _, lang_hashes = shard.reader.known()
    starts = max(0, len(ids) - length + 1)
    found, state = word_hashes[ids], lang_hashes[of[:starts]]
    solid = np.ones(starts, dtype=bool)
    for i in range(length):
        state = _mixed(state, found[i : i + starts])
        solid &= ids[i : i + starts] != BREAK
    solid[solid] = passes(bits, state[solid])
    return solid


def counted(
    ids: np.ndarray, of: np.ndarray, shard: Shard, length: int, parts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """A block's phrases of that length all of whose shorter phrases pass (``parts``, by ``passing``), sorted:
    rows of places in the sorted words (the language first), their counts, and the words."""
    words, _, langs, _ = shard.reader.known()
    starts = len(ids) - length + 1
    shifts = len(parts) - starts + 1  # shorter phrases in one of that length
    begin = parts[:starts].copy() if starts > 0 else np.empty(0, bool)
    for i in range(1, shifts if starts > 0 else 0):
        begin &= parts[i : i + starts]
    at = np.flatnonzero(begin)
    if not len(at):
        return np.empty((0, length + 1), np.int64), np.empty(0, np.int64), []
    columns = [ids[at + i] for i in range(length)]
    used = np.unique(np.concatenate(columns))
    known = sorted({*(words[i] for i in used.tolist()), *langs})
    place = {w: i for i, w in enumerate(known)}
    rank = np.zeros(len(words), dtype=np.int64)
    rank[used] = [place[words[i]] for i in used.tolist()]
    first = np.array([place[w] for w in langs], dtype=np.int64)[of[at]]
    rows, number = ranked(itertools.chain([first], (rank[column] for column in columns)))
    return rows, np.bincount(number), known


def block_tables(
    shard: Shard, lengths: tuple[int, ...], shorter: int, bits: np.ndarray
) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, list[bytes]]]]:
    """(length, what ``counted`` makes) of each of a shard's blocks."""
    for ids, of in shard.blocks(lengths[-1]):
        parts = passing(ids, of, shard, shorter, bits)
        for length in lengths:
            room = min(len(ids), SHARD + length - 1)  # what begins later is the next block's
            yield length, counted(ids[:room], of[:room], shard, length, parts[: max(0, room - shorter + 1)])


def count_phrases(
    texts: DataFrame, lengths: tuple[int, ...], bits: np.ndarray, shorter: int, cuts: list[tuple[bytes, bytes]], least: int
) -> DataFrame:
    """(lang, phrase, words, f) of the phrases of those lengths that occur ``least`` times, by a filter of phrases of ``shorter`` words."""
    held = texts.sparkSession.sparkContext.broadcast((bits, cuts))

    def work(rows):
        bits, cuts = held.value
        for shard in Reader().shards(rows):
            for length, (found, counts, known) in block_tables(shard, lengths, shorter, bits):
                if len(found):
                    new = np.flatnonzero(np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)])
                    part = [bisect_right(cuts, (known[a], known[b])) for a, b in found[new, :2].tolist()]
                    bounds = [i for i, p in enumerate(part) if not i or p != part[i - 1]]
                    edges = [*new[bounds].tolist(), len(found)]
                    for i, begin, end in zip(bounds, edges, edges[1:]):
                        yield length, part[i], of_table(found[begin:end], counts[begin:end], known).to_bytes()

    def merge(rows):
        for (length, _), run in itertools.groupby(rows, lambda r: r[:2]):
            held, arcs = [], 0
            for _, _, data in run:
                held.append(Automaton.from_bytes(data))
                arcs += len(held[-1])
                if arcs > ARCS and len(held) > 1:
                    held = [union(held, length + 1)]
                    arcs = len(held[0]) // 2  # what is new must be as much again
            found, counts, words = summed(held, length + 1)
            often = counts >= least
            for (lang, *said), n in zip(found[often].tolist(), counts[often].tolist()):
                yield words[lang].decode(), b" ".join([words[i] for i in said]).decode(), length, n

    parts = map_stream(texts, work, "words int, range int, automaton binary")
    dealt = parts.repartition("words", "range").sortWithinPartitions("words", "range")
    return map_stream(dealt, merge, "lang string, phrase string, words int, f bigint")


def range_cuts(words: DataFrame, stride: int = STRIDE) -> list[tuple[bytes, bytes]]:
    """Every ``stride``-th of the sorted frequent (language, word): the driver holds that part of them."""

    def work(rows):
        for lang, word in itertools.islice(rows, stride - 1, None, stride):
            yield lang, word

    found = map_stream(words.select("lang", "phrase").orderBy("lang", "phrase"), work, "lang string, phrase string")
    return sorted((r[0].encode(), r[1].encode()) for r in found.collect())


def frequent_phrases(texts: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, list]:
    """(lang, phrase, words, f) of all phrases that occur ``least`` times, (lang, n), and the ranges' cuts."""
    words = settle(count_words(texts), "words")
    totals = settle(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    level = settle(words.where(F.col("f") >= least).select("lang", "phrase", F.lit(1).alias("words"), "f"), "phrases")
    cuts = range_cuts(level)
    found, length = level, 1
    while length < longest:
        # Few texts still hold phrases that the last filter but one lets through, so the last two lengths share a pass.
        lengths = (length + 1,) if longest - length != 2 else (longest - 1, longest)
        level = settle(count_phrases(texts, lengths, filter_bits(level), length, cuts, least), "phrases")
        found, length = found.union(level), lengths[-1]
    return found, totals, cuts


# Parts.


def with_parts(found: DataFrame, cuts: list[tuple[bytes, bytes]]) -> DataFrame:
    """(lang, phrase, k, l, r): counts of the first k words and of the rest, for each cut of each phrase of two words or more."""
    held = found.sparkSession.sparkContext.broadcast(cuts)

    def ask(rows):
        cuts = held.value
        place = lambda lang, part: bisect_right(cuts, (lang.encode(), part.split(" ", 1)[0].encode()))
        for lang, phrase, size, f in rows:
            yield place(lang, phrase), lang, phrase, f, None, None, None
            words = phrase.split(" ")
            for k in range(1, size):
                for first, part in ((True, " ".join(words[:k])), (False, " ".join(words[k:]))):
                    yield place(lang, part), lang, part, None, phrase, k, first

    def answer(rows):
        for _, run in itertools.groupby(rows, lambda r: r[0]):
            counts, asked = {}, {}
            for _, lang, part, f, *whole in run:
                key = (lang.encode(), *part.encode().split(b" "))
                if f is not None:
                    counts[key] = f
                else:
                    asked.setdefault(key, []).append((lang, *whole))
            keys = sorted(asked)
            over = lambda d: build(sorted(d.items()), (w for s in d for w in s))
            for i, f in compose(over({s: i for i, s in enumerate(keys)}), over(counts)):
                for lang, phrase, k, first in asked[keys[i]]:
                    yield lang, phrase, k, first, f

    requests = map_stream(
        found.select("lang", "phrase", "words", "f"), ask,
        "range int, lang string, part string, f bigint, phrase string, k int, first boolean",
    )
    dealt = requests.repartition("range").sortWithinPartitions("range")
    parts = map_stream(dealt, answer, "lang string, phrase string, k int, first boolean, f bigint")
    return parts.groupBy("lang", "phrase", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r")
    )


def _score() -> Column:
    """floor(1000 a n / (l r)), exact up to 38 digits."""
    return F.expr("(CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(n AS DECIMAL(17, 0))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, lang: str = "lang", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases by their weakest cut."""
    texts = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    found, totals, cuts = frequent_phrases(texts, least, longest)
    candidates = found.where("words > 1").select("lang", "phrase", F.col("f").alias("a"))
    words = F.split("phrase", " ", -1)
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("w") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.array_join(F.slice("w", i, size), " ")),
    ))
    longer = found.where("words > 2").select("lang", "f", words.alias("w")).select("lang", "f", F.explode(inner).alias("phrase"))
    hidden = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = candidates.join(hidden, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a").drop("longer")
    cut = left.join(with_parts(found, cuts), ["lang", "phrase"]).join(totals, "lang").withColumn("score", _score())
    weakest = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(best).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
