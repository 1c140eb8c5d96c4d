"""Conversations repaired at least cost, by divide and conquer in linear space.

The rows of a conversation are aligned with the roles ``(s?(ua)+)?``: rows are kept, given
another role or deleted, and empty rows inserted. After each row one of four states holds
(nothing yet, after a system, a user or an assistant row), and the least cost of going from
state to state over some rows is a small table, so costs of neighbouring spans add up.

Hirschberg's scheme finds the edits without keeping a table over all rows: cost vectors run
forwards from the start and backwards from the end and meet in the middle; the state
with the least sum is where the best edits cross, and both halves are solved alike. Of equal
sums the crossing is taken whose forward edits are least: besides its cost a forward vector
ranks the least edits that lead to each state. (Edits that end with a row never begin one
another, and a state and a letter have one successor, so ranks decide the whole text.)

Spark does the dividing for long conversations. Rows are sorted by range, so that one
conversation may lie over many tasks, and cut into segments of at most ``SEGMENT`` rows;
each segment gives its table of costs and ranks, from these the crossings between segments are
chosen, and then each segment is repaired on its own. Texts move once, to meet their edits in
the same order; a conversation that lies in one task is put together there, and of others
pieces of joined text go to the task that hashes them, one after the other. Equal rows
of one turn travel as one row with a count.

Defined results: nulls count as one space, also in the identity of a row; null ids form one
conversation, as equal ids do; null turns come first; rows of one turn are ordered by role
and by a digest of the text, so equal rows are neighbours; other columns are ignored; an
empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm.common import map_rows, map_stream
from ripplekit.session import settle

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FAR = 1 << 60
SEGMENT = 4096
PIECE = 1 << 20  # characters of a piece of a conversation that goes on in another task

SPACES = " \t\n\x0b\x0c\r"
#: Kinds of rows: what faults ask of them.
PLAIN, CUT, GONE = 0, 1, 2


def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text): the rows after the damage that the checksum of id and turn names."""
    named = rows.select(
        F.col(key).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
    )
    mark = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")])
    kind = F.crc32(mark.cast("binary")) % 20
    hurt = named.withColumn("kind", kind).where("kind <> 0")
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return hurt.select(
        "conv", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def digest() -> Column:
    return F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32).alias("digest")


# The cheapest way from state to state over one row, by its role's initial and kind.


@functools.cache
def moves(initial: str, kind: int) -> tuple[tuple[tuple[int, str], ...], ...]:
    """[from][to] = (cost, letters), the letters ending with the row's own; FAR where there is no way."""
    table = [[(FAR, "")] * 4 for _ in range(4)]
    for begin in range(4):
        found: dict[int, list[tuple[int, str]]] = {begin: [(DELETE, "D")]}
        if kind != GONE:
            penalty = TRUNCATED if kind == CUT else 0
            at, inserts = begin, ""
            for _ in range(3):
                for sign, end in NEXT[at].items():
                    if sign == initial:
                        found.setdefault(end, []).append((INSERT * len(inserts) + penalty, inserts + "K"))
                    if sign in "ua":
                        found.setdefault(end, []).append((INSERT * len(inserts) + REROLE + penalty, inserts + "R"))
                at, inserts = NEXT[at].get("a", USER), inserts + "I"
        for end, ways in found.items():
            table[begin][end] = min(ways)
    return tuple(map(tuple, table))


#: What remains to be inserted after the last row.
TAILS = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))

Row = tuple[str, int, int]  # initial, kind, and how many equal rows; those after the first are deleted
Costs = list[tuple[int, int]]  # by state: cost and rank


def forwards(rows: list[Row], begin: int) -> Costs:
    """For each state the least cost of reaching it, and the rank of the least edits that do."""
    at: Costs = [(0, 0) if s == begin else (FAR, 0) for s in range(4)]
    for initial, kind, n in rows:
        table = moves(initial, kind)
        ways = [min((at[s][0] + table[s][end][0], at[s][1], table[s][end][1]) for s in range(4)) for end in range(4)]
        at = ranked(ways, DELETE * (n - 1))
    return at


def ranked(ways: list[tuple], more: int = 0) -> Costs:
    order = {w: i for i, w in enumerate(sorted({w[1:3] for w in ways if w[0] < FAR}))}
    return [(w[0] + more, order[w[1:3]]) if w[0] < FAR else (FAR, 0) for w in ways]


def backwards(rows: list[Row], end: int) -> list[int]:
    """For each state the least cost of going on from it to the end."""
    at = [0 if s == end else FAR for s in range(4)]
    for initial, kind, n in reversed(rows):
        table = moves(initial, kind)
        at = [min(FAR, min(table[s][e][0] + at[e] for e in range(4)) + DELETE * (n - 1)) for s in range(4)]
    return at


def edits(rows: list[Row], begin: int, end: int) -> list[tuple[str, int]]:
    """Each row's letters and the state after it: the least of the cheapest that lead from begin to end."""
    if len(rows) == 1:
        initial, kind, n = rows[0]
        return [(moves(initial, kind)[begin][end][1] + "D" * (n - 1), end)]
    middle = len(rows) // 2
    one, two = forwards(rows[:middle], begin), backwards(rows[middle:], end)
    cross = min(range(4), key=lambda s: (one[s][0] + two[s], one[s][1]))
    return edits(rows[:middle], begin, cross) + edits(rows[middle:], cross, end)


def cross_segments(tables: list[np.ndarray]) -> tuple[int, list[int], str]:
    """Cost, the states before, between and after the segments, and the tail, from their tables [from, to, (cost, rank)]."""
    at: Costs = [(0, 0) if s == START else (FAR, 0) for s in range(4)]
    back = np.zeros((len(tables), 4), dtype=np.int8)
    for i, table in enumerate(tables):
        table = table.tolist()
        ways = [min((at[s][0] + table[s][e][0], at[s][1], table[s][e][1], s) for s in range(4)) for e in range(4)]
        back[i] = [w[3] for w in ways]
        at = ranked(ways)
    state = min(range(4), key=lambda s: (at[s][0] + TAILS[s][0], at[s][1]))
    cost, tail, states = at[state][0] + TAILS[state][0], TAILS[state][1], [state]
    for i in range(len(tables) - 1, -1, -1):
        state = int(back[i, state])
        states.append(state)
    return cost, states[::-1], tail


def lines(letters: str, begin: int, end: int, role: str | None, text: str | None) -> list[str]:
    """The lines that a row's letters leave."""
    found, at = [], begin
    for letter in letters:
        if letter == "I":
            at = NEXT[at].get("a", USER)
            found.append(f"{ROLES[at]}:")
        elif letter == "K":
            found.append(f"{role}:{text}")
        elif letter == "R":
            found.append(f"{ROLES[end]}:{text}")
    return found


# Spark: distinct rows in order, cut into segments.

KEYS = ["conv", "turn", "role", "digest"]


def distinct_rows(hurt: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, n, kind, seen): equal rows of one turn once; ``seen``: role and text came in an earlier turn."""
    rest = F.rtrim("text", F.lit(SPACES))
    last = F.substring(rest, -1, 1)
    kind = F.when(last == "", GONE).when(last.isin(".", "!", "?"), PLAIN).otherwise(CUT)
    rows = hurt.select("conv", "turn", "role", digest(), kind.alias("kind"))
    rows = settle(rows.groupBy(*KEYS).agg(F.count("*").alias("n"), F.max("kind").alias("kind")), "conversation-rows")
    first = rows.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("least"))
    # Met by the whole key of the first row: no key of this join is hot.
    named = first.select(
        F.col("conv").alias("f_conv"), F.col("least.turn").alias("f_turn"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest")
    )
    same = [F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in KEYS]
    met = rows.join(named, same[0] & same[1] & same[2] & same[3], "left")
    return met.select(*KEYS, "n", "kind", F.col("f_digest").isNull().alias("seen"))


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row for each run of at most ``size`` distinct rows of a conversation; (part, seg) are in order."""
    conv = rows.schema["conv"].dataType.simpleString()

    def work(found):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), itertools.count()
        for key, run in itertools.groupby(found, lambda r: r[0]):
            while held := list(itertools.islice(run, size)):
                _, turns, roles, digests, counts, kinds, seen = map(list, zip(*held))
                marks = [GONE if s else k for k, s in zip(kinds, seen)]
                line = [(r[:1], k, n) for r, k, n in zip(roles, marks, counts)]
                costs = [x for begin in range(4) for pair in forwards(line, begin) for x in pair]
                blank = sum(n for n, k in zip(counts, kinds) if k == GONE)
                duplicate = sum(n - (not s) for n, k, s in zip(counts, kinds, seen) if k != GONE)
                truncated = sum(k == CUT for k in marks)
                illegal = sum(counts) - len(counts) + sum(a[:1] + b[:1] not in LEGAL for a, b in itertools.pairwise(roles))
                known = [t for t in turns if t is not None]
                ends = [known[0], known[-1], len(set(known))] if known else [None, None, 0]
                yield (key, part, next(number), turns, roles, digests, counts, marks, costs,
                       blank, duplicate, truncated, illegal, *ends, roles[0][:1], roles[-1][:1])

    keyed = rows.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    return map_stream(keyed.select(*KEYS, "n", "kind", "seen"), work, f"conv {conv}, part int, seg bigint, {ROWS}, {SUMS}")


LEGAL = ("su", "ua", "au")
ROWS = "turns array<bigint>, roles array<string>, digests array<string>, counts array<bigint>, marks array<int>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SUMS = (
    "costs array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, turns_known bigint, "
    "first_role string, last_role string"
)
SUM_NAMES = [s.split()[0] for s in SUMS.split(", ")]


def crossings(found: DataFrame) -> DataFrame:
    """(part, seg, begin, end, and for a conversation's last segment its tail, sums and how many distinct rows it has)."""

    def work(rows):
        for _, run in itertools.groupby(rows, lambda r: r[0]):
            places, tables, sizes = [], [], 0
            blank = duplicate = truncated = illegal = known = 0
            low = high = before = None
            for _, part, seg, size, costs, b, d, t, i, lo, hi, k, one, last in run:
                places.append((part, seg))
                tables.append(np.array(costs, dtype=np.int64).reshape(4, 4, 2))
                sizes += size
                blank, duplicate, truncated, illegal = blank + b, duplicate + d, truncated + t, illegal + i
                if before is not None and before + one not in LEGAL:
                    illegal += 1
                before = last
                if k:
                    known += k - (lo == high)  # a turn that goes on
                    low, high = lo if low is None else low, hi
            cost, states, tail = cross_segments(tables)
            gaps = high - low + 1 - known if known else 0
            sums = [gaps, blank, duplicate, truncated, illegal, cost]
            for n, (part, seg) in enumerate(places):
                end = n == len(places) - 1
                yield part, seg, states[n], states[n + 1], tail if end else "", sums if end else None, sizes

    small = found.select("conv", "part", "seg", F.size("roles").alias("size"), *SUM_NAMES)
    by = small.repartition("conv").sortWithinPartitions("conv", "part", "seg")
    return map_stream(
        by, work, "part int, seg bigint, begin int, end int, tail string, sums array<bigint>, total bigint"
    ).withColumnsRenamed({"part": "c_part", "seg": "c_seg"})


def row_edits(found: DataFrame, crossed: DataFrame) -> DataFrame:
    """Each distinct row's letters, the states before and after it and, with a conversation's last row, its tail and sums."""
    conv = found.schema["conv"].dataType.simpleString()

    def start():
        def work(key, turns, roles, digests, counts, marks, begin, end, tail, sums, total):
            line = [(r[:1], k, n) for r, k, n in zip(roles, marks, counts)]
            at = begin
            for n, (letters, after) in enumerate(edits(line, begin, end)):
                last = n == len(line) - 1
                yield key, turns[n], roles[n], digests[n], letters, at, after, tail if last else "", sums if last else None, total
                at = after

        return work

    met = found.join(crossed, (F.col("part") == F.col("c_part")) & (F.col("seg") == F.col("c_seg")))
    names = [c.split()[0] for c in ROWS.split(", ")]
    return map_rows(met.select("conv", *names, "begin", "end", "tail", "sums", "total"), start, f"conv {conv}, {EDITS}")


EDITS = (
    "turn bigint, role string, digest string, letters string, begin int, end int, tail string, sums array<bigint>, total bigint"
)
EDIT_NAMES = ["letters", "begin", "end", "tail", "sums", "total"]


def once_a_batch(hurt: DataFrame) -> DataFrame:
    """The rows without those whose equal came in the same Arrow batch, so that no row's key stays hot."""
    columns = ["conv", "turn", "role", "digest", "text"]

    def run(batches):
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(4)))
            place = {key: i for i, key in enumerate(keys)}
            yield batch.take(pa.array(sorted(place.values()), pa.int64())) if len(place) < batch.num_rows else batch

    rows = hurt.select("conv", "turn", "role", digest(), "text")
    return rows.mapInArrow(run, rows.select(columns).schema)


def put_together(changes: DataFrame, hurt: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256, sums): texts meet their edits in order."""
    conv = changes.schema["conv"].dataType.simpleString()

    def work(rows):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for key, run in itertools.groupby(rows, lambda r: r[0]):
            audit, out, size, met, number, sums = [], [], 0, 0, 0, None
            want = None  # the edit whose text is still to come
            for _, _, role, _, text, letters, begin, end, tail, found, total in run:
                if letters is None:
                    if want is None:
                        continue  # an equal row
                    (role, kept, begin, end, tail), want = want, None
                    fresh = lines(kept, begin, end, role, text) + lines(tail, end, ASSISTANT, None, None)
                else:
                    met, sums = met + 1, found if found is not None else sums
                    audit.append(letters + tail)
                    if "K" in letters or "R" in letters:
                        want = role, letters, begin, end, tail
                        continue
                    want, fresh = None, lines(letters + tail, begin, end, None, None)
                out += fresh
                size += sum(map(len, fresh))
                if size >= PIECE and met < total:
                    yield key, part, number, "".join(audit), "\n".join(out), len(out), sums, False, None
                    audit, out, size, number, sums = [], [], 0, number + 1, None
            whole = met == total and number == 0
            text = "\n".join(out)
            if whole:
                yield key, part, number, "".join(audit), None, 0, sums, True, hashlib.sha256(text.encode()).hexdigest()
            else:
                yield key, part, number, "".join(audit), text, len(out), sums, False, None

    def finish(rows):
        for key, run in itertools.groupby(rows, lambda r: r[0]):
            audit, digest_, started, sums = [], hashlib.sha256(), False, None
            for _, _, _, letters, text, count, found in run:
                audit.append(letters)
                sums = sums or found
                if count:
                    digest_.update(("\n" * started + text).encode())
                    started = True
            yield key, "".join(audit), digest_.hexdigest(), sums

    nothing = [F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in EDITS.split(", ")) if n in EDIT_NAMES]
    texts = once_a_batch(hurt).select(*KEYS, F.lit(1).alias("second"), "text", *nothing)
    named = changes.select(*KEYS, F.lit(0).alias("second"), F.lit(None).cast("string").alias("text"), *EDIT_NAMES)
    met = named.union(texts).repartitionByRange(*KEYS).sortWithinPartitions(*KEYS, "second")
    pieces = settle(map_stream(
        met.select(*KEYS, "text", *EDIT_NAMES), work,
        f"conv {conv}, part int, piece int, audit string, body string, lines int, sums array<bigint>, whole boolean, repaired_sha256 string",
    ), "conversation-pieces")
    parts = pieces.where("NOT whole").repartition("conv").sortWithinPartitions("conv", "part", "piece")
    joined = map_stream(
        parts.select("conv", "part", "piece", "audit", "body", "lines", "sums"), finish,
        f"conv {conv}, audit string, repaired_sha256 string, sums array<bigint>",
    )
    return pieces.where("whole").select("conv", "audit", "repaired_sha256", "sums").union(joined)


def repair(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", size: int = SEGMENT
) -> DataFrame:
    """(conv, audit, repaired_sha256, sums) of the conversations as they are given."""
    given = rows.select(
        F.col(key).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
    )
    found = settle(segments(distinct_rows(given), size), "segments")
    changes = settle(row_edits(found, settle(crossings(found), "crossings")), "edits")
    return put_together(changes, given)


def repair_damaged(rows: DataFrame, key: str = "conv_id", size: int = SEGMENT) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): every conversation, damaged and repaired."""
    found = repair(damage(rows, key), "conv", size=size)
    all_of = rows.select(F.col(key).alias("all_conv")).distinct()
    met = all_of.join(found, F.col("all_conv").eqNullSafe(F.col("conv")), "left")
    return met.select(
        F.col("all_conv").alias(key),
        *[F.coalesce(F.col("sums")[i], F.lit(0)).cast("bigint").alias(name) for i, name in enumerate(COUNTS)],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
