"""Main text, phrases and conversations against brute force and written pages."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan
from ripplekit.llm import conversations, main_text, phrases
from ripplekit.llm.count_automaton import Automaton, build, compose, summed, union
from ripplekit.llm.queries import queries

# Main text.

PAGES = {
    "generic": (
        '<html><body><div id="header"><h2>Site</h2><a href=/>Home</a></div><div class="wrap"><div class="content"><h1>Title here</h1>'
        "<p>First paragraph, of some length, with commas. And a second sentence.</p><ul><li>one item</li><li>two</li></ul><p>Short.</p>"
        '<blockquote>Quoted words, these.</blockquote></div><div class="sidebar"><p>Buy this, now. Great deal, yes.</p></div></div>'
        '<div class="cookie-notice">We use cookies.</div><section id="comments"><p>I disagree, totally. Really, no.</p></section></body></html>',
        "Title here\nFirst paragraph, of some length, with commas. And a second sentence.\none item\ntwo\nShort.\nQuoted words, these.",
    ),
    "article": (
        "<main><article><header><h1>T</h1></header><p>aa bb.</p><aside>side</aside><form>f<input></form><div class=ad>ad</div></article>"
        '<article class="comment"><p>cc, dd, ee. ff, gg.</p></article></main><footer>end</footer>',
        "T\naa bb.",
    ),
    "no marks": (
        "<body><div><a href=1>aaa bbb</a> <a href=2>ccc</a></div><div><p>Long text here, with words. More words follow, yes indeed.</p>"
        "<p>again text, again text, and again. So it goes on.</p></div><div><a href=4>x</a></div></body>",
        "Long text here, with words. More words follow, yes indeed.\nagain text, again text, and again. So it goes on.",
    ),
    "broken": ('<p>a < b, <b>bold<p>next &lt;x&gt; &#65;&#x42;&nbsp; <script>if(a<b){"</p>"}</script>tail<!-- c', "a < b, bold\nnext <x> AB tail"),
    "plain": ("just  text &amp; more", "just text & more"),
    "nothing": ("<html><body><nav><a href=1>x</a></nav></body></html>", ""),
    "cut": ("<article><p>one.</p><p>two &am", "one.\ntwo &am"),
}


@pytest.mark.parametrize("name", PAGES)
def test_written_pages(name):
    page, want = PAGES[name]
    assert main_text.main_text(page) == want


def test_given_pages_give_their_articles(spark):
    """The articles of the given pages, cut out by a plain expression."""
    sf = "/root/testdata/sf0.1"
    got = {r.page_id: r for r in queries()["op11_main_text"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages) > 2000
    for page in pages:
        inside = re.search(r"<article>(.*?)(?:</article>|(?:<[^>]*)?\Z)", page.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
        want = "\n".join(filter(None, blocks))
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (want, len(want), page.url)


def test_pages_of_any_shape_take_linear_time(spark):
    shapes = ["<div>", "<b>", '<a "', "< ", "<p>x", "<li>x", "<!--", "<" + "a" * 50, "&#", "</p>", "<table><tr><td>"]
    rows = [(i, None, s * 20_000 + "end") for i, s in enumerate(shapes)] + [(None, None, None), (None, None, ""), (5, "u", "x" * 500_000)] * 2
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("a"))
    got = main_text.extract_text(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    assert sorted(r.n_chars for r in got.where("url = 'u'").collect()) == [500_000] * 2
    assert {r.text for r in got.where("page_id IS NULL").collect()} == {""}
    assert main_text.extract_text(frame.limit(0)).count() == 0


# Count automata.


def test_automata_keep_counts_and_meet():
    rng = random.Random(1)
    for _ in range(200):
        one, two = (
            {tuple(rng.choice([b"a", b"b", b"c\t", b""]) for _ in range(rng.randint(1, 4))): rng.randint(0, 20) for _ in range(rng.randint(0, 40))}
            for _ in range(2)
        )
        first, second = (
            Automaton.from_bytes(build(sorted(d.items()), (w for s in d for w in s)).to_bytes()) for d in (one, two)
        )
        assert list(first.items()) == sorted(one.items())
        for length in (1, 2, 3):
            both = {k: one.get(k, 0) + two.get(k, 0) for k in one.keys() | two.keys() if len(k) == length}
            rows, counts, words = summed([first, second], length)
            assert [(tuple(words[i] for i in r), n) for r, n in zip(rows.tolist(), counts.tolist())] == sorted(both.items())
            if length > 1:
                again = union([first, second], length)
                assert list(again.items()) == sorted(both.items())
                plain = build(sorted(both.items()), (w for s in both for w in s))
                assert len(again) == len(plain) and len(again.last) <= len(plain.last) + 1  # as small as one by one
        assert sorted(compose(first, second)) == sorted((one[k], two[k]) for k in one.keys() & two.keys())


def test_equal_rests_are_one_state():
    words = [bytes([97 + i]) for i in range(10)]
    items = [((a, b), 5 * i) for i, a in enumerate(words) for b in words]
    assert len(build(items, words)) == 20  # ten arcs to one state, ten beyond


# Phrases.


def brute_collocations(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            said = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(said)
            for size in range(1, 6):
                counts[lang].update(tuple(said[i : i + size]) for i in range(len(said) - size + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {p[i:j] for p, a in good.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and f[p[i:j]] <= a}
        found = []
        for p, a in good.items():
            if p in hidden:
                continue
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, one, rest) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, one, rest, totals[lang], -score))
    return sorted(out)


def collocated(frame, least, top=2000):
    return sorted(tuple(r) for r in phrases.collocations(frame, least, top).collect())


def test_blocks_of_any_size_give_each_phrase_once():
    """Several lengths in one pass, whatever the blocks' borders."""
    rng = random.Random(3)
    said = [rng.choice(["a", "b", "c", ","]) for _ in range(60)]
    pieces = [p.split() for p in " ".join(said).split(",")]
    old = phrases.SHARD
    try:
        for phrases.SHARD in range(1, 70):
            got = Counter()
            for shard in phrases.Reader().shards(iter([("en", " ".join(said))])):
                full = np.full(1 << (phrases.FILTER - 6), np.iinfo(np.uint64).max)
                for n, row in phrases.block_tables(shard, (4, 5), 3, full):
                    for labels, count in zip(*row[:2]):
                        got[tuple(row[2][i].decode() for i in labels[1:])] += int(count)
            want = Counter(tuple(p[i : i + n]) for p in pieces for n in (4, 5) for i in range(len(p) - n + 1))
            assert got == want, phrases.SHARD
    finally:
        phrases.SHARD = old


@pytest.mark.parametrize("shard", [7, 2_000_000])
def test_phrases_equal_brute_force(spark, shard, monkeypatch):
    monkeypatch.setattr(phrases, "STRIDE", 3)
    rng = random.Random(shard)
    vocabulary = ["a", "B", "b", "cat", "Ünder", "x\x01y", "中", "the", "of", "É"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", "\r", " ", ""]
    rows = []
    for _ in range(60):
        text = "".join(rng.choice(vocabulary[: rng.randint(2, 10)]) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        rows += [(rng.choice(["en", "fr", None, "und", "l\ta ng"]), text)] * rng.choice([1, 1, 1, 4])
    rows += [(None, None), ("de", ""), ("en", "the of the of. " * 400)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for least, top in ((2, 2000), (5, 7)):
        want = brute_collocations(rows, least, top)
        assert want and collocated(frame, least, top) == want


def test_small_shards_give_the_same_counts():
    """Shards and chunks of a few words, so that phrases lie over their edges."""
    text = "the cat sat, the cat ran. the dog sat on the mat " * 3
    want = Counter()
    for piece in re.split("[.,]", text):
        said = piece.split()
        want.update(tuple(said[i : i + 3]) for i in range(len(said) - 2))
    old = phrases.SHARD, phrases.CHUNK, phrases.KEPT
    try:
        phrases.SHARD, phrases.CHUNK, phrases.KEPT = 4, 9, 3
        got = Counter()
        for shard in phrases.Reader().shards(iter([("en", text), ("en", "x")])):
            for ids, of in shard.blocks(3):
                full = np.full(1 << (phrases.FILTER - 6), np.iinfo(np.uint64).max)
                parts = phrases.passing(ids, of, shard, 2, full)
                rows, counts, known = phrases.counted(ids, of, shard, 3, parts)
                for row, n in zip(rows.tolist(), counts.tolist()):
                    got[tuple(known[i].decode() for i in row[1:])] += n
        assert got == want
    finally:
        phrases.SHARD, phrases.CHUNK, phrases.KEPT = old


def test_phrases_of_odd_tables(spark, odd, clashing, none):
    want = brute_collocations([(r.lang, r.text) for r in odd.collect()], 2, 2000)
    for frame in (odd, clashing.withColumns({c: F.lit(1) for c in ("phrase", "a", "l", "r", "n", "f", "k", "rank", "words")})):
        assert collocated(frame, 2) == want
    assert collocated(none, 2) == []


# Conversations.


def brute_repair(rows):
    """All edits of a short conversation [(role, text)], by trying every one that is not hopeless."""
    blank = lambda t: not re.search("[^\x20\x09-\x0d]", t)
    seen, ways = set(), {("", 0, ()): 0}
    for role, text in rows:
        gone = blank(text) or (role, text) in seen
        seen.add((role, text))
        cut = not gone and text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?"
        after = {}

        def put(audit, state, out, cost):
            key = (audit, state, out)
            after[key] = min(cost, after.get(key, cost))

        for (audit, state, out), cost in ways.items():
            for _ in range(3):
                put(audit + "D", state, out, cost + 4)
                if not gone:
                    nexts = {0: "su", 1: "u", 2: "a", 3: "u"}[state]
                    for sign in nexts:
                        to = " sua".index(sign)
                        if role[:1] == sign:
                            put(audit + "K", to, (*out, f"{role}:{text}"), cost + 3 * cut)
                        if sign in "ua":
                            put(audit + "R", to, (*out, f"{'user' if sign == 'u' else 'assistant'}:{text}"), cost + 3 + 3 * cut)
                state, name = (3, "assistant") if state == 2 else (2, "user")
                audit, out, cost = audit + "I", (*out, f"{name}:"), cost + 3
        least = min(after.values())
        ways = {k: c for k, c in after.items() if c <= least + 12}
    ends = []
    for (audit, state, out), cost in ways.items():
        more = {0: (), 1: ("user:", "assistant:"), 2: ("assistant:",), 3: ()}[state]
        ends.append((cost + 3 * len(more), audit + "I" * len(more), "\n".join(out + more)))
    return min(ends)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_conversations(rows):
    want = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in damaged(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        said = [(r[1], r[2]) for r in mine]
        cost, audit, text = brute_repair(said) if said else (0, "", "")
        turns = [r[0] for r in mine if r[0] is not None]
        blank = duplicate = truncated = 0
        for i, (role, body) in enumerate(said):
            rest = body.rstrip(" \t\n\x0b\x0c\r")
            if not rest:
                blank += 1
            elif (role, body) in said[:i]:
                duplicate += 1
            elif rest[-1] not in ".!?":
                truncated += 1
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        want[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return want


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def repaired(frame, size):
    return {r[0]: tuple(r)[1:] for r in conversations.repair_damaged(frame, size=size).collect()}


@pytest.mark.parametrize("size", [1, 2, 4096])
def test_conversations_equal_brute_force(spark, size):
    rng = random.Random(size)
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(rng.randint(1, 6)):
            turn = rng.choice([turn, turn, turn, None, 3])
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "tool", "", None, "user"]), rng.choice(["Yes.", "No", "é!", " ", None, "a.\n", "So?"])))
    frame = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    assert repaired(frame, size) == brute_conversations(rows)


def test_a_long_conversation_over_many_tasks(spark):
    """Thousands of rows of one conversation, most of them equal, beside short ones; the table over all rows is the check."""
    rng = random.Random(9)
    rows = [(1, turn, rng.choice(["user", "assistant", "assistant"]), rng.choice([f"t{turn}.", f"t{turn}", ""])) for turn in range(4000)]
    rows += [(1, 17, "user", "the same.")] * 3000 + [(c, t, "user", f"x{c}.") for c in range(2, 50) for t in range(2)]
    frame = spark.createDataFrame(rows, CONVERSATIONS).repartition(8)
    got = repaired(frame, 300)
    mine = sorted(damaged([r for r in rows if r[0] == 1]), key=lambda r: (r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    best, seen = {0: (0, "", [])}, set()
    for _, _, role, text in mine:
        gone = not text or (role, text) in seen
        seen.add((role, text))
        kind = conversations.GONE if gone else conversations.PLAIN if text.endswith(".") else conversations.CUT
        table, after = conversations.moves(role[:1], kind), {}
        for s, (cost, audit, _) in best.items():
            for e, (more, letters) in enumerate(table[s]):
                if more < conversations.FAR:
                    after[e] = min(after.get(e, (1 << 61, "")), (cost + more, audit + letters))
        best = {e: (*way, None) for e, way in after.items()}
    cost, audit = min((c + conversations.TAILS[s][0], a + conversations.TAILS[s][1]) for s, (c, a, _) in best.items())
    assert got[1][5:7] == (cost, audit)
    assert len(got) == 49


def test_conversations_of_odd_tables(spark):
    frame = spark.createDataFrame([(None, None, None, None)] * 3 + [(1, None, "user", "x" * 300_000 + " " * 70_000)], CONVERSATIONS)
    rows = [tuple(r) for r in frame.collect()]
    clash = frame.withColumns({c: F.lit(1) for c in ("conv", "sums", "audit", "cost", "part", "seg", "digest", "kind", "n", "copy", "letters")})
    assert repaired(frame, 2) == repaired(clash, 2) == brute_conversations(rows)
    assert repaired(frame.limit(0), 2) == {}
    assert conversations.repair_damaged(frame).columns == ["conv_id", *conversations.COUNTS, "audit", "repaired_sha256"]


def test_no_cross_joins(spark):
    sf = "/root/testdata/sf0.001"
    for name in ("op11_main_text", "op12_phrases", "op13_conversations"):
        text = plan(queries()[name](spark, sf))
        assert "NestedLoop" not in text and "Cartesian" not in text
