"""Scans, languages, tokens and counts against brute force and round trips."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ripplekit.llm import bpe_automaton, language_id, secret_scan, token_counts, words
from ripplekit.llm.automaton import Dfa, Nfa, anchored
from ripplekit.llm.queries import queries
from ripplekit.session import shared_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def either(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(either, ("password", "passwd", "secret", "token")), f"{either('api')}_?{either('key')}"])
BRUTE = (
    ("assign", re.compile(rf"""(?:{NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
)


def brute_spans(text):
    found = [
        (m.start(), k, m.end()) for k, (_, rx, group, least) in enumerate(BRUTE)
        for m in rx.finditer(text) if len(m[group]) >= least
    ]
    return [(BRUTE[k][0], s, e) for s, k, e in sorted(found)]


SECRET_PARTS = [
    "token", "Secret", "api_key", "APIKEY", "passwd", "PASSWORD", "=", ":", " ", "  ", '"', "'", "AKIA", "ABCD1234EFGH",
    "0123456789abcdef", "deadbeef", "é", "\n", "x", "-", "_", ".", "ghp_", "abcdefgh", "K", "ſecret",
]


def test_secrets_equal_plain_expressions():
    rng, scan = random.Random(1), secret_scan.scanner(secret_scan.RULES)
    for _ in range(5000):
        text = "".join(rng.choice(SECRET_PARTS) for _ in range(rng.randint(0, 14)))
        assert [s for s in scan.spans(text) if s[0] in ("assign", "access", "hex")] == brute_spans(text), text


def test_added_rules_find_their_secrets():
    found = {k for k, _, _ in secret_scan.scanner(secret_scan.RULES).spans(
        f"ghp_{'a1' * 20} xoxb-{'1' * 20} AIza{'x' * 35} eyJ{'a' * 20}.{'b' * 20}.{'c' * 20} -----BEGIN RSA PRIVATE KEY-----")}
    assert found >= {"github", "slack", "google", "jwt", "pem"}


def test_automata_are_minimal_and_read_what_the_expression_reads():
    rng = random.Random(2)
    for pattern in ["a(b|c)*d?", "(ab|a)(c|bcd)", "[a-c]{2,3}d+", "a?b?c?", "[^ab]c"]:
        dfa = anchored(pattern)
        for _ in range(500):
            text = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 7)))
            ends = [e for e in range(len(text) + 1) if re.fullmatch(pattern, text[:e])]
            assert dfa.longest(text.encode(), 0) == (ends[-1] if ends else -1), (pattern, text)
    nfa = Nfa()
    start = nfa.state()
    assert len(Dfa(nfa, start, [nfa.add("(a|b)*abb", start)], False).accepts) == 5  # four and one dead


def test_secret_query_on_odd_rows(spark, odd, clashing, none):
    got = {(r.doc_id, i): r.spans for i, r in enumerate(secret_scan.scan_secrets(odd).collect())}
    want = [brute_spans(t or "") for t in [r.text for r in odd.collect()]]
    assert [[tuple(s) for s in spans if s["kind"] in ("assign", "access", "hex")] for spans in got.values()] == want
    assert secret_scan.scan_secrets(clashing).columns == ["doc_id", "spans"]
    assert secret_scan.scan_secrets(none).count() == 0
    clean = secret_scan.redact_secrets(odd, size="n_chars")
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert clean.where("text LIKE '%[secret]%'").count() == sum(map(bool, want))
    assert clean.where("n_chars != char_length(text)").count() == 0


def test_secret_digests(spark, sf):
    got = {r.doc_id: r for r in queries()["op1_secret_scan"](spark, sf).collect()}
    for doc in spark.read.parquet(f"{sf}/documents.parquet").collect():
        spans = brute_spans(doc.text or "")
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        row = got[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == n for k, _, _ in spans) for n in ("assign", "access", "hex"))
        assert set(text.split(",")) - {""} <= set(row.spans.split(","))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


TEXT_PARTS = [
    "a", "aa", "aaa", "the", " the", " ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\u00a0", "\u2003", "'s", "'S", "don't", "12",
    "é", "e\u0301", "İ", "ß", "Σ", "中", "中文", "😀", "<|endoftext|>", "<|startoftext|>", "<|", ".", ",", "A", "Hello", "\u0000",
    "\u200b", "ſ", "\u212a", "ﬁ", "ñ", "Ñ", "\u0558",
]


def test_token_ids_equal_the_library(library):
    rng, codec = random.Random(3), bpe_automaton.codec(BYTE_BPE)
    cased, bare = words.library_spaced(BYTE_BPE), words.library_bare(WORD_BPE)
    lower = Tokenizer.from_file(WORD_BPE)
    for _ in range(5000):
        text = "".join(rng.choice(TEXT_PARTS) for _ in range(rng.randint(0, 12)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.ids(text) == cased.ids(text) == words.packed(ids), text
        assert codec.text(words.packed(ids)) == library.decode(ids, skip_special_tokens=False), text
        assert bare.ids(text) == words.packed(lower.encode(text, add_special_tokens=False).ids), text


def test_every_token_and_random_bytes_have_one_path(library):
    rng, codec = random.Random(4), bpe_automaton.codec(BYTE_BPE)
    letters = {b: c for c, b in bpe_automaton.byte_of_letter().items()}
    for _ in range(3000):
        word = bytes(rng.choice(b"abcdefehinrst \xc3\xa9\xff\x00") for _ in range(rng.randint(1, 12)))
        mapped = "".join(letters[b] for b in word)
        assert codec.automaton.walk(word) == [t.id for t in library.model.tokenize(mapped)]


def test_long_words_take_time_in_proportion():
    assert len(words.packed(bpe_automaton.codec(BYTE_BPE).automaton.walk(b"ab" * 50_000))) > 0


def test_kept_values_are_bounded_and_right():
    made = []
    kept = words.Kept(lambda k: made.append(k) or k.encode(), 10)
    assert all(kept[str(i % 7)] == str(i % 7).encode() for i in range(100))
    assert all(kept[str(i)] == str(i).encode() for i in range(100))
    assert len(kept) + len(kept.older) <= 10
    long = "x" * (words.LONGEST + 1)
    assert kept[long] == long.encode() and long not in kept and long not in kept.older


def test_codec_round_trip_on_odd_rows(spark, odd, clashing, none, library):
    decoded = bpe_automaton.decode(bpe_automaton.encode(odd, BYTE_BPE), BYTE_BPE).collect()
    assert [r.text for r in decoded] == [r.text or "" for r in odd.collect()]
    assert [bytes(r.ids) for r in decoded] == [
        words.packed(library.encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect()
    ]
    assert bpe_automaton.encode(clashing, BYTE_BPE).count() == odd.count()
    assert bpe_automaton.encode(none, BYTE_BPE).count() == 0


def test_codec_query(spark, sf, library):
    got = {r.doc_id: r for r in queries()["op4_bpe_codec"](spark, sf).collect()}
    for doc in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(doc.text, add_special_tokens=False).ids
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_counts_are_cached_by_text_and_tokenizer(spark, odd, clashing, none, library):
    cache = shared_dir(spark, "cache")
    want = sorted((len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())

    def counts(docs):
        return sorted((r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, BYTE_BPE, cache).collect())

    assert counts(none) == []
    half = odd.where("doc_id % 2 = 0")
    counts(half)
    stored = spark.read.parquet(cache)
    first = stored.count()
    assert first == half.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert counts(odd) == want == counts(clashing)
    assert spark.read.parquet(cache).count() == odd.select(F.coalesce("text", F.lit(""))).distinct().count() > first
    # A stored count is used as it is: a changed one shows.
    marked = shared_dir(spark, "cache")
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(99).cast("bigint")).write.partitionBy("tokenizer").parquet(marked)
    assert {r.n_tokens for r in token_counts.count_tokens(odd, BYTE_BPE, marked).collect()} == {99}


def test_count_query(spark, sf, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries()["op9_token_counts"](spark, sf).collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries()["op3_language_id"](spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in unseen)
    assert right >= 0.95 * len(unseen), (right, len(unseen))


def test_languages_of_odd_rows(spark, odd, clashing, none):
    network = language_id.learn(odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb")), per_language=100)
    got = language_id.predict_language(clashing, network).collect()
    for r, doc in zip(got, clashing.collect()):
        letters = any(map(str.isalpha, doc.text or ""))
        assert (r.lang_pred in ("aa", "bb") and r.score > 0) if letters else (r.lang_pred, r.score) == ("und", 0.0)
    assert language_id.learn(none) is None
    assert {r.lang_pred for r in language_id.predict_language(odd, None).collect()} == {"und"}
    assert language_id.predict_language(none, network).count() == 0


def test_windows_hold_whole_texts():
    texts = [bytes([i % 251]) * n for i, n in enumerate([1, 255, 256, 257, 1000])]
    windows, sizes, firsts = language_id.cut(texts)
    for text, first, end in zip(texts, firsts, [*firsts[1:], len(windows)]):
        flat = windows[first:end].ravel()
        assert bytes(flat[flat < 256].astype("uint8")) == text and sizes[first:end].sum() == len(text)
