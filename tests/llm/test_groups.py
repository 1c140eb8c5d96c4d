"""URL verdicts, packing, neighbours, near copies, shards and quality against brute force."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ripplekit.llm import neighbours, packing, quality, sharding, simhash, url_filter
from ripplekit.llm.queries import oracle_sql, queries

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_url_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.sql(oracle_sql()["op2_url_filter"])
    got = queries()["op2_url_filter"](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


URLS = {
    "http://A.Example.ORG/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/en/14": ("example.org", "/en/14", "example.org/en/1", "block"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "http://org/": ("org", "/", "org/", "allow"),
    "http://example.org": ("example.org", "", None, "allow"),
    "http://x.com/de/?q=/fr/": ("x.com", "/de/", "com/de/", "block"),
    "http://xcom/fr/": ("xcom", "/fr/", None, "allow"),
    "http://x.com/DE/": ("x.com", "/DE/", None, "allow"),
    "http://my.casino-win.example.net/en/": ("my.casino-win.example.net", "/en/", None, "block"),
    "http://casinos.example.net/en/": ("casinos.example.net", "/en/", None, "allow"),
    "http://É.com/fr/": ("É.com", "/fr/", "com/fr/", "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
    "http://x.net/en/7/": ("x.net", "/en/7/", None, "block"),
    "http://x.net/en/7/\n": ("x.net", "/en/7/\n", None, "allow"),
    "http://écasino.net/": ("écasino.net", "/", None, "block"),
    "http://a_casino.net/": ("a_casino.net", "/", None, "allow"),
    "http://casino": ("casino", "", None, "allow"),
    "http://cheap.x.info/": ("cheap.x.info", "/", None, "block"), "http://cheap.x.de/": ("cheap.x.de", "/", None, "allow"),
    "http://docs.x.net/en/7/": ("docs.x.net", "/en/7/", None, "allow"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
}


def test_urls_one_by_one(spark):
    rows = [(i, u, 1, 2) for i, u in enumerate(URLS)] * 2 + [(None, None, 1, 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host int, verdict int")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()]
    want = [(i, *v) for i, v in enumerate(URLS.values())] * 2 + [(None, "", "", None, "allow")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_urls_one_by_one_by_sql(spark):
    pages = pa.table({"page_id": list(range(len(URLS))), "url": list(URLS)})
    con = duckdb.connect()
    con.register("pages", pages)
    got = con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({oracle_sql()['op2_url_filter']}) ORDER BY page_id").fetchall()
    assert got == [(i, *v) for i, v in enumerate(URLS.values())]


def test_no_rules_allow_every_url(spark):
    pages = spark.createDataFrame([(1, "http://x.com/de/")], "page_id bigint, url string")
    none = spark.createDataFrame([], url_filter.RULE)
    assert [r.verdict for r in url_filter.judge_urls(pages, none).collect()] == ["allow"]


def test_rules_are_stored_under_their_rarest_choice(spark):
    tokens = spark.createDataFrame([(t,) for t in ["org"] * 5 + ["example"] * 3 + ["es"] * 9 + ["en"]], "token string")
    loose = url_filter.PatternRule("loose", "a|b", "block", ())
    rules = url_filter.rule_table(spark, patterns=(*url_filter.PATTERNS, loose))
    got = {}
    for r in url_filter.indexed(rules, tokens).collect():
        got.setdefault(r["name"], set()).add(r.token)
    assert got["example.org/es/"] == {"example"} and got["example.org/en/1"] == {"en"} and got["loose"] == {""}
    assert got["short-pages"] == {"en", "fr", "de", "es"} and got["help-pages"] == {"docs", "help"}


def test_thousands_of_site_rules_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "bc", "shop", "x1", "news", "é", "a-b", "Zed", "c++", "$"])
    hosts = [".".join(word().lower() for _ in range(rng.randint(1, 3))) for _ in range(3000)]
    sites = {(h, "/" + "/".join(word() for _ in range(rng.randint(0, 3)))): rng.choice(["allow", "block"]) for h in hosts}
    rows = [(h, p, v) for (h, p), v in sites.items()]
    rules = url_filter.site_rules(spark.createDataFrame(rows + rows[:50] + [(None, "/", "block"), ("a", "/", None)], "host string, path string, verdict string"))
    urls = [f"http://{'.'.join(word().lower() for _ in range(rng.randint(1, 4)))}/{'/'.join(word() for _ in range(rng.randint(0, 4)))}" for _ in range(1500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    for i, url in enumerate(urls):
        host, _, path = url[7:].partition("/")
        fits = [(len(h + p), h + p, v) for h, p, v in rows if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        assert got[i] == (max(fits)[1:] if fits else (None, "allow")), url
    assert sum(r is not None for r, _ in got.values()) > 500


# ---- packing


def brute_pieces(text, tokenizer, capacity):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    return [ids[i : i + capacity] for i in range(0, len(ids), capacity)]


def check_packing(rows, capacity):
    """Gapless from 0 in each sequence, none too long; returns the number of sequences."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(spark):
    sf, tokenizer = "/root/testdata/sf0.01", Tokenizer.from_file(WORD_BPE)
    rows = queries()["op5_packing"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = defaultdict(dict)
    for r in rows:
        got[r.doc_id][r.piece] = (r.start, r.length, r.ids_crc32)
    import zlib

    for doc_id, text in texts.items():
        want, at = {}, 0
        for k, part in enumerate(brute_pieces(text, tokenizer, 2048)):
            want[k] = (at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
            at += len(part)
        assert got[doc_id] == want
    bound = -(-sum(r.length for r in rows) // 2048)
    assert check_packing(rows, 2048) <= 1.01 * bound + 1


@pytest.mark.parametrize("kind", ["even", "large", "small", "equal", "one"])
def test_packing_comes_near_the_bound(spark, kind):
    rng = random.Random(5)
    lengths = {
        "even": [rng.randint(1, 2047) for _ in range(8000)],
        "large": [rng.randint(1025, 2047) for _ in range(1500)],
        "small": [rng.randint(1, 40) for _ in range(5000)],
        "equal": [700] * 3000,
        "one": [5],
    }[kind]
    parts = spark.createDataFrame([(n,) for n in lengths], "length bigint")
    rows = packing.pack(parts, items=2000).collect()
    assert Counter(r.length for r in rows) == Counter(lengths)
    bound = 1500 if kind == "equal" else packing.least_bins(lengths, 2048)
    assert check_packing(rows, 2048) <= 1.005 * bound + 1


def test_packing_odd_rows(spark, odd, clashing, none):
    rows = packing.pack(packing.pieces(clashing, WORD_BPE, with_ids=False)).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in odd.collect())
    assert {r.length for r in rows if r.doc_id in (0, 1)} == {1}
    check_packing(rows, 2048)
    assert packing.pack(packing.pieces(none, WORD_BPE)).count() == 0
    tokens = packing.pieces(odd, WORD_BPE).where("length != octet_length(ids) / 4").count()
    assert tokens == 0


def test_crossover_keeps_every_document_once():
    rng = random.Random(6)
    island = packing.Island([rng.randint(1, 2048) for _ in range(300)], 2048, 1)
    one, two = island.newcomer(), island.newcomer()
    for child in (island.cross(one, two), island.mutate(one), island.evolve([one, two])):
        assert sorted(i for b in child for i in b) == list(range(300))
        assert max(island.fills(child)) <= 2048


# ---- neighbours


def brute_nearest(rows, is_query, k=10):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and len(v)
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if is_query(q):
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in good if i != q and len(w) == len(v))
            out[q] = [(i, d) for d, i in near[:k]]
    return out


def recall(got, want):
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {q for q, near in want.items() if near}
    hits = total = 0
    for q, near in want.items():
        assert len(found[q]) == len(near)
        assert found[q] == sorted(found[q], key=lambda x: (x[1], x[0]))
        hits += len({i for i, _ in near} & {i for i, _ in found[q]})
        total += len(near)
    return hits / max(1, total)


def test_neighbour_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries()["op6_neighbours"](spark, sf).collect()
    assert recall(got, brute_nearest(rows, lambda i: i % 100 == 0)) >= 0.95


def test_neighbours_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 300)
    monkeypatch.setattr(neighbours, "QUERIES", 20)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=24) + 3 * (i % 5)).tolist()) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(frame, F.col("vec_id") % 30 == 0).collect()
    assert recall(got, brute_nearest(rows, lambda i: i % 30 == 0)) >= 0.9


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, float(i % 3)]) for i in range(40)]
    rows += [(100, None), (200, []), (300, [0.0, 0.0, 0.0]), (400, [nan, 1.0, 1.0]), (500, [inf, 1.0, 1.0]), (600, [None, 1.0, 1.0]),
             (None, [1.0, 0.0, 0.0]), (700, [1.0, 2.0]), (800, [1.0, 2.0]), (900, [5.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"id": F.lit(1), "score": F.lit(1)})
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    want = brute_nearest(rows, lambda i: i % 20 == 0)
    assert recall(got, want) == 1.0
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0] == want[0]
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("size", [1e200, 1e307, 1e-200])
def test_neighbours_of_very_large_and_small_components(spark, size):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) * size / 10).tolist()) for i in range(60)] + [(60 + i, rng.normal(size=6).tolist()) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in (0, 20, 40, 60, 80):
        query = np.array(rows[q][1], dtype=np.longdouble)
        far = sorted((float(np.sqrt(np.square(np.array(v, dtype=np.longdouble) - query).sum())), i) for i, v in rows if i != q)
        assert [i for i, _ in got[q]] == [i for _, i in far[:10]]
        assert np.allclose([s for _, s in got[q]], [d for d, _ in far[:10]], rtol=1e-12, atol=0)


def test_neighbours_too_far_for_a_double_rank_last(spark):
    rows = [(0, [1.7e308, 0.0]), (1, [-1.7e308, 0.0]), (2, [-1.7e308, 1.0]), (3, [1.7e308, 1e300])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(3, 1e300), (1, float("inf")), (2, float("inf"))]


def test_repeated_queries_ask_once_and_repeated_rows_part(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 50)
    rows = [(i, [float(i), 1.0]) for i in range(60)]
    frame = spark.createDataFrame(rows + rows[:1] * 200 + rows[5:6] * 4, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(frame, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5, 5, 5, 5, 5, 6]


# ---- near copies


def brute_fingerprint(text):
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    runs = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(values, near):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if near(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def brute_components(rows):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    roots = union({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, f in prints:
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    return sorted(((i, f"{f:016x}", least.get(roots[f])) for i, f in prints), key=repr)


def test_near_copy_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries()["op7_simhash"](spark, sf).collect()), key=repr) == brute_components(rows)


def test_near_copies_odd_rows(spark, odd, clashing, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = simhash.near_duplicates(clashing).collect()
    assert sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got), key=repr) == brute_components(rows)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius", [1, 4])
def test_links_over_chains_and_shards(spark, radius):
    """Chains of fingerprints whose ends lie far apart, and clusters, over all shards."""
    rng, values = random.Random(9), set()
    for _ in range(30):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            values.add(v)
            for _ in range(rng.randint(0, radius + 1)):
                v ^= 1 << rng.randrange(64)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.shard_links(frame, radius)).collect()}
    want = union(values, lambda a, b: (a ^ b).bit_count() <= radius)
    groups = defaultdict(set)
    for v, r in want.items():
        groups[r].add(signed[v])
    for members in groups.values():
        assert {roots.get(m, m) for m in members} == {min(members)}


LINKS = {
    "none": [],
    "stars already": [(9, 1), (8, 1), (7, 2)],
    "one node under two": [(9, 1), (9, 2)],
    "a root that is a leaf": [(9, 5), (5, 1)],
    "a path": [(i, i + 1) for i in range(40)],
    "a mixed path, either way and repeated": [(i * 7 % 31, (i + 1) * 7 % 31) for i in range(30)] * 2 + [(3, 3)],
}


@pytest.mark.parametrize("links", LINKS.values(), ids=LINKS)
def test_components_of_links(spark, links):
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    pairs = {frozenset(x) for x in links}
    want = {}
    for node in {n for x in links for n in x}:
        reached, grown = {node}, None
        while reached != grown:
            grown, reached = reached, reached | {n for p in pairs if p & reached for n in p}
        want[node] = min(reached)
    assert got == {n: r for n, r in want.items() if n != r}


# ---- shards


def check_shards(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert set(by) <= set(range(shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def cut_groups(rows):
    found = defaultdict(Counter)
    for r in rows:
        found[r.group][r.shard] += 1
    return {g: c for g, c in found.items() if sum(c.values()) > 1}


def test_shard_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries()["op8_sharding"](spark, sf).collect()
    check_shards(rows, 16)
    import zlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "rows", None)
    placed = sharding.shard_documents(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    groups = cut_groups(placed)
    assert groups and sum(len(c) == 1 for c in groups.values()) >= 0.9 * len(groups)


def test_a_hot_group_fills_whole_shards(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"pair {i // 6}" if i % 3 == 1 else f"single {i}") for i in range(4800)]
    placed = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), rounds=6).collect()
    check_shards(placed, 16)
    groups = cut_groups(placed)
    hot = max(groups.values(), key=lambda c: sum(c.values()))
    assert sum(hot.values()) == 1600 and len([n for n in hot.values() if n >= 50]) < 16
    pairs = [c for c in groups.values() if c is not hot]
    assert sum(len(c) == 1 for c in pairs) >= 0.8 * len(pairs)


def kept_links(groups):
    """The share of pairs of equal texts that lie in one shard."""
    pairs = lambda n: n * (n - 1) // 2
    return sum(pairs(n) for c in groups for n in c.values()) / sum(pairs(sum(c.values())) for c in groups)


def test_a_third_of_all_rows_fills_whole_shards_by_default(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"triple {i // 9}" if i % 10 == 1 else f"single {i}") for i in range(96_000)]
    placed = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check_shards(placed, 16)
    hot = max(cut_groups(placed).values(), key=lambda c: sum(c.values()))
    assert sum(hot.values()) == 32_000 and sum(sorted(hot.values())[-6:]) >= 0.97 * 32_000
    assert kept_links([hot]) >= 0.16  # 5 whole shards and a third: 0.177


@pytest.mark.parametrize("hot", [0, 16_000])
def test_pairs_stay_together_where_every_row_has_a_copy(spark, hot):
    rows = [(i, "hot" if i < hot else f"pair {i // 2}") for i in range(48_000)]
    placed = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check_shards(placed, 16)
    assert kept_links([c for c in cut_groups(placed).values() if sum(c.values()) == 2]) >= 0.97


def test_shards_odd_rows(spark, odd, clashing, none):
    rows = sharding.shard_documents(clashing).collect()
    check_shards(rows, 16)
    assert Counter(r.key if "key" in r else r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    assert sharding.shard_documents(none).count() == 0


# ---- quality


def brute_statistics(text):
    import re

    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    often = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(often),
    )


def test_statistics_equal_plain_counts():
    rng = random.Random(10)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b", " ", " ", "\n", "#", "|", "é", "\u00a0", "\x0b", "\x1c", "\t"]) for _ in range(rng.randint(0, 60)))
        assert quality.statistics(text)[:5] == brute_statistics(text), text


def test_quality_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries()["op10_quality"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        r, want = got[doc.doc_id], brute_statistics(doc.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_odd_rows(spark, odd, clashing, none):
    got = quality.judge_quality(clashing).collect()
    assert len(got) == odd.count() and all(r.base_failed or r.kept for r in got)
    assert quality.judge_quality(none).count() == 0
    kept = quality.keep_quality(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(r.kept for r in got)


def mahalanobis(points, steps=4):
    """The same concentration steps in numpy."""
    floor = np.diag(np.square(list(quality.FLOORS.values())))
    low, centre, high = (np.sort(points, axis=0)[int(np.ceil(q * len(points))) - 1] for q in (0.25, 0.5, 0.75))
    inverse = np.linalg.inv(np.diag(((high - low) / 1.349) ** 2) + floor)
    for _ in range(steps):
        d = np.einsum("ni,ij,nj->n", points - centre, inverse, points - centre)
        near = points[d <= np.sort(d)[int(np.ceil(0.75 * len(d))) - 1]]
        centre, inverse = near.mean(axis=0), np.linalg.inv(np.cov(near.T, bias=True) + floor)
    d = np.einsum("ni,ij,nj->n", points - centre, inverse, points - centre)
    return d / max(1.0, np.sort(d)[int(np.ceil(0.5 * len(d))) - 1] / quality.MEDIAN)


def test_outliers_equal_numpy_and_far_ones_go(spark):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(60, 400))), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(rng.choice(vocabulary) * 12 + "#$%&|<>" for _ in range(100)), "en", "s") for i in range(5)]
    rows += [(2000 + i, rows[i][1], None, None) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge_quality(frame).collect()}
    assert not any(got[1000 + i].kept for i in range(5))
    assert all(got[i].kept for i in range(300)) and all(got[2000 + i].kept for i in range(30))
    measured = quality.measure(frame.where("lang = 'en'"), "text").where("NOT failed").select("doc_id", *quality.NAMES).collect()
    want = mahalanobis(np.array([r[1:] for r in measured]))
    have = np.array([got[r.doc_id].distance for r in measured])
    assert np.allclose(have, want, rtol=0.05), np.abs(have / want - 1).max()


@pytest.mark.parametrize("size", [30, 100, 300])
def test_an_outlier_goes_from_tables_of_any_size(spark, size):
    rng = random.Random(size)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 400))), "en", f"s{i % 7}") for i in range(size)]
    rows.append((size, " ".join(rng.choice(vocabulary) * 12 + "#$%&|<>" for _ in range(100)), "en", "s"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge_quality(frame).collect()}
    measured = quality.measure(frame, "text").where("NOT failed").select("doc_id", *quality.NAMES).collect()
    want = mahalanobis(np.array([r[1:] for r in measured]))
    assert np.allclose([got[r.doc_id].distance for r in measured], want, rtol=0.05)
    assert [i for i, r in got.items() if not r.kept] == [size]


def test_labelled_poor_texts_go(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    judged = queries()["op10_quality"](spark, sf).where("NOT base_failed").join(labels, "doc_id")
    found = Counter((r.quality, r.kept) for r in judged.select("quality", "kept").collect())
    print(found)
    assert found[0, False] >= 0.95 * (found[0, False] + found[0, True])
    assert found[1, False] <= 0.02 * (found[1, False] + found[1, True])
