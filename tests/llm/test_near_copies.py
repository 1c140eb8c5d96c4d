"""The pipeline's near copies against brute force over five-word runs."""

import random
import re
import time
from collections import Counter, defaultdict
from functools import partial

from pyspark.sql import functions as F

import corpus_pipeline
from ripplekit.llm import near_copies, simhash
from ripplekit.session import Scratch

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def five_words(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))}


def brute_pairs(rows):
    """Pairs of different rows whose run sets have a Jaccard similarity of 0.8 or more: such a pair shares one of
    each set's rarest fifth (and one more) of runs, so only rows that do are compared."""
    sets, by = {i: five_words(t) for i, t in rows}, defaultdict(list)
    often = Counter(run for runs in sets.values() for run in runs)
    for i, runs in sets.items():
        for run in sorted(runs, key=lambda r: (often[r], r))[: len(runs) - -(-8 * len(runs) // 10) + 1]:
            by[run].append(i)
    pairs = set()
    for i, j in {(j, i) for ids in by.values() for i in ids for j in ids if j < i}:
        shared = len(sets[i] & sets[j])
        if 10 * shared >= 8 * (len(sets[i]) + len(sets[j]) - shared):
            pairs.add((i, j))
    return pairs


def components(rows, pairs):
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in root}


def planted(rng):
    """Texts with edits of every size, alone and in families that descend from each other."""
    vocabulary = [f"word{i}" for i in range(5000)]
    texts = []
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.randint(60, 300))
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            base = list(rng.choice([base, texts[-1]]))
            for _ in range(rng.randint(1, 5)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            texts.append(base)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_edited_copies_go_and_others_stay(spark):
    rows = planted(random.Random(3))
    want = components(rows, brute_pairs(rows))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCUMENTS)
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").collect()}
    assert 60 <= len(set(want.values())) < len(rows)
    assert kept == set(want.values())


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").groupBy("text").agg({"doc_id": "min"}).toDF("text", "doc_id")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pairs = brute_pairs(rows)
    roots = {r.node: r.root for r in near_copies.near_copies(docs).collect()}
    copies = {r.doc_id: r.copy for r in docs.select("doc_id", near_copies.copy_id(docs.text).alias("copy")).collect()}
    root = {i: roots.get(c, c) for i, c in copies.items()}
    recalled = sum(root[a] == root[b] for a, b in pairs)
    print(f"{recalled} of {len(pairs)} pairs in one component")
    assert len(pairs) >= 40 and recalled >= 0.98 * len(pairs)


def test_leaders_meet_their_pairs_in_parts(spark):
    """Pairs of one leader dealt to many tasks give what they give in one."""
    texts = [(i, " ".join([*(f"w{j}" for j in range(100)), *["x"] * (i % 3), f"y{i}"])) for i in range(50)] + [(99, "other")]
    bodies = spark.createDataFrame(texts, "copy bigint, body string")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 50)] + [(99, 0), (5, 99)], "a bigint, b bigint")
    want = sorted((i, 0) for i in range(1, 50))
    for share in (3, 1000):
        assert sorted(tuple(r) for r in near_copies.checked(pairs, bodies, 0.8, 5, share).collect()) == want


def test_similarity_hashes_come_first(spark, monkeypatch):
    """The trees' own pairs, checked, link lightly edited copies, without minimum hashes."""
    rng = random.Random(5)
    base = rng.choices([f"word{i}" for i in range(3000)], k=2000)
    texts = [" ".join([*base[:i], f"new{i}", *base[i + 1 :]]) for i in range(0, 2000, 200)] + ["other " + " ".join(rng.choices(base, k=90))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(near_copies, "keys", lambda found: [])  # no buckets
    roots = {r.node: r.root for r in near_copies.near_copies(docs).collect()}
    copies = [r.copy for r in docs.orderBy("doc_id").select(near_copies.copy_id(F.col("text")).alias("copy")).collect()]
    assert len({roots.get(c, c) for c in copies[:-1]}) == 1 and copies[-1] not in roots


def test_direct_links_are_within_the_radius():
    rng = random.Random(6)
    values = [rng.getrandbits(64)]
    for _ in range(300):
        values.append(rng.choice(values) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values = sorted(set(values))
    links = simhash.linked(values, 4, direct=True)
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    by = lambda found: components([(v, "") for v in values], found)
    assert by(links) == by(simhash.linked(values, 4))


def test_texts_are_dealt_out_once_to_be_chosen(spark):
    """The rows' own texts cross one exchange, not one for the join and one for repeats."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, f"{i} " + " ".join(f"w{i}x{j}" for j in range(50)), "en", "s", 1) for i in range(20)] * 2
        docs = spark.createDataFrame(rows, DOCUMENTS)
        kept = corpus_pipeline.one_of_each(spark, docs, "")
        tops = kept._jdf.queryExecution().executedPlan().toString().split("LeftSemi")[0]
        assert "Exchange" not in tops and kept.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_odd_tables(spark, odd, none, clashing):
    """Texts without words are alike; short ones are alike if equal but for case and space; columns do not clash."""
    clash = clashing.withColumns({c: F.lit(1) for c in ("copy", "body", "bucket", "comp", "node", "root")})
    for docs in (odd, clash):
        roots = {r.node: r.root for r in near_copies.near_copies(docs).collect()}
        copies = {r.text: r.copy for r in odd.select("text", near_copies.copy_id(F.col("text")).alias("copy")).collect()}
        root = {t: roots.get(c, c) for t, c in copies.items()}
        assert len({root[t] for t in (None, "", " ", "\n\n")}) == 1
        assert root["one two three four"] == root["ONE two three FOUR"] != root["a"]
    assert near_copies.near_copies(none).count() == 0


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_rounds_of_components_leave_no_files(spark, monkeypatch):
    """Of all rounds one table stays, and none of their shuffle files; tasks may hold few nodes at a time."""
    rng = random.Random(7)
    pairs = [(i, i + 1) for i in range(200) if i % 50] + [tuple(rng.sample(range(300, 500), 2)) for _ in range(150)]
    links = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(3)
    monkeypatch.setattr(simhash, "contracted", partial(simhash.contracted, most=20))
    before, scratch = shuffle_files(spark), Scratch(spark)
    found = simhash.components(links, scratch)
    late = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < late:
        time.sleep(0.2)  # they are deleted in the background
    assert not left
    assert {name: len(paths) for name, paths in scratch.paths.items() if paths} == {"links": 1}
    want = components([(i, "") for i in sorted({i for pair in pairs for i in pair})], pairs)
    assert {r.node: r.root for r in found.collect()} == {i: root for i, root in want.items() if i != root}


def test_links_of_a_task_are_contracted_at_once(spark):
    """A path in one task needs no round of stars, however long."""
    scratch, names = Scratch(spark), []
    keep = scratch.keep
    scratch.keep = lambda df, name: names.append(name) or keep(df, name)
    found = simhash.components(spark.range(2000).selectExpr("id AS a", "id + 1 AS b").coalesce(1), scratch)
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(1, 2001)}
    assert "least" not in names
