import random
import re

import numpy as np
from pyspark.sql import functions as F

from feedlark.llm import neardup, queries


def sets(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()


def plain(docs):
    """{doc: (n, component)} from all pairs."""
    s = [sets(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 85 * len(s[i] | s[j]):
                a, b = sorted((root(i), root(j)), key=lambda k: docs[k][0])
                parent[b] = a
    return {d: (len(s[i]), docs[root(i)][0]) for i, (d, _) in enumerate(docs)}


def judged(df):
    got = neardup.near_duplicates(df).collect()
    assert all(r["kept"] == (r["doc"] == r["component_id"]) for r in got)
    return {r["doc"]: (r["n_shingles"], r["component_id"]) for r in got}


def corpus(rnd):
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(12):
        base = rnd.choices(vocabulary, k=rnd.randint(30, 150))
        for _ in range(rnd.randint(1, 25)):
            copy = list(base)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                base = copy  # a chain
            docs.append(rnd.choice([" ", "\n", "  "]).join(copy))
    docs += ["", " \n", "a", "A", "a b", "é b c d", "É b c d", "a\x1cb c d", "a\x85b c d"] + [docs[0].upper()] * 30
    ids = rnd.sample(range(10_000), len(docs))
    return list(zip(ids, docs))


def test_against_all_pairs(spark):
    docs = corpus(random.Random(31))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert judged(df) == plain(docs)


def test_nulls_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d", 1), (1, "a b c d", 1), (2, "A  b\tc d", 1), (None, "a b c d", 1), (3, None, 1), (None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int")
    got = sorted(((r["doc"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True), (3, 0, 3, True), (None, 0, None, True)], key=repr)
    assert neardup.near_duplicates(df.limit(0)).count() == 0
    assert sorted((r["doc_id"] for r in neardup.keep_one(df).collect()), key=repr) == [1, 1, 3, None, None]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5001), (5001, 5000), (6000, 6000)]
    got = neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)} | {5000: 5000, 5001: 5000}
    assert {r["node"]: r["component"] for r in got} == want


def test_posterior_bounds_keep_what_is_similar():
    rnd = np.random.default_rng(5)
    limits = neardup.most_mismatches()
    assert limits == sorted(limits) and limits[-1] < neardup.BATCH * neardup.BATCHES * 0.25
    agree = rnd.random((20_000, neardup.BATCH * neardup.BATCHES)) < 0.925
    differing = (~agree).reshape(-1, neardup.BATCHES, neardup.BATCH).sum(axis=2).cumsum(axis=1)
    assert (differing <= limits).all(axis=1).mean() > 0.999


def test_signature_estimates_similarity():
    rnd = random.Random(3)
    a = [f"w{rnd.randrange(10**6)}".encode() for _ in range(9_000)]
    b = a[:8_000] + [f"v{i}".encode() for i in range(1_000)]
    x, y = (neardup.signature(neardup.shingle_hashes(w)) for w in (a, b))
    true = len(neardup.shingles(a) & neardup.shingles(b)) / len(neardup.shingles(a) | neardup.shingles(b))
    assert abs((x == y).mean() - true) < 0.1 and len(neardup.shingle_hashes(a)) == len(neardup.shingles(a))


def test_query_on_the_whole_table(spark):
    got = queries.op7_near_dedup(spark, "/root/testdata/sf0.001").collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(docs)
    assert not all(r["kept"] for r in got) and len(got) == len(docs)


def test_blocks_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MEMBERS", 4)
    monkeypatch.setattr(neardup, "TURNS", 0)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(60):
        copy = list(base)
        for _ in range(rnd.randint(0, 4)):
            copy[rnd.randrange(60)] = f"n{rnd.randrange(10)}"
        docs.append((100 - i, " ".join(copy)))
    assert judged(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs)


def plain_links(docs, shingle, share):
    """{doc: component} from all pairs of the sets of `shingle` words."""
    s = [neardup.shingles(t.lower().encode().split(), shingle) for _, t in docs]
    component = {d: d for d, _ in docs}
    for i, (a, _) in enumerate(docs):
        for j, (b, _) in enumerate(docs[:i]):
            if share[1] * len(s[i] & s[j]) >= share[0] * len(s[i] | s[j]):
                old, new = sorted((component[a], component[b]), reverse=True)
                component = {d: new if c == old else c for d, c in component.items()}
    return component


def test_five_words_and_another_threshold(spark):
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(4000)]
    docs = []
    for _ in range(20):
        base = rnd.choices(vocabulary, k=200)
        for more in (0, 40, rnd.randint(41, 70)):
            docs.append((len(docs), " ".join(base + rnd.choices(vocabulary, k=more))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    components = {}
    for rule in ((5, (80, 100)), (3, (85, 100))):
        got = neardup.near_duplicates(df, shingle=rule[0], share=rule[1]).collect()
        components[rule[0]] = {r["doc"]: r["component_id"] for r in got}
        assert components[rule[0]] == plain_links(docs, *rule)
    assert all(components[5][i + 1] == components[5][i] and components[3][i + 1] != components[3][i] for i in range(0, 60, 3))
    assert {r["doc_id"] for r in neardup.keep_one(df, shingle=5, share=(80, 100)).collect()} == set(components[5].values())


def test_bands_miss_little_at_the_threshold():
    for share in ((70, 100), (80, 100), (85, 100), (95, 100)):
        rule = neardup.rule_of(5, share)
        assert (1 - (share[0] / share[1]) ** rule.band_rows) ** rule.bands < neardup.MISS
        assert rule.bands * rule.band_rows <= neardup.BATCH * neardup.BATCHES
    assert neardup.rule_of()[2:4] == (neardup.BANDS, neardup.BAND_ROWS)
