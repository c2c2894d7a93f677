import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlark.functions.text import split_tokens, text_key
from feedlark.operators import mention

PLAIN = {"tokens": split_tokens, "counted": lambda c: F.col(c) != ""}
SPLIT = {"bag_rows": 7}  # many blocks
CELLS = {"block_cells": 20}
POSTS, PRODUCTS = "id string, clean_text string", "product_id string, clean_name string"


def brute_force(posts, products, max_features=10_000):
    """{post text: [(-rank, product, score)] best first} by scoring every pair."""
    bags = [Counter(t.split()) for _, t in posts], [Counter(t.split()) for _, t in products]
    full = [b for side in bags for b in side if b]
    df, ctf = Counter(), Counter()
    for b in full:
        df.update(b.keys())
        ctf.update(b)
    vocab = sorted(ctf, key=lambda t: (-ctf[t], t))[:max_features]
    idf = {t: math.log((1 + len(full)) / (1 + df[t])) + 1 for t in vocab}
    raw = [[{t: n * idf[t] for t, n in b.items() if t in idf} for b in side] for side in bags]
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    found = {}
    for (_, text), v in zip(posts, raw[0]):
        scores = []
        for (pid, _), w in zip(products, raw[1]):
            dot = sum(x * w.get(t, 0) for t, x in v.items()) / (norm(w) or 1)
            if round(dot, 6) > 0:
                scores.append((-round(dot, 6), pid, round(dot / norm(v), 6)))
        found[text] = sorted(scores)
    return found


def random_rows(seed, n, prefix, longest):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    weight = [60, 30, 20, 10, 8, 6, 5, 4, 3, 2, 2, 1]
    return [(f"{prefix}{i}", " ".join(rng.choices(words, weight, k=rng.randint(0, longest)))) for i in range(n)]


def test_golden(spark, rows):
    posts = spark.createDataFrame([("r1", "red bolt loose"), ("r2", "blue gear"), ("r3", "zzz")], POSTS)
    products = spark.createDataFrame([("p1", "red bolt"), ("p2", "blue ring")], PRODUCTS)
    got = mention.map_mentions(posts, products, tokenising=PLAIN)
    assert rows(got.select("id", "product_id", "similarity_score")) == [
        ("r1", "p1", 0.75204), ("r2", "p2", 0.394276), ("r3", None, 0.0)]


@pytest.mark.parametrize("limits, k", [({}, 1), ({}, 3), ({**SPLIT, **CELLS, "hot_rows": 2}, 1), ({**SPLIT, **CELLS, "hot_rows": 2}, 3), ({}, 2)])
def test_against_brute_force(spark, limits, k):
    posts, products = random_rows(1, 150, "r", 6), random_rows(2, 120, "p", 4)
    products = [p for p in products if p[1]]
    posts += [("r0", "w0")] * 30 + [("r0", "w0 w1")] * 20  # copies that make up a quarter of the posts
    want = brute_force(posts, products)
    got = mention.map_mentions(
        spark.createDataFrame(posts, POSTS), spark.createDataFrame(products, PRODUCTS), k=k, tokenising=PLAIN, **limits
    ).collect()
    expected = Counter()
    for pid, text in posts:
        best = want[text][:k] or [(0, None, 0.0)]
        expected.update((pid, text, i + 1, b[1], b[2]) for i, b in enumerate(best))
    assert Counter((r.id, r.clean_text, r.place, r.product_id, r.similarity_score) for r in got) == expected


@pytest.mark.parametrize("limits", [{}, SPLIT])
def test_similar_pairs_against_brute_force(spark, limits):
    posts, products = random_rows(3, 120, "r", 6), [p for p in random_rows(4, 30, "p", 4) if p[1]]
    want = {
        (text, next(n for i, n in products if i == pid), score)
        for text, found in brute_force(posts, products).items() for _, pid, score in found if score >= 0.4
    }
    p, q = spark.createDataFrame(posts, POSTS), spark.createDataFrame(products, PRODUCTS)
    catalog, texts = mention.fit_catalog(p, q, **PLAIN, **(CELLS if limits else {}))
    got = mention.similar_pairs(texts, catalog, 0.4, **limits)
    got = got.join(p.select("clean_text", text_key("clean_text").alias("text_key")).distinct(), "text_key")
    got = got.join(q.select("clean_name", text_key("clean_name").alias("name_key")).distinct(), "name_key")
    assert {(r.clean_text, r.clean_name, r.similarity_score) for r in got.collect()} == want


@pytest.mark.parametrize("k", [1, 2])
def test_a_word_of_many_names(spark, k):
    products = [(f"p{i:03}", f"w0 own{i}") for i in range(200)] + [("q2", "w0"), ("q1", "w0")]
    posts = spark.createDataFrame([("a", "w0"), ("b", "w0 own150")], POSTS)
    catalog, texts = mention.fit_catalog(posts, spark.createDataFrame(products, PRODUCTS), k=k, **PLAIN)
    got = mention.attach_matches(posts, mention.map_texts(texts, catalog), "clean_text").collect()
    best = {(r.id, r.place): r.product_id for r in got}
    assert best["a", 1] == "q1" and best["b", 1] == "p150"
    assert k == 1 or (best["a", 2] == "q2" and best["b", 2] == "q1")


def test_vocabulary_limit(spark):
    posts, products = random_rows(5, 60, "r", 6), [p for p in random_rows(6, 20, "p", 4) if p[1]]
    want = brute_force(posts, products, max_features=4)
    got = mention.map_mentions(
        spark.createDataFrame(posts, POSTS), spark.createDataFrame(products, PRODUCTS), max_features=4, tokenising=PLAIN
    ).collect()
    best = {t: (w[0][1], w[0][2]) if w else (None, 0.0) for t, w in want.items()}
    assert all((r.product_id, r.similarity_score) == best[r.clean_text] for r in got)


def test_unlimited_vocabulary_gives_the_same(spark, rows):
    posts = spark.createDataFrame(random_rows(5, 60, "r", 6), POSTS)
    products = spark.createDataFrame([p for p in random_rows(6, 20, "p", 4) if p[1]], PRODUCTS)
    maps = [mention.map_mentions(posts, products, max_features=n, tokenising=PLAIN) for n in (None, 10_000)]
    assert rows(maps[0]) == rows(maps[1])


def test_an_empty_post_does_not_shift_the_others(spark, rows):
    posts = spark.createDataFrame([("a", "red bolt"), ("b", ""), ("c", "blue ring")], POSTS)
    products = spark.createDataFrame([("p1", "blue ring"), ("p2", "red bolt")], PRODUCTS)
    got = mention.map_mentions(posts, products, tokenising=PLAIN)
    assert rows(got.select("id", "product_id", "similarity_score")) == [
        ("a", "p2", 1.0), ("b", None, 0.0), ("c", "p1", 1.0)]


def test_equal_names_go_to_the_lowest_id(spark, rows):
    posts = spark.createDataFrame([("a", "red bolt")], POSTS)
    products = spark.createDataFrame([("p3", "red bolt"), ("p2", "red bolt"), ("p1", "ring")], PRODUCTS)
    got = mention.map_mentions(posts, products, k=2, tokenising=PLAIN)
    assert rows(got.select("place", "product_id")) == [(1, "p2"), (2, "p3")]


def test_min_score(spark, rows):
    posts = spark.createDataFrame([("a", "red x y z"), ("b", "red")], POSTS)
    products = spark.createDataFrame([("p1", "red")], PRODUCTS)
    got = mention.map_mentions(posts, products, min_score=0.9, tokenising=PLAIN)
    assert rows(got.select("id", "product_id", "similarity_score")) == [("a", None, 0.0), ("b", "p1", 1.0)]


def test_texts_of_common_words_count_as_documents(spark):
    """Words of the 318-word list leave the vocabulary after the documents were counted."""
    posts = spark.createDataFrame([("a", "red bolt"), ("b", "please"), ("c", "the")], POSTS)
    products = spark.createDataFrame([("p1", "red bolt")], PRODUCTS)
    texts, names = mention.distinct_texts(posts, "clean_text"), mention.distinct_texts(products, "clean_name")
    assert mention.document_count(texts, names) == 3
    assert {r.term for r in mention.term_stats(texts, names).collect()} == {"red", "bolt"}


@pytest.mark.parametrize("posts, products", [([], []), ([("a", "x")], []), ([], [("p", "x")]), ([("a", "")], [("p", "")])])
def test_nothing_to_map(spark, rows, posts, products):
    got = mention.map_mentions(
        spark.createDataFrame(posts, POSTS), spark.createDataFrame(products, PRODUCTS), tokenising=PLAIN
    )
    assert rows(got) == [(i, t, 1, None, None, 0.0) for i, t in posts]


def test_plan_has_no_cross_join(spark):
    posts, products = random_rows(1, 20, "r", 6), [p for p in random_rows(2, 10, "p", 4) if p[1]]
    p, q = spark.createDataFrame(posts, POSTS), spark.createDataFrame(products, PRODUCTS)
    catalog, texts = mention.fit_catalog(p, q, **PLAIN)
    words = mention.shared_words(texts, catalog).withColumn("bag_key", F.col("text_key"))
    plan = mention.best_names(words, catalog, **SPLIT)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_words_of_a_text_are_weighed_where_they_lie(spark, monkeypatch):
    rnd = random.Random(12)
    words = [f"word{i}" for i in range(30)]
    text = lambda: " ".join(rnd.choices(words, k=rnd.randint(1, 12)))
    posts = spark.createDataFrame([(str(i), text()) for i in range(90)] + [("x", None), ("y", "none of it")], POSTS)
    products = spark.createDataFrame([(str(i), text()) for i in range(5)], PRODUCTS)
    monkeypatch.setattr(mention, "WEIGH_ROWS", 7)
    catalog, texts = mention.fit_catalog(posts, products)
    near = mention.shared_words(texts, catalog)
    assert "Exchange" not in near._jdf.queryExecution().executedPlan().toString()
    catalog.bounded = False  # the join by terms, for a vocabulary of any size
    told = lambda df: sorted((bytes(r.text_key), r.copies, round(r.norm, 9), [(w.term, round(w.raw, 9)) for w in r.shared]) for r in df.collect())
    assert told(near) == told(mention.shared_words(texts, catalog)) != []
    weights = lambda bounded: sorted((bytes(r.text_key), r.term, round(r.weight, 9)) for r in mention.tfidf_weights(texts, catalog.vocab, bounded).collect())
    assert weights(True) == weights(False) != []


@pytest.mark.parametrize("k", [1, 2])
def test_names_that_are_not_asked_for_stay_out_of_the_joins(spark, rows, monkeypatch, k):
    posts = spark.createDataFrame(random_rows(8, 60, "r", 6), POSTS)
    products = spark.createDataFrame([p for p in random_rows(9, 20, "p", 4) if p[1]], PRODUCTS)
    kept, store = {}, mention.runtime.materialise
    monkeypatch.setattr(mention.runtime, "materialise", lambda df, label, *more: kept.update({label: store(df, label, *more)}) or kept[label])
    found = [mention.map_mentions(posts, products, k=k, with_names=x, tokenising=PLAIN) for x in (True, False)]
    assert {r.product_name for r in kept["ids"].collect()} == {None}
    assert rows(found[0].drop("product_name")) == rows(found[1].drop("product_name"))
