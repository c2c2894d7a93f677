import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from feedlark.llm import decontam, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items):
    """{doc: (n_words, n_hit, item ids)} from windows, one by one."""
    windows = {}
    for key, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[s : s + 13]), set()).add(str(key))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, keys = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    keys |= found
        out.append((doc, len(w), len(hit), sorted(keys), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def judged(df, items, **more):
    got = decontam.decontaminate(df, items, **more).collect()
    return [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_against_plain_python(spark, most):
    rnd = random.Random(13)
    vocabulary = ["the", "of", "a"] * 6 + ["x", "été", "z9", "Zebra", "lion", "q"]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(14, 30)))) for i in range(12)]
    items += [(50, "lion, zebra"), (51, "q"), (52, None), (53, "!!"), (2, "the of a x q lion the of"), (2, "the of a x q lion the of"), (54, "the " * 20)]
    docs = []
    for i in range(60):
        parts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 40)))]
        for _ in range(rnd.randint(0, 3)):
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randint(0, max(0, len(w) - 13))
            parts.append(" ".join(w[a : a + rnd.randint(10, 20)]) + rnd.choice([" ", ". "]))
        rnd.shuffle(parts)
        docs.append((i % 50, rnd.choice([" ", "\n", "--"]).join(parts)))
    docs += [(90, None), (91, ""), (92, "..."), (93, "THE " * 4000), (None, items[0][1]), (None, items[0][1])]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item int")
    table = spark.createDataFrame(items, "item_id long, text string")
    assert order(judged(df, table, most_terms=most)) == order(plain(docs, items))


def test_empty_tables_and_clashes(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert judged(docs, items.limit(0)) == [(1, 2, 0, [], False)]
    assert judged(docs.limit(0), items) == []
    clash = docs.select("*", *(F.lit(9).alias(c) for c in ("n_hit", "row", "words", "pos", "item", "term")))
    got = decontam.decontaminate(clash, items).first()
    assert (got["n_hit"], got["row"], got["words"], got["text"]) == (2, 9, 9, "a b")


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "lion a a zebra"), (2, "zebra lion"), (3, "lion " + "a " * 40 + "zebra")], "doc_id long, text string")
    items = decontam.store_items(spark.createDataFrame([(7, "zebra of the lion of a a")], "item_id long, text string"), "item_id", "text")
    stored = decontam.store_words(docs.union(docs.filter("false")), "text", ["doc_id"])
    index = decontam.build_index(stored, items)
    items2 = decontam.store_items(spark.createDataFrame([(7, "zebra lion")], "item_id long, text string"), "item_id", "text")
    near = decontam.proximity_matches(decontam.build_index(stored, items2), items2, within=5).join(stored, "row")
    assert sorted((r["doc_id"], r["distance"]) for r in near.collect()) == [(1, 3), (2, 1)]
    assert index.filter("term = 'lion'").count() == 3


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op9_decontaminate(spark, sf).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = [(d, n, h, len(k), hashlib.sha256(",".join(k).encode()).hexdigest(), c) for d, n, h, k, c in plain(docs, items)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert any(r["contaminated"] for r in got)
