import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from feedlark.llm import quality, queries

SCHEMA = "doc_id long, text string, lang string, source string"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def statistics(df):
    out = quality.with_statistics(df).collect()
    return {r["doc_id"]: tuple(r[c] for c in (*quality.STATISTICS, "base_failed")) for r in out}


def test_statistics_against_plain_python(spark):
    rnd = random.Random(5)
    texts = [None, "", " \t\n ", "a", "a b c", "a b c d", "a a a a", "a b c a b c", "é𝄞 x\x0b\x0cy\x1cz w", "# $ |\n\n# $ |\n \n"]
    texts += ["".join(rnd.choice(["a", "b", "c", " ", "  ", "\n", "#"]) for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    texts += ["w x y z\n" * 30_000]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    assert statistics(df) == {i: plain(t) for i, t in enumerate(texts)}


def test_outliers_go_and_the_rest_stays(spark):
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8))) for _ in range(3000)]

    def text(n):
        return " ".join(rnd.choices(vocabulary, k=n))

    rows = [(i, text(rnd.randint(80, 400)), "en", "big" if i < 350 else None) for i in range(600)]
    rows += [(1000 + i, text(100).replace(" ", " #$%&*| "), "en", "big") for i in range(20)]
    rows += [(2000, text(200), "xx", "few"), (2001, "short", "xx", "few")]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *(F.lit("clash").alias(c) for c in ("m0", "l00", "cell", "distance", "length", "n_words")))
    got = quality.robust_quality(quality.with_statistics(df)).collect()
    assert {r["m0"] for r in got} == {"clash"}
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert len(got) == len(rows) and all(kept[i] for i in range(600)) and not any(kept[1000 + i] for i in range(20))
    assert kept[2000] and not kept[2001]


def test_empty_table(spark):
    assert quality.robust_quality(quality.with_statistics(spark.createDataFrame([], SCHEMA))).count() == 0


def test_distance_is_mahalanobis(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=5)
    a = rnd.normal(size=(5, 5))
    scatter = a @ a.T + np.eye(5)
    factor = np.linalg.cholesky(scatter)
    row = {n: float(v) for n, v in zip(quality.FEATURES, x)}
    row |= {f"m{i}": float(i) for i in range(5)} | {f"l{i}{k}": float(factor[i, k]) for i in range(5) for k in range(i + 1)}
    got = spark.createDataFrame([row]).select(quality._distance()).first()[0]
    d = x - np.arange(5)
    assert abs(got - d @ np.linalg.inv(scatter) @ d) < 1e-9


def test_query_on_the_whole_table(spark):
    got = {r["doc_id"]: r for r in queries.op10_quality_outliers(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert tuple(r[c] for c in (*quality.STATISTICS, "base_failed")) == plain(d["text"])
        assert not (r["base_failed"] and r["kept"])
