import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlark.llm import queries, toxicity

BAD = ["grunk", "blorf", "snivelA", "snivelB"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        words = rnd.choices(vocabulary, k=rnd.randint(5, 60))
        bad = rnd.random() < 0.2
        if bad:
            for w in rnd.sample(BAD, rnd.randint(1, 3)):
                words.insert(rnd.randrange(len(words)), w)
        docs.append((i, " ".join(words), int(bad)))
        labels.append((i, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus(700)
    docs += [(10_000, None, 0), (10_001, "", 0), (10_002, "grunk blorf", 1), (10_003, "grunk blorf", 1)]
    labels += [(3, None), (4, 0), (99_999, 1), (None, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, truth int")
    return df, toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(learned):
    df, model = learned
    got = toxicity.score(df, model).withColumn("held", toxicity.is_held_out(F.col("doc_id"))).collect()
    held = [r for r in got if r["held"]]
    assert len(held) > 100 and sum(r["predicted"] == r["truth"] for r in held) >= 0.98 * len(held)
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[10_000]["score"] == by_id[10_001]["score"] < 0.5 < by_id[10_002]["score"] == by_id[10_003]["score"]
    assert len(got) == 704 and all(0 <= r["score"] <= 1 for r in got)


def test_label_model(learned):
    _, model = learned
    rates = dict(zip(model.voters, zip(model.on_toxic, model.on_other)))
    assert any("grunk".startswith(v.rstrip("*")) for v in rates)
    assert all(a > b for a, b in rates.values())
    assert model.correlation.shape == (len(model.voters),) * 2


def test_correlated_voters_share_their_weight(spark):
    rnd = random.Random(2)
    rows = []
    for _ in range(2_000):
        bad = rnd.random() < 0.3
        same = rnd.random() < (0.6 if bad else 0.02)
        votes = [0, 1] if same else []
        votes += [k for k in (2, 3) if rnd.random() < (0.6 if bad else 0.02)]
        rows.append((",".join(map(str, votes)), 1))
    patterns = spark.createDataFrame(rows, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    seen = np.array([[50.0] * 4, [10.0] * 4])
    m = toxicity.fit_label_model(patterns, list("abcd"), seen, (100, 200), 0.3)
    assert m.correlation[0, 1] > 0.9 and abs(m.correlation[2, 3]) < 0.3
    assert m.share[0] < 0.6 and m.share[2] == 1
    assert np.abs(m.on_toxic - 0.6).max() < 0.15 and m.on_other.max() < 0.08


def test_terms():
    assert toxicity.terms(None) == set()
    assert toxicity.terms("ABC déjà") == {"abc", "déjà", "déj*", "~shouting"}
    assert "~exclamation" in toxicity.terms("no!!")


def test_without_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(df, none)
    assert toxicity.score(df, model).first()["predicted"] == 0
    assert toxicity.score(df.limit(0), toxicity.fit(df.limit(0), none)).count() == 0
    assert toxicity.score(df.withColumn("score", F.lit(7)), model).first()["score"] < 0.5


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    told = got.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in told) >= 0.9 * len(told)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
