import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlark.llm import toxicity
from tests.llm.test_decontam import plain as plain_hits
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_linededup import plain_runs
from tests.llm.test_neardup import plain as plain_components

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_every_stage_on_its_own_input(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").coalesce(1).cache()
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]

    want = [(i, t) for (i, _), t in zip(given, plain_lines(given, 50))]
    want = [(i, t) for (i, t), (_, old) in zip(want, given) if t == old or t.strip()]
    got = stages["line dedup"](spark, docs, SF)
    assert rows_of(got) == sorted(want, key=repr) and got.columns == docs.columns
    assert got.filter("n_chars <> length(text)").count() == docs.filter("n_chars <> length(text)").count()

    component = plain_components(given)
    got = stages["near dedup"](spark, docs, SF)
    assert sorted(i for i, _ in rows_of(got)) == sorted(i for i, _ in given if component[i][1] == i)
    assert got.columns == docs.columns

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = stages["decontamination"](spark, docs, SF)
    assert rows_of(got) == sorted(((d, t) for (d, t), r in zip(given, plain_hits(given, items)) if not r[4]), key=repr)
    assert got.columns == docs.columns


def test_repeated_runs_go_with_both_ends(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").coalesce(1).cache()
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = [(i, new) for (i, old), new in zip(given, plain_runs(given, 50)) if new == old or new.strip()]
    got = corpus_pipeline.drop_repeated_lines(spark, docs, SF, both_sides=True)
    assert rows_of(got) == sorted(kept, key=repr) and got.columns == docs.columns
    assert rows_of(got) != rows_of(corpus_pipeline.drop_repeated_lines(spark, docs, SF))


def test_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    left = {r[0]: r[1] for r in kept.join(labels, "doc_id").groupBy("toxic").count().collect()}
    total = {r[0]: r[1] for r in labels.join(docs, "doc_id").groupBy("toxic").count().collect()}
    assert left[0] >= 0.98 * total[0] and left.get(1, 0) <= 0.4 * total[1]
    assert kept.columns == docs.columns
    held = labels.filter(toxicity.is_held_out(F.col("doc_id"))).count()
    assert held > 0


@pytest.mark.parametrize("rows", [0, 12])
def test_odd_rows_and_names(spark, tmp_path, rows):
    rnd = random.Random(4)
    long = " ".join(rnd.choices("abcdefgh", k=60))
    docs = [(i, rnd.choice([None, "", long, f"x{i} y z", "a"]), None, None, None) for i in range(8)]
    docs += [(None, long, "en", "s", 1), (None, None, None, None, None), (3, long, "en", "s", 5), (3, long, "en", "s", 5)]
    df = spark.createDataFrame(docs[:rows], DOCUMENTS)
    df = df.select("*", *(F.lit(7).alias(c) for c in ("score", "row", "deleted", "n_hit", "doc", "kept", "node", "ids")))
    folder = str(tmp_path)
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no such words")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, folder)
        assert df.count() <= rows and {r["row"] for r in df.select("row").collect()} <= {7}
    out = corpus_pipeline.run(spark, folder)
    assert out.count() == df.count() and (rows == 0 or out.count() >= 4)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    ids = [r["doc_id"] for r in out]
    assert len(ids) == len(set(ids)) > 100 and all(r["n_tokens"] >= 0 for r in out)


def test_run_deletes_repeated_runs_to_both_ends(spark, tmp_path):
    line = lambda word, n: " ".join(f"{word}{i}" for i in range(n))
    passage, end = f"{line('a', 30)}\n{line('b', 30)}", line("c", 15)
    texts = {1: f"{passage}\n{end}", 2: f"own\n{passage}\n{end}\nlast", 3: f"other words\n{end}"}
    docs = [(i, text, "en", "s", len(text)) for i, text in texts.items()]
    folder = str(tmp_path)
    spark.createDataFrame(docs, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no such words")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == {i: hashlib.sha256(text.encode()).hexdigest() for i, text in (texts | {2: "own\nlast"}).items()}
