from pathlib import Path

from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.functions.text import clean_text, split_tokens
from feedlark.operators import mention
from feedlark.streaming import streams
from registry import bindings

POSTS = "id string, text string"


def land(spark, folder, data):
    spark.createDataFrame(data, POSTS).coalesce(1).write.mode("append").parquet(folder)


def test_stream_clean_takes_only_new_files(spark, rows, tmp_path):
    folder, out, state = (str(tmp_path / x) for x in "abc")
    land(spark, folder, [("1", "The <b>Phone</b>"), ("2", None)])
    run = lambda: streams.stream_clean(streams.landed_files(spark, folder, POSTS), out, state)
    run(), run()
    assert rows(spark.read.parquet(out).select("id", "clean_text")) == [("1", "phone"), ("2", "")]
    land(spark, folder, [("3", "blue ring")])
    run()
    batch = spark.read.parquet(folder).select("id", clean_text("text", "social").alias("clean_text"))
    assert rows(spark.read.parquet(out).select("id", "clean_text")) == rows(batch)


def test_stream_mapping_equals_batch(spark, rows, tmp_path):
    folder, out, state = (str(tmp_path / x) for x in "abc")
    plain = {"tokens": split_tokens, "counted": lambda c: F.col(c) != ""}
    posts = spark.createDataFrame([("1", "red bolt loose"), ("2", "blue gear"), ("3", "zzz")], POSTS)
    products = spark.createDataFrame([("p1", "red bolt"), ("p2", "blue ring")], "product_id string, clean_name string")
    catalog, _ = mention.fit_catalog(posts, products, post_text="text", **plain)
    want = mention.map_mentions(posts, products, post_text="text", tokenising=plain)
    land(spark, folder, [("1", "red bolt loose"), ("2", "blue gear")])
    run = lambda: streams.stream_mention_map(
        streams.landed_files(spark, folder, POSTS), catalog, out, state, "text"
    )
    run(), run()
    land(spark, folder, [("3", "zzz")])
    run()
    cols = ("id", "product_id", "similarity_score")
    assert rows(spark.read.parquet(out).select(*cols)) == rows(want.select(*cols))


def test_streams_keep_each_other_s_rows(spark, rows, tmp_path):
    """Two sources with a checkpoint each write into one folder, and leave no scratch behind."""
    plain = {"tokens": split_tokens, "counted": lambda c: F.col(c) != ""}
    products = spark.createDataFrame([("p1", "red bolt")], "product_id string, clean_name string")
    catalog, _ = mention.fit_catalog(spark.createDataFrame([("0", "red")], POSTS), products, post_text="text", **plain)
    out = str(tmp_path / "out")
    scratch = Path(runtime.scratch_folder(spark).removeprefix("file:"))
    before = sorted(scratch.iterdir())
    for name in "ab":
        land(spark, str(tmp_path / name), [(name, "red bolt")])
        source = streams.landed_files(spark, str(tmp_path / name), POSTS)
        streams.stream_mention_map(source, catalog, out, str(tmp_path / f"state-{name}"), "text")
    assert rows(spark.read.parquet(out).select("id", "product_id")) == [("a", "p1"), ("b", "p1")]
    assert sorted(scratch.iterdir()) == before


def test_registered_streams_read_tables_of_many_files(spark, rows, tmp_path):
    """A table may be a folder of files; every one of them is new to a stream."""
    sf = "/root/testdata/sf0.001"
    for name, parts in (("documents", 3), ("conversations", 2), ("benchmark", 1)):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(parts).write.parquet(str(tmp_path / f"{name}.parquet"))
    for query in (bindings.stream_clean, bindings.stream_mention_map):
        assert rows(query(spark, str(tmp_path))) == rows(query(spark, sf)) != []
