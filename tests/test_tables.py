import pytest
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.operators import tables
from feedlark.plans import pipelines


def test_merge_reviews_by_position(spark, rows):
    a = spark.createDataFrame([("p1", "n", 1.0, "t", "pos")], "a string, b string, c double, d string, e string")
    b = spark.createDataFrame([("p1", "n", 1.0, "t", "pos")] * 2, "v string, w string, x double, y string, z string")
    merged = tables.merge_reviews({"one": a, "two": b})
    assert merged.columns[-1] == "platform" and merged.count() == 3
    with pytest.raises(ValueError, match="two"):
        tables.merge_reviews({"one": a, "two": b.drop("z")})


def test_keep_first(spark, rows):
    df = spark.createDataFrame([(2, "a", None), (1, "a", "x"), (5, "b", "y")], "seq int, k string, v string")
    assert rows(tables.keep_first(df, ["k"], ["seq"])) == [(1, "a", "x"), (5, "b", "y")]


def test_normalise_strings_leaves_other_types(spark, rows):
    df = spark.createDataFrame([(" a - b ", 1.5, None)], "s string, d double, n string")
    assert rows(tables.normalise_strings(df)) == [("a-b", 1.5, None)]


def test_posts_blank_and_empty(spark, rows):
    items = spark.createDataFrame([("a", ["x", None, "y"]), ("b", []), ("c", None), ("d", ["  "])], "id string, texts array<string>")
    assert rows(tables.social_posts(items)) == [("a", "x y")]


def test_unpivot_wide_table(spark, rows):
    wide = spark.createDataFrame([(["a"], ["b", "c"])], "r1 array<string>, r2 array<string>")
    assert rows(tables.unpivot_ids(wide)) == [("r1", ["a"]), ("r2", ["b", "c"])]


def test_explode_comments(spark, rows):
    items = spark.createDataFrame([("a", [" <b>x</b> ", "y<s>"])], "id string, texts array<string>")
    assert rows(tables.explode_comments(items)) == [("a", 0, " <b>x</b> ", "x"), ("a", 1, "y<s>", "y")]


def test_keyword_search(spark, rows):
    df = spark.createDataFrame([("<i>Red bolt</i>", "Red bolt"), ("nut", "nut")], "raw string, plain string")
    assert rows(tables.keyword_search(df, "BOLT", "raw", "plain").select("shown")) == [("<i>Red bolt</i>",)]
    assert rows(tables.keyword_search(df, "b.lt", "raw", "plain", True).select("shown")) == [("Red bolt",)]
    assert tables.keyword_search(df, "b.lt", "raw", "plain", regex=False).isEmpty()


def test_valid_rows(spark):
    df = spark.createDataFrame([("p", "a"), ("", "a"), (None, "a"), ("p", ""), ("p", None)], "product_id string, clean_name string")
    assert tables.valid_products(df).count() == 1
    assert tables.valid_posts(df.withColumnRenamed("clean_name", "clean_text")).count() == 3


def test_filters_reach_the_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("p", "a", 1)], "product_id string, clean_name string, x int").write.parquet(path)
    plan = tables.valid_products(spark.read.parquet(path)).select("clean_name")._jdf.queryExecution().toString()
    assert "Not(EqualTo(clean_name,))" in plan and "IsNotNull(product_id)" in plan
    assert "x:int" not in plan.split("ReadSchema")[-1]


def test_number_rows(spark):
    data = [("a", f"t{i % 3}") for i in range(50)] + [("b", "z")] * 7
    df = spark.createDataFrame(data, "id string, t string").repartition(5)
    got = [(r.review_id, r.id, r.t) for r in tables.number_rows(df, "id", "t").orderBy("review_id").collect()]
    assert [g[1:] for g in got] == sorted(data) and [g[0] for g in got] == list(range(1, 58))


def test_place_within_a_key_that_fills_many_ranges(spark):
    data = [("hot", None if i % 3 else i % 2, f"t{i}") for i in range(3000)] + [(None, i, "n") for i in range(5)] + [("z", 7, None)]
    df = spark.createDataFrame(data, "id string, pos int, text string").repartition(7)
    got = tables.place_within(df, "id", "pos", F.xxhash64("text")).collect()
    places = {}
    for r in sorted(got, key=lambda r: r.place):
        places.setdefault(r.id, []).append((r.place, -1 if r.pos is None else r.pos))
    assert sorted((r.id, r.pos, r.text) for r in got if r.id == "hot" and r.pos) == sorted(d for d in data if d[0] == "hot" and d[1])
    for found in places.values():
        assert [p for p, _ in found] == list(range(1, len(found) + 1))
        assert [x for _, x in found] == sorted(x for _, x in found)
    assert {k: len(v) for k, v in places.items()} == {"hot": 3000, None: 5, "z": 1}


@pytest.mark.parametrize("pos", ["7", "CAST(NULL AS INT)", "CAST(id AS INT) * 1000"])
def test_lists_are_bounded_whatever_pos_is(spark, pos):
    df = spark.range(100_000).selectExpr("'a' AS id", f"{pos} AS pos", "CAST(id AS STRING) AS text")
    got = tables.group_comments(df).collect()
    assert sorted(r.chunk for r in got) == list(range(100)) and {len(r.texts) for r in got} == {1000}
    assert len({t for r in got for t in r.texts}) == 100_000
    if "id" in pos:  # in the order of pos
        assert [t for r in sorted(got, key=lambda r: r.chunk) for t in r.texts] == [str(i) for i in range(100_000)]


def test_few_comments_stay_in_order_in_one_list(spark, rows):
    df = spark.createDataFrame([("a", 9, "x"), ("a", 2, None), ("a", 2, "b"), (None, 1, "n")], "id string, pos int, text string")
    assert rows(tables.group_comments(df)) == [("a", 0, [None, "b", "x"]), (None, 0, ["n"])]
    assert rows(tables.group_comments(df.filter("false"))) == []


def test_counts(spark, rows):
    df = spark.createDataFrame([("a",), ("",), (None,)], "c string")
    assert rows(tables.quality_counts(df, "c")) == [(3, 2, 1)]
    assert rows(tables.stage_counts(df, {"all": F.lit(True), "named": F.col("c") != ""})) == [("all", 3), ("named", 1)]


def test_sample_is_the_first_rows(spark, rows):
    assert rows(tables.sample_n(spark.range(50).orderBy(F.desc("id")), 3, "id")) == [(0,), (1,), (2,)]


@pytest.mark.parametrize("hot_rows", [0, 2, 100])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_is_a_join(spark, rows, hot_rows, how):
    left = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9), ("c", 8), (None, 7)], "k string, v int")
    lookup = spark.createDataFrame([("a", "A", 5), ("b", "B", 1), ("b", "BB", 1)], "k string, w string, n long")
    got = runtime.hot_key_join(left, lookup, "k", "n", hot_rows, how)
    assert rows(got) == rows(left.join(lookup.drop("n"), "k", how))


def test_hot_key_join_limits_what_it_broadcasts(spark, rows):
    left = spark.createDataFrame([(i % 5, i) for i in range(50)], "k int, v int")
    lookup = spark.createDataFrame([(i, f"w{i}", 10 + 100 * (i == 4)) for i in range(5)], "k int, w string, n long")
    got = runtime.hot_key_join(left, lookup, "k", "n", hot_rows=2, most=1)
    assert rows(got) == rows(left.join(lookup.drop("n"), "k"))
    plan = got._jdf.queryExecution().toString()
    assert "n#" in plan and "> 20)" in plan


def test_scratch_needs_a_shared_folder(spark, monkeypatch, tmp_path):
    assert runtime.scratch_folder(spark).startswith(runtime.scratch_root(spark))

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.scratch_root(Session)


def test_flows_end_to_end(spark, rows):
    label = lambda name: lambda df, text: df.withColumn(name, F.when(F.col(text).contains("bad"), "negative").otherwise("positive"))
    posts = spark.createDataFrame([(1, "A <b>Red</b> bolt, not bad"), (2, "the"), (3, "blue ring!")], "id bigint, text string")
    products = spark.createDataFrame([("p1", "Red-Bolt red bolt"), ("p2", "Blue Ring")], "product_id string, product_name string")
    social = pipelines.social_flow(posts, products, label("sentiment"))
    assert rows(social.select("review_id", "review_text", "product_id", "sentiment")) == [
        (1, "red bolt bad", "p1", "negative"), (3, "blue ring", "p2", "positive")]
    named = pipelines.social_flow(posts.select(F.concat(F.lit("r"), "id").alias("id"), "text"), products, label("sentiment"))
    assert rows(named) == [(i + 1, *r[1:]) for i, r in enumerate(rows(social))]
    assert dict(named.dtypes)["review_id"] == "bigint"
    raw = pipelines.social_flow(posts, products, lambda df, t: df.withColumn("sentiment", F.col(t)), score_on="text")
    assert ("A <b>Red</b> bolt, not bad",) in rows(raw.select("sentiment"))
    reviews = spark.createDataFrame([("p1", "The Bolt", 4.0, "Not bad", "positive", "one")],
        "product_id string, product_name string, rating double, review_text string, sentiment string, platform string")
    table = pipelines.review_flow(reviews, label("sentiment_api"))
    assert rows(table) == [("p1", "The Bolt", 4.0, "Not bad", "positive", "one", "bolt", "not bad", "negative")]


def test_flows_store_only_the_texts_they_are_asked_for(spark, rows, monkeypatch):
    kept, store = {}, runtime.materialise
    monkeypatch.setattr(runtime, "materialise", lambda df, label, *more: kept.update({label: df.columns}) or store(df, label, *more))
    label = lambda name: lambda df, text: df.withColumn(name, F.when(F.col(text).contains("bad"), "negative").otherwise("positive"))
    posts = spark.createDataFrame([(1, "a red bolt, not bad"), (1, "blue ring!"), (3, "blue ring!"), (4, "none")], "id bigint, text string")
    products = spark.createDataFrame([("p1", "red bolt"), ("p2", "blue ring")], "product_id string, product_name string")
    columns = ["product_id", "similarity_score", "sentiment"]
    few = pipelines.social_flow(posts, products, label("sentiment"), columns=columns)
    assert few.columns == columns and kept["labelled"] == ["id", "mention_key", "sentiment"]
    assert rows(few) == rows(pipelines.social_flow(posts, products, label("sentiment")).select(*columns)) and few.count() == 4
    reviews = spark.createDataFrame([("p1", "The Bolt", 4.0, "Not bad", "positive", "one"), (None, None, None, None, None, "two")],
        "product_id string, product_name string, rating double, review_text string, sentiment string, platform string")
    for columns in (["rating", "sentiment_api"], ["sentiment_humanlabels", "platform", "sentiment_api"]):
        few = pipelines.review_flow(reviews, label("sentiment_api"), columns)
        assert few.columns == columns and not {"review_text", "product_name", "clean_product_name"} & set(kept["reviews"])
        assert rows(few) == rows(pipelines.review_flow(reviews, label("sentiment_api")).select(*columns)) and few.count() == 2
