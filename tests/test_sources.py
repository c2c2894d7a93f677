import json

import pytest
from pyspark.sql import functions as F

from feedlark.functions import html as H
from feedlark.operators import tables
from feedlark.sources import readers, sinks


def put(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(folder)


def posts(spark, path, **options):
    return tables.social_posts(readers.read_text_items(spark, path, **options))


def put_all(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        (folder / f"{name}.json").write_text(content)
    return str(folder)


def test_both_layouts_in_one_folder(spark, rows, tmp_path):
    path = put_all(tmp_path / "x", a='{"TextItem": {"r1": ["a"]}}\n{"TextItem": {"r2": ["b"]}}\n', b='[\n{"TextItem":\n {"r3": ["c"]}},\n{"TextItem": {"r4": ["d"]}}\n]')
    assert rows(posts(spark, path)) == [("r1", "a"), ("r2", "b"), ("r3", "c"), ("r4", "d")]


def test_single_values_become_text(spark, rows, tmp_path):
    path = put_all(tmp_path / "x", a='{"TextItem": {"r1": 12, "r2": 1.5, "r3": true, "r4": "s", "r5": [1, "x"], "r6": null}}')
    assert rows(posts(spark, path)) == [("r1", "12"), ("r2", "1.5"), ("r3", "true"), ("r4", "s"), ("r5", "1 x")]


@pytest.mark.parametrize("bad", ['{"TextItem": {"r1": ["a"]', '{"TextItem": {"r1": ["a"]}}\n{"TextItem": {"r2": ["b"'])
def test_damaged_posts_raise(spark, tmp_path, bad):
    path = put_all(tmp_path / "x", good='{"TextItem": {"r0": ["a"]}}', bad=bad)
    with pytest.raises(Exception, match="(?i)malformed|damaged"):
        posts(spark, path).collect()


def test_first_product_by_place(spark, tmp_path):
    one = '{"Product": {"p1": ["%s", "c", 1]}}'
    path = put_all(tmp_path / "x", a="\n".join(one % n for n in ("Zed", "Alpha")))
    assert [r["product_name"] for r in readers.read_catalog(spark, path).collect()] == ["Zed"]
    path = put_all(tmp_path / "y", a="[\n" + ",\n\n".join(one % n for n in ("Zed", "Alpha")) + "\n]")
    assert [r["product_name"] for r in readers.read_catalog(spark, path).collect()] == ["Zed"]


@pytest.mark.parametrize("bad", ['{"Product": {"p1": ["a", "c"', '{"Other": {"p1": ["a", "c", 1]}}'])
def test_damaged_catalogs_raise(spark, tmp_path, bad):
    path = put_all(tmp_path / "x", good='{"Product": {"p0": ["a", "c", 1]}}', bad=bad)
    with pytest.raises(Exception, match="(?i)malformed|damaged|without Product"):
        readers.read_catalog(spark, path).collect()


def test_writers_and_readers_fit(spark, tmp_path):
    df = spark.createDataFrame([(str(i), 0, f"t{i}") for i in range(20)], "id string, pos int, text string").coalesce(1)
    sinks.write_text_items(df, str(tmp_path / "t"))
    assert posts(spark, str(tmp_path / "t")).count() == 20
    items = spark.createDataFrame([(str(i), f"n{i}", "c", 1.0) for i in range(20)], "product_id string, product_name string, product_category string, price double").coalesce(1)
    sinks.write_catalog(items, str(tmp_path / "c"))
    assert readers.read_catalog(spark, str(tmp_path / "c")).count() == 20


def test_posts_of_several_objects(spark, rows, tmp_path):
    items = [{"TextItem": {"r1": ["a", "b"], "r2": [], "r3": None, "R9": ["q"]}}, {"TextItem": {"r1": ["c"]}}]
    assert rows(posts(spark, put(tmp_path / "s", "a.json", items))) == [("R9", "q"), ("r1", "a b"), ("r1", "c")]


def test_posts_with_one_id_twice(spark, rows, tmp_path):
    path = put(tmp_path / "s", "a.json", '{"TextItem":{"r1":["a"],"r1":["b"]}}')
    assert rows(posts(spark, path)) == [("r1", "a"), ("r1", "b")]


def test_posts_as_plain_strings(spark, rows, tmp_path):
    path = put(tmp_path / "s", "a.json", {"TextItem": {"r1": "plain", "r2": "[x] y", "r3": ["z", None, "é"]}})
    assert rows(posts(spark, path)) == [("r1", "plain"), ("r2", "[x] y"), ("r3", "z é")]


def test_posts_of_several_files_and_lines(spark, rows, tmp_path):
    put(tmp_path / "s", "a.json", {"TextItem": {"r1": ["a"]}})
    put(tmp_path / "s", "b.json", {"TextItem": {"r2": ["b", "  "]}})
    put(tmp_path / "s", "c.txt", "no JSON")
    assert rows(posts(spark, str(tmp_path / "s"))) == [("r1", "a"), ("r2", "b   ")]
    lines = put(tmp_path / "l", "a.json", '{"TextItem":{"r1":["a"]}}\n{"TextItem":{"r2":["b"]}}\n')
    assert rows(posts(spark, lines)) == [("r1", "a"), ("r2", "b")]


def test_files_without_posts(spark, rows, tmp_path):
    path = put(tmp_path / "s", "a.json", [{"Other": 1}])
    with pytest.raises(readers.SourceError, match="TextItem"):
        readers.read_text_items(spark, path)
    assert rows(readers.read_text_items(spark, path, strict=False)) == [(1,)]
    (tmp_path / "e").mkdir()
    assert rows(posts(spark, str(tmp_path / "e"))) == []


def test_catalog(spark, rows, tmp_path):
    path = put(tmp_path / "c", "a.json", {"Product": {"p1": ["A - B", "cat", 12.5], "p2": ["C", "k", "n/a"], "p3": ["D"]}})
    assert rows(readers.read_catalog(spark, path)) == [
        ("p1", "A-B", "cat", 12.5), ("p2", "C", "k", None), ("p3", "D", None, None)]


def test_catalog_keeps_the_first_of_an_id(spark, rows, tmp_path):
    put(tmp_path / "c", "b.json", {"Product": {"p1": ["Second", "x", 2], "p2": ["Other", "x", 3]}})
    path = put(tmp_path / "c", "a.json", {"Product": {"p1": ["First", "x", 1], " p1 ": ["Late", "x", 9]}})
    assert rows(readers.read_catalog(spark, path)) == [("p1", "First", "x", 1.0), ("p2", "Other", "x", 3.0)]


HEADER = "id,whatever,x,y,z\n"


def test_review_csvs(spark, rows, tmp_path):
    put(tmp_path / "r", "a.csv", HEADER + 'p1,"A, ""q""",4,"line1\nline2",pos\np2,NA,,x,\n')
    path = put(tmp_path / "r", "b.csv", HEADER + "p3,n,bad, t ,None\n")
    assert rows(readers.read_reviews_csv(spark, path)) == [
        ("p1", 'A, "q"', 4.0, "line1\nline2", "pos"), ("p2", None, None, "x", None), ("p3", "n", None, " t ", None)]
    assert readers.read_reviews_csv(spark, path + "/b.csv").count() == 1


def test_review_folder_without_csvs(spark, rows, tmp_path):
    path = put(tmp_path / "r", "a.txt", "x")
    empty = readers.read_reviews_csv(spark, path)
    assert rows(empty) == [] and dict(empty.dtypes)["rating"] == "double"


def test_review_csvs_of_the_wrong_width(spark, tmp_path):
    narrow = put(tmp_path / "r", "a.csv", "a,b,c,d\n1,2,3,4\n")
    with pytest.raises(readers.SourceError, match="4 columns"):
        readers.read_reviews_csv(spark, narrow)
    put(tmp_path / "q", "a.csv", HEADER + "p1,n,4,t,pos\n")
    late = put(tmp_path / "q", "b.csv", "a,b,c,d\n1,2,3,4\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_reviews_csv(spark, late).collect()


def blocks(spark, source, **kind):
    df = spark.createDataFrame([(1, source)], "page int, html string")
    return [(r.id, r.text) for r in H.nested_blocks(df, "page", "html", **kind).orderBy("pos").collect()]


@pytest.mark.parametrize("source, want", [
    ('<div class="comment" data-id="7"> a <b>b</b> </div><div class="comment">x</div>', [("7", "ab"), ("unknown", "x")]),
    ('<div class="big comment" data-id="">a&amp;b &lt; c</div>', [("unknown", "a&b < c")]),
    ('<div class="comment" data-id="1">a<div class="comment" data-id="2">b</div>c</div>d', [("1", "abc"), ("2", "b")]),
    ('<div class="comment">a<br>b<img src="x">c<script>no</script><!-- no --></div>', [("unknown", "abc")]),
    ('<div class="comment">open <p>one<p>two', [("unknown", "openonetwo")]),
    ('<div class="comments">no</div><span class="comment">no</span>', []),
    (None, []),
])
def test_nested_blocks(spark, source, want):
    assert blocks(spark, source) == want


def test_flat_blocks(spark):
    df = spark.createDataFrame([('<p>a</p><p id="1">b\nc</p><pre>d</pre><div class="ad">e</div>',)], "html string")
    got = df.select(H.flat_blocks("html", "p").alias("p"), H.flat_blocks("html", "div", "ad").alias("ad")).first()
    assert got.p == ["a", "b\nc"] and got.ad == ["e"]


def test_comments_round_trip(spark, rows, tmp_path):
    data = [("x", i, f"t{i}") for i in range(7)] + [("ü", 0, 'é "q"\n')]
    comments = spark.createDataFrame(data, "id string, pos int, text string")
    path = str(tmp_path / "out")
    sinks.write_text_items(comments, path, chunk_rows=3)
    back = readers.read_text_items(spark, path)
    assert sorted(len(r.texts) for r in back.collect()) == [1, 1, 3, 3]
    assert rows(back.select("id", F.explode("texts"))) == sorted(((i, t) for i, _, t in data), key=repr)


def test_verified_write(spark, rows, tmp_path):
    df = spark.range(100)
    back = sinks.write_parquet(df, str(tmp_path / "t"))
    assert rows(back) == rows(df)
    assert rows(sinks.write_parquet(spark.range(3), str(tmp_path / "t"), "snappy", single_file=True)) == [(0,), (1,), (2,)]
    assert len(list((tmp_path / "t").glob("*.snappy.parquet"))) == 1
    many = sinks.write_parquet(spark.range(0, 10, 1, 1), str(tmp_path / "m"), max_records_per_file=4)
    assert many.count() == 10 and len(list((tmp_path / "m").glob("*.gz.parquet"))) == 3


def test_a_write_that_loses_rows_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks.F, "count", lambda c: F.sum(F.lit(2)))
    with pytest.raises(sinks.WriteError):
        sinks.write_parquet(spark.range(5), str(tmp_path / "t"))


def lose_a_file(folder, pattern):
    victim = sorted(folder.glob(pattern))[0]
    victim.unlink()


def test_a_lost_file_is_found(spark, tmp_path):
    df = spark.range(100).repartition(3)
    back = sinks.write_parquet(df, str(tmp_path / "p"))
    sinks.check_manifest(spark, str(tmp_path / "p"), back)
    lose_a_file(tmp_path / "p", "part-*")
    with pytest.raises(sinks.WriteError, match="lacks"):
        sinks.check_manifest(spark, str(tmp_path / "p"), spark.read.parquet(str(tmp_path / "p")))

    back = sinks.write_by_period(df.withColumn("period", F.col("id") % 2), str(tmp_path / "d"))
    sinks.check_manifest(spark, str(tmp_path / "d"), back)
    lose_a_file(tmp_path / "d", "period=1/part-*")
    with pytest.raises(sinks.WriteError, match="lacks"):
        sinks.check_manifest(spark, str(tmp_path / "d"), spark.read.parquet(str(tmp_path / "d")))

    comments = spark.createDataFrame([(str(i), 0, f"t{i}") for i in range(20)], "id string, pos int, text string")
    items = spark.createDataFrame([(str(i), "n", "c", 1.0) for i in range(20)], "product_id string, product_name string, product_category string, price double")
    for name, write, rows in (("t", sinks.write_text_items, comments), ("c", sinks.write_catalog, items)):
        path = tmp_path / name
        write(rows, str(path))
        sinks.check_manifest(spark, str(path), spark.read.text(str(path)))
        lose_a_file(path, "part-*")
        with pytest.raises(sinks.WriteError, match="lacks"):
            sinks.check_manifest(spark, str(path), spark.read.option("pathGlobFilter", "*.json").text(str(path)))


def test_a_failed_write_leaves_the_old_table(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(3), path)
    monkeypatch.setattr(sinks.F, "count", lambda c: F.sum(F.lit(2)))
    for write in (sinks.write_parquet, lambda df, p: sinks.write_by_period(df.withColumn("period", F.lit(1)), p)):
        with pytest.raises(sinks.WriteError):
            write(spark.range(5), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_many_files_of_several_lines(spark, rows, tmp_path):
    files = {f"f{i}": json.dumps({"TextItem": {f"r{i}": ["a", str(i)]}}, indent=2) for i in range(12)}
    files["lines"] = '{"TextItem": {"x": ["1"]}}\n\n{"TextItem": {"y": ["2"]}}\n'
    path = put_all(tmp_path / "x", **files)
    assert rows(posts(spark, path)) == sorted([(f"r{i}", f"a {i}") for i in range(12)] + [("x", "1"), ("y", "2")], key=repr)


def test_a_period_replaces_only_itself(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_by_period(spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "v int, period string"), path)
    back = sinks.write_by_period(spark.createDataFrame([(9, "2024-02")], "v int, period string"), path)
    assert rows(back) == [(1, "2024-01"), (9, "2024-02")]
    plan = back.filter("period = '2024-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_external_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.createDataFrame([(1, "a")], "v bigint, s string"), path)
    assert rows(sinks.external_table(spark, "t_external", "v bigint, s string", path)) == [(1, "a")]
    with pytest.raises(sinks.WriteError):
        sinks.external_table(spark, "t_external", "v bigint, other string", path)
    spark.sql("DROP TABLE t_external")


def test_table_globs(spark, tmp_path):
    sinks.write_parquet(spark.range(4), str(tmp_path / "a" / "b"))
    assert readers.read_table(spark, str(tmp_path / "*" / "*")).count() == 4
    assert readers.read_table(spark, str(tmp_path), recursive=True).count() == 4
