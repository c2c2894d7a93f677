import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlark.llm import hilbert, queries


@pytest.mark.parametrize("bits,dims", [(1, 2), (3, 2), (2, 3), (2, 4)])
def test_curve_visits_every_cell_and_steps_to_a_neighbour(bits, dims):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(rows, shards):
    sizes = [0] * shards
    slots = {}
    for r in rows:
        sizes[r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


@pytest.mark.parametrize("n,shards", [(0, 3), (1, 4), (7, 3), (100, 40), (400, 7)])
def test_shards_are_even_and_in_curve_order(spark, n, shards):
    rows = [(i, "a" if i % 3 else None, None if i % 5 == 0 else i * i % 17, "extra") for i in range(n)]
    df = spark.createDataFrame(rows, "id long, lang string, size long, place_of string")
    dims = {"size": F.col("size"), "lang": hilbert.text_rank(F.col("lang")), "id": F.col("id")}
    out = hilbert.hilbert_shards(df, dims, shards, ties=("id",))
    got = out.collect()
    assert sorted((r["id"], r["lang"], r["size"], r["place_of"]) for r in got) == sorted(rows, key=lambda r: r[0])
    check(got, shards)


def test_equal_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x")] * 50, "id long, lang string")
    check(hilbert.hilbert_shards(df, {"id": F.col("id")}, 4).collect(), 4)
    clash = df.select("*", *(F.lit(-9).alias(c) for c in ("slot", "place", "part", "curve")))
    got = hilbert.hilbert_shards(clash, {"id": F.col("id")}, 4, ties=("lang",)).collect()
    check(got, 4)
    assert {(r["place"], r["part"]) for r in got} == {(-9, -9)}


def test_a_box_touches_few_shards(spark, tmp_path):
    df = spark.range(4096).select((F.col("id") % 64).alias("x"), F.expr("id div 64").alias("y"))
    dims = {"x": F.col("x"), "y": F.col("y")}
    placed = hilbert.hilbert_shards(df, dims, 16, bits=6)
    bounds = hilbert.shard_bounds(placed, dims)
    hit = {r[0] for r in hilbert.shards_of_box(bounds, {"x": (0, 7), "y": (0, 7)}).collect()}
    assert 1 <= len(hit) <= 4
    hilbert.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    inside = back.filter("x between 0 and 7 and y between 0 and 7")
    assert inside.count() == 64 and {r[0] for r in inside.select("shard").distinct().collect()} <= hit


def test_query_on_the_whole_table(spark):
    got = queries.op1_hilbert_shards(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import zlib

    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        text = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), "rows")
    check(got, 40)
