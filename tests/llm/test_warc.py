import io
import random
import struct

import pytest
from pyspark.sql import functions as F
import zstandard

from feedlark.llm import queries, warc
from tools.check import comparable, duck, type_differences

SCHEMA = "page_id long, url string, html string"


def read(spark, tmp_path, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    manifest = warc.write_archives(df, (tmp_path / "out").as_uri())
    return manifest, sorted((tuple(r) for r in warc.read_archives(manifest).collect()), key=repr)


def plain(rows):
    import hashlib

    out = []
    for i, _, t in rows:
        body = (t or "").encode()
        same = [j for j, _, u in rows if (u or "") == (t or "") and j is not None]
        first = min(same) if same and len(body) >= 100 else None
        revisit = first is not None and first != i
        told = (None if i is None else str(i), len(body), hashlib.sha256(body).hexdigest())
        out.append((*told, "revisit" if revisit else "response", str(first) if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_with_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4_000)
    rnd = random.Random(1)
    long = "<p>é𝄞\r\n\r\n</p>" * 20
    rows = [(i, f"http://h/{i}\r\nx ü", "".join(rnd.choices("<p>abc \n", k=rnd.randint(0, 400)))) for i in range(80)]
    rows += [(100 + i, None, long) for i in range(9)] + [(5_000, "", None), (5_001, "", ""), (5_002, "u", "x" * 99), (5_003, "u", "x" * 99)]
    rows += [(None, None, long), (100, None, long), (6_000, "big", long * 3_000), (None, None, "y" * 200)]
    manifest, got = read(spark, tmp_path, rows)
    assert got == plain(rows)
    assert manifest.count() > 5 and manifest.agg({"n_records": "sum"}).first()[0] == len(rows)


def test_empty_table(spark, tmp_path):
    manifest, got = read(spark, tmp_path, [])
    assert got == [] and manifest.count() == 0


def test_many_archives_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    rows = [(i, "u", f"{i} " * 300) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    manifest = warc.write_archives(df, str(tmp_path / "many"))
    assert manifest.count() == 200
    found = warc.read_archives(manifest)
    tasks = {r[0]: r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()}
    assert found.count() == 200 and len(tasks) == found.rdd.getNumPartitions() == 16 and max(tasks.values()) <= 16


def test_dictionary_leads_and_helps():
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(300)]
    records = [warc.record(str(i), "u", ("<div class=comment>" + " ".join(rnd.choices(words, k=40))).encode(), "d", None, "t") for i in range(400)]
    parts = list(warc.archive_bytes(records))
    magic, size = struct.unpack("<II", parts[0][:8])
    assert magic == 0x184D2A5D and size == len(parts[0]) - 8 > 0
    assert len(parts) == 1 + len(records)
    alone = zstandard.ZstdCompressor(level=3)
    assert sum(map(len, parts[1:])) < 0.7 * sum(len(alone.compress(r)) for r in records)
    assert list(warc.read_archive(io.BytesIO(b"".join(parts)))) == records
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(parts[0][8:]))
    assert one.decompress(parts[7]) == records[6]
    packed = zstandard.ZstdCompressor().compress(parts[0][8:])
    assert list(warc.read_archive(io.BytesIO(struct.pack("<II", magic, len(packed)) + packed + b"".join(parts[1:])))) == records


def test_damaged_archives_raise():
    parts = b"".join(warc.archive_bytes([warc.record("1", "u", b"abc", "d", None, "t")]))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(parts[:-3])))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(b"\0" * 20)))
    with pytest.raises(ValueError):
        warc.parse(next(warc.read_archive(io.BytesIO(parts))))  # the digest is not that of the payload


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    df, rel = queries.op4_warc_archives(spark, sf), duck(sf).sql(queries.SQL["op4_warc_archives"])
    assert comparable(df.columns, df.collect()) == comparable(rel.columns, rel.fetchall())
    assert not type_differences(df, rel)
