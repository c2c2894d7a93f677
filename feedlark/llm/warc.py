"""WARC archives whose records are compressed one by one with a dictionary of their own archive.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary, which
is built from records of the same archive. Every record is a frame, so it can be read alone with the
dictionary, and small records compress as well as if they stood together.

Of records with equal payloads of at least `LEAST_REVISIT` bytes, the one with the smallest key is a
response and the others are revisits of it, without the payload. A task writes an archive whenever it
has gathered `ARCHIVE_BYTES` of records; names are unique for every attempt, and only the manifest of
finished tasks counts, so an executor that is lost leaves a file that nobody reads.

Defined results: a null payload is empty; a null key is never revisited, and is a revisit if its
payload stands under another key; rows that repeat the smallest key are all responses; null or odd
addresses are left out or percent-encoded; an empty table gives no archives. Other columns are ignored.
Archives are written and read through pyarrow's file systems, by the address that the caller gives.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_REVISIT = 100
ARCHIVE_BYTES = 32 << 20  # of uncompressed records
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20  # of records that a dictionary is built from
MOST_GROUPS = 500_000  # payloads that occur several times, broadcast up to so many (100 bytes each)
LEVEL = 3
READ_BYTES = 1 << 20

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(key: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    name = f"urn:page:{quote(key)}" if key is not None else f"urn:uuid:{uuid.uuid4()}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if key is not None:
        head.append(f"X-Page-Key: {quote(key)}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{quote(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """From whole records, taken evenly; nothing where there is too little to learn from."""
    usable = [r for r in records if len(r) <= SAMPLE_BYTES // 8]
    step = max(1, -(-sum(map(len, usable)) // SAMPLE_BYTES))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, usable[::step]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def archive_bytes(records: list[bytes]) -> Iterator[bytes]:
    dictionary = build_dictionary(records)
    yield struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
    with_it = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **with_it)
    for r in records:
        yield compressor.compress(r)


def read_archive(file) -> Iterator[bytes]:
    """The records of an open archive, holding one record and one block at a time."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary")
    dictionary = file.read(size)
    if dictionary.startswith(FRAME_MAGIC):  # may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    with_it = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    decompressor = zstandard.ZstdDecompressor(**with_it)
    rest, frame, parts = b"", None, []
    while rest or (rest := file.read(READ_BYTES)):
        frame = frame or decompressor.decompressobj()
        parts.append(frame.decompress(rest))
        rest = frame.unused_data if frame.eof else b""
        if frame.eof:
            yield b"".join(parts)
            frame, parts = None, []
    if parts:
        raise ValueError("the archive ends within a record")


def parse(raw: bytes) -> tuple[str | None, int, str, str, str | None]:
    """(key, payload bytes, digest, type, key referred to); a response's digest is computed again."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a record")
    key = fields.get("X-Page-Key")
    told = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        refers = re.fullmatch("<urn:page:(.*)>", fields["WARC-Refers-To"])[1]
        return key, int(fields["X-Payload-Length"]), told, "revisit", refers
    payload = block.partition(b"\r\n\r\n")[2]
    if (digest := hashlib.sha256(payload).hexdigest()) != told:
        raise ValueError(f"the payload of {key} does not have its digest")
    return key, len(payload), digest, "response", None


def write_archives(pages: DataFrame, root: str, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """Writes archives below `root`; returns the stored manifest (path, n_records, raw_bytes, n_bytes)."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), body.alias("payload"), F.sha2(body, 256).alias("digest"))
    large = F.octet_length("payload") >= LEAST_REVISIT
    groups = rows.filter(large).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = runtime.materialise(groups.filter("n > 1").drop("n"), "payloads")
    # payloads that are never revisited, the empty ones among them, have a key of their own each
    own = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    keyed = rows.withColumn("met", F.when(large, F.col("digest")).otherwise(own))
    placed = keyed.join(small(groups.withColumnRenamed("digest", "met"), MOST_GROUPS), "met", "left")
    refers = F.when(large & ~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    placed = placed.select(F.col("id").cast("string"), "url", "payload", "digest", refers.cast("string").alias("refers_to"))
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = fs.FileSystem.from_uri(root)
        system.create_dir(folder, recursive=True)

        def close(records: list[bytes]) -> pd.DataFrame:
            name, size = f"{uuid.uuid4().hex}.warc.zst", 0
            with system.open_output_stream(f"{folder}/{name}") as out:
                for part in archive_bytes(records):
                    out.write(part)
                    size += len(part)
            told = (f"{root}/{name}", len(records), sum(map(len, records)), size)
            return pd.DataFrame([told], columns=["path", "n_records", "raw_bytes", "n_bytes"])

        gathered: list[bytes] = []
        size = 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                made = record(
                    *(None if pd.isna(x) else x for x in (row.id, row.url)),
                    row.payload.encode(),
                    row.digest,
                    None if pd.isna(row.refers_to) else row.refers_to,
                    date,
                )
                if gathered and size + len(made) > ARCHIVE_BYTES:
                    yield close(gathered)
                    gathered, size = [], 0
                gathered.append(made)
                size += len(made)
        if gathered:
            yield close(gathered)

    manifest = placed.mapInPandas(write, "path string, n_records long, raw_bytes long, n_bytes long")
    return runtime.materialise(manifest, "manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of every record of the manifest's
    archives; keys as strings. A task reads whole archives, one record at a time; archives are dealt out in turn to
    as many tasks as there are archives, or four times the cores, since the manifest's size says nothing about theirs."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for frame in frames:
            for path in frame["path"]:
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_stream(place) as file:
                    yield pd.DataFrame([parse(r) for r in read_archive(file)], columns=columns)

    spark = manifest.sparkSession
    cores = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    spread = manifest.select("path").repartition(max(1, min(manifest.count(), 4 * cores)))
    return spread.mapInPandas(read, "key string, payload_bytes long, payload_digest string, record_type string, refers_to string")
