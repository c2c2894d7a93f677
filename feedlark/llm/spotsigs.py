"""SpotSigs fingerprints: chains of content words that follow common words.

Every occurrence of a common word (anchor) gives a signature: the anchor and the next `CHAIN` content words, with
all stop words between them passed over. The set of signatures is the document's fingerprint (Theobald, Siddharth
and Paepcke, "SpotSigs", 2008). Prose has anchors everywhere, lists and navigation have few.

Near duplicates are found within partitions of set length: at a threshold t, sets of sizes a <= b can be alike
only if a >= t * b. Partition borders grow by t ** -4, and a set lies in its own partition and, if one of up to 1 / t
times its size would, in the next. Each partition has an inverted index over the rarest signatures of each set: two sets that reach
t share one of the |A| - ceil(t * |A|) + 1 first of A, whatever the common order. The order is from rare to
frequent by counts of `CELLS` cells of signature hashes (each task leaves out cells met once), which only decide the cost. What shares a posting list is
compared by Jaccard with bounds: sizes first, then chunk by chunk, until what is left cannot reach t.

Sets that are equal are one node. A posting list is not expanded into pairs: every node meets one other, the nodes
of lists that still hold several components meet once more, twice, and what is left is compared block by block
through an index of the block, between different components; no pair but a link becomes a row.

Defined results: null text is empty; a text without words has no signature, and two such sets are alike (1.0); a text
with words but without a whole chain has one signature, of all its words; rows of one id are rows of their own, in a
fixed order; null ids come after all others, are in no class and have none; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import small
from feedlark.llm.neardup import components, merge, mixed_buckets, other_stars

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHAIN = 3  # content words of a signature
SHARE = (80, 100)  # alike: 100 * intersection >= 80 * union
CELLS = 1 << 20  # counters of signature frequency
WIDTH = 4  # lengths within a partition differ by up to this power of the threshold
TURNS = 2
MEMBERS = 1024  # nodes of a posting list that meet in one task with as many others
MOST_CLASSES = 2_000_000  # rows of classes that are broadcast (64 MB)
FRAME = 500  # texts that are held at a time

#: Common words of four languages; some are anchors.
ANCHORS = frozenset("the is was that der die das ist le la les est el los es una".encode().split())
STOP_WORDS = ANCHORS | frozenset(
    """a an and are as at be by for from had have he in it its not of on or this to were which with
    als auf aus bei dem den des ein eine für im in mit nicht sich sie und von war zu zum
    au aux avec ce dans de du elle en et il ou par pas pour que qui sur un une
    al con de del en la las lo no o para por que se su un y""".encode().split()
)
_ASCII = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_random = np.random.Generator(np.random.PCG64(20_08))
_PLACE = _random.integers(1, 1 << 63, CHAIN + 1, dtype=np.uint64) | np.uint64(1)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_STOPS, _HEADS = (np.sort(_hashes(sorted(w))) for w in (STOP_WORDS, ANCHORS))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def signatures(text: str | None) -> np.ndarray:
    """The sorted set of a text's signatures, as 64-bit hashes."""
    words = (text or "").encode().translate(_ASCII).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = _hashes(words)
    stop = _among(hashes, _STOPS)
    content = hashes[~stop]
    at = np.flatnonzero(stop)
    at = at[_among(hashes[at], _HEADS)]
    before = np.cumsum(~stop)[at]  # content words up to the anchor: the chain begins with the next
    whole = before + CHAIN <= len(content)
    at, before = at[whole], before[whole]
    if not len(at):
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    total = hashes[at] * _PLACE[0]
    for i in range(CHAIN):
        total += _mixed(content[before + i]) * _PLACE[i + 1]
    return np.unique(_mixed(total))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def reaches(a: np.ndarray, b: np.ndarray, share: tuple[int, int] = SHARE, chunk: int = 64) -> bool:
    """Is the similarity of two sorted sets at least the share? Ends as soon as it cannot be."""
    least, most = sorted((len(a), len(b)))
    if not most or share[1] * least < share[0] * most:
        return False
    need = -(-share[0] * (len(a) + len(b)) // (share[0] + share[1]))  # members in common that are enough
    common = 0
    for i in range(0, len(a), chunk):
        part = a[i : i + chunk]
        common += int(_among(part, b).sum())
        if common + len(a) - i - len(part) < need:
            return False
    return common >= need


# ---- fingerprints of texts and of edited texts


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts are compressed for the one time that they are shuffled."""
    packer = zstandard.ZstdCompressor(level=3)
    for frame in frames:
        raw = [t.encode() for t in frame["text"]]
        order = np.array([xxhash.xxh3_64_intdigest(t) for t in raw], np.uint64).view(np.int64)
        yield pd.DataFrame({"doc": frame["doc"], "order": order, "text": [packer.compress(t) for t in raw]})


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by the beginning of the following one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _told(doc: int | None, text: str, mine: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    changed = edited(text, following)
    after = signatures(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc, len(text), digest, mine.tobytes(), after.tobytes(), jaccard(mine, after), jaccard(mine, theirs)


TOLD = "doc long, n_chars long, edited_sha256 string, mine binary, after binary, near_edited double, near_next double"
SKETCH = f"{TOLD}, part int, first string, last string"


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a partition in order; its first text, and its last row, go on to meet those beside them."""
    unpacker = zstandard.ZstdDecompressor()
    part, held, first = TaskContext.get().partitionId(), None, None
    columns = [c.split()[0] for c in SKETCH.split(", ")]
    for frame in frames:
        out = []
        for doc, packed in zip(frame["doc"], frame["text"]):
            text = unpacker.decompress(packed).decode()
            mine = signatures(text)
            if held is None:
                first = text
            else:
                out.append((*_told(*held, text, mine), part, None, None))
            held = (None if pd.isna(doc) else int(doc), text, mine)
            if len(out) == FRAME:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)
    if held is not None:
        doc, text, _ = held
        yield pd.DataFrame([(doc, *[None] * 6, part, first, text)], columns=columns)


def _close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [
            _told(None if pd.isna(d) else int(d), text, signatures(text), following, signatures(following))
            for d, text, following in zip(frame["doc"], frame["last"], frame["following"])
        ]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in TOLD.split(", ")])


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_chars, edited_sha256, mine, after, near_edited, near_next): each document with the next one, by descending
    key; the last meets the first. Sets are binary, 8 bytes for each signature. All of it is stored."""
    spark = docs.sparkSession
    given = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    packed = given.mapInPandas(_packed, "doc long, order long, text binary")
    order = [F.col("doc").desc_nulls_last(), F.col("order")]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sketched = packed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(_stream, SKETCH)
    sketched = runtime.materialise(sketched, "sketches")
    edges = sketched.filter("last is not null")
    found = sorted(r["part"] for r in edges.select("part").collect())  # a number for each partition
    beside = spark.createDataFrame(list(zip(found, found[1:] + found[:1])), "part int, beside int")
    closed = edges.select("doc", "last", "part").join(F.broadcast(beside), "part")
    closed = closed.join(edges.select(F.col("part").alias("beside"), F.col("first").alias("following")), "beside")
    closed = closed.select("doc", "last", "following").mapInPandas(_close, TOLD)
    closed = runtime.materialise(closed, "sketches")
    return sketched.filter("last is null").drop("part", "first", "last").unionByName(closed)


# ---- classes of near duplicates


def length_partitions(size: int, share: tuple[int, int] = SHARE) -> range:
    """The partition of a set of this size and, if a longer set that may be alike lies in the next, that one."""
    at = lambda n: math.floor(math.log(n) / (WIDTH * math.log(share[1] / share[0])) + 1e-9) if share[0] < share[1] else n
    return range(at(size), at(max(size, share[1] * size // share[0])) + 1)


def postings(frames: Iterator[pd.DataFrame], counts: np.ndarray, share: tuple[int, int]) -> Iterator[pd.DataFrame]:
    """(node, mine) to (node, key): posting lists of the rarest signatures, in the set's length partitions."""
    for frame in frames:
        for start in range(0, len(frame), FRAME):
            nodes, keys = [], []
            for node, mine in zip(frame["node"].iloc[start : start + FRAME], frame["mine"].iloc[start : start + FRAME]):
                found = np.frombuffer(mine, np.uint64)
                rare = found[np.lexsort((found, counts[found % np.uint64(CELLS)]))]
                rare = rare[: len(rare) - (-(-share[0] * len(rare) // share[1])) + 1]
                for part in length_partitions(len(found), share):
                    keys.append(_mixed(rare + _mixed(np.array([part + 1], np.uint64))).view(np.int64))
                    nodes.append(np.full(len(rare), node, np.int64))
            yield pd.DataFrame({"node": np.concatenate(nodes), "key": np.concatenate(keys)} if nodes else {"node": [], "key": []})


def _cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often each cell of signature hashes is met in this task."""
    seen = np.zeros(CELLS, np.int64)
    for frame in frames:  # the cells of a frame are counted among themselves: a pass over `seen` costs more than a text
        found, n = np.unique(np.frombuffer(b"".join(frame["mine"]), np.uint64) % np.uint64(CELLS), return_counts=True)
        seen[found.astype(np.int64)] += n
    cell = np.flatnonzero(seen > 1)
    yield pd.DataFrame({"cell": cell, "n": seen[cell]})


def _links(frames: Iterator[pd.DataFrame], share: tuple[int, int]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        keep = [
            reaches(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), share)
            for x, y in zip(frame["mine_a"], frame["mine_b"])
        ]
        yield frame.loc[keep, ["a", "b"]]


def verified(pairs: DataFrame, nodes: DataFrame, share: tuple[int, int]) -> DataFrame:
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("mine").alias(f"mine_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "mine_a", "mine_b")
    return runtime.materialise(both.mapInPandas(lambda frames: _links(frames, share), "a long, b long").distinct(), "links")


def compare_blocks(rows: list[tuple], share: tuple[int, int]) -> list[tuple[int, int]]:
    """Links between the components of two blocks of a posting list; rows are (key, i, j, block, node, component, mine).
    Two components are linked once."""
    i, j = rows[0][1:3]
    left = [r for r in rows if r[3] == i]
    right = left if i == j else [r for r in rows if r[3] == j]
    if not left or not right or len({r[5] for r in rows}) < 2:
        return []
    sets = {r[4]: np.frombuffer(r[6], np.uint64) for r in rows}
    links: dict[tuple[int, int], tuple[int, int]] = {}
    if len(left) * len(right) <= 64:
        for a in left:
            for b in right:
                joint = (min(a[5], b[5]), max(a[5], b[5]))
                if a[5] != b[5] and joint not in links and reaches(sets[a[4]], sets[b[4]], share):
                    links[joint] = (a[4], b[4])
        return list(links.values())
    # an inverted index of the right block
    sizes = np.array([len(sets[r[4]]) for r in right], np.int64)
    owner = np.repeat(np.arange(len(right)), sizes)
    flat = np.concatenate([sets[r[4]] for r in right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    component = np.array([r[5] for r in right], np.int64)
    for a in left:
        mine = sets[a[4]]
        low, high = np.searchsorted(flat, mine, "left"), np.searchsorted(flat, mine, "right")
        hits = np.concatenate([owner[x:y] for x, y in zip(low, high) if y > x] or [owner[:0]])
        common = np.bincount(hits, minlength=len(right))
        alike = np.flatnonzero((component != a[5]) & (share[1] * common >= share[0] * (len(mine) + sizes - common)))
        for k in alike:
            links.setdefault((min(a[5], right[k][5]), max(a[5], right[k][5])), (a[4], right[k][4]))
    return list(links.values())


def compare_groups(frames: Iterator[pd.DataFrame], share: tuple[int, int]) -> Iterator[pd.DataFrame]:
    """Groups of rows follow one another and may go over the end of a frame."""
    group: list[tuple] = []
    for frame in frames:
        links: list[tuple[int, int]] = []
        for row in frame.itertuples(index=False, name=None):
            if group and group[0][:3] != row[:3]:
                links += compare_blocks(group, share)
                group = []
            group.append(row)
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    if group:
        yield pd.DataFrame(compare_blocks(group, share), columns=["a", "b"], dtype="int64")


def compare_rest(mixed: DataFrame, nodes: DataFrame, share: tuple[int, int]) -> DataFrame:
    counts = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    counts = runtime.materialise(counts, "members").withColumn("blocks", F.ceil(F.col("members") / MEMBERS).cast("int"))
    placed = mixed.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = placed.select("key", "node", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    whole = pairs.join(nodes.select("node", "mine"), "node").select("key", "i", "j", "block", "node", "component", "mine")
    ordered = whole.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    links = ordered.mapInPandas(lambda frames: compare_groups(frames, share), "a long, b long")
    return runtime.materialise(links.distinct(), "links")


def classes(sketches: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """(d1, d2, class_id): for every distinct set, by its digest, the smallest document that is reached from it by links
    of the given similarity. `sketches` (doc, mine) is a stored table."""
    digests = [F.xxhash64("mine").alias("d1"), F.xxhash64(F.lit(1), "mine").alias("d2")]
    nodes = sketches.filter("doc is not null and length(mine) > 0").select("doc", "mine", *digests).groupBy("d1", "d2")
    nodes = runtime.materialise(nodes.agg(F.min("doc").alias("node"), F.first("mine").alias("mine")), "nodes")
    cells = nodes.select("mine").mapInPandas(_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    met = cells.toArrow()  # `CELLS` rows at most
    counts = np.zeros(CELLS, np.int64)
    counts[met["cell"].to_numpy()] = met["n"].to_numpy()
    sent = nodes.sparkSession.sparkContext.broadcast(counts)

    listed = nodes.select("node", "mine").mapInPandas(lambda frames: postings(frames, sent.value, share), "node long, key long")
    listed = runtime.materialise(listed, "postings")
    shared = listed.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead <> last")
    shared = runtime.materialise(shared.select("key", "lead"), "keys")
    buckets = runtime.materialise(listed.join(shared, "key"), "buckets")
    stars = buckets.groupBy("node").agg(F.min("lead").alias("a")).filter("node <> a")
    links = verified(stars.select("a", F.col("node").alias("b")), nodes, share)
    labels = runtime.materialise(components(links), "components")
    mixed = buckets.select("key", "node")
    for turn in range(TURNS):
        mixed = mixed_buckets(mixed.select("key", "node"), labels)
        labels = merge(labels, verified(other_stars(mixed, turn), nodes, share))
    mixed = mixed_buckets(mixed.select("key", "node"), labels)
    labels = merge(labels, compare_rest(mixed, nodes, share))
    told = nodes.select("d1", "d2", "node").join(labels, "node", "left")
    return told.select("d1", "d2", F.coalesce("component", "node").alias("class_id"))


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", share: tuple[int, int] = SHARE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id), one row per row
    of `docs`. A fingerprint is the sorted set, 16 hexadecimal digits for each signature."""
    sketches = with_next(docs, key, text)
    found = classes(sketches.select("doc", "mine"), share)
    digests = [F.xxhash64("mine").alias("d1"), F.xxhash64(F.lit(1), "mine").alias("d2")]
    copies = sketches.filter("doc is not null").select("doc", *digests).join(found, ["d1", "d2"])
    joined = runtime.materialise(copies.filter("doc <> class_id").select("doc", "class_id").distinct(), "classes")
    told = sketches.join(small(joined, MOST_CLASSES), "doc", "left")
    return told.select(
        F.col("doc").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("mine")).alias("fingerprint"),
        F.lower(F.hex("after")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.coalesce("class_id", "doc").alias("class_id"),
    )
