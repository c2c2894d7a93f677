"""MinHash near-dedup with sequential Bayesian verification.

Texts of the same words are one node. Nodes that agree in all hashes of a band are candidates. A
candidate pair's signatures are compared batch by batch, and the pair is dropped as soon as the
posterior probability that its similarity reaches the threshold falls below `MISS` (Satuluri and
Parthasarathy, "Bayesian locality sensitive search", 2012); a batch holds one bit of each of 63 MinHash values
(Li and König, "b-Bit minwise hashing", 2010), so it costs one exclusive or, inside the join. What is left is
verified on the full sets of shingles.

Large buckets are not expanded into pairs. First every node meets one other, the smallest that shares a
bucket with it; buckets whose members are then in one component are done. In those that are mixed each
node meets one more of another component, and again, and only what is still mixed after that is
compared member by member, between different components, by tasks that each hold two blocks of a
bucket and give back links alone. So no candidate link between components is left out.

Shingle size and threshold are arguments (`Rule`). Bands have as many rows as leave a pair at the threshold
without a common band with probability below `MISS`: 36 of 7 for 0.85, (1 - 0.85**7)**36 < 1e-6, and 50
of 5 for 0.8, (1 - 0.8**5)**50 < 1e-8. The posterior limits are those of the threshold.

Defined results: rows of one id are one document; null ids are not linked and stay; null texts and texts
without words have no shingles, are linked with nothing and stay; repeated rows have equal results;
an empty table stays empty.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
SHARE = (85, 100)  # linked: intersection * 100 >= union * 85
BANDS, BAND_ROWS = 36, 7
BATCHES, BATCH = 4, 63  # bits of the signature that are compared at a time; BANDS * BAND_ROWS in all
MISS = 1e-6
TURNS = 2  # meetings of a node with one node of another component, before all such pairs are compared
MEMBERS = 1024  # nodes of a bucket that meet in one task with as many others
BLOCK = 4096  # shingles that are hashed at a time

_random = np.random.Generator(np.random.PCG64(20_03))
_WORD = _random.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)
_SLOPE = (_random.integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2)) + np.uint64(1)
_SHIFT = _random.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)
_BAND = _random.integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)
_PLACE = np.uint64(1) << np.arange(BATCH, dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Only A-Z are lower-cased, and only \\x20 and \\x09-\\x0D part words: what bytes methods do."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], shingle: int = SHINGLE) -> set[tuple[bytes, ...]]:
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(shingle))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes], weights: np.ndarray = _WORD) -> np.ndarray:
    """The distinct 64-bit hashes of the shingles, which have a word for each weight but the last."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(len(weights) - 1, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64) * weights[-1]
    for i in range(size):
        total += hashes[i : len(hashes) - size + 1 + i] * weights[i]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    least = np.full(len(_SLOPE), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK, None] * _SLOPE + _SHIFT
        np.minimum(least, part.min(axis=0), out=least)
    return least


@lru_cache(maxsize=4)
def most_mismatches(threshold: float = SHARE[0] / SHARE[1], miss: float = MISS) -> list[int]:
    """After each batch, the most differing bits with which a pair still goes on.

    With a uniform prior on the similarity J, a bit agrees with probability (1 + J) / 2.
    """
    j = (np.arange(20_000) + 0.5) / 20_000
    limits = []
    for n in range(BATCH, BATCH * BATCHES + 1, BATCH):
        best = 0
        for differing in range(n + 1):
            logs = (n - differing) * np.log((1 + j) / 2) + differing * np.log((1 - j) / 2)
            weight = np.exp(logs - logs.max())
            if weight[j >= threshold].sum() / weight.sum() < miss:
                break
            best = differing
        limits.append(best)
    return limits


class Rule(NamedTuple):
    """Linked: share[1] * intersection >= share[0] * union of the sets of shingles."""

    share: tuple[int, int]
    weights: np.ndarray  # of the words of a shingle, and of its size
    bands: int
    band_rows: int
    limits: list[int]

    @property
    def shingle(self) -> int:
        return len(self.weights) - 1


def rule_of(shingle: int = SHINGLE, share: tuple[int, int] = SHARE) -> Rule:
    """The longest bands, up to `BAND_ROWS`, that miss a pair at the threshold with probability below `MISS`."""
    threshold = share[0] / share[1]
    if shingle < 1 or not 0 < threshold <= 1:
        raise ValueError(f"no shingles of {shingle} words, or no threshold: {threshold}")
    hashes = BATCH * BATCHES
    fits = [r for r in range(1, BAND_ROWS + 1) if (1 - threshold**r) ** (hashes // r) < MISS]
    if not fits:
        raise ValueError(f"{hashes} hashes are too few for a threshold of {threshold}")
    rows = fits[-1]
    weights = np.random.Generator(np.random.PCG64(20_03)).integers(1, 1 << 63, shingle + 1, dtype=np.uint64)
    return Rule(share, weights | np.uint64(1), hashes // rows, rows, most_mismatches(threshold))


def sketch(frames: Iterator[pd.DataFrame], rule: Rule) -> Iterator[pd.DataFrame]:
    """(doc, text) to (doc, n, d1, d2, s0 to s3, bands): size and digest of the word sequence, the bits
    of the signature, and one key for each band."""
    shape, used = (rule.bands, rule.band_rows), rule.bands * rule.band_rows
    for frame in frames:
        out = []
        for doc, text in zip(frame["doc"], frame["text"]):
            words = words_of(text)
            hashes = shingle_hashes(words, rule.weights)
            digest = xxhash.xxh3_128_intdigest(b" ".join(words))
            d1, d2 = np.array([digest >> 64, digest & (1 << 64) - 1], dtype=np.uint64).view(np.int64)
            least = signature(hashes)
            bits = ((least >> np.uint64(20)) & np.uint64(1)).reshape(BATCHES, BATCH)
            s = (bits * _PLACE).sum(axis=1, dtype=np.uint64).view(np.int64)
            keys = _mixed(((least[:used] >> np.uint64(32)) * _BAND[:used]).reshape(shape).sum(axis=1, dtype=np.uint64))
            out.append((doc, len(hashes), d1, d2, *s, keys.view(np.int64) if len(hashes) else []))
        yield pd.DataFrame(out, columns=["doc", "n", "d1", "d2", "s0", "s1", "s2", "s3", "bands"])


SKETCH = "doc long, n long, d1 long, d2 long, s0 long, s1 long, s2 long, s3 long, bands array<long>"


def likely(a: str, b: str, rule: Rule) -> Column:
    """May two nodes still be linked, by their sizes and, batch after batch, by their signatures?"""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    hope = rule.share[1] * F.least(na, nb) >= rule.share[0] * F.greatest(na, nb)
    differing = F.lit(0)
    for i, most in enumerate(rule.limits):
        differing = differing + F.bit_count(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}")))
        hope = hope & (differing <= most)
    return hope


def linked(frames: Iterator[pd.DataFrame], rule: Rule) -> Iterator[pd.DataFrame]:
    """Pairs whose full sets are similar enough; rows of one `a` follow one another."""
    last, last_text, left = None, None, set()
    for frame in frames:
        keep = []
        for a, text_a, text_b in zip(frame["a"], frame["text_a"], frame["text_b"]):
            if a != last or text_a != last_text:
                last, last_text, left = a, text_a, shingles(words_of(text_a), rule.shingle)
            right = shingles(words_of(text_b), rule.shingle)
            common = len(left & right)
            keep.append(rule.share[1] * common >= rule.share[0] * (len(left) + len(right) - common))
        yield frame.loc[keep, ["a", "b"]]


def verify(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """(a, b) of the pairs that are links. A node that stands in very many pairs is split by the
    joins, and its own text joins last, so it is not shuffled with each of its partners."""
    marks = [c for c in nodes.columns if c not in ("node", "bands")]
    side = lambda x: nodes.select(F.col("node").alias(x), *(F.col(c).alias(f"{x}{c}") for c in marks))
    hopeful = pairs.join(side("a"), "a").join(side("b"), "b").filter(likely("a", "b", rule)).select("a", "b")
    hopeful = runtime.materialise(hopeful, "hopeful")
    both = hopeful.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    found = both.select("a", "b", "text_a", "text_b").mapInPandas(lambda frames: linked(frames, rule), "a long, b long")
    return runtime.materialise(found.distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have links.

    In every round each node takes the first of its neighbours and itself, by id or, in every second
    round, by a hash of the round, so that long chains of rising ids shrink by a share too. The links
    are then drawn between what was taken, until none is left.
    """
    a, b = F.col("a"), F.col("b")
    edges = runtime.materialise(links.select("a", "b").union(links.select(b.alias("a"), a.alias("b"))).filter(a != b).distinct(), "edges")
    labels = runtime.materialise(edges.select(a.alias("node"), a.alias("component")).distinct(), "labels")
    turn = 0
    while not edges.isEmpty():
        order = (lambda x: x) if turn % 2 == 0 else (lambda x, t=turn: F.xxhash64(x, F.lit(t)))
        near = edges.groupBy("a").agg(F.min(F.struct(order(b).alias("o"), b.alias("to"))).alias("least"))
        own = F.struct(order(a).alias("o"), a.alias("to"))
        taken = runtime.materialise(near.select("a", F.least(F.col("least"), own)["to"].alias("to")), "taken")
        labels = labels.join(taken.select(a.alias("component"), "to"), "component", "left")
        labels = runtime.materialise(labels.select("node", F.coalesce("to", "component").alias("component")), "labels")
        drawn = edges.join(taken.select("a", F.col("to").alias("to_a")), "a")
        drawn = drawn.join(taken.select(a.alias("b"), F.col("to").alias("to_b")), "b").filter("to_a <> to_b")
        edges = runtime.materialise(drawn.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "edges")
        turn += 1
    least = labels.groupBy("component").agg(F.min("node").alias("least"))
    return labels.join(least, "component").select("node", F.col("least").alias("component"))


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` (node, component), stored, after more links."""
    placed = links
    for x in ("a", "b"):
        of = labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
        placed = placed.join(of, x, "left").withColumn(x, F.coalesce(f"c{x}", x)).drop(f"c{x}")
    new = components(runtime.materialise(placed.filter("a <> b"), "merged"))
    new = runtime.materialise(new.select(F.col("node").alias("old"), F.col("component").alias("new")), "merged")
    known = labels.select("node", "component")
    lone = new.join(known, new["old"] == known["node"], "left_anti").select(F.col("old").alias("node"), F.col("old").alias("component"))
    both = known.union(lone)
    moved = both.join(new, both["component"] == new["old"], "left")
    return runtime.materialise(moved.select("node", F.coalesce("new", "component").alias("component")), "components")


def mixed_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, component) of the buckets that hold more than one component."""
    placed = buckets.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    placed = runtime.materialise(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
    mixed = runtime.materialise(mixed.filter("c1 <> c2").select("key"), "mixed")
    return runtime.materialise(placed.join(mixed, "key"), "mixed-buckets")


def other_stars(mixed: DataFrame, turn: int) -> DataFrame:
    """(a, b): nodes with one node of another component each: of the leads of its buckets, which are
    the first nodes by a hash of the turn, a node meets the first that is in another component."""
    order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node", "component")
    first = mixed.groupBy("key").agg(F.min(order).alias("lead"))
    first = runtime.materialise(first.select("key", F.col("lead.o").alias("o"), F.col("lead.node").alias("a"), F.col("lead.component").alias("c")), "leads")
    met = mixed.join(first, "key").filter("component <> c")
    stars = met.groupBy("node").agg(F.min(F.struct("o", "a")).alias("lead"))
    return stars.select(F.col("lead.a").alias("a"), F.col("node").alias("b"))


def compare_group(rows: list[tuple], rule: Rule) -> Iterator[tuple[int, int]]:
    """Links between the components of one pair of a bucket's blocks. Rows are (key, i, j, block, node,
    component, n, s0 to s3, bands, text). A pair is compared in the first band that it shares, and no
    longer once its components are joined; the likeliest partners come first."""
    key, i, j = rows[0][:3]
    left = [r for r in rows if r[3] == i]
    right = left if i == j else [r for r in rows if r[3] == j]
    if not left or not right or len({r[5] for r in rows}) < 2:
        return
    component, sizes = (np.array([r[k] for r in right], dtype=np.int64) for k in (5, 6))
    bits = np.array([r[7:11] for r in right], dtype=np.int64).view(np.uint64)
    bands = np.array([r[11] for r in right], dtype=np.int64)
    limits, band = rule.limits, int(np.argmax(np.array(left[0][11]) == key))
    joined: dict[int, int] = {}
    sets: dict[int, set] = {}

    def root(c: int) -> int:
        while c in joined:
            c = joined[c]
        return c

    def full(row: tuple) -> set:
        if row[4] not in sets:
            sets[row[4]] = shingles(words_of(row[12]), rule.shingle)
        return sets[row[4]]

    for at, a in enumerate(left):
        start = at + 1 if i == j else 0
        hope = component[start:] != a[5]
        hope &= rule.share[1] * np.minimum(sizes[start:], a[6]) >= rule.share[0] * np.maximum(sizes[start:], a[6])
        if not hope.any():
            continue
        if band:
            hope &= ~(bands[start:, :band] == np.array(a[11][:band])).any(axis=1)
        differing = np.bitwise_count(bits[start:] ^ np.array(a[7:11], dtype=np.int64).view(np.uint64)).cumsum(axis=1)
        hope &= (differing <= limits).all(axis=1)
        found = np.flatnonzero(hope)
        for k in found[np.argsort(differing[found, -1], kind="stable")]:
            b = right[start + k]
            if root(a[5]) == root(b[5]):
                continue
            common = len(full(a) & full(b))
            if rule.share[1] * common >= rule.share[0] * (len(full(a)) + len(full(b)) - common):
                joined[root(a[5])] = root(b[5])
                yield a[4], b[4]


def compare_groups(frames: Iterator[pd.DataFrame], rule: Rule) -> Iterator[pd.DataFrame]:
    """Groups of rows follow one another and may go over the end of a frame."""
    group: list[tuple] = []
    for frame in frames:
        links = []
        for row in frame.itertuples(index=False, name=None):
            if group and group[0][:3] != row[:3]:
                links += compare_group(group, rule)
                group = []
            group.append(row)
        yield pd.DataFrame(links, columns=["a", "b"])
    if group:
        yield pd.DataFrame(list(compare_group(group, rule)), columns=["a", "b"])


def compare_all(mixed: DataFrame, nodes: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): links between the components of mixed buckets. A bucket is cut into blocks of some
    `MEMBERS` nodes, and every pair of its blocks is compared by one task; pairs of nodes are never rows."""
    counts = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    counts = runtime.materialise(counts, "members").withColumn("blocks", F.ceil(F.col("members") / MEMBERS).cast("int"))
    placed = mixed.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("key", "node", "component", "block", other)
    pairs = pairs.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    marks = nodes.select("node", "n", "s0", "s1", "s2", "s3", "bands").join(texts, "node")
    marks = runtime.materialise(marks.join(mixed.select("node").distinct(), "node", "left_semi"), "marks")
    whole = pairs.join(marks, "node").select(
        "key", "i", "j", "block", "node", "component", "n", "s0", "s1", "s2", "s3", "bands", "text"
    )
    sorted_groups = whole.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    links = sorted_groups.mapInPandas(lambda frames: compare_groups(frames, rule), "a long, b long")
    return runtime.materialise(links.distinct(), "links")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, share: tuple[int, int] = SHARE
) -> DataFrame:
    """(doc, n_shingles, component_id, kept): one row per row of `docs`. Linked are documents whose sets of
    `shingle` words have a similarity of share[0] / share[1] or more."""
    rule = rule_of(shingle, share)
    given = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    sketches = runtime.materialise(given.mapInPandas(lambda frames: sketch(frames, rule), SKETCH), "sketches")
    marks = ["n", "s0", "s1", "s2", "s3", "bands"]
    nodes = sketches.filter("n > 0 and doc is not null").groupBy("d1", "d2")
    nodes = runtime.materialise(nodes.agg(F.min("doc").alias("node"), *(F.first(m).alias(m) for m in marks)), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last"))
    shared = runtime.materialise(shared.filter("lead <> last").select("key", "lead"), "keys")
    buckets = runtime.materialise(banded.join(shared, "key"), "buckets")
    met = runtime.materialise(buckets.select("node").distinct(), "met")
    texts = runtime.materialise(given.join(met, F.col("doc") == F.col("node")).select("node", "text"), "texts")

    stars = buckets.groupBy("node").agg(F.min("lead").alias("a")).filter("node <> a")
    labels = runtime.materialise(components(verify(stars.select("a", F.col("node").alias("b")), nodes, texts, rule)), "components")
    mixed = buckets.select("key", "node")
    for turn in range(TURNS):
        mixed = mixed_buckets(mixed.select("key", "node"), labels)
        labels = merge(labels, verify(other_stars(mixed, turn), nodes, texts, rule))

    mixed = mixed_buckets(mixed.select("key", "node"), labels)
    labels = merge(labels, compare_all(mixed, nodes, texts, rule))

    copies = nodes.select("d1", "d2", "node").join(labels, "node", "left")
    copies = runtime.materialise(copies.select("d1", "d2", F.coalesce("component", "node").alias("component")), "copies")
    told = sketches.select("doc", "n", "d1", "d2").join(copies, ["d1", "d2"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "doc")).otherwise(F.col("doc"))
    component = F.when(F.col("doc").isNull(), F.lit(None)).otherwise(component)
    return told.select(
        "doc",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, share: tuple[int, int] = SHARE
) -> DataFrame:
    """The rows of `docs` that stay: of each group of near copies the document of the smallest id."""

    def lost() -> DataFrame:
        judged = near_duplicates(docs, key, text, shingle, share)
        return judged.filter("not kept").select(F.col("doc").alias("__gone")).distinct()

    gone = runtime.settle(docs.sparkSession, lost, "gone")
    return docs.join(gone, docs[key].cast("long") == gone["__gone"], "left_anti")
