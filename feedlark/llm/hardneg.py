"""Hard-negative mining by exact scores from subset-sum tables ("Four Russians").

Components become integers. Every eight dimensions of an anchor give a table of 256 subset sums. A
candidate's integers are cut into bit planes in two's complement, and the planes of eight dimensions are
packed into one byte each; such a byte indexes the tables of all anchors of a block at once. The looked-up
sums of a plane are added, shifted by the place of the plane and added again (the top plane is subtracted),
which gives the whole, exact inner product of every anchor with every candidate.

Anchors, one in a hundred rows, are a stated query set: they are packed into blocks of at most `ANCHORS`, the
candidates into blocks of at most `CANDIDATES`, and every pair of blocks is one row of a join, so that no pair
of rows is ever one. A block pair gives back at most the first few of each anchor. Two passes: the first
finds the positives; the second, which knows their scores, the negatives within reach of each positive.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no part.
Vectors of different lengths meet as if the shorter ended in zeros. Rows that repeat an id are rows of their
own, as candidates and as anchors, but never partners of an anchor of the same id. An anchor without a
positive, and a positive without a negative within reach, give no row; an empty table gives none. Components
so large that a score could pass 64 bits raise.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlark import runtime

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
NEAR = (80, 100)  # a negative scores at least this share of the positive, and at most as much
ANCHORS, CANDIDATES = 256, 2048  # rows of a block
GROUP = 8  # dimensions of a table
TOP = 1 << 61  # scores stay below

BLOCK = "ids binary, labels binary, width int, planes int, data binary"
_BITS = (np.arange(256)[:, None] >> np.arange(GROUP)) & 1  # the subset of each byte


def usable(embedding: Column) -> Column:
    """Is every component there and finite?"""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return embedding.isNotNull() & ~odd


def quantised(vectors: pd.Series) -> np.ndarray:
    """floor(SCALE * x) as integers, zeros after the end of shorter vectors."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out = np.floor(SCALE * out)
    if out.size and np.abs(out).max() >= 1 << 53:
        raise ValueError("components too large for exact scores")
    return out.astype(np.int64)


def to_planes(values: np.ndarray) -> tuple[int, bytes]:
    """Number of bit planes, and the packed bytes by (plane, group, row)."""
    rows, width = values.shape
    reach = int(max(values.max(initial=0), -(values.min(initial=0) + 1)))
    planes = reach.bit_length() + 1
    padded = np.zeros((rows, -(-width // GROUP) * GROUP), np.int64)
    padded[:, :width] = values
    bits = (padded[None] >> np.arange(planes)[:, None, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
    return planes, np.ascontiguousarray(packed.transpose(0, 2, 1)).tobytes()


def pack_candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(vec_id, label, embedding) to blocks in which rows lie in the order of their ids."""
    for part in _slices(frames, CANDIDATES):
        part = part.sort_values("vec_id", kind="stable")
        values = quantised(part["embedding"])
        planes, data = to_planes(values)
        yield _block(part["vec_id"], part["label"], values.shape[1], planes, data)


def pack_anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(anchor, anchor_id, label, embedding, reach) to blocks; `reach` holds the scores of the positives found
    so far, which the second pass needs."""
    for part in _slices(frames, ANCHORS):
        values = quantised(part["embedding"])
        out = _block(part["anchor_id"], part["label"], values.shape[1], 0, values.tobytes())
        out["anchors"] = [part["anchor"].to_numpy(np.int64).tobytes()]
        reach = np.full((len(part), POSITIVES), -1, np.int64)  # no negative is in reach of a score below 0
        for i, scores in enumerate(part["reach"]):
            reach[i, : len(scores)] = scores
        out["reach"] = [reach.tobytes()]
        yield out


def _slices(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Slices of `size` rows across the ends of frames."""
    held: list[pd.DataFrame] = []
    n = 0
    for frame in frames:
        while len(frame):
            held.append(frame.iloc[: size - n])
            frame = frame.iloc[size - n :]
            n += len(held[-1])
            if n == size:
                yield pd.concat(held)
                held, n = [], 0
    if held:
        yield pd.concat(held)


def _block(ids: pd.Series, labels: pd.Series, width: int, planes: int, data: bytes) -> pd.DataFrame:
    row = (ids.to_numpy(np.int64).tobytes(), labels.to_numpy(np.int64).tobytes(), width, planes, data)
    return pd.DataFrame([row], columns=["ids", "labels", "width", "planes", "data"])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables by (group, byte, anchor): the sum of the anchor's dimensions that the byte selects."""
    n, width = anchors.shape
    padded = np.zeros((n, -(-width // GROUP) * GROUP), np.int64)
    padded[:, :width] = anchors
    return np.einsum("bd,agd->gba", _BITS, padded.reshape(n, -1, GROUP))


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products by (row, anchor), from tables and packed planes by (plane, group, row)."""
    n_planes, groups, rows = planes.shape
    groups = min(groups, len(tables))  # dimensions of one side alone meet zeros
    small = GROUP * groups * int(np.abs(tables).max(initial=0)) < 1 << 31
    tables = tables.astype(np.int32) if small else tables
    total = np.zeros((rows, tables.shape[2]), np.int64)
    looked = np.empty((rows, tables.shape[2]), tables.dtype)
    for k in range(n_planes):
        plane = np.zeros_like(looked)
        for g in range(groups):
            np.take(tables[g], planes[k, g], axis=0, out=looked, mode="clip")
            plane += looked
        shifted = plane.astype(np.int64) << k
        total += -shifted if k == n_planes - 1 else shifted
    return total


def firsts(score: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the n first allowed rows of each anchor: higher scores, then lower rows. Both arrays
    are by (anchor, row)."""
    low = np.iinfo(np.int64).min
    masked = np.where(allowed, score, low)
    if masked.shape[1] > n:
        least = np.partition(masked, masked.shape[1] - n, axis=1)[:, masked.shape[1] - n, None]
        hit = allowed & (masked >= least)
    else:
        hit = allowed
    a, c = np.nonzero(hit)
    order = np.lexsort((c, -masked[a, c], a))
    a, c = a[order], c[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    return a[place < n], c[place < n]


def score_blocks(frames: Iterator[pd.DataFrame], negatives: bool) -> Iterator[pd.DataFrame]:
    """Each row is a pair of blocks. Without `negatives` the first rows of each anchor's label; with them, for
    each positive score the first rows of other labels within its reach: (anchor, reach, vec_id, score)."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            anchors, ids, labels, a_ids, a_labels = (
                np.frombuffer(x, np.int64) for x in (row.anchors, row.ids, row.labels, row.a_ids, row.a_labels)
            )
            values = np.frombuffer(row.a_data, np.int64).reshape(len(anchors), row.a_width)
            groups = -(-row.width // GROUP)
            planes = np.frombuffer(row.data, np.uint8).reshape(row.planes, groups, len(ids))
            most = int(np.abs(values).max(initial=0)) * (1 << row.planes) * max(1, row.width)
            if most >= TOP // NEAR[1]:
                raise ValueError("components too large for exact 64-bit scores")
            score = np.ascontiguousarray(scores(subset_sums(values), planes).T)
            other, same = a_ids[:, None] != ids, a_labels[:, None] == labels
            found = []
            if negatives:
                reach = np.frombuffer(row.reach, np.int64).reshape(len(anchors), POSITIVES)
                for place in range(POSITIVES):
                    bound = reach[:, place, None]
                    fits = other & ~same & (NEAR[0] * bound <= NEAR[1] * score) & (score <= bound) & (bound >= 0)
                    some = np.flatnonzero(fits.any(axis=1))
                    a, c = firsts(score[some], fits[some], NEGATIVES)
                    found.append((some[a], np.full(len(a), place), c))
            else:
                a, c = firsts(score, other & same, POSITIVES)
                found.append((a, np.zeros(len(a), np.int64), c))
            a, place, c = (np.concatenate(x) for x in zip(*found))
            yield pd.DataFrame({"anchor": anchors[a], "place": place, "vec_id": ids[c], "score": score[a, c]})


def _meet(candidates: DataFrame, anchors: DataFrame, lanes: int, negatives: bool) -> DataFrame:
    """Every block of anchors meets every block of candidates. Candidates lie in lanes; anchors, the fewer, go
    to each. The number of partitions is given, as the size of the blocks says little about the work."""
    packed = anchors.mapInPandas(pack_anchors, f"{BLOCK}, anchors binary, reach binary")
    packed = packed.select("anchors", "reach", *(F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "width", "data")))
    packed = packed.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    pairs = candidates.repartition(lanes, "lane").join(packed.repartition(lanes, "lane"), "lane")
    found = pairs.drop("lane").mapInPandas(
        lambda frames: score_blocks(frames, negatives), "anchor long, place int, vec_id long, score long"
    )
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= (NEGATIVES if negatives else POSITIVES))


def hard_negatives(
    rows: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", embedding: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of
    its first `POSITIVES` other rows of the same label, the first `NEGATIVES` rows of another label that score
    no more than the positive and at least `NEAR` of it."""
    spark = rows.sparkSession
    given = rows.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(embedding).cast("array<double>").alias("embedding"), is_anchor.alias("is_anchor"),
    )
    given = given.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    anchors = given.filter("is_anchor").withColumn("anchor", F.monotonically_increasing_id())
    anchors = runtime.materialise(anchors.withColumnRenamed("vec_id", "anchor_id").drop("is_anchor"), "anchors")

    # dealt out in turn, so that blocks are even whatever the ids and labels, and not smaller than they may be
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    total, n_anchors = given.count(), anchors.count()
    dealt = given.drop("is_anchor").repartition(max(1, min(tasks, -(-total // CANDIDATES))))
    blocks = dealt.mapInPandas(pack_candidates, BLOCK)
    lanes = max(1, min(tasks, -(-total // CANDIDATES)))
    blocks = blocks.withColumn("lane", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(lanes)).cast("int"))
    blocks = runtime.materialise(blocks, "candidates")
    parts = max(1, min(tasks, -(-n_anchors // ANCHORS)))

    none = F.array().cast("array<long>")
    first = _meet(blocks, anchors.withColumn("reach", none).repartition(parts), lanes, negatives=False)
    positives = runtime.materialise(first.drop("place"), "positives")
    # an anchor has few positives, ordered by rank
    known = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    known = anchors.join(known, "anchor").withColumn("reach", F.transform("p", lambda x: x["score"])).drop("p")
    second = _meet(blocks, known.repartition(parts), lanes, negatives=True)
    found = runtime.materialise(second, "negatives")
    told = positives.join(anchors.select("anchor", "anchor_id"), "anchor").select(
        "anchor", "anchor_id", (F.col("rank") - 1).alias("place"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return found.join(told, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
