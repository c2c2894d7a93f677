"""Prefix trie of conversations from a sorted list: sparse tables over the longest common prefixes.

Conversations are sorted by their sequences of turns, and each keeps the number of first turns that it has in
common with the one before (LCP). The conversations that share the first d turns with the one at place i lie
around i as far as no LCP in between is below d. A sparse table holds the least LCP of every stretch whose
length is a power of two, so both ends of that interval are found by binary search, each on its own and for
all prefixes of all conversations at once; there is no stack. A prefix whose interval begins at i itself is
a node of the trie; the others are reported by the conversation at which their interval begins.

The sorted list is cut into blocks of consecutive places, one task each. Inside a block, intervals are found
with the block's own table. What reaches over a block's end is settled by a second sparse table over the least
LCP of every block: it holds at most `BLOCKS` numbers, as blocks grow beyond `BLOCK` rows where there would be
more. For every depth that is open at the start of a block, a binary search to the left finds the block in which
the node begins; there a depth that is open at the end belongs to one node. A block adds what it knows of an open
node (members, children, leaves, words, ids) as one row, and these few rows are summed by node.

The sums come from places: a node's members are an interval; leaves and the words of new nodes are counted at the
place where they begin; and the sum of (members - 1) * words over a subtree is the words of all members' turns
from the node's depth on, less the words of the nodes themselves.

What meets in one row is the turns of one conversation, as two hashes and a number each. Equal conversations, a
common first turn and the root reach over many blocks, and are not gathered anywhere but for the digest of
`ends`, which is made from one text of ids for each node: blocks join theirs, and one task reads them in order.

Defined results: rows without conversation id belong to none and take no part; null role or text is empty; null turn
comes first, and rows of equal turn are in the order of role and text; a conversation without turns belongs to the root
alone; an empty table has no node.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import pieces

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1024  # conversations of a block
BLOCKS = 65_536  # the most blocks, and so the most numbers that are sent to every task
FIELDS = "conv_id long, n_convs long, n_children long, n_leaves long, words long, new_words long"
EMITTED = (
    f"kind string, block long, depth long, {FIELDS}, parent_conv_id long, parent_over string, ends string, ends_sha256 string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---- sequences


def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, place, a, b, words): every turn, by two hashes of role and text, placed from 0."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("place"),
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit(1), "text", "role").alias("b"),
        F.size(pieces(F.col("text"), r"[\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def with_shared_starts(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """(conv_id, place, a, b, words) after every conversation's first `heads` turns, `most` at most, are replaced by
    those of the conversation `base`; both are expressions of conv_id. The last row of each conversation has
    no turn (null place), so that none is lost."""
    turns = runtime.materialise(turns, "turns")
    convs = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), heads.alias("heads"))
    convs = runtime.materialise(convs, "conversations")
    firsts = turns.filter(F.col("place") < most).join(convs.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi")
    firsts = runtime.materialise(firsts.withColumnRenamed("conv_id", "base"), "first-turns")
    given = convs.join(firsts, "base").filter("place < heads").select("conv_id", "place", "a", "b", "words")
    sizes = firsts.groupBy("base").agg(F.count(F.lit(1)).alias("has"))  # `most` at most
    shift = convs.join(sizes, "base", "left")
    shift = shift.select("conv_id", "heads", F.least("heads", F.coalesce("has", F.lit(0))).alias("got"))
    own = turns.join(shift, "conv_id").filter("place >= heads")
    own = own.select("conv_id", (F.col("place") - F.col("heads") + F.col("got")).alias("place"), "a", "b", "words")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("place", "long"), ("a", "long"), ("b", "long"), ("words", "long"))]
    return given.unionByName(own).unionByName(convs.select("conv_id", *none))


def sorted_sequences(turns: DataFrame) -> tuple[DataFrame, int]:
    """(conv_id, a, b, words, at) in the order of the sequences, numbered from 0; and their number."""
    spark = turns.sparkSession
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "a", "b", "words"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("seq"))
    rows = rows.select(
        "conv_id",
        F.transform("seq", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"))).alias("key"),
        F.transform("seq", lambda t: t["words"]).alias("words"),
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # copies are told apart by their ids, so a large group of them is cut like everything else
    rows = runtime.materialise(rows, "sequences").repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    numbered = rows.withColumn("number", F.monotonically_increasing_id()).select(
        "conv_id",
        F.transform("key", lambda t: t["a"]).alias("a"),
        F.transform("key", lambda t: t["b"]).alias("b"),
        "words",
        F.shiftright("number", 33).alias("part"),
        F.col("number").bitwiseAND((1 << 33) - 1).alias("i"),
    )
    stored = runtime.materialise(numbered, "sorted")
    counts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row for each partition
    starts, total = [], 0
    for row in counts:
        starts.append((row["part"], total))
        total += row["n"]
    offsets = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
    return stored.join(offsets, "part").select("conv_id", "a", "b", "words", (F.col("start") + F.col("i")).alias("at")), total


# ---- one block


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """levels[k][i]: the least of values[i : i + 2**k]."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def reach_left(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first place l with values[l + 1 .. at] all at least `depth`."""
    left = at.copy()
    for k in reversed(range(len(levels))):
        step = 1 << k
        ok = left >= step
        low = np.where(ok, left - step + 1, 0)
        ok &= (low < len(levels[k])) & (levels[k][np.minimum(low, len(levels[k]) - 1)] >= depth)
        left = np.where(ok, left - step, left)
    return left


def reach_right(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last place r with values[at + 1 .. r] all at least `depth`."""
    right = at.copy()
    n = len(levels[0])
    for k in reversed(range(len(levels))):
        step = 1 << k
        ok = right + step < n
        low = np.where(ok, right + 1, 0)
        ok &= levels[k][np.minimum(low, len(levels[k]) - 1)] >= depth
        right = np.where(ok, right + step, right)
    return right


def least_of(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least of values[left .. right], by two stretches that may overlap."""
    k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), levels[0].dtype)
    for level in np.unique(k):
        m = k == level
        out[m] = np.minimum(levels[level][left[m]], levels[level][right[m] - (1 << level) + 1])
    return out


def common_prefixes(a: np.ndarray, b: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For every sequence but the first the number of first turns it has in common with the one before."""
    shared = np.minimum(sizes[1:], sizes[:-1])
    owner = np.repeat(np.arange(len(shared)), shared)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(shared) - shared, shared)
    x, y = starts[1:][owner] + step, starts[:-1][owner] + step
    out = shared.copy()
    differs = (a[x] != a[y]) | (b[x] != b[y])
    np.minimum.at(out, owner[differs], step[differs])
    return out


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def block_nodes(frame: pd.DataFrame, total: int) -> pd.DataFrame:
    """Nodes that begin in a block, and its share of those that are open at its start. The frame holds the block's
    rows and, where there are such, the row before and the row after."""
    frame = frame.sort_values("at", kind="stable")
    block = int(frame["block"].iloc[0])
    at, home = frame["at"].to_numpy(np.int64), ~frame["halo"].to_numpy(bool)
    sizes = np.array([len(x) for x in frame["a"]], np.int64)
    starts = np.cumsum(sizes) - sizes
    a, b, words = (
        np.concatenate([np.asarray(x, np.int64) for x in frame[c]] or [np.zeros(0, np.int64)]) for c in ("a", "b", "words")
    )
    first, last = int(np.flatnonzero(home)[0]), int(np.flatnonzero(home)[-1])
    lcp_all = np.concatenate([[-1], common_prefixes(a, b, starts, sizes)])  # -1: nothing is open before the first place
    after = int(lcp_all[last + 1]) if last + 1 < len(at) else -1
    n = last - first + 1
    lcp, size, conv = lcp_all[first : last + 1], sizes[first : last + 1], frame["conv_id"].to_numpy(np.int64)[first : last + 1]
    table, convs = sparse_table(lcp), sparse_table(conv)

    # words of the first d turns of each place, at offset[i] + d
    offset = np.cumsum(size + 1) - (size + 1)
    upto = np.zeros(int((size + 1).sum()), np.int64)
    for i in range(n):
        upto[offset[i] + 1 : offset[i] + size[i] + 1] = np.cumsum(words[starts[first + i] : starts[first + i] + size[i]])
    whole = upto[offset + size]
    new = whole - np.where(lcp > 0, upto[offset + np.maximum(np.minimum(lcp, size), 0)], 0)
    behind = np.append(lcp[1:], after)
    leaf = (behind < size).astype(np.int64)
    sums = {c: np.concatenate([[0], np.cumsum(x)]) for c, x in (("whole", whole), ("new", new), ("leaf", leaf))}
    between = lambda c, l, r: sums[c][r + 1] - sums[c][l]

    # every prefix of every conversation, each with both ends of its interval
    place = np.repeat(np.arange(n), size + 1)
    depth = np.arange(len(place)) - np.repeat(offset, size + 1)
    left, right = reach_left(table, place, depth), reach_right(table, place, depth)
    starts_before = (left == 0) & (lcp[0] >= depth)  # open at the start of the block
    is_node = (left == place) & ~starts_before
    known = lambda i, d: upto[offset[i] + np.maximum(d - 1, 0)]  # noqa: E731  words above the node's own turn

    node = np.flatnonzero(is_node)
    i, d, r = place[node], depth[node], right[node]
    number = np.full(len(place), -1)
    number[node] = np.arange(len(node))
    count = r - i + 1
    out = {
        "conv_id": least_of(convs, i, r),
        "n_convs": count,
        "n_leaves": between("leaf", i, r),
        "words": between("whole", i, r) - count * known(i, d),
        "new_words": between("new", i + 1, r) + whole[i] - known(i, d),
    }
    tail = (r == n - 1) & (after >= d)

    # the parent is the prefix one turn shorter of the same place; its interval begins where its left end is
    above = np.maximum(offset[i] + d - 1, 0)
    top = d == 0
    from_before = starts_before[above] & ~top
    parent = number[np.where(from_before | top, 0, offset[left[above]] + d - 1)]
    parent = np.where(from_before | top, -1, parent)
    out["n_children"] = np.bincount(parent[parent >= 0], minlength=len(node))
    parent_conv = np.where(parent >= 0, out["conv_id"][parent], 0)
    parent_over = np.where(from_before, "open", np.where((parent >= 0) & tail[parent], "tail", ""))

    # copies lie together; those that end at depth d come first in the node's interval
    same = np.concatenate([[False], (lcp[1:] == size[1:]) & (size[1:] == size[:-1])])
    run_end = reach_right(sparse_table(same.astype(np.int64)), np.arange(n), np.ones(n, np.int64))
    ends, digests = np.full(len(node), None, object), np.full(len(node), NO_ENDS, object)
    for k in np.flatnonzero(size[i] == d):
        told = _joined(conv[i[k] : run_end[i[k]] + 1])
        if tail[k]:
            ends[k] = told
        else:
            digests[k] = hashlib.sha256(told.encode()).hexdigest()
    made = pd.DataFrame(out)
    made["kind"], made["depth"], made["ends"], made["ends_sha256"] = np.where(tail, "tail", "node"), d, ends, digests
    made["parent_conv_id"] = pd.array(parent_conv, dtype="Int64")
    made.loc[(parent_over != "") | top, "parent_conv_id"] = pd.NA
    made["parent_over"] = parent_over

    # depths that are open at the start
    od = np.arange(int(lcp[0]) + 1)
    zero = np.zeros(len(od), np.int64)
    reach = reach_right(table, zero, od)
    count = reach + 1
    held = pd.DataFrame(
        {
            "conv_id": least_of(convs, zero, reach),
            "n_convs": count,
            "n_children": np.bincount(d[from_before] - 1, minlength=len(od))[: len(od)] if len(od) else zero,
            "n_leaves": between("leaf", zero, reach),
            "words": between("whole", zero, reach) - count * known(zero, od),
            "new_words": between("new", zero, reach),
        }
    )
    held["kind"], held["depth"] = "open", od
    held["ends"] = [_joined(conv[: run_end[0] + 1]) if x == size[0] else None for x in od]
    held["ends_sha256"], held["parent_conv_id"] = None, pd.array([pd.NA] * len(od), dtype="Int64")
    least = pd.DataFrame([{"kind": "least", "depth": int(lcp.min())}])
    made = pd.concat([made, held, least], ignore_index=True)
    made["block"] = block
    columns = [c.split()[0] for c in EMITTED.split(", ")]
    made = made.reindex(columns=columns)
    for c in (*(f.split()[0] for f in FIELDS.split(", ")), "parent_conv_id"):
        made[c] = made[c].astype("Int64")
    return made


# ---- over blocks


def owners(frames: Iterator[pd.DataFrame], levels: list[np.ndarray]) -> Iterator[pd.DataFrame]:
    """For each depth that is open at the start of a block, the block in which its node begins: the nearest one
    to the left with a lesser LCP."""
    for frame in frames:
        block, depth = frame["block"].to_numpy(np.int64), frame["depth"].to_numpy(np.int64)
        # values[l + 1 .. block - 1] at least depth
        yield frame.assign(owner=reach_left(levels, block - 1, depth))


def merge_open(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one node follow one another, by block; the first is the one with which it begins."""
    node, sums, digest = None, None, None

    def closed() -> tuple:
        return (*node, *sums, digest.hexdigest())

    columns = ["owner", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "words", "new_words", "ends_sha256"]
    for frame in frames:
        done = []
        for row in frame.itertuples(index=False):
            if (row.owner, row.depth) != node:
                if node is not None:
                    done.append(closed())
                node, sums, digest, some = (row.owner, row.depth), [row.conv_id, 0, 0, 0, 0, 0], hashlib.sha256(), False
            sums = [min(sums[0], row.conv_id)] + [
                s + x for s, x in zip(sums[1:], (row.n_convs, row.n_children, row.n_leaves, row.words, row.new_words))
            ]
            if isinstance(row.ends, str):
                digest.update((("," if some else "") + row.ends).encode())
                some = True
        yield pd.DataFrame(done, columns=columns)
    if node is not None:
        yield pd.DataFrame([closed()], columns=columns)


def prefix_trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of `turns` (conv_id, place, a, b, words; null place: no turn): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    rows, total = sorted_sequences(turns)
    block = max(block, -(-total // BLOCKS))
    n_blocks = -(-total // block)
    home, step = F.floor(F.col("at") / block), F.col("at") % block
    seen_by = lambda b, halo: F.struct(b.alias("block"), F.lit(halo).alias("halo"))
    shared = F.array(  # the block's own rows, and those beside it
        seen_by(home, False),
        F.when((step == 0) & (F.col("at") > 0), seen_by(home - 1, True)),
        F.when((step == block - 1) & (F.col("at") + 1 < total), seen_by(home + 1, True)),
    )
    placed = rows.select("*", F.inline(F.array_compact(shared)))
    tasks = max(1, min(n_blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)))
    grouped = placed.repartition(tasks, "block").groupBy("block")
    made = runtime.materialise(grouped.applyInPandas(lambda frame: block_nodes(frame, total), EMITTED), "nodes")

    found = made.filter("kind in ('node', 'tail')")
    least = {r["block"]: r["depth"] for r in made.filter("kind = 'least'").select("block", "depth").collect()}  # `BLOCKS` at most
    levels = sparse_table(np.array([least[k] for k in range(n_blocks)], np.int64)) if n_blocks else []
    fields = [f.split()[0] for f in FIELDS.split(", ")]
    share = made.filter("kind = 'open'").select("block", "depth", *fields, "ends")
    schema = f"block long, depth long, {FIELDS}, ends string, owner long"
    share = share.mapInPandas(lambda frames: owners(frames, levels), schema)
    share = runtime.materialise(share.select("owner", "block", "depth", *fields, "ends"), "open")
    begun = made.filter("kind = 'tail'").select(F.col("block").alias("owner"), "block", "depth", *fields, "ends")
    ordered = begun.unionByName(share).repartition(tasks, "owner", "depth").sortWithinPartitions("owner", "depth", "block")
    merged = ordered.mapInPandas(merge_open, f"owner long, depth long, {FIELDS}, ends_sha256 string")
    merged = runtime.materialise(merged, "merged")

    # a parent that reaches over a block's start or end is known by the child's block, its depth, and which of both
    whole = merged.select("owner", "depth", F.col("conv_id").alias("of"))
    seen = share.select("owner", "block", "depth").join(whole, ["owner", "depth"]).select("block", "depth", "of", F.lit("open").alias("parent_over"))
    ends = whole.select(F.col("owner").alias("block"), "depth", "of", F.lit("tail").alias("parent_over"))
    seen = runtime.materialise(seen.unionByName(ends), "parents")
    tails = found.filter("kind = 'tail'").drop(*fields, "ends", "ends_sha256").join(
        merged.withColumnRenamed("owner", "block"), ["block", "depth"]
    )
    columns = ["block", "depth", *fields, "parent_conv_id", "parent_over", "ends_sha256"]
    nodes = found.filter("kind = 'node'").select(*columns).unionByName(tails.select(*columns))
    parents = seen.select("block", (F.col("depth") + 1).alias("depth"), "parent_over", "of")
    # a block's own depths: no more than its rows of that depth meet in one key
    told = nodes.join(parents, ["block", "depth", "parent_over"], "left")
    return told.select(
        "conv_id",
        "depth",
        F.coalesce("of", "parent_conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("words") - F.col("new_words")).alias("saved_tokens"),
        "ends_sha256",
    )
