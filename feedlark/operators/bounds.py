"""Sparse dot products of bags and names by blocks, with upper bounds (MaxScore; Turtle and Flood, 1995).

The names of a catalog lie in blocks of similar length, each with its postings by term and the largest weight of
every term. A bag's terms are taken from the largest possible contribution to the smallest. As soon as the terms that
are left could not lift a new name to the result, no new name is taken up; the terms that are left are only added to
names that can still reach it. What counts as the result is a fixed least score (`least`), or the k best found so far.
Bags are summed one after another, so that the sums over a block's names and the postings of a bag stay in a core's cache.

Blocks of bags and blocks of names are packed into one row each and meet in the cells of a grid.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlark import runtime

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_CELLS = 2_000_000  # postings of a block of names, 24 bytes each
BLOCK_NAMES = 50_000  # names of a block, so that a bag's sums stay small
BAG_ROWS = 256  # bags of a block
PASS_CELLS = 2_000_000  # sums and postings of the bags whose results a worker holds at once
LOOK_UPS = 12  # postings that are added in the time that one takes to be looked up
TRIED_BAGS = 16  # in a block where bounds spare little, one bag in so many still goes by them
SPARED = 0.2  # the share of postings that bounds must spare
CHUNK_WORDS = 4_000_000  # words of the bags that a task holds, 12 bytes each
DECIMALS = 1e6  # results are ordered by totals rounded to 6 decimals
SLACK = 2e-6  # what rounding may add to a total

NAME_BLOCK = "terms array<string>, starts binary, places binary, weights binary, most binary, names binary"
BAG_BLOCK = "bag_block long, bags binary, bag_terms array<string>, bag_starts binary, codes binary, raws binary, least binary"


class NameBlock:
    """Postings of a block: for term i, places[starts[i] : starts[i + 1]] in `names`, in order, with their weights."""

    def __init__(self, row):
        self.number = {t: i for i, t in enumerate(row.terms)}
        self.starts, self.names = (np.frombuffer(x, np.int64) for x in (row.starts, row.names))
        self.places = np.frombuffer(row.places, np.int32).astype(np.int64)  # as `bincount` takes them
        self.weights, self.most = (np.frombuffer(x, np.float64) for x in (row.weights, row.most))
        self.added = 0  # postings that were added or looked up
        self.tried = self.spared = 0  # postings of bags that went by bounds, and how many of them were neither added nor looked up

    @cached_property
    def keys(self) -> np.ndarray:
        """(term, place) of every posting as one number, in order."""
        return np.repeat(np.arange(len(self.most)), np.diff(self.starts)) * len(self.names) + self.places

    def sums(self, lists: list[slice], raws: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What a bag's words, given by their `lists` of postings, bring to each name."""
        brought = np.concatenate([self.weights[x] for x in lists])
        brought *= np.repeat(raws, sizes)
        self.added += len(brought)
        return np.bincount(np.concatenate([self.places[x] for x in lists]), brought, minlength=len(self.names))

    def look_up(self, terms: np.ndarray, raws: np.ndarray, places: np.ndarray) -> np.ndarray:
        """What a bag's (term, raw) bring to some names; 0 where a name does not have the term."""
        wanted = terms[:, None] * len(self.names) + places
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        self.added += wanted.size
        return (raws[:, None] * np.where(self.keys[at] == wanted, self.weights[at], 0.0)).sum(axis=0)


def pack_names(frame: pd.DataFrame) -> pd.DataFrame:
    """One block: (name_no, term, weight) rows to a packed row."""
    codes, terms = pd.factorize(frame["term"], sort=True)
    names, places = np.unique(frame["name_no"].to_numpy(np.int64), return_inverse=True)
    order = np.lexsort((places, codes))
    weights = frame["weight"].to_numpy(np.float64)[order]
    starts = np.searchsorted(codes[order], np.arange(len(terms) + 1)).astype(np.int64)
    most = np.maximum.reduceat(weights, starts[:-1])
    row = [list(terms), starts.tobytes(), places[order].astype(np.int32).tobytes(), weights.tobytes(), most.tobytes(), names.tobytes()]
    return pd.DataFrame([row], columns=[c.split()[0] for c in NAME_BLOCK.split(", ")])


def name_blocks(postings: DataFrame, cells: int = BLOCK_CELLS) -> DataFrame:
    """`postings` (name_no, term, weight), stored, as numbered blocks of names whose numbers of terms differ by a factor
    of less than two, so that a block's largest weights are near to what its names have."""
    sizes = postings.groupBy("name_no").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("name_no", "n", F.floor(F.log2("n")).cast("long").alias("length"))
    sizes = runtime.pack(sizes, "name-sizes")
    totals = sizes.groupBy("length").agg(F.sum("n").alias("cells"), F.count(F.lit(1)).alias("names"))
    splits = [(r["length"], -(-max(r["cells"] * BLOCK_NAMES, r["names"] * cells) // (cells * BLOCK_NAMES))) for r in totals.collect()]
    first = [sum(n for _, n in splits[:i]) for i in range(len(splits))]
    dealt = [(length, n, at) for (length, n), at in zip(splits, first)]
    dealt = F.broadcast(postings.sparkSession.createDataFrame(dealt, "length long, splits long, first long"))
    block = (F.col("first") + F.pmod("name_no", "splits")).alias("block")
    blocks = sizes.join(dealt, "length").select("name_no", block)
    tasks = max(1, min(sum(n for _, n in splits), runtime.tasks_of(postings.sparkSession)))
    rows = postings.select("name_no", "term", "weight").join(blocks, "name_no").repartition(tasks, "block")

    def pack(key: tuple[pa.Scalar, ...], postings: pa.Table) -> pa.Table:
        frame = pack_names(postings.to_pandas(strings_to_categorical=True))  # a term is one string, not one for each posting
        return pa.Table.from_pandas(frame.assign(block=key[0].as_py()), preserve_index=False)

    return runtime.pack(rows.groupBy("block").applyInArrow(pack, f"{NAME_BLOCK}, block long"), "name-blocks")


def pack_bags(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """(bag_no, shared, least) to blocks; terms are numbered within a block."""
    columns = [c.split()[0] for c in BAG_BLOCK.split(", ")]
    for frame in frames:
        for start in range(0, len(frame), rows):
            part = frame.iloc[start : start + rows]
            number: dict[str, int] = {}
            codes, raws, sizes = [], [], []
            for shared in part["shared"]:
                sizes.append(len(shared))
                for word in shared:
                    codes.append(number.setdefault(word["term"], len(number)))
                    raws.append(word["raw"])
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            bags = part["bag_no"].to_numpy(np.int64)
            row = [int(bags[0]), bags.tobytes(), list(number), starts.tobytes(), np.array(codes, np.int32).tobytes(),
                   np.array(raws, np.float64).tobytes(), part["least"].to_numpy(np.float64).tobytes()]
            yield pd.DataFrame([row], columns=columns)


def kth_best(totals: np.ndarray, k: int) -> float:
    if len(totals) < k:
        return 0.0
    return totals.max() if k == 1 else np.partition(totals, len(totals) - k)[len(totals) - k]


def names_of(sums: np.ndarray, reach: float) -> np.ndarray:
    """The places of names that have a word and reach `reach`."""
    return np.flatnonzero(sums >= reach if reach > 0 else sums > 0)


class Bag:
    """A bag's words in one block, from the largest bound to the smallest: rest[i] bounds what word i and those after it bring."""

    def __init__(self, block: NameBlock, terms: np.ndarray, raws: np.ndarray, sizes: np.ndarray, lists: list[slice], rest: np.ndarray):
        self.block, self.terms, self.raws, self.sizes, self.lists, self.rest = block, terms, raws, sizes, lists, rest

    def sums(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        return self.block.sums(self.lists[begin:end], self.raws[begin:end], self.sizes[begin:end])

    def whole(self, least: float, k: int | None) -> tuple[np.ndarray, np.ndarray]:
        """`reaching` for one bag, with all sums."""
        sums = self.sums()
        if k:
            least = max(least, kth_best(sums, k))
        place = names_of(sums, least - SLACK)
        return place, sums[place]

    def reached(self, least: float, k: int | None) -> tuple[np.ndarray, np.ndarray]:
        """`reaching` for one bag, with what bounds leave of the sums."""
        at, end, step, rest = 0, len(self.terms), 8, self.rest
        sums = np.zeros(len(self.block.names))
        while at < end and rest[at] >= least - SLACK:
            # all words without which a new name may reach the least that is known, or some to learn of one
            to = np.searchsorted(-rest[:end], SLACK - least, side="right") if least > 0 else min(at + step, end)
            sums += self.sums(at, to)
            at, step = to, step * 2
            if k:
                least = max(least, kth_best(sums, k))
        # no new names from here on; what is left is looked up for those that can still count, or added where these are many
        place = names_of(sums, least - rest[at] - SLACK)
        if at < end and LOOK_UPS * len(place) * (end - at) > self.sizes[at:].sum():
            sums += self.sums(at)
            at = end
            if k:
                least = max(least, kth_best(sums, k))
            place = names_of(sums, least - rest[at] - SLACK)
        totals = sums[place]
        while at < end and len(place):
            to = min(at + 8, end)
            totals += self.block.look_up(self.terms[at:to], self.raws[at:to], place)
            at = to
            if k:
                least = max(least, kth_best(totals, k))
            stays = totals >= least - rest[at] - SLACK
            place, totals = place[stays], totals[stays]
        return place, totals


def reaching(
    block: NameBlock, bags: np.ndarray, terms: np.ndarray, raws: np.ndarray, least: np.ndarray, k: int | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bag, place, total): for every bag the names with a total of at least `least`, or the k best of them. Words are
    given by bag, in order."""
    bound = raws * block.most[terms]
    order = np.lexsort((-bound, bags))
    bags, terms, raws = bags[order], terms[order], raws[order]
    upto = np.concatenate([[0.0], np.cumsum(bound[order])])
    edges = np.searchsorted(bags, np.arange(len(least) + 1))
    rest = upto[edges[1:]] - upto[edges[:-1]]
    starts, ends = block.starts[terms], block.starts[terms + 1]
    lists, sizes = [slice(*x) for x in zip(starts.tolist(), ends.tolist())], ends - starts
    found = []
    for n, i in enumerate(np.flatnonzero((edges[:-1] < edges[1:]) & (rest >= least - SLACK)).tolist()):
        begin, end = edges[i], edges[i + 1]
        bag = Bag(block, terms[begin:end], raws[begin:end], sizes[begin:end], lists[begin:end], upto[end] - upto[begin : end + 1])
        # where words are about as frequent bounds spare little, and steps cost more than that: all postings are added at once
        if n % TRIED_BAGS == 0 or block.spared > SPARED * block.tried:
            before, whole = block.added, int(bag.sizes.sum())
            place, totals = bag.reached(least[i], k)
            block.tried += whole
            block.spared += whole - (block.added - before)
        else:
            place, totals = bag.whole(least[i], k)
        if k and len(place) > k:
            first = np.lexsort((place, -np.floor(totals * DECIMALS + 0.5)))[:k]
            place, totals = place[first], totals[first]
        if len(place):
            found.append((i, place, totals))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    numbers, places, totals = zip(*found)
    return np.repeat(numbers, [len(x) for x in places]), np.concatenate(places), np.concatenate(totals)


def passes(block: NameBlock, edges: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of bags (words of bag i: edges[i] to edges[i + 1]) whose sums and postings have at most PASS_CELLS
    places together, or a single bag."""
    postings = np.concatenate([[0], np.cumsum(block.starts[terms + 1] - block.starts[terms])])
    cost = np.cumsum(postings[edges[1:]] - postings[edges[:-1]] + len(block.names))
    begin = 0
    while begin < len(cost):
        spent = cost[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(cost, spent + PASS_CELLS, side="right")))
        yield begin, end
        begin = end


class BagBlock:
    """Bags of a block, and the k best totals of each so far."""

    def __init__(self, row, k: int | None):
        self.numbers, starts = np.frombuffer(row.bags, np.int64), np.frombuffer(row.bag_starts, np.int64)
        self.codes, self.raws = np.frombuffer(row.codes, np.int32), np.frombuffer(row.raws, np.float64)
        self.least, self.terms, self.k = np.frombuffer(row.least, np.float64), row.bag_terms, k
        self.bags = np.repeat(np.arange(len(self.numbers)), np.diff(starts))
        self.best = np.zeros((len(self.numbers), k or 0))

    def meet(self, block: NameBlock) -> Iterator[pd.DataFrame]:
        terms = np.array([block.number.get(t, -1) for t in self.terms], np.int64)[self.codes]
        known = terms >= 0
        bags, terms, raws = self.bags[known], terms[known], self.raws[known]
        edges = np.searchsorted(bags, np.arange(len(self.numbers) + 1))
        least = np.maximum(self.least, self.best[:, 0]) if self.k else self.least
        for begin, end in passes(block, edges, terms):
            part = slice(edges[begin], edges[end])
            bag, place, totals = reaching(block, bags[part] - begin, terms[part], raws[part], least[begin:end], self.k)
            if self.k:
                held = np.zeros((end - begin, self.k))
                held[bag, np.arange(len(bag)) - np.searchsorted(bag, bag)] = totals
                both = np.concatenate([self.best[begin:end], held], axis=1)
                self.best[begin:end] = np.sort(both, axis=1)[:, -self.k :]
            rank = np.floor(totals * DECIMALS + 0.5) / DECIMALS
            yield pd.DataFrame({"bag_no": self.numbers[begin + bag], "name_no": block.names[place], "total": totals, "rank_by": rank})


def meet_blocks(frames: Iterator[pd.DataFrame], k: int | None) -> Iterator[pd.DataFrame]:
    """Cells to (bag_no, name_no, total, rank_by). A cell's blocks of bags come first and are held; its blocks of names
    pass one after another. The k-th best totals so far are the least that counts."""
    cell, held = None, []
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.cell != cell:
                cell, held = row.cell, []
            if row.kind == 0:
                held.append(BagBlock(row, k))
            elif held:
                block = NameBlock(row)
                for bags in held:
                    yield from bags.meet(block)


def scores(bags: DataFrame, blocks: DataFrame, k: int | None, bag_rows: int = BAG_ROWS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(bag_no, name_no, total, rank_by) of `bags` (bag_no, shared, least) and a catalog's blocks: all that reach
    `least`, or a superset of each bag's k best.

    Chunks of bags and groups of blocks of names meet in the cells of a grid, each sent to one task as single
    blocks. There are as few chunks as their size allows, since each gets a copy of all names, and as many groups as
    it takes to have enough tasks; a catalog of few blocks is met by more chunks instead.
    """
    spark = bags.sparkSession
    n_bags, words = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("shared")), F.lit(0))).first()
    n_blocks, tasks = max(1, blocks.count()), runtime.tasks_of(spark)
    chunks = max(1, -(-words // chunk_words), min(-(-tasks // n_blocks), -(-n_bags // bag_rows)))
    groups = -(-tasks // chunks)
    groups = n_blocks if n_blocks < 2 * groups else groups  # not two blocks in some cells and one in others
    packed = bags.select("bag_no", "shared", "least").mapInPandas(lambda f: pack_bags(f, bag_rows), BAG_BLOCK)
    # blocks are dealt out in turn where they are packed, each task beginning at another chunk: bags are shuffled once
    turn = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.spark_partition_id().cast("long") * chunks / max(1, bags.rdd.getNumPartitions())
    packed = packed.withColumn("chunk", F.pmod(turn + F.floor(first), F.lit(chunks)).cast("int"))
    packed = runtime.pack(packed, "bag-blocks")
    dealt = blocks.withColumn("group", F.pmod("block", F.lit(groups)).cast("int")).drop("block")
    group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    rows = packed.select("*", group, F.lit(0).alias("kind")).unionByName(
        dealt.select("*", chunk, F.lit(1).alias("kind")), allowMissingColumns=True
    )
    cells = rows.withColumn("cell", F.col("chunk") * groups + F.col("group")).drop("chunk", "group")
    cells = cells.repartitionById(chunks * groups, "cell").sortWithinPartitions("cell", "kind")
    return cells.mapInPandas(lambda frames: meet_blocks(frames, k), "bag_no long, name_no long, total double, rank_by double")
