"""Shards in the order of a Hilbert curve, so that files can be skipped on several columns at once.

Every dimension is quantised by its own quantiles, rows are sorted by the index of their cell on the
curve, and the sorted sequence is cut into runs of equal numbers of rows. Neighbours on the curve are
neighbours in every dimension, so a run spans a small box, and a reader that looks for a box skips
the shards whose bounds lie outside.

Defined results: nulls of a dimension form its first cell; ties are ordered by the columns named in
`ties` and then as Spark finds them; repeated rows are rows of their own; an empty table gives no
shards. All columns of the input are kept, but for those named like an added one.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import shield, unshield

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

ACCURACY = 10_000  # of the quantiles: the rank of a bound is off by at most rows / ACCURACY


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of cells (rows x dimensions, each 0 to 2**bits - 1).

    Skilling, "Programming the Hilbert curve" (2004), for all rows at once: undo the rotations from
    the coarsest level down, apply the Gray code, and interleave the bits.
    """
    x = [np.array(axis, dtype=np.int64) for axis in np.asarray(cells).T]
    level = 1 << (bits - 1)
    while level > 1:
        for i in range(len(x)):
            inverted = (x[i] & level) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & (level - 1))
            x[0] ^= np.where(inverted, level - 1, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[-1] & level, level - 1, 0)
        level >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> b) & 1)
    return index


def text_rank(column: Column) -> Column:
    """The first 7 bytes of a string as a number: quantiles need only its order."""
    digits = F.substring(F.rpad(F.hex(column.cast("string")), 14, "0"), 1, 14)
    return F.conv(digits, 16, 10).cast("long")


def quantile_bounds(df: DataFrame, dimensions: dict[str, Column], bits: int) -> list[list[float]]:
    """2**bits - 1 bounds for each dimension: all rows are read, and this is all that comes back."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(
        *(F.percentile_approx(c.cast("double"), shares, ACCURACY).alias(n) for n, c in dimensions.items())
    ).first()
    return [list(found[n] or []) for n in dimensions]


def curve_index(dimensions: list[Column], bounds: list[list[float]], bits: int) -> Column:
    """A cell is the number of bounds below the value, so equal values share a cell."""

    @F.pandas_udf("long")
    def index(columns: pd.DataFrame) -> pd.Series:
        cells = np.zeros((len(columns), len(bounds)), dtype=np.int64)
        for i, limits in enumerate(bounds):
            values = columns.iloc[:, i].to_numpy(dtype=float, na_value=np.nan)
            known = ~np.isnan(values)
            cells[known, i] = np.searchsorted(np.array(limits), values[known], side="left")
        return pd.Series(hilbert_index(cells, bits))

    return index(F.struct(*(c.cast("double").alias(f"d{i}") for i, c in enumerate(dimensions))))


def hilbert_shards(
    df: DataFrame, dimensions: dict[str, Column], shards: int, bits: int = 5, ties: tuple[str, ...] = ()
) -> DataFrame:
    """`df` with curve (index), shard (0 to `shards` - 1) and slot (place in the shard, from 0).

    Shards differ by one row at most. The rows are sorted once by ranges, which split the rows of a
    crowded cell by `ties`; a row's place is its place in its range plus the rows of the ranges
    before it, of which there are as many as partitions.
    """
    if bits * len(dimensions) > 62:
        raise ValueError("the index must fit into a long")
    df = df.withColumns({f"__d{i}": c for i, c in enumerate(dimensions.values())} | {f"__t{i}": F.col(c) for i, c in enumerate(ties)})
    dimensions = {f"__d{i}": F.col(f"__d{i}") for i in range(len(dimensions))}
    ties = tuple(f"__t{i}" for i in range(len(ties)))
    df, names = shield(df, *dimensions, *ties)
    bounds = quantile_bounds(df, dimensions, bits)
    indexed = df.withColumn("curve", curve_index(list(dimensions.values()), bounds, bits))
    ordered = indexed.repartitionByRange("curve", *ties).sortWithinPartitions("curve", *ties)
    stored = runtime.materialise(ordered.withColumn("place", F.monotonically_increasing_id()), "curve")
    stored = stored.withColumn("part", F.shiftright("place", 33))
    counts = sorted((r["part"], r["count"]) for r in stored.groupBy("part").count().collect())
    total, starts = 0, []
    for part, rows in counts:
        starts.append((part, total))
        total += rows
    small, larger = divmod(total, shards)
    begins = df.sparkSession.createDataFrame(starts, "part long, begins long")
    stored = stored.join(F.broadcast(begins), "part")  # a row per partition
    rank = F.col("begins") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    edge = larger * (small + 1)  # the first shards have a row more
    ranked = stored.withColumn("place", rank.cast("long"))
    if not small:
        shard, slot = F.col("place"), F.lit(0)
    else:
        late = F.col("place") - edge
        shard = F.when(late < 0, F.floor(F.col("place") / (small + 1))).otherwise(larger + F.floor(late / small))
        slot = F.when(late < 0, F.col("place") % (small + 1)).otherwise(late % small)
    told = ranked.select(*names.values(), "curve", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))
    return unshield(told, names)


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, its rows in curve order; a shard of any size is written by one task in
    order, so `shards` sets the size of the work."""
    ordered = assigned.repartitionByRange(F.col("shard")).sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)


def shard_bounds(assigned: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """(shard, n_rows, min_x and max_x of every dimension): what a reader needs for skipping."""
    edges = [f(c).alias(f"{f.__name__}_{n}") for n, c in dimensions.items() for f in (F.min, F.max)]
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *edges)


def shards_of_box(bounds: DataFrame, box: dict[str, tuple]) -> DataFrame:
    """The shards that may hold rows with low <= x <= high for every x of `box`."""
    hit = F.lit(True)
    for name, (low, high) in box.items():
        hit &= (F.col(f"max_{name}") >= low) & (F.col(f"min_{name}") <= high)
    return bounds.filter(hit).select("shard")
