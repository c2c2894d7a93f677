"""Row and column work on posts, products and reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from feedlark import runtime, schemas
from feedlark.functions import text as T


def rename_by_position(df: DataFrame, names: list[str], label: str = "source") -> DataFrame:
    if len(df.columns) != len(names):
        raise ValueError(f"{label} has {len(df.columns)} columns, not {len(names)}: {df.columns}")
    return df.toDF(*names)


def merge_reviews(sources: dict[str, DataFrame]) -> DataFrame:
    """All review sources as one table; columns are aligned by position, `platform` is the key."""
    names = schemas.names(schemas.REVIEWS)
    parts = [
        rename_by_position(df.withColumn("platform", F.lit(platform)), names, platform)
        for platform, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in `order`. An aggregate, so a key of many rows is thinned out
    before the shuffle."""
    rest = [c for c in df.columns if c not in key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("r")
    return df.groupBy(*key).agg(first).select(*[c if c in key else f"r.{c}" for c in df.columns])


def normalise_strings(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Normalise every string column; other types are left alone."""
    return df.select(
        *[
            T.normalise_name(f.name).alias(f.name)
            if isinstance(f.dataType, StringType) and f.name not in skip
            else F.col(f.name)
            for f in df.schema
        ]
    )


def social_posts(items: DataFrame) -> DataFrame:
    """(id, texts) -> (id, text): the comments of an id as one text, blank ones dropped."""
    posts = items.select("id", T.join_texts("texts").alias("text"))
    return drop_blank(posts, "text")


def unpivot_ids(df: DataFrame) -> DataFrame:
    """A table with one column per id -> (id, texts); for wide tables that were written that way."""
    return df.unpivot([], df.columns, "id", "texts")


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~T.is_blank(column))


def explode_comments(items: DataFrame) -> DataFrame:
    """One row per comment: id, pos, original_text and the text without tags."""
    rows = items.select("id", F.posexplode("texts").alias("pos", "original_text"))
    return rows.withColumn("cleaned_text", T.strip(T.strip_html("original_text")))


def group_comments(comments: DataFrame, chunk_rows: int = 1_000) -> DataFrame:
    """(id, pos, text) -> (id, chunk, texts): comments in order, at most `chunk_rows` in a list.

    `pos` orders the comments of an id; it may be sparse, repeat or be null (nulls come first). Lists are
    cut by the place in that order, so no id becomes one row, whatever its share of all comments is and
    whatever `pos` holds. Null texts are kept; rows without an id are a group of their own.
    """
    rows = place_within(comments.select("id", "pos", "text"), "id", "pos", F.xxhash64("text"), name="place")
    chunk = F.floor((F.col("place") - 1) / chunk_rows).alias("chunk")
    lists = rows.groupBy("id", chunk).agg(
        F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("items")
    )
    return lists.select("id", "chunk", F.col("items.text").alias("texts"))


def valid_products(df: DataFrame) -> DataFrame:
    """Products that have an id and a name left after cleaning."""
    return df.filter("clean_name != '' AND product_id IS NOT NULL AND cast(product_id AS string) != ''")


def valid_posts(df: DataFrame) -> DataFrame:
    return df.filter("clean_text != ''")


def clean_reviews(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "clean_product_name": T.clean_text("product_name", "review"),
            "clean_text_review": T.clean_text("review_text", "review"),
        }
    )


def keyword_search(df: DataFrame, term: str, raw: str, cleaned: str, show_cleaned: bool = False,
                   regex: bool = True) -> DataFrame:
    """Rows whose tag-free text matches `term` in any case; `shown` is the raw or the tag-free text."""
    hay = F.lower(cleaned)
    hit = hay.rlike(term.lower()) if regex else hay.contains(term.lower())
    return df.filter(hit).withColumn("shown", F.when(F.lit(show_cleaned), F.col(cleaned)).otherwise(F.col(raw)))


def sample_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first `n` rows in a given order: the row budget of a scoring run, or one page of a view."""
    return df.orderBy(*order).limit(n)


def _in_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """`df` in ranges of `keys` and a column _tie, stored with the number of the range as _part.

    The tie-breaker makes the sort keys unique, so equal rows spread over ranges too.
    """
    rows = runtime.materialise(df.withColumn("_tie", F.monotonically_increasing_id()), "rows")
    parts = rows.sparkSession.sparkContext.defaultParallelism
    wanted = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts)
    ranged = rows.repartitionByRange(wanted, *keys, "_tie").withColumn("_part", F.spark_partition_id())
    return runtime.materialise(ranged, "ranged")


def number_rows(df: DataFrame, *order: str, name: str = "review_id") -> DataFrame:
    """Number all rows from 1 in a given order without sorting them in one task.

    Range partitions are numbered apart and shifted by the sizes of those before them.
    """
    ranged = _in_ranges(df, [*order])
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_tie"))
    ranged = ranged.withColumn(name, place).join(F.broadcast(shift), "_part")
    return ranged.withColumn(name, F.col(name) + F.col("_before")).select(name, *df.columns)


def place_within(df: DataFrame, key: str, *order: Column | str, name: str = "place") -> DataFrame:
    """Add each row's place, from 1, among the rows of its key. No task gets all rows of a key.

    All rows are put into ranges of (key, order). Places are counted within a range, and shifted by the
    key's rows in the ranges before: one number for each key and range, joined by both. Rows of a null key
    are numbered like those of any other.
    """
    sorts = [f"_by{i}" for i in range(len(order))]
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = _in_ranges(df.withColumns(dict(zip(sorts, by))), [key, *sorts])
    sizes = ranged.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    # a key has no more sizes than there are ranges; only keys that reach over several are joined
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.withColumn("_before", F.sum("_rows").over(before)).filter("_before > 0")
    shift = shift.select(F.col(key).alias("_key"), F.col("_part").alias("_in"), "_before")
    place = F.row_number().over(Window.partitionBy("_part", key).orderBy(*sorts, "_tie"))
    found = ranged.withColumn("_place", place).join(
        shift, (F.col("_part") == F.col("_in")) & F.col(key).eqNullSafe(F.col("_key")), "left"
    )
    return found.select(*df.columns, (F.col("_place") + F.coalesce("_before", F.lit(0))).alias(name))


def quality_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows, and rows with and without a value left in `column`."""
    empty = F.coalesce(F.col(column) == "", F.lit(True))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(empty).alias("empty_rows"),
        F.count_if(~empty).alias("filled_rows"),
    )


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Rows that satisfy each stage's condition, all counted in one pass: stage, row_count."""
    counts = df.agg(*[F.count_if(c).alias(s) for s, c in stages.items()])
    return counts.unpivot([], list(stages), "stage", "row_count")
