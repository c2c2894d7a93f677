"""Which product does a post mention: TF-IDF weights and cosine top-k as joins and aggregates.

The order of products for a post depends only on the words that the post shares with the catalog,
so the work is done once per distinct text and once per distinct bag of shared words:

    posts -> distinct texts -> bags of shared words -> best names per bag
          <----------------- joined back by key ----<

Bags and names meet in blocks, and products are summed with upper bounds (`operators.bounds`): a name that cannot
be among the best, or reach a threshold, is left out as soon as that is known.
Weights follow the usual smooth form: idf = ln((1+N)/(1+df)) + 1, weight = tf * idf, L2 norm.
Names are ranked by their dot product with the unnormalised post, rounded to 6 decimals, then by
lowest product id.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.functions.text import text_key
from feedlark.operators import bounds
from feedlark.operators.tables import number_rows
from feedlark.operators.texts import attach, distinct_texts, text_words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_FEATURES = 10_000
BROADCAST_TERMS = 100_000  # the largest vocabulary that is sent to every executor
WEIGH_ROWS = 2_000  # texts that are weighed at a time


def term_stats(*sides: DataFrame) -> DataFrame:
    """Document frequency and corpus frequency of every term over all sides: term, df, ctf."""
    words = text_words(sides[0]).select("copies", "term", "tf")
    for side in sides[1:]:
        words = words.unionByName(text_words(side).select("copies", "term", "tf"))
    return words.groupBy("term").agg(
        F.sum("copies").alias("df"), F.sum(F.col("copies") * F.col("tf")).alias("ctf")
    )


def document_count(*sides: DataFrame) -> int:
    counted = sides[0].filter("counted").select("copies")
    for side in sides[1:]:
        counted = counted.unionByName(side.filter("counted").select("copies"))
    return counted.agg(F.sum("copies")).first()[0] or 0


def vocabulary(stats: DataFrame, n_docs: int, max_features: int | None = MAX_FEATURES) -> DataFrame:
    """The `max_features` terms of highest corpus frequency (ties: term ascending), with idf."""
    if max_features is not None:
        stats = stats.orderBy(F.desc("ctf"), "term").limit(max_features)
    return stats.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0)


def with_idf(words: DataFrame, terms: DataFrame) -> DataFrame:
    """Join words and a vocabulary without a size limit: a shuffle join in which the most frequent terms are broadcast."""
    return runtime.hot_key_join(words, terms, "term", "df", how="inner")


def _weighed(batch: pa.RecordBatch, vocab: pa.Table) -> pa.RecordBatch:
    n, bag = batch.num_rows, batch.column("bag")
    sizes = pc.fill_null(pc.list_value_length(bag), 0).to_numpy(zero_copy_only=False)
    words, terms = bag.flatten(), vocab["term"].combine_chunks()
    at = pc.index_in(words.field("term"), value_set=terms)
    known = at.is_valid().to_numpy(zero_copy_only=False)
    at = at.drop_null().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(n), sizes)[known]
    raw = words.field("tf").to_numpy(zero_copy_only=False)[known] * vocab["idf"].to_numpy()[at]
    norm = np.sqrt(np.bincount(rows, raw * raw, minlength=n))
    kept = vocab["kept"].to_numpy()[at]
    shared = pa.StructArray.from_arrays([terms.take(pa.array(at[kept])), pa.array(raw[kept])], ["term", "raw"])
    starts = pa.array(np.searchsorted(rows[kept], np.arange(n + 1)).astype(np.int32))
    columns = [batch.column("text_key"), batch.column("copies"), pa.array(norm, pa.float64()), pa.ListArray.from_arrays(starts, shared)]
    return pa.RecordBatch.from_arrays(columns, ["text_key", "copies", "norm", "shared"])


def weighed_bags(texts: DataFrame, vocab: DataFrame, kept: Column) -> DataFrame:
    """(text_key, copies, norm, shared): the norm over all words of the vocabulary, which is small and sent to every task,
    and those that are `kept`, by term. A text's words lie in one row and stay there."""
    terms = vocab.select("term", "idf", kept.alias("kept")).toArrow()
    sent = texts.sparkSession.sparkContext.broadcast(terms)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, WEIGH_ROWS):
                yield _weighed(batch.slice(i, WEIGH_ROWS), sent.value)

    schema = "text_key binary, copies long, norm double, shared array<struct<term: string, raw: double>>"
    return texts.select("text_key", "copies", "bag").mapInArrow(weigh, schema).filter(F.size("shared") > 0)


def tfidf_weights(texts: DataFrame, vocab: DataFrame, bounded: bool = True) -> DataFrame:
    """(text_key, term, norm, weight): tf * idf over the norm of the text."""
    if bounded:
        words = weighed_bags(texts, vocab, F.lit(True)).select("text_key", "norm", F.inline("shared"))
        return words.select("text_key", "term", "norm", (F.col("raw") / F.col("norm")).alias("weight"))
    words = with_idf(text_words(texts), vocab.select("term", "idf", "df"))
    raw = F.col("tf") * F.col("idf")
    # the rows of a text lie together, so partial aggregation leaves one row per text to shuffle
    bags = words.groupBy("text_key").agg(
        F.sqrt(F.sum(raw * raw)).alias("norm"), F.collect_list(F.struct("term", raw.alias("raw"))).alias("bag")
    )
    words = bags.select("text_key", "norm", F.inline("bag"))
    return words.select("text_key", "term", "norm", (F.col("raw") / F.col("norm")).alias("weight"))


@dataclass
class Catalog:
    """What scoring needs from the products, stored once; every table is small next to the posts."""

    blocks: DataFrame  # postings of the names by blocks; names are numbered by lowest product id
    ids: DataFrame  # name_no, name_key, product_id, product_name: the k lowest ids per name
    vocab: DataFrame  # term, idf, df, named (does a name have the term?)
    k: int = 1
    bounded: bool = True  # has the vocabulary a size limit, so that it may be broadcast


def fit_catalog(
    posts: DataFrame,
    products: DataFrame,
    post_text: str = "clean_text",
    product_id: str = "product_id",
    product_name: str = "clean_name",
    k: int = 1,
    max_features: int | None = MAX_FEATURES,
    block_cells: int = bounds.BLOCK_CELLS,
    with_names: bool = True,
    **tokenising,
) -> tuple[Catalog, DataFrame]:
    """Vocabulary and weights fitted over both sides: the catalog, and the distinct post texts. Without `with_names` the
    names of matches are null, so that long ones do not go through the joins."""
    first = F.min(product_id).alias("first_id")
    texts = distinct_texts(posts, post_text, **tokenising)
    names = distinct_texts(products, product_name, first, **tokenising)
    vocab = vocabulary(term_stats(texts, names), document_count(texts, names), max_features)
    vocab = runtime.pack(vocab.select("term", "idf", "df"), "vocab")
    bounded = max_features is not None and max_features <= BROADCAST_TERMS

    weights = tfidf_weights(names, vocab, bounded)
    numbered = number_rows(names.select("first_id", F.col("text_key").alias("name_key")), "first_id", "name_key", name="name_no")
    numbered = runtime.pack(numbered.select(F.col("name_no").cast("long"), "name_key"), "names")
    postings = weights.join(numbered, weights["text_key"] == numbered["name_key"]).select("term", "name_no", "weight")
    postings = runtime.pack(postings, "postings")
    named = postings.select("term", F.lit(True).alias("named")).distinct()
    vocab = vocab.join(named, "term", "left").withColumn("named", F.coalesce("named", F.lit(False)))
    vocab = runtime.pack(vocab, "vocab")
    if k == 1:
        ids = names.select(
            F.col("text_key").alias("name_key"),
            F.col("first_id").alias("product_id"),
            F.col("text").alias("product_name"),
        )
    else:
        # names of equal text score alike, so only their k lowest ids can be reported; the limit
        # is applied before the shuffle too, which keeps a name with many products harmless
        order = Window.partitionBy("product_name").orderBy("product_id")
        ids = products.select(
            F.col(product_id).alias("product_id"), F.col(product_name).alias("product_name")
        )
        ids = ids.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
        ids = ids.select(text_key("product_name").alias("name_key"), "product_id", "product_name")
    if not with_names:
        ids = ids.withColumn("product_name", F.lit(None).cast("string"))
    ids = runtime.pack(ids.join(numbered, "name_key"), "ids")
    return Catalog(bounds.name_blocks(postings, block_cells), ids, vocab, k, bounded), texts


def shared_words(texts: DataFrame, catalog: Catalog) -> DataFrame:
    """(text_key, copies, norm, shared): the words a text shares with the catalog."""
    if catalog.bounded:
        return weighed_bags(texts, catalog.vocab, F.col("named"))
    raw = F.col("tf") * F.col("idf")
    words = with_idf(text_words(texts), catalog.vocab)
    # the rows of a text lie together, so partial aggregation leaves one row per text to shuffle
    word = F.when(F.col("named"), F.struct("term", raw.alias("raw")))
    words = words.groupBy("text_key", "copies").agg(
        F.sqrt(F.sum(raw * raw)).alias("norm"), F.sort_array(F.collect_list(word)).alias("shared")
    )
    return words.filter(F.size("shared") > 0)


def overlap_scores(
    bags: DataFrame, catalog: Catalog, keep: tuple[str, ...] = (), least: Column | None = None, k: int | None = None, **limits
) -> tuple[DataFrame, DataFrame]:
    """Bags with their bag_no, and (bag_no, name_no, total, rank_by): the names whose dot product with the bag is at
    least `least`, or those among which are its k best. Names that cannot be among these are not summed."""
    bags = bags.select("bag_key", *keep, "shared", (F.lit(0.0) if least is None else least).alias("least"))
    bags = runtime.pack(bags.withColumn("bag_no", F.monotonically_increasing_id()), "bags")
    return bags, bounds.scores(bags, catalog.blocks, k, **limits)


def best_names(bags: DataFrame, catalog: Catalog, keep: tuple[str, ...] = (), **limits) -> DataFrame:
    """The k best names of each bag: bag_key, *keep, name_no, rank_by (rounded total; ties go to the lowest product
    id, which has the lowest number), total."""
    bags, scores = overlap_scores(bags, catalog, k=catalog.k, keep=keep, **limits)
    scores = scores.filter("rank_by > 0")
    if catalog.k == 1:  # an aggregate leaves one row per bag before the shuffle already
        best = F.min(F.struct((-F.col("rank_by")).alias("minus"), "name_no", "total"))
        best = scores.groupBy("bag_no").agg(best.alias("b"))
        best = best.select("bag_no", "b.name_no", (-F.col("b.minus")).alias("rank_by"), "b.total")
    else:
        order = Window.partitionBy("bag_no").orderBy(F.desc("rank_by"), "name_no")
        best = scores.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= catalog.k)
    best = best.join(bags.select("bag_no", "bag_key", *keep), "bag_no")
    return best.select("bag_key", *keep, "name_no", "rank_by", "total")


def map_texts(
    texts: DataFrame,
    catalog: Catalog,
    hot_rows: int = runtime.HOT_ROWS,
    **limits,
) -> DataFrame:
    """(text_key, copies, matches): the k best products of each distinct text, best first."""
    bag = F.transform("shared", lambda w: F.concat_ws(":", w["term"], w["raw"]))
    words = shared_words(texts, catalog).withColumn("bag_key", text_key(F.array_join(bag, " ")))
    words = runtime.pack(words, "words")
    bags = words.groupBy("bag_key", "shared").agg(F.count(F.lit(1)).alias("texts"))

    best = best_names(bags, catalog, ("texts",), **limits)
    best = runtime.pack(best, "ranked").join(catalog.ids, "name_no")
    match = F.struct((-F.col("rank_by")).alias("minus"), "product_id", "product_name", "total")
    best = best.groupBy("bag_key", "texts").agg(  # at most k * k entries
        F.slice(F.sort_array(F.collect_list(match)), 1, catalog.k).alias("matches")
    )
    best = runtime.pack(best, "best")
    texts = words.select("text_key", "copies", "norm", "bag_key")
    found = runtime.hot_key_join(texts, best, "bag_key", "texts", hot_rows)
    score = lambda m: F.round(m["total"] / F.col("norm"), 6)
    return found.select(
        "text_key",
        "copies",
        F.transform(
            "matches",
            lambda m: F.struct(
                m["product_id"].alias("product_id"),
                m["product_name"].alias("product_name"),
                score(m).alias("similarity_score"),
            ),
        ).alias("matches"),
    )


def attach_matches(
    posts: DataFrame, mapped: DataFrame, text: str, min_score: float = 0.0, hot_rows: int = runtime.HOT_ROWS, key: str | None = None
) -> DataFrame:
    """One row per post and match, best first; a post without a match keeps a row with nulls and 0. `key` as in `attach`."""
    keyed = attach(posts, text, mapped, hot_rows, key)
    good = F.filter("matches", lambda m: m["similarity_score"] >= min_score)
    return keyed.select(*posts.columns, F.posexplode_outer(good).alias("pos", "m")).select(
        *posts.columns,
        F.coalesce(F.col("pos") + 1, F.lit(1)).alias("place"),
        "m.product_id",
        "m.product_name",
        F.coalesce("m.similarity_score", F.lit(0.0)).alias("similarity_score"),
    )


def map_mentions(
    posts: DataFrame,
    products: DataFrame,
    post_text: str = "clean_text",
    product_id: str = "product_id",
    product_name: str = "clean_name",
    k: int = 1,
    max_features: int | None = MAX_FEATURES,
    min_score: float = 0.0,
    tokenising: dict | None = None,
    hot_rows: int = runtime.HOT_ROWS,
    block_cells: int = bounds.BLOCK_CELLS,
    onto: tuple[DataFrame, str] | None = None,
    with_names: bool = True,
    **limits,
) -> DataFrame:
    """The k products each post resembles most, as rows: the post, place, product, score.

    Posts are read twice, so pass a stored table and not a long computation. `onto` names rows that get the products
    in place of the posts, and their column with the key of the post's text. `with_names` as in `fit_catalog`.
    """
    catalog, texts = fit_catalog(
        posts, products, post_text, product_id, product_name, k, max_features, block_cells, with_names, **(tokenising or {})
    )
    mapped = map_texts(texts, catalog, hot_rows, **limits)
    rows, key = onto or (posts, None)
    return attach_matches(rows, mapped, post_text, min_score, hot_rows, key)


def similar_pairs(texts: DataFrame, catalog: Catalog, min_score: float, **limits) -> DataFrame:
    """(text_key, name_key, similarity_score) of every distinct text and name that score at least
    `min_score`, which must be above 0."""
    if min_score <= 0:
        raise ValueError("min_score must be above 0")
    bags = runtime.pack(shared_words(texts, catalog).withColumnRenamed("text_key", "bag_key"), "words")
    least = (F.lit(min_score) - 1e-6) * F.col("norm")
    bags, scores = overlap_scores(bags, catalog, ("norm",), least, **limits)
    scores = scores.join(bags.select("bag_no", "bag_key", "norm"), "bag_no").select(
        F.col("bag_key").alias("text_key"),
        "name_no",
        F.round(F.col("total") / F.col("norm"), 6).alias("similarity_score"),
    )
    scores = scores.filter(F.col("similarity_score") >= min_score)
    names = catalog.ids.select("name_no", "name_key").distinct()
    return scores.join(names, "name_no").select("text_key", "name_key", "similarity_score")
