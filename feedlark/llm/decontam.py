"""Benchmark decontamination with a positional inverted index of the training text.

The index has one posting (term, row, pos) for every training word that some benchmark item has; its
counts rank the terms. Of every window of 13 consecutive item words, the two rarest terms' posting
lists are intersected after shifting one by their distance. At the places that are left, the document
is compared with the item word by word, up to 12 words to either side: a run that holds a whole window
is a phrase match, and its words are hit. Neighbouring windows mostly have the same rarest terms, so
an occurrence gives a few candidates, not one for each window. A window with a term that no document
has is dropped at once.

Everything is an expression, join, aggregate or window of Spark. Benchmark tables are broadcast up to
a stated number of rows, and shuffled beyond. A row's hits meet in one task; there are no more than
its words times the items that match there.

Defined results: null and wordless texts have no words, no hits, and are not contaminated; wordless
items match nothing; repeated items of one id are items of their own that count as one id; repeated
documents are judged each; without documents or items there are no hits; a carried
column of the name of an added one is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import ascii_lower, pieces, shield, small, unshield

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what is not part of a word, in lower case (fixed value)
WINDOW = 13
SHARE = 20  # contaminated: one word of so many is hit
MOST_TERMS = 1_000_000  # rows of a benchmark table that is broadcast


def words_of(text: str) -> Column:
    return pieces(ascii_lower(F.coalesce(F.col(text), F.lit(""))), BETWEEN)


def store_words(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """(row, words, n_words, `carry`), stored: `row` numbers the rows from here on."""
    split = docs.select(*carry, words_of(text).alias("words"))
    numbered = split.select("*", F.size("words").cast("long").alias("n_words"), F.monotonically_increasing_id().alias("row"))
    return runtime.materialise(numbered, "words")


def store_items(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, item_key, item_words) of items that have words."""
    split = items.select(F.col(key).alias("item_key"), words_of(text).alias("item_words")).filter(F.size("item_words") > 0)
    return runtime.materialise(split.withColumn("item", F.monotonically_increasing_id()), "items")


def build_index(stored: DataFrame, items: DataFrame, most_terms: int = MOST_TERMS) -> DataFrame:
    """(term, row, pos): postings of the terms that items have, in the order of the documents."""
    terms = runtime.materialise(items.select(F.explode("item_words").alias("term")).distinct(), "terms")
    spread = stored.select("row", F.posexplode("words").alias("pos", "term"))
    return runtime.materialise(spread.join(small(terms, most_terms), "term"), "postings")


def rarest_pairs(index: DataFrame, items: DataFrame) -> DataFrame:
    """(item, p1, t1, t2, delta): of every window the two terms with the shortest lists."""
    counts = runtime.materialise(index.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "counts")
    ranked = items.select("item", F.posexplode("item_words").alias("pos", "term")).join(counts, "term", "left")
    entry = F.struct("pos", F.coalesce("n", F.lit(0)).alias("n"), "term")
    lists = ranked.groupBy("item").agg(F.sort_array(F.collect_list(entry)).alias("terms"))
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("terms") - WINDOW, F.lit(0)))).alias("start")
    windows = lists.select("item", "terms", start).select("item", F.slice("terms", F.col("start") + 1, F.lit(WINDOW)).alias("window"))
    by_count = F.sort_array(F.transform("window", lambda t: F.struct(t["n"].alias("n"), t["pos"].alias("pos"), t["term"].alias("term"))))
    first = windows.select("item", F.get(by_count, F.lit(0)).alias("a"), F.get(by_count, F.lit(1)).alias("b")).filter("a.n > 0")
    second = F.coalesce(F.col("b"), F.col("a"))
    pairs = first.select(
        "item",
        F.col("a.pos").alias("p1"),
        F.col("a.term").alias("t1"),
        second["term"].alias("t2"),
        (second["pos"] - F.col("a.pos")).alias("delta"),
    )
    return runtime.materialise(pairs.distinct(), "pairs")


def shifted_intersection(index: DataFrame, pairs: DataFrame, most_terms: int = MOST_TERMS) -> DataFrame:
    """(row, item, p1, pos): places where both terms of a pair stand at their distance."""
    ours = small(pairs, most_terms)
    first = index.join(ours, F.col("term") == F.col("t1")).select(
        "row", "item", "p1", "pos", "t2", (F.col("pos") + F.col("delta")).alias("pos2")
    )
    wanted = runtime.materialise(pairs.select("t2").distinct(), "second")
    second = index.join(small(wanted, most_terms), F.col("term") == F.col("t2")).select("t2", "row", F.col("pos").alias("pos2"))
    met = first.join(second, ["t2", "row", "pos2"])
    return runtime.materialise(met.select("row", "item", "p1", "pos").distinct(), "candidates")


def _extent(step: int) -> Column:
    """Equal words next to the anchor, in one direction, 12 at most."""

    def go(seen: Column, k: Column) -> Column:
        same = F.get("words", F.col("pos") + step * k) == F.get("item_words", F.col("p1") + step * k)
        on = seen["on"] & F.coalesce(same, F.lit(False))
        return F.struct(on.alias("on"), (seen["n"] + on.cast("int")).alias("n"))

    start = F.struct(F.lit(True).alias("on"), F.lit(0).alias("n"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WINDOW - 1)), start, go)["n"]


def phrase_matches(
    stored: DataFrame, items: DataFrame, found: DataFrame, most_terms: int = MOST_TERMS
) -> DataFrame:
    """(row, item_key, first, last, item_first): exact runs around an anchor that hold a whole window."""
    placed = stored.select("row", "words").join(small(found, most_terms), "row").join(small(items, most_terms), "item")
    grown = placed.withColumn("left", _extent(-1)).withColumn("right", _extent(1))
    whole = F.col("left") + F.col("right") + 1 >= F.least(F.lit(WINDOW), F.size("item_words"))
    runs = grown.filter(whole).select(
        "row",
        "item_key",
        (F.col("pos") - F.col("left")).alias("first"),
        (F.col("pos") + F.col("right")).alias("last"),
        (F.col("p1") - F.col("left")).alias("item_first"),
    )
    return runtime.materialise(runs, "matches")


def proximity_matches(index: DataFrame, items: DataFrame, within: int = WINDOW, most_terms: int = MOST_TERMS) -> DataFrame:
    """(row, item_key, p1, pos, distance): the two rarest terms of a window, in any order, at most
    `within` words apart. Positions are cut into blocks, and a posting looks into three of them."""
    pairs = rarest_pairs(index, items).filter("t1 <> t2").select("item", "p1", "t1", "t2").distinct()
    pairs = runtime.materialise(pairs, "near-pairs")
    first = index.join(small(pairs, most_terms), F.col("term") == F.col("t1"))
    block = F.floor(F.col("pos") / within)
    first = first.select("row", "item", "p1", "pos", "t2", F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    wanted = runtime.materialise(pairs.select("t2").distinct(), "second")
    second = index.join(small(wanted, most_terms), F.col("term") == F.col("t2"))
    second = second.select("t2", "row", block.alias("block"), F.col("pos").alias("pos2"))
    near = first.join(second, ["t2", "row", "block"]).withColumn("distance", F.abs(F.col("pos2") - F.col("pos")))
    least = near.filter(F.col("distance") <= within).groupBy("row", "item", "p1", "pos").agg(F.min("distance").alias("distance"))
    return least.join(items.select("item", "item_key"), "item").select("row", "item_key", "p1", "pos", "distance")


def hit_words(matches: DataFrame) -> DataFrame:
    """(row, n_hit, items): words that runs cover, each once, and the sorted ids of the items."""
    order = Window.partitionBy("row").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("last") - F.greatest(F.col("first") - 1, F.coalesce(before, F.lit(-1))), F.lit(0))
    runs = matches.select("row", "first", "last").distinct()
    covered = runs.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    keys = matches.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_key").cast("string"))).alias("items"))
    return covered.join(keys, "row")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "item_id",
    carry: list[str] | None = None,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """The columns `carry` (all, unless named) with n_words, n_hit, items (sorted ids) and contaminated."""
    wanted = docs.columns if carry is None else carry
    docs, names = shield(docs.select(*wanted, F.col(text).alias("__text")), "__text")
    carry, text = list(names.values()), "__text"
    stored = store_words(docs, text, carry)
    chosen = store_items(items, key, "text")
    index = build_index(stored, chosen, most_terms)
    found = shifted_intersection(index, rarest_pairs(index, chosen), most_terms)
    hits = runtime.materialise(hit_words(phrase_matches(stored, chosen, found, most_terms)), "hits")
    told = stored.select(*carry, "row", "n_words").join(hits, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    judged = told.select(
        *carry,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
    return unshield(judged, names)
