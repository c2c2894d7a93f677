"""Work done once per distinct text, and put back on every row that carries the text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.functions.text import alnum_tokens, drop_stop_words, text_key, with_term_counts


def mapping_tokens(clean: Column | str) -> Column:
    """Tokens of cleaned text that may enter the vocabulary."""
    return drop_stop_words(alnum_tokens(clean, 3), "mapping", "english318")


def has_mapping_tokens(clean: Column | str) -> Column:
    """Does the text count as a document: a word is left before the 318-word list is applied."""
    return F.size(drop_stop_words(alnum_tokens(clean, 3), "mapping")) > 0


def long_tokens(clean: Column | str) -> Column:
    return alnum_tokens(clean, 3)


def distinct_texts(
    df: DataFrame,
    text: str,
    *more: Column,
    tokens: Callable = mapping_tokens,
    counted: Callable = has_mapping_tokens,
) -> DataFrame:
    """One row per distinct text: text_key, copies, counted (is it a document for idf), bag, text_no.

    Copies are merged before and after the shuffle, so a text that makes up a third of all rows is
    one row from here on. `more` holds further aggregates, which bring the text along.
    """
    texts = df.groupBy(F.col(text).alias("text")).agg(F.count(F.lit(1)).alias("copies"), *more)
    extra = [c for c in texts.columns if c not in ("text", "copies")]
    texts = texts.withColumn("tokens", tokens("text"))
    counts = counted("text")
    if tokens is mapping_tokens and counted is has_mapping_tokens:  # a token of the one is a word of the other
        counts = F.when(F.size("tokens") > 0, F.lit(True)).otherwise(counts)
    texts = texts.select(
        text_key("text").alias("text_key"), "copies", counts.alias("counted"), *(["text", *extra] if extra else []), "tokens"
    )
    texts = with_term_counts(texts, "tokens").withColumn("text_no", F.monotonically_increasing_id())
    return runtime.pack(texts, "texts")


def text_words(texts: DataFrame) -> DataFrame:
    """(text_key, copies, term, tf)"""
    return texts.select("text_key", "copies", F.inline("bag"))


def attach(
    df: DataFrame, text: str, results: DataFrame, hot_rows: int = runtime.HOT_ROWS, key: str | None = None
) -> DataFrame:
    """Put `results` (text_key, copies, …; one row per text) on every row of `df` with that text.

    `df` is read up to three times, so it should be a stored table. `key` names a column that holds the key of the
    text, for rows that go on without their texts.
    """
    results = runtime.pack(results, "results")
    # null texts have no results: a key of their own for each keeps them out of one large partition
    own = F.concat(F.lit("null-"), F.monotonically_increasing_id().cast("string")).cast("binary")
    keyed = df.withColumn("text_key", F.coalesce(text_key(text) if key is None else F.col(key), own))
    return runtime.hot_key_join(keyed, results, "text_key", "copies", hot_rows).drop("text_key")
