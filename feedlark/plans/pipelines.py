"""The stages of the two feedback flows, from raw table to stored result table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.functions.text import clean_text, text_key
from feedlark.operators import sentiment
from feedlark.operators.mention import map_mentions
from feedlark.operators.tables import clean_reviews, number_rows, valid_posts, valid_products


def cleaned_posts(posts: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Posts with `clean_text`, stored once: the later stages read it several times. `keep` names the columns that are
    stored beside it, all if not given."""
    return runtime.pack(posts.select(*(posts.columns if keep is None else keep), clean_text(text, "social").alias("clean_text")), "posts")


def cleaned_products(products: DataFrame, name: str = "product_name") -> DataFrame:
    return products.withColumn("clean_name", clean_text(name, "product"))


def social_flow(
    posts: DataFrame,
    products: DataFrame,
    label: Callable[[DataFrame, str], DataFrame],
    key: str = "id",
    score_on: str = "clean_text",
    columns: list[str] | None = None,
    **mapping,
) -> DataFrame:
    """Posts (key, text) and products (product_id, product_name) -> the stored mention table, or some `columns` of it:
    texts that are not asked for do not go through the joins.

    `label(df, text column)` adds `sentiment`; `score_on="text"` scores the raw text, which still
    has the negations that the social stop words remove. Ids that are not numbers are replaced by
    row numbers in order of id and text, as the table's `review_id` is a number.
    """
    clean = valid_posts(cleaned_posts(posts, keep=[key] if score_on == "clean_text" else list(dict.fromkeys([key, score_on]))))
    if dict(clean.dtypes)[key] == "string":
        clean = runtime.pack(number_rows(clean, key, "clean_text"), "numbered")
        key = "review_id"
    texts = ["clean_text"] if columns is None or "review_text" in columns else []
    labelled = label(clean.withColumn("mention_key", text_key("clean_text")), score_on)
    labelled = runtime.pack(labelled.select(key, *texts, "mention_key", "sentiment"), "labelled")
    mapped = map_mentions(clean, valid_products(cleaned_products(products)), onto=(labelled, "mention_key"), **mapping)
    return sentiment.social_table(mapped, key, "clean_text", columns)


def review_flow(
    reviews: DataFrame, label: Callable[[DataFrame, str], DataFrame], columns: list[str] | None = None
) -> DataFrame:
    """Merged reviews -> the stored review table, or some `columns` of it; `label(df, text column)` adds `sentiment_api`."""
    clean = clean_reviews(reviews)
    if columns is not None:  # of the texts only the one that is labelled is stored
        needed = {"clean_text_review", *columns} | ({"sentiment"} if "sentiment_humanlabels" in columns else set())
        clean = clean.select(*(c for c in clean.columns if c in needed))
    return sentiment.ecommerce_table(label(runtime.pack(clean, "reviews"), "clean_text_review"), columns)


def with_period(df: DataFrame, ts: str, pattern: str = "yyyy-MM", period: str = "period") -> DataFrame:
    """The folder that a row belongs to; by default its month."""
    return df.withColumn(period, F.date_format(ts, pattern))
