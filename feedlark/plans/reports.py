"""Reports over the result tables; each is one aggregate whose size does not depend on the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlark.schemas import LABELS


def _label_counts(column: str):
    return [F.count_if(F.col(column) == x).alias(f"{x}_rows") for x in LABELS]


def sentiment_by_product(social: DataFrame) -> DataFrame:
    """Mentions of each product, and how many of them have each sentiment."""
    found = social.filter(F.col("product_id").isNotNull())
    return found.groupBy("product_id", "product_name").agg(
        F.count(F.lit(1)).alias("mentions"), *_label_counts("sentiment")
    )


def sentiment_by_platform(reviews: DataFrame) -> DataFrame:
    """Rows, mean rating and share of each sentiment per platform."""
    counted = reviews.groupBy("platform").agg(
        F.count(F.lit(1)).alias("review_rows"),
        F.round(F.avg("rating"), 6).alias("mean_rating"),
        *_label_counts("sentiment_api"),
    )
    shares = [F.round(F.col(f"{x}_rows") / F.col("review_rows"), 6).alias(f"{x}_share") for x in LABELS]
    return counted.select("platform", "review_rows", "mean_rating", *shares)


def sentiment_over_time(
    feedback: DataFrame, ts: str, sentiment: str, *by: str, grain: str = "week"
) -> DataFrame:
    """Rows of each sentiment per period (its first day) and per column in `by`."""
    period = F.date_format(F.date_trunc(grain, ts), "yyyy-MM-dd").alias("period")
    return feedback.groupBy(period, *by).agg(
        F.count(F.lit(1)).alias("feedback_rows"), *_label_counts(sentiment)
    )


def product_overview(social: DataFrame, reviews: DataFrame) -> DataFrame:
    """Social mentions and store reviews of each product in one row; both sides are aggregated
    before they are joined."""
    s = social.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.count_if(F.col("sentiment") == "positive").alias("positive_mentions"),
    )
    r = reviews.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(F.col("sentiment_api") == "positive").alias("positive_reviews"),
        F.avg("rating").alias("mean_rating"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return s.join(r, "product_id", "full").select(
        "product_id", zero("mentions"), zero("positive_mentions"), zero("reviews"),
        zero("positive_reviews"), F.round("mean_rating", 6).alias("mean_rating"),
    )


def top_products(social: DataFrame, n: int = 10) -> DataFrame:
    """The `n` products with most mentions, with their mean score."""
    found = social.filter(F.col("product_id").isNotNull()).groupBy("product_id", "product_name").agg(
        F.count(F.lit(1)).alias("mentions"), F.round(F.avg("similarity_score"), 4).alias("mean_score")
    )
    return found.orderBy(F.desc("mentions"), "product_id").limit(n)
