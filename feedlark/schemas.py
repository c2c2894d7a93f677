"""Schemas of the stored tables."""

PRODUCTS = "product_id string, product_name string, product_category string, price double"
POSTS = "id string, text string"
RAW_REVIEWS = "product_id string, product_name string, rating string, review_text string, sentiment string"
REVIEWS = (
    "product_id string, product_name string, rating double, review_text string, sentiment string, "
    "platform string"
)
SENTIMENT_ECOMMERCE = (
    "product_id string, product_name string, rating double, review_text string, "
    "sentiment_humanlabels string, platform string, clean_product_name string, "
    "clean_text_review string, sentiment_api string"
)
SENTIMENT_SOCIAL = (
    "review_id bigint, review_text string, product_id string, product_name string, "
    "similarity_score double, sentiment string"
)
LABELS = ("negative", "neutral", "positive")


def names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(",")]
