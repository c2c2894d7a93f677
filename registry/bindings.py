"""Every operator bound to the test tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlark import runtime, schemas
from feedlark.functions import html as H
from feedlark.functions import text as T
from feedlark.functions.stopwords import PROFILES
from feedlark.operators import mention, sentiment, tables
from feedlark.operators.texts import distinct_texts, long_tokens, mapping_tokens, text_words
from feedlark.plans import pipelines, reports
from feedlark.sources import readers, sinks
from feedlark.streaming import streams

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # for the scorer below

PLATFORMS = ("store_a", "store_b")
TOP_K = 3
MIN_SCORE = 0.1
VOCABULARY = 10_000
FOLDS = 5  # labelled rows are split by the remainder of their id
MOST_LABELS = 2_000_000  # label rows that are sent to every executor; more are shuffled with the texts

MENTIONS = ["product_id", "product_name", "similarity_score", "sentiment"]  # what reports read of the mention table
RATINGS = ["product_id", "rating", "platform", "sentiment_api"]  # and of the review table

_tables: dict[tuple, DataFrame] = {}
_models: dict[tuple, sentiment.BayesModel] = {}


def table(spark: SparkSession, sf: str, name: str, key: str | None = None) -> DataFrame:
    df = readers.read_table(spark, f"{sf}/{name}.parquet")
    return runtime.spread(df, key) if key else df


def documents(spark, sf):
    return table(spark, sf, "documents", "doc_id")


def posts(spark, sf):
    return documents(spark, sf).select("doc_id", "text")


def products(spark, sf):
    items = table(spark, sf, "benchmark")
    return items.select(F.col("item_id").alias("product_id"), F.col("text").alias("product_name"))


def comments(spark, sf):
    rows = table(spark, sf, "conversations")
    return rows.select(F.col("conv_id").cast("string").alias("id"), F.col("turn").alias("pos"), "role", "text")


def human_label(quality: str = "quality", toxic: str = "toxic") -> Column:
    return F.when(F.col(toxic) == 1, "negative").when(F.col(quality) == 1, "positive").otherwise("neutral")


def labels(spark, sf):
    """What people said of documents: a few numbers a row, for which no texts are shuffled unless there are too many."""
    rows = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return F.broadcast(rows) if rows.limit(MOST_LABELS + 1).count() <= MOST_LABELS else rows


def labelled(spark, sf):
    """Documents that people labelled, with cleaned text."""
    docs = documents(spark, sf).join(labels(spark, sf), "doc_id")
    return docs.select(
        "doc_id", T.clean_text("text", "review").alias("clean"), human_label().alias("human")
    )


def model(spark, sf):
    """The terms are stored; a session trains once for a folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        _models[key] = sentiment.train_bayes(stored_labelled(spark, sf), "clean", "human")
    return _models[key]


def platform_of() -> Column:
    """Documents of even sources are reviews in one store, the others in the other."""
    return F.when(F.substring("source", 4, 9).cast("int") % 2 == 0, PLATFORMS[0]).otherwise(PLATFORMS[1])


def store_catalog(spark, sf):
    """All parts as products of the stores. A benchmark item of the same number gives its text as the name, so
    that reviews and mentions speak of the same products."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), "p_name")
    both = parts.join(products(spark, sf), "product_id", "full")
    return both.select("product_id", F.coalesce("product_name", "p_name").alias("product_name"))


def review_rows(spark, sf):
    """All documents as reviews, 5 columns and the platform: dealt out to the products of the stores in turn. A
    document without an id, or without any product to name, stays with nulls."""
    items = tables.number_rows(store_catalog(spark, sf), "product_id", name="place")
    items = runtime.pack(items.withColumn("place", F.col("place") - 1), "catalog")
    docs = documents(spark, sf).withColumn("place", F.pmod("doc_id", F.lit(max(1, items.count()))))
    rows = docs.join(items, "place", "left").join(labels(spark, sf), "doc_id", "left")
    return rows.select(
        F.col("product_id").cast("string").alias("product_id"),
        "product_name",
        (F.col("n_chars") % 5 + 1).cast("double").alias("rating"),
        F.col("text").alias("review_text"),
        F.when(F.col("quality").isNotNull(), human_label()).alias("sentiment"),
        platform_of().alias("platform"),
    )


def reviews(spark, sf):
    """One source for each platform, merged."""
    rows = runtime.pack(review_rows(spark, sf), "reviews")
    return tables.merge_reviews({p: rows.filter(F.col("platform") == p).drop("platform") for p in PLATFORMS})


def once(name):
    """A result table is stored once for a session and folder; reports read it."""

    def decorate(build):
        def read(spark, sf):
            key = (spark.sparkContext.applicationId, name, sf)
            if key not in _tables:
                _tables[key] = runtime.pack(build(spark, sf), name)
            return _tables[key]

        return read

    return decorate


def for_reports(spark, sf, name: str, stored: DataFrame) -> DataFrame:
    """A stored result table, which reports of this session read from now on."""
    _tables[spark.sparkContext.applicationId, name, sf] = stored
    return stored


def chunks(spark, sf, text: Column | None = None):
    rows = comments(spark, sf)
    return tables.group_comments(rows.withColumn("text", text) if text is not None else rows)


# ---- sources and sinks


def scan_social_json(spark, sf):
    path = runtime.scratch_path(spark, "social-json")
    sinks.write_text_items(comments(spark, sf), path)
    return tables.social_posts(readers.read_text_items(spark, path))


def scan_social_multiline(spark, sf):
    """All comments as objects over several lines, a thousand conversations or so in a file."""
    path = runtime.scratch_path(spark, "social-objects")
    rows = chunks(spark, sf)
    files = max(1, rows.count() // 1000)
    placed = rows.withColumn("file", F.pmod(F.xxhash64("id"), F.lit(files)))
    entries = F.collect_list(F.struct(F.concat("id", F.lit("#"), F.lpad("chunk", 9, "0")), "texts"))
    objects = placed.groupBy("file").agg(F.map_from_entries(entries).alias("TextItem"))
    text = F.to_json(F.struct("TextItem"), {"pretty": "true"}).alias("value")
    objects.select(text, "file").write.partitionBy("file").text(path)
    posts = tables.social_posts(readers.read_text_items(spark, path, pattern="*.txt"))
    return posts.select(F.regexp_extract("id", "^(.*)#", 1).alias("id"), "text")


def scan_catalog_json(spark, sf):
    path = runtime.scratch_path(spark, "catalog-json")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").alias("price"),
    )
    sinks.write_catalog(parts, path)
    return readers.read_catalog(spark, path)


def scan_reviews_csv(spark, sf):
    path = runtime.scratch_path(spark, "reviews-csv")
    rows = documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("product_id"),
        F.col("source").alias("product_name"),
        (F.col("n_chars") % 5 + 1).alias("rating"),
        F.col("text").alias("review_text"),
        F.col("lang").alias("sentiment"),
    )
    writer = rows.write.option("header", True).option("escape", '"').option("quoteAll", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)
    return readers.read_reviews_csv(spark, path)


def sink_roundtrip(spark, sf):
    return sinks.write_parquet(documents(spark, sf), runtime.scratch_path(spark, "sink"))


def period_partitioned(spark, sf):
    events = table(spark, sf, "events", "event_id").select("event_type", "value", "ts")
    daily = pipelines.with_period(events, "ts", "yyyy-MM-dd")
    stored = sinks.write_by_period(daily, runtime.scratch_path(spark, "periods"))
    return stored.groupBy("period", "event_type").agg(
        F.count(F.lit(1)).alias("event_rows"), F.round(F.sum("value"), 2).alias("value_sum")
    )


def group_comments(spark, sf):
    return chunks(spark, sf).select(
        "id", "chunk", F.size("texts").alias("n_texts"), F.array_join("texts", " | ").alias("texts")
    )


def explode_comments(spark, sf):
    return tables.explode_comments(chunks(spark, sf))


def html_blocks(spark, sf):
    pages = table(spark, sf, "pages", "page_id")

    def placed(kind: str, found: Column) -> Column:
        return F.transform(found, lambda b, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), b.alias("block")))

    ads, paragraphs = H.flat_blocks("html", "div", "ad"), H.flat_blocks("html", "p")
    blocks = pages.select("page_id", F.inline(F.concat(placed("ad", ads), placed("p", paragraphs))))
    return blocks.withColumn("block", T.strip(T.strip_html("block")))


def html_blocks_nested(spark, sf):
    return H.nested_blocks(table(spark, sf, "pages", "page_id"), "page_id", "html", "div", "ad")


def result_table(spark, df, name: str, ddl: str):
    path = runtime.scratch_path(spark, name)
    sinks.write_parquet(df, path, compression="snappy")
    return sinks.external_table(spark, f"sentiment_{path.rsplit('/', 1)[1].replace('-', '_')}", ddl, path)


def table_sentiment_ecommerce(spark, sf):
    table = result_table(spark, review_table(spark, sf), "ecommerce", schemas.SENTIMENT_ECOMMERCE)
    return for_reports(spark, sf, "ecommerce", table)


def table_sentiment_social(spark, sf):
    table = result_table(spark, mention_table(spark, sf), "social", schemas.SENTIMENT_SOCIAL)
    return for_reports(spark, sf, "social", table)


# ---- projections, filters, text


def unpivot_posts(spark, sf):
    items = chunks(spark, sf).select(F.create_map("id", "texts").alias("TextItem"))
    return tables.social_posts(items.select(F.explode("TextItem").alias("id", "texts")))


def array_text_normalise(spark, sf):
    only = F.when(F.col("role") == "assistant", F.col("text"))
    return chunks(spark, sf, only).select("id", T.join_texts("texts").alias("text"))


def drop_blank_text(spark, sf):
    rows = comments(spark, sf).withColumn("text", F.when(F.col("role") != "user", F.col("text")).otherwise("  "))
    return tables.drop_blank(rows, "text").select("id", "pos", "text")


def messy_parts(spark, sf):
    """Products with uneven names, and without an id for some sizes."""
    name = F.concat(F.lit("  "), "p_name", F.lit(" -\t"), "p_brand", F.lit("  / "), "p_type", F.lit(" "))
    return table(spark, sf, "part").select(
        F.when(F.col("p_size") != 7, F.col("p_partkey").cast("string")).otherwise("").alias("product_id"),
        name.alias("product_name"),
        F.when(F.col("p_size") != 9, F.col("p_name")).otherwise("The").alias("short_name"),
        "p_retailprice",
    )


def valid_products(spark, sf):
    clean = messy_parts(spark, sf).select("product_id", T.clean_text("short_name", "product").alias("clean_name"))
    return tables.valid_products(clean)


def valid_posts(spark, sf):
    rows = documents(spark, sf).select("doc_id", T.clean_text("text", "social").alias("clean_text"))
    return tables.valid_posts(rows)


def clean_reviews(spark, sf):
    clean = tables.clean_reviews(reviews(spark, sf))
    return clean.select("product_id", "platform", "clean_product_name", "clean_text_review")


def keyword_search(spark, sf):
    pages = table(spark, sf, "pages", "page_id").select("page_id", "html", T.strip_html("html").alias("plain"))
    found = tables.keyword_search(pages, "THIN(G|T)", "html", "plain", show_cleaned=True)
    return found.select("page_id", "shown")


def strip_html(spark, sf):
    return table(spark, sf, "pages", "page_id").select("page_id", T.strip_html("html").alias("plain"))


def strip_urls(spark, sf):
    said = F.concat_ws(" ", F.lit("see"), "url", F.lit("or"), F.concat("url", F.lit("/www.x, y")))
    return table(spark, sf, "pages").select("page_id", T.strip_urls(said).alias("plain"))


def normalise_names(spark, sf):
    rows = tables.normalise_strings(messy_parts(spark, sf).drop("short_name"))
    return rows.groupBy("product_id", "product_name", "p_retailprice").agg(F.count(F.lit(1)).alias("n"))


def tokenise(spark, sf):
    tokens = T.split_tokens(T.keep_alnum(F.lower("text")))
    return documents(spark, sf).select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


def filter_tokens(spark, sf):
    tokens = documents(spark, sf).select("doc_id", T.split_tokens(T.keep_alnum(F.lower("text"))).alias("t"))
    kept = [F.array_join(T.filter_tokens("t", p), " ").alias(f"kept_{p}") for p in PROFILES]
    return tokens.select("doc_id", *kept)


def clean_product(spark, sf):
    named = table(spark, sf, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    items = table(spark, sf, "benchmark").select(F.lit("benchmark").alias("kind"), F.col("item_id").alias("id"), F.col("text").alias("name"))
    return named.unionByName(items).select("kind", "id", T.clean_text("name", "product").alias("clean_name"))


def clean_social(spark, sf):
    return documents(spark, sf).select("doc_id", T.clean_text("text", "social").alias("clean_text"))


def word_tokens(spark, sf):
    words = T.word_tokens("text")
    return documents(spark, sf).select(
        "doc_id", F.size(words).alias("n_words"), F.array_join(words, " ").alias("words")
    )


def clean_mapping(spark, sf):
    clean = documents(spark, sf).select("doc_id", T.clean_text("text", "social").alias("clean"))
    return clean.select(
        "doc_id",
        T.clean_text("clean", "mapping").alias("mapping_text"),
        F.array_join(mapping_tokens("clean"), " ").alias("vocabulary_text"),
    )


# ---- rows


def dedup_products(spark, sf):
    parts = table(spark, sf, "part").select("p_name", "p_partkey", "p_brand", "p_retailprice")
    return tables.keep_first(parts, ["p_name"], ["p_partkey"])


def sample_n(spark, sf):
    return tables.sample_n(table(spark, sf, "documents").select("doc_id", "lang", "source"), 100, "doc_id")


def stage_counts(spark, sf):
    rows = documents(spark, sf).select("text", T.clean_text("text", "social").alias("clean"))
    rows = rows.withColumn("words", mapping_tokens("clean"))
    return tables.stage_counts(
        rows,
        {
            "read": F.lit(True),
            "not_blank": ~T.is_blank("text"),
            "cleaned": F.col("clean") != "",
            "with_words": F.size("words") > 0,
        },
    )


def quality_counts(spark, sf):
    rows = messy_parts(spark, sf).select(T.clean_text("short_name", "product").alias("clean_name"))
    return tables.quality_counts(rows, "clean_name")


# ---- mention mapping


def mapping_inputs(spark, sf):
    clean = pipelines.cleaned_posts(posts(spark, sf), keep=["doc_id"])
    return tables.valid_posts(clean), tables.valid_products(pipelines.cleaned_products(products(spark, sf)))


def mention_map(spark, sf):
    clean, items = mapping_inputs(spark, sf)
    return mention.map_mentions(clean, items).select(
        "doc_id", "product_id", "product_name", "similarity_score"
    )


def mention_topk(spark, sf):
    clean, items = mapping_inputs(spark, sf)
    return mention.map_mentions(clean, items, k=TOP_K).select(
        "doc_id", "place", "product_id", "similarity_score"
    )


def mention_scores(spark, sf):
    clean, items = mapping_inputs(spark, sf)
    catalog, texts = mention.fit_catalog(clean, items)
    pairs = mention.similar_pairs(texts, catalog, MIN_SCORE)
    pairs = runtime.pack(pairs.join(texts.select("text_key", "copies"), "text_key"), "pairs")
    found = clean.select("doc_id", T.text_key("clean_text").alias("text_key"))
    found = runtime.hot_key_join(found, pairs, "text_key", "copies", how="inner")
    names = items.select("product_id", T.text_key("clean_name").alias("name_key"))
    return found.join(names, "name_key").select("doc_id", "product_id", "similarity_score")


def mention_catalog(spark, sf):
    """Conversation turns against all documents as names: a catalog that grows with the data."""
    turns = table(spark, sf, "conversations").select((F.col("conv_id") * 1_000_000 + F.col("turn")).alias("turn_id"), "text")
    clean = tables.valid_posts(pipelines.cleaned_posts(turns, keep=["turn_id"]))
    names = posts(spark, sf).select(F.col("doc_id").alias("product_id"), F.col("text").alias("product_name"))
    names = tables.valid_products(pipelines.cleaned_products(names)).drop("product_name")
    found = mention.map_mentions(clean, runtime.pack(names, "catalog"), with_names=False)
    return found.select("turn_id", "product_id", "similarity_score")


def row_numbers(spark, sf):
    """All documents numbered by language and id; the source id stays beside the number."""
    rows = table(spark, sf, "documents").select("lang", "doc_id")
    return tables.number_rows(rows, "lang", "doc_id").withColumn("review_id", F.col("review_id").cast("long"))


def both_sides(spark, sf):
    clean, items = mapping_inputs(spark, sf)
    return clean, items, distinct_texts(clean, "clean_text"), distinct_texts(items, "clean_name")


def term_stats(spark, sf):
    return mention.term_stats(*both_sides(spark, sf)[2:])


def tfidf_vocab(spark, sf):
    sides = both_sides(spark, sf)[2:]
    vocab = mention.vocabulary(mention.term_stats(*sides), mention.document_count(*sides), VOCABULARY)
    return vocab.withColumn("idf", F.round("idf", 6))


def tfidf_weights(spark, sf):
    clean, items, texts, names = both_sides(spark, sf)
    vocab = mention.vocabulary(mention.term_stats(texts, names), mention.document_count(texts, names))
    vocab = runtime.pack(vocab, "vocab")
    out = []
    for side, rows, distinct, key, text in (
        ("post", clean, texts, "doc_id", "clean_text"),
        ("product", items, names, "product_id", "clean_name"),
    ):
        weights = mention.tfidf_weights(distinct, vocab).join(distinct.select("text_key", "copies"), "text_key")
        weights = runtime.pack(weights, "weights")
        keyed = rows.select(F.lit(side).alias("side"), F.col(key).alias("id"), T.text_key(text).alias("text_key"))
        out.append(runtime.hot_key_join(keyed, weights, "text_key", "copies", how="inner").select("side", "id", "term", F.round("weight", 6).alias("weight")))
    return out[0].unionByName(out[1])


# ---- sentiment


def fake_scorer(labels=schemas.LABELS):
    """Stands in for a sentiment service: the reply depends on the length of the text."""

    def send(texts):
        replies = []
        for text in texts:
            n = len(text)
            if n % 7 == 0:
                replies.append((503, None, None))
            elif n % 11 == 0:
                replies.append((None, None, "timeout"))
            elif n % 13 == 0:
                replies.append((200, "{}", None))
            else:
                replies.append((200, '{"sentiment": "%s"}' % labels[n % len(labels)], None))
        return replies

    return send


def score_udf(spark, sf):
    rows = documents(spark, sf).select("doc_id", "text")
    return sentiment.score_texts(rows, "text", fake_scorer, concurrency=spark.sparkContext.defaultParallelism).select("doc_id", "sentiment", "error")


def score_errors(spark, sf):
    kind = F.col("event_type")
    replies = table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", 503).when(kind != "click", 200).alias("status"),
        F.when(kind == "purchase", '{"sentiment": "positive"}').when(kind == "view", "{}").alias("body"),
        F.when(kind == "click", "timeout").alias("exception"),
    )
    reply = ("status", "body", "exception")
    return replies.select(
        "event_id", sentiment.reply_label(*reply).alias("sentiment"), sentiment.reply_error(*reply).alias("error")
    )


def nb_train(spark, sf):
    bayes = model(spark, sf)
    logs = [F.round(F.col(x) - bayes.log_total[x], 6).alias(x) for x in bayes.labels]
    return bayes.terms.select("term", *logs)


def scored_documents(spark, sf, bayes, keep_scores=False):
    rows = documents(spark, sf).select("doc_id", T.clean_text("text", "review").alias("clean"))
    rows = runtime.pack(rows, "clean")
    return sentiment.bayes_label(rows, "clean", bayes, keep_scores=keep_scores)


def nb_score(spark, sf):
    return scored_documents(spark, sf, model(spark, sf), keep_scores=True).drop("clean")


@once("labelled")
def stored_labelled(spark, sf):
    return labelled(spark, sf)


def label_confusion(spark, sf):
    """Every labelled row by the model of the four folds that it does not lie in."""
    rows = stored_labelled(spark, sf).withColumn("fold", F.pmod("doc_id", F.lit(FOLDS)))
    return sentiment.confusion(sentiment.cross_label(rows, "clean", "human", "fold", FOLDS), "human", "sentiment")


def label_quality(spark, sf):
    return sentiment.label_quality(runtime.pack(label_confusion(spark, sf), "confusion"))


def review_table(spark, sf, columns=None):
    bayes = model(spark, sf)
    label = lambda df, text: sentiment.bayes_label(df, text, bayes, label="sentiment_api")
    return pipelines.review_flow(review_rows(spark, sf), label, columns)


def mention_table(spark, sf, columns=None):
    bayes = model(spark, sf)
    label = lambda df, text: sentiment.bayes_label(df, text, bayes)
    return pipelines.social_flow(posts(spark, sf), products(spark, sf), label, "doc_id", columns=columns)


@once("ecommerce")
def ecommerce(spark, sf):
    return review_table(spark, sf, RATINGS)


@once("social")
def social(spark, sf):
    return mention_table(spark, sf, MENTIONS)


# ---- reports


def sentiment_by_product(spark, sf):
    return reports.sentiment_by_product(social(spark, sf))


def sentiment_by_platform(spark, sf):
    return reports.sentiment_by_platform(ecommerce(spark, sf))


def sentiment_over_time(spark, sf):
    kind = F.col("event_type")
    feeling = F.when(kind == "error", "negative").when(kind == "purchase", "positive").otherwise("neutral")
    rows = table(spark, sf, "events").select("ts", (F.col("user_id") % 64).alias("product_id"), feeling.alias("sentiment"))
    return reports.sentiment_over_time(rows, "ts", "sentiment", "product_id")


def product_overview(spark, sf):
    return reports.product_overview(social(spark, sf), ecommerce(spark, sf))


def top_products(spark, sf):
    return reports.top_products(social(spark, sf))


# ---- streams


def landed_table(spark, sf, name):
    """A table as new files: one file, or a folder of files. A stream's path must be a folder or a pattern."""
    return streams.landed_files(spark, f"{sf}/{{{name}.parquet}}", table(spark, sf, name).schema)


def stream_clean(spark, sf):
    out, checkpoint = (runtime.scratch_path(spark, x) for x in ("stream", "stream-state"))
    for _ in range(2):  # the second run finds no new file and must add nothing
        landed = landed_table(spark, sf, "documents").select("doc_id", "text")
        # the table may be one file, which one task would read and clean
        landed = landed.repartition(spark.sparkContext.defaultParallelism, "doc_id")
        streams.stream_clean(landed, out, checkpoint)
    return readers.read_table(spark, out).select("doc_id", "clean_text")


def stream_mention_map(spark, sf):
    """Conversation turns as new posts, against the catalog fitted on the documents."""
    catalog, _ = mention.fit_catalog(*mapping_inputs(spark, sf))
    landed = landed_table(spark, sf, "conversations").select("conv_id", "turn", T.clean_text("text", "social").alias("clean_text"))
    out, checkpoint = (runtime.scratch_path(spark, x) for x in ("mapped-stream", "mapped-state"))
    for _ in range(2):
        streams.stream_mention_map(landed, catalog, out, checkpoint)
    return readers.read_table(spark, out).select("conv_id", "turn", "product_id", "similarity_score")


QUERIES = [
    scan_social_json, scan_social_multiline, scan_catalog_json, scan_reviews_csv, html_blocks, html_blocks_nested,
    explode_comments, sink_roundtrip, group_comments, table_sentiment_ecommerce, table_sentiment_social,
    period_partitioned, unpivot_posts, array_text_normalise, drop_blank_text, valid_products, valid_posts,
    clean_reviews, keyword_search, strip_html, strip_urls, normalise_names, tokenise, filter_tokens,
    clean_product, clean_social, word_tokens, clean_mapping, dedup_products, sample_n, mention_map,
    mention_topk, mention_scores, mention_catalog, row_numbers, stage_counts, quality_counts, term_stats, tfidf_vocab, tfidf_weights,
    score_udf, score_errors, nb_train, nb_score, label_confusion, label_quality, sentiment_by_product,
    sentiment_by_platform, sentiment_over_time, product_overview, top_products, stream_clean,
    stream_mention_map,
]

queries = {q.__name__: q for q in QUERIES} | {"merge_reviews": reviews}
