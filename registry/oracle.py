"""The same results as DuckDB SQL, written the direct way: all rows, no shortcuts."""

from __future__ import annotations

from feedlark.schemas import LABELS
from registry.bindings import FOLDS, MIN_SCORE, PLATFORMS, TOP_K, VOCABULARY
from registry.wordlists import PROFILES


def words(*profiles: str) -> str:
    return ", ".join(f"'{w}'" for w in sorted({w for p in profiles for w in PROFILES[p][0]}))


def no_tags(c: str) -> str:
    return f"regexp_replace({c}, '</?[^>]+>', '', 'g')"


def no_urls(c: str) -> str:
    return rf"regexp_replace({c}, 'http\S+|www\S+|https\S+', '', 'g')"


def alnum(c: str) -> str:
    return rf"regexp_replace({c}, '[^a-z0-9\s]', '', 'g')"


def split(c: str) -> str:
    return rf"list_filter(string_split_regex({c}, '\s+'), lambda x: x <> '')"


def kept(tokens: str, min_len: int, *profiles: str) -> str:
    return f"list_filter({tokens}, lambda x: length(x) >= {min_len} AND x NOT IN ({words(*profiles)}))"


def joined(tokens: str) -> str:
    return f"coalesce(array_to_string({tokens}, ' '), '')"


def clean(c: str, profile: str) -> str:
    text = alnum(no_urls(no_tags(f"lower({c})")))
    return joined(kept(split(text), PROFILES[profile][1], profile))


def mapped(c: str, *profiles: str) -> str:
    return kept(split(c), 3, *profiles)


HUMAN = "CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END"

# Posts and products of the vocabulary, and the weights of both sides.
DOCUMENT_POSTS = f"SELECT doc_id AS id, {clean('text', 'social')} AS txt FROM documents"
ITEMS = f"SELECT item_id AS id, {clean('text', 'product')} AS txt FROM benchmark"


def fit(posts: str = DOCUMENT_POSTS, items: str = ITEMS) -> str:
    return f"""
posts AS MATERIALIZED (SELECT * FROM ({posts}) WHERE txt <> ''),
items AS MATERIALIZED (SELECT * FROM ({items}) WHERE txt <> ''),
sides AS (SELECT 'post' AS side, id, txt FROM posts UNION ALL SELECT 'product', id, txt FROM items),
n AS (SELECT count(*) AS n_docs FROM sides WHERE len({mapped('txt', 'mapping')}) > 0),
tf AS MATERIALIZED (
  SELECT side, id, term, count(*) AS tf
  FROM (SELECT side, id, unnest({mapped('txt', 'mapping', 'english318')}) AS term FROM sides)
  GROUP BY ALL),
stats AS (SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS ctf FROM tf GROUP BY term)"""


FIT = fit()


def vocab(limit: int = 10_000) -> str:
    return f"""
vocab AS MATERIALIZED (
  SELECT term, df, ctf, ln((1.0 + n_docs) / (1.0 + df)) + 1.0 AS idf
  FROM stats, n ORDER BY ctf DESC, term LIMIT {limit})"""


WEIGHTS = """
raws AS MATERIALIZED (SELECT side, id, term, tf * idf AS raw FROM tf JOIN vocab USING (term)),
norms AS (SELECT side, id, sqrt(sum(raw * raw)) AS norm FROM raws GROUP BY side, id),
weights AS MATERIALIZED (
  SELECT side, id, term, raw, norm, raw / norm AS weight FROM raws JOIN norms USING (side, id))"""

DOTS = """
dots AS MATERIALIZED (
  SELECT p.id AS doc_id, q.id AS product_id, sum(p.raw * q.weight) AS dot, any_value(p.norm) AS norm
  FROM weights p JOIN weights q ON p.term = q.term AND p.side = 'post' AND q.side = 'product'
  GROUP BY p.id, q.id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(dot, 6) DESC, product_id) AS place
  FROM dots WHERE round(dot, 6) > 0)"""

MENTION = f"WITH {FIT}, {vocab()}, {WEIGHTS}, {DOTS}"


def mention(k: int, fitted: str = FIT) -> str:
    return f"""WITH {fitted}, {vocab()}, {WEIGHTS}, {DOTS}
SELECT posts.id AS doc_id, posts.txt, coalesce(place, 1)::INTEGER AS place, product_id,
       items.txt AS product_name, coalesce(round(dot / norm, 6), 0.0) AS similarity_score
FROM posts LEFT JOIN (SELECT * FROM ranked WHERE place <= {k}) r ON r.doc_id = posts.id
LEFT JOIN items ON items.id = r.product_id"""


TURNS = f"SELECT conv_id * 1000000 + turn AS id, {clean('text', 'social')} AS txt FROM conversations"
DOCUMENT_NAMES = f"SELECT doc_id AS id, {clean('text', 'product')} AS txt FROM documents"


# naive Bayes trained on all labelled documents
TRAIN = f"""
gold AS MATERIALIZED (
  SELECT doc_id, {HUMAN} AS human, {clean('text', 'review')} AS clean FROM documents JOIN labels USING (doc_id)),
gold_terms AS MATERIALIZED (
  SELECT term, {', '.join(f"count(*) FILTER (human = '{x}') AS {x}" for x in LABELS)}
  FROM (SELECT human, unnest(list_filter(string_split(clean, ' '), lambda x: length(x) >= 3)) AS term FROM gold)
  GROUP BY term),
gold_sums AS (SELECT {', '.join(f"ln(sum({x}) + count(*)) AS t_{x}" for x in LABELS)} FROM gold_terms),
priors AS (
  SELECT {', '.join(f"ln(count(*) FILTER (human = '{x}')::DOUBLE) - ln(count(*)::DOUBLE) AS p_{x}" for x in LABELS)}
  FROM gold)"""


GREATEST = "greatest(" + ", ".join(LABELS) + ")"
BEST_LABEL = "CASE " + " ".join(f"WHEN {x} = {GREATEST} THEN '{x}'" for x in LABELS) + " END"


def bayes(source: str, key: str, text: str) -> str:
    """CTEs that end in `scored`: key, sentiment and the scores of the rows of `source`."""
    sums = ", ".join(f"sum(tf * ln({x} + 1.0)) AS {x}" for x in LABELS)
    scores = ", ".join(
        f"round(p_{x} + coalesce({x}, 0.0) - coalesce(n_words, 0) * t_{x}, 6) AS {x}" for x in LABELS
    )
    return f"""
bag AS (
  SELECT {key}, term, count(*) AS tf
  FROM (SELECT {key}, unnest(list_filter(string_split({text}, ' '), lambda x: length(x) >= 3)) AS term FROM {source})
  GROUP BY ALL),
hits AS (SELECT {key}, sum(tf) AS n_words, {sums} FROM bag JOIN gold_terms USING (term) GROUP BY {key}),
scores AS (SELECT s.{key}, {scores} FROM {source} s LEFT JOIN hits USING ({key}), gold_sums, priors),
scored AS (SELECT {key}, {BEST_LABEL} AS sentiment, {', '.join(LABELS)} FROM scores)"""


REVIEWS = f"""
SELECT CAST(product_id AS VARCHAR) AS product_id, product_name,
       CAST(n_chars % 5 + 1 AS DOUBLE) AS rating, d.text AS review_text,
       CASE WHEN quality IS NOT NULL THEN {HUMAN} END AS sentiment,
       CASE WHEN CAST(substr(source, 4) AS INTEGER) % 2 = 0 THEN '{PLATFORMS[0]}' ELSE '{PLATFORMS[1]}' END AS platform,
       doc_id
FROM documents d LEFT JOIN (
  SELECT coalesce(p_partkey, item_id) AS product_id, coalesce(text, p_name) AS product_name,
         row_number() OVER (ORDER BY coalesce(p_partkey, item_id)) - 1 AS place
  FROM part FULL JOIN benchmark ON p_partkey = item_id) c
ON place = doc_id % (SELECT count(*) FROM part FULL JOIN benchmark ON p_partkey = item_id)
LEFT JOIN labels USING (doc_id)"""

ECOMMERCE = f"""
reviews AS MATERIALIZED (
  SELECT *, {clean('product_name', 'review')} AS clean_product_name,
         {clean('review_text', 'review')} AS clean_text_review FROM ({REVIEWS})),
{TRAIN}, {bayes('reviews', 'doc_id', 'clean_text_review')},
ecommerce AS (
  SELECT product_id, product_name, rating, review_text, reviews.sentiment AS sentiment_humanlabels, platform,
         clean_product_name, clean_text_review, scored.sentiment AS sentiment_api
  FROM reviews JOIN scored USING (doc_id))"""

SOCIAL = f"""
mapping AS MATERIALIZED ({mention(1)}),
{TRAIN}, {bayes('mapping', 'doc_id', 'txt')},
social AS (
  SELECT doc_id AS review_id, txt AS review_text, CAST(product_id AS VARCHAR) AS product_id, product_name,
         similarity_score, sentiment
  FROM mapping JOIN scored USING (doc_id))"""

# The CTE names of both flows overlap, so each flow is a query of its own where they meet.
ECOMMERCE_ROWS = f"(WITH {ECOMMERCE} SELECT * FROM ecommerce)"
SOCIAL_ROWS = f"(WITH {SOCIAL} SELECT * FROM social)"


def label_counts(c: str) -> str:
    return ", ".join(f"count(*) FILTER ({c} = '{x}') AS {x}_rows" for x in LABELS)


MESSY = """
SELECT CASE WHEN p_size <> 7 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS product_id,
       '  ' || p_name || ' -' || chr(9) || p_brand || '  / ' || p_type || ' ' AS product_name,
       CASE WHEN p_size <> 9 THEN p_name ELSE 'The' END AS short_name, p_retailprice FROM part"""

PROBE = f"""
new_posts AS (SELECT conv_id, turn, {clean('text', 'social')} AS txt FROM conversations),
new_tf AS (
  SELECT conv_id, turn, term, count(*) AS tf
  FROM (SELECT conv_id, turn, unnest({mapped('txt', 'mapping', 'english318')}) AS term FROM new_posts) GROUP BY ALL),
new_raws AS MATERIALIZED (SELECT conv_id, turn, term, tf * idf AS raw FROM new_tf JOIN vocab USING (term)),
new_norms AS (SELECT conv_id, turn, sqrt(sum(raw * raw)) AS norm FROM new_raws GROUP BY ALL),
new_dots AS (
  SELECT conv_id, turn, q.id AS product_id, sum(p.raw * q.weight) AS dot
  FROM new_raws p JOIN weights q ON p.term = q.term AND q.side = 'product' GROUP BY conv_id, turn, q.id),
new_best AS (
  SELECT * FROM new_dots WHERE round(dot, 6) > 0
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY round(dot, 6) DESC, product_id) = 1)"""

FAKE_LABEL = f"""CASE length(text) % 3 WHEN 0 THEN '{LABELS[0]}' WHEN 1 THEN '{LABELS[1]}' ELSE '{LABELS[2]}' END"""

TERM_COUNTS = ", ".join(f"count(*) FILTER (human = '{x}') AS {x}" for x in LABELS)

# a model for each fold, trained on the rows of the others
CONFUSION = f"""
WITH gold AS MATERIALIZED (
  SELECT doc_id, doc_id % {FOLDS} AS fold, {HUMAN} AS human, {clean('text', 'review')} AS clean
  FROM documents JOIN labels USING (doc_id)),
folds AS (SELECT range AS held FROM range({FOLDS})),
words AS MATERIALIZED (
  SELECT doc_id, fold, human, unnest(list_filter(string_split(clean, ' '), lambda x: length(x) >= 3)) AS term FROM gold),
models AS MATERIALIZED (
  SELECT held, term, {TERM_COUNTS} FROM folds JOIN words ON fold <> held GROUP BY held, term),
sums AS (
  SELECT held, {', '.join(f"ln(sum({x}) + count(*)) AS t_{x}" for x in LABELS)} FROM models GROUP BY held),
priors AS (
  SELECT held, {', '.join(f"ln(count(*) FILTER (human = '{x}')::DOUBLE) - ln(count(*)::DOUBLE) AS p_{x}" for x in LABELS)}
  FROM folds JOIN gold ON fold <> held GROUP BY held),
bag AS (SELECT doc_id, fold AS held, term, count(*) AS tf FROM words GROUP BY ALL),
hits AS (
  SELECT doc_id, sum(tf) AS n_words, {', '.join(f"sum(tf * ln({x} + 1.0)) AS {x}" for x in LABELS)}
  FROM bag JOIN models USING (held, term) GROUP BY doc_id),
scores AS (
  SELECT human, {', '.join(f"round(p_{x} + coalesce({x}, 0.0) - coalesce(n_words, 0) * t_{x}, 6) AS {x}" for x in LABELS)}
  FROM gold JOIN sums ON sums.held = fold JOIN priors ON priors.held = fold LEFT JOIN hits USING (doc_id))
SELECT human AS human_label, {BEST_LABEL} AS model_label, count(*) AS row_count FROM scores GROUP BY ALL"""

SQL = {
    "scan_social_json": "SELECT CAST(conv_id AS VARCHAR) AS id, string_agg(text, ' ' ORDER BY turn) AS text "
    "FROM conversations GROUP BY conv_id",
    "scan_social_multiline": "SELECT CAST(conv_id AS VARCHAR) AS id, string_agg(text, ' ' ORDER BY turn) AS text "
    "FROM conversations GROUP BY conv_id",
    "scan_catalog_json": "SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, "
    "p_type AS product_category, p_retailprice AS price FROM part",
    "scan_reviews_csv": "SELECT CAST(doc_id AS VARCHAR) AS product_id, source AS product_name, "
    "CAST(n_chars % 5 + 1 AS DOUBLE) AS rating, text AS review_text, lang AS sentiment FROM documents",
    "html_blocks": rf"""
WITH blocks AS (
  SELECT page_id, 'ad' AS kind, regexp_extract_all(html, '(?s)<div class="ad">(.*?)</div>', 1) AS b FROM pages
  UNION ALL
  SELECT page_id, 'p', regexp_extract_all(html, '(?s)<p(?: [^>]*)?>(.*?)</p>', 1) FROM pages)
SELECT page_id, kind, CAST(i - 1 AS INTEGER) AS pos,
       regexp_replace({no_tags('b[i]')}, '^\s+|\s+$', '', 'g') AS block
FROM (SELECT page_id, kind, b, unnest(range(1, len(b) + 1)) AS i FROM blocks)""",
    "html_blocks_nested": r"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, 'unknown' AS id, trim(b[i]) AS text
FROM (SELECT page_id, b, unnest(range(1, len(b) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '(?s)<div class="ad">(.*?)</div>', 1) AS b FROM pages))""",
    "explode_comments": rf"""
SELECT CAST(conv_id AS VARCHAR) AS id, CAST(turn AS INTEGER) AS pos, text AS original_text,
       regexp_replace({no_tags('text')}, '^\s+|\s+$', '', 'g') AS cleaned_text FROM conversations""",
    "sink_roundtrip": "SELECT * FROM documents",
    "group_comments": "SELECT CAST(conv_id AS VARCHAR) AS id, CAST(floor(turn / 1000) AS BIGINT) AS chunk, "
    "CAST(count(*) AS INTEGER) AS n_texts, string_agg(text, ' | ' ORDER BY turn) AS texts "
    "FROM conversations GROUP BY ALL",
    "table_sentiment_ecommerce": f"WITH {ECOMMERCE} SELECT * FROM ecommerce",
    "table_sentiment_social": f"WITH {SOCIAL} SELECT * FROM social",
    "period_partitioned": "SELECT event_type, strftime(ts, '%Y-%m-%d') AS period, count(*) AS event_rows, "
    "round(sum(value), 2) AS value_sum FROM events GROUP BY ALL",
    "unpivot_posts": "SELECT CAST(conv_id AS VARCHAR) AS id, string_agg(text, ' ' ORDER BY turn) AS text "
    "FROM conversations GROUP BY conv_id",
    "array_text_normalise": "SELECT CAST(conv_id AS VARCHAR) AS id, "
    "coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'assistant'), '') AS text "
    "FROM conversations GROUP BY conv_id",
    "drop_blank_text": "SELECT CAST(conv_id AS VARCHAR) AS id, turn AS pos, text FROM conversations "
    "WHERE role <> 'user' AND trim(text) <> ''",
    "merge_reviews": f"SELECT * EXCLUDE (doc_id) FROM ({REVIEWS})",
    "valid_products": f"SELECT * FROM (SELECT product_id, {clean('short_name', 'product')} AS clean_name "
    f"FROM ({MESSY})) WHERE product_id <> '' AND clean_name <> ''",
    "valid_posts": f"SELECT * FROM (SELECT doc_id, {clean('text', 'social')} AS clean_text FROM documents) "
    "WHERE clean_text <> ''",
    "clean_reviews": f"SELECT product_id, platform, {clean('product_name', 'review')} AS clean_product_name, "
    f"{clean('review_text', 'review')} AS clean_text_review FROM ({REVIEWS})",
    "keyword_search": f"SELECT page_id, plain AS shown FROM (SELECT page_id, {no_tags('html')} AS plain FROM pages) "
    "WHERE regexp_matches(lower(plain), 'thin(g|t)')",
    "strip_html": f"SELECT page_id, {no_tags('html')} AS plain FROM pages",
    "strip_urls": "SELECT page_id, "
    + no_urls("'see ' || url || ' or ' || url || '/www.x, y'")
    + " AS plain FROM pages",
    "normalise_names": f"""
SELECT product_id, regexp_replace(regexp_replace(trim(regexp_replace(product_name, '\\s+', ' ', 'g')),
       '\\s*-\\s*', '-', 'g'), '\\s*/\\s*', '/', 'g') AS product_name, p_retailprice, count(*) AS n
FROM ({MESSY}) GROUP BY ALL""",
    "tokenise": f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, {joined('t')} AS tokens "
    f"FROM (SELECT doc_id, {split(alnum('lower(text)'))} AS t FROM documents)",
    "filter_tokens": "SELECT doc_id, "
    + ", ".join(f"{joined(kept('t', PROFILES[p][1], p))} AS kept_{p}" for p in PROFILES)
    + f" FROM (SELECT doc_id, {split(alnum('lower(text)'))} AS t FROM documents)",
    "clean_product": f"SELECT kind, id, {clean('name', 'product')} AS clean_name FROM ("
    "SELECT 'part' AS kind, p_partkey AS id, p_name AS name FROM part "
    "UNION ALL SELECT 'benchmark', item_id, text FROM benchmark)",
    "clean_social": f"SELECT doc_id, {clean('text', 'social')} AS clean_text FROM documents",
    "word_tokens": r"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, ' ') AS words
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pM\p{Nd}\p{Pc}]+') AS w FROM documents)""",
    "clean_mapping": f"SELECT doc_id, {joined(mapped('clean', 'mapping'))} AS mapping_text, "
    f"{joined(mapped('clean', 'mapping', 'english318'))} AS vocabulary_text "
    f"FROM (SELECT doc_id, {clean('text', 'social')} AS clean FROM documents)",
    "dedup_products": "SELECT p_name, p_partkey, p_brand, p_retailprice FROM part "
    "QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1",
    "sample_n": "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 100",
    "mention_map": f"SELECT doc_id, product_id, product_name, similarity_score FROM ({mention(1)})",
    "mention_topk": f"SELECT doc_id, place, product_id, similarity_score FROM ({mention(TOP_K)})",
    "mention_scores": f"SELECT * FROM ({MENTION} SELECT doc_id, product_id, round(dot / norm, 6) AS similarity_score "
    f"FROM dots) WHERE similarity_score >= {MIN_SCORE}",
    "mention_catalog": "SELECT doc_id AS turn_id, product_id, similarity_score FROM ("
    + mention(1, fit(TURNS, DOCUMENT_NAMES))
    + ")",
    "row_numbers": "SELECT row_number() OVER (ORDER BY lang, doc_id) AS review_id, lang, doc_id FROM documents",
    "stage_counts": f"""
SELECT unnest(['read', 'not_blank', 'cleaned', 'with_words']) AS stage,
       unnest([count(*), count(*) FILTER (trim(text) <> ''), count(*) FILTER (c <> ''),
               count(*) FILTER (len({mapped('c', 'mapping', 'english318')}) > 0)]) AS row_count
FROM (SELECT text, {clean('text', 'social')} AS c FROM documents)""",
    "quality_counts": f"SELECT count(*) AS total_rows, count(*) FILTER (c = '') AS empty_rows, "
    f"count(*) FILTER (c <> '') AS filled_rows FROM (SELECT {clean('short_name', 'product')} AS c FROM ({MESSY}))",
    "term_stats": f"WITH {FIT} SELECT * FROM stats",
    "tfidf_vocab": f"WITH {FIT}, {vocab(VOCABULARY)} SELECT term, df, ctf, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights": f"WITH {FIT}, {vocab()}, {WEIGHTS} SELECT side, id, term, round(weight, 6) AS weight FROM weights",
    "score_udf": f"""
SELECT doc_id,
  CASE WHEN length(text) % 7 = 0 THEN 'ERROR_503' WHEN length(text) % 11 = 0 THEN 'ERROR_timeout'
       WHEN length(text) % 13 = 0 THEN 'UNKNOWN' ELSE {FAKE_LABEL} END AS sentiment,
  CASE WHEN length(text) % 7 = 0 THEN '503' WHEN length(text) % 11 = 0 THEN 'timeout'
       WHEN length(text) % 13 = 0 THEN 'no sentiment in reply' END AS error
FROM documents""",
    "score_errors": """
SELECT event_id,
  CASE event_type WHEN 'error' THEN 'ERROR_503' WHEN 'click' THEN 'ERROR_timeout' WHEN 'purchase' THEN 'positive'
       WHEN 'view' THEN 'UNKNOWN' ELSE 'ERROR_invalid reply' END AS sentiment,
  CASE event_type WHEN 'error' THEN '503' WHEN 'click' THEN 'timeout' WHEN 'purchase' THEN NULL
       WHEN 'view' THEN 'no sentiment in reply' ELSE 'invalid reply' END AS error
FROM events""",
    "nb_train": f"WITH {TRAIN} SELECT term, "
    + ", ".join(f"round(ln({x} + 1.0) - t_{x}, 6) AS {x}" for x in LABELS)
    + " FROM gold_terms, gold_sums",
    "nb_score": f"WITH {TRAIN}, rows_ AS MATERIALIZED (SELECT doc_id, {clean('text', 'review')} AS clean FROM documents), "
    f"{bayes('rows_', 'doc_id', 'clean')} SELECT * FROM scored",
    "label_confusion": CONFUSION,
    "label_quality": f"""
WITH pairs AS ({CONFUSION}),
sides AS (
  SELECT human_label AS label, row_count AS human, 0 AS model,
         CASE WHEN human_label = model_label THEN row_count ELSE 0 END AS hits FROM pairs
  UNION ALL SELECT model_label, 0, row_count, 0 FROM pairs)
SELECT label, sum(human)::BIGINT AS human_rows, sum(model)::BIGINT AS model_rows, sum(hits)::BIGINT AS hits,
       round(CASE WHEN sum(model) > 0 THEN sum(hits) / sum(model) END, 6) AS label_precision,
       round(CASE WHEN sum(human) > 0 THEN sum(hits) / sum(human) END, 6) AS label_recall,
       round((SELECT sum(row_count) FILTER (human_label = model_label) / sum(row_count) FROM pairs), 6) AS accuracy
FROM sides GROUP BY label""",
    "sentiment_by_product": f"SELECT product_id, product_name, count(*) AS mentions, {label_counts('sentiment')} "
    f"FROM {SOCIAL_ROWS} WHERE product_id IS NOT NULL GROUP BY ALL",
    "sentiment_by_platform": "SELECT platform, count(*) AS review_rows, round(avg(rating), 6) AS mean_rating, "
    + ", ".join(f"round(count(*) FILTER (sentiment_api = '{x}') / count(*), 6) AS {x}_share" for x in LABELS)
    + f" FROM {ECOMMERCE_ROWS} GROUP BY platform",
    "sentiment_over_time": f"""
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS period, product_id, count(*) AS feedback_rows,
       {label_counts('sentiment')}
FROM (SELECT ts, user_id % 64 AS product_id, CASE event_type WHEN 'error' THEN 'negative'
             WHEN 'purchase' THEN 'positive' ELSE 'neutral' END AS sentiment FROM events)
GROUP BY ALL""",
    "product_overview": f"""
WITH s AS (
  SELECT product_id, count(*) AS mentions, count(*) FILTER (sentiment = 'positive') AS positive_mentions
  FROM {SOCIAL_ROWS} WHERE product_id IS NOT NULL GROUP BY product_id),
r AS (
  SELECT product_id, count(*) AS reviews, count(*) FILTER (sentiment_api = 'positive') AS positive_reviews,
         avg(rating) AS mean_rating FROM {ECOMMERCE_ROWS} GROUP BY product_id)
SELECT product_id, coalesce(mentions, 0) AS mentions, coalesce(positive_mentions, 0) AS positive_mentions,
       coalesce(reviews, 0) AS reviews, coalesce(positive_reviews, 0) AS positive_reviews,
       round(mean_rating, 6) AS mean_rating
FROM s FULL JOIN r USING (product_id)""",
    "top_products": f"SELECT product_id, product_name, count(*) AS mentions, "
    f"round(avg(similarity_score), 4) AS mean_score FROM {SOCIAL_ROWS} WHERE product_id IS NOT NULL "
    "GROUP BY ALL ORDER BY mentions DESC, product_id LIMIT 10",
    "stream_clean": f"SELECT doc_id, {clean('text', 'social')} AS clean_text FROM documents",
    "stream_mention_map": f"""
WITH {FIT}, {vocab()}, {WEIGHTS}, {PROBE}
SELECT p.conv_id, p.turn, b.product_id, coalesce(round(b.dot / nn.norm, 6), 0.0) AS similarity_score
FROM new_posts p LEFT JOIN new_best b ON b.conv_id = p.conv_id AND b.turn = p.turn
LEFT JOIN new_norms nn ON nn.conv_id = p.conv_id AND nn.turn = p.turn""",
}
