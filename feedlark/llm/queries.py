"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm import (
    bpe, chat, decontam, hardneg, hilbert, linededup, neardup, prefixtrie, quality, secretscan, spotsigs, toxicity, warc,
)

SHARDS = 40
BPE_FILE = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id",
        "lang",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dimensions = {
        "size": F.col("size"),
        "lang": hilbert.text_rank(F.col("lang")),
        "source": hilbert.text_rank(F.col("source")),
        "doc_id": F.col("doc_id"),
    }
    placed = hilbert.hilbert_shards(docs, dimensions, SHARDS, ties=("text_crc32", "doc_id"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema)
    made = chat.format_conversations(rows.union(more))
    read = made.withColumn("turns", chat.read_back(F.col("formatted")))
    read = read.withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_spans")))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escaped",
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    read = warc.read_archives(warc.write_archives(pages, runtime.scratch_path(spark, "warc")))
    return read.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op5_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # names the vocabulary files; no other query needs it

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.with_round_trip(docs, public_tokenizers.path(BPE_FILE)).drop("text")


def op6_line_dedup(spark: SparkSession, folder: str, both_sides: bool = False) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = linededup.dedup_lines(docs, both_sides=both_sides)
    kept = F.coalesce("kept_text", F.lit(""))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_deleted",
        linededup.ranges(F.col("deleted")).alias("deleted"),
        F.length(kept).cast("long").alias("kept_chars"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def op6_line_dedup_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated runs with both their ends."""
    return op6_line_dedup(spark, folder, both_sides=True)


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, shingle=3, share=(85, 100)).withColumnRenamed("doc", "doc_id")


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secretscan.scan(docs).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secretscan.BASE]))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, r.kind))).cast("long").alias(f"n_{r.kind}") for r in secretscan.BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secretscan.joined_spans(base), 256).alias("base_sha256"),
        secretscan.joined_spans(F.col("spans")).alias("spans"),
    )


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = decontam.decontaminate(docs, table(spark, folder, "benchmark"), carry=["doc_id"])
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    judged = quality.robust_quality(quality.with_statistics(docs).drop("text"))
    return judged.select("doc_id", *quality.STATISTICS, "base_failed", "kept", "distance")


def op11_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spotsigs.edited_likeness(docs)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    conv = F.col("conv_id")
    heads = F.crc32(conv.cast("string").cast("binary")) % 4
    turns = prefixtrie.turn_rows(table(spark, folder, "conversations"))
    return prefixtrie.prefix_trie(prefixtrie.with_shared_starts(turns, conv - conv % 20, heads, most=3))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_hilbert_shards, op2_chat_format, op3_toxicity, op4_warc_archives, op5_bpe_round_trip, op6_line_dedup, op6_line_dedup_runs, op7_near_dedup, op8_secret_scan, op9_decontaminate, op10_quality_outliers, op11_spotsigs, op12_prefix_trie, op13_hard_negatives)}

def _secret_sql() -> str:
    """All matches of every rule by one pass of its expression over whole texts: no index."""
    parts = []
    for n, rule in enumerate(secretscan.BASE + secretscan.ADDED):
        pattern = rule.pattern
        for word in ("password", "passwd", "secret", "token", "api_?key"):  # either case, letter by letter
            pattern = pattern.replace(word, "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word))
        pattern = pattern.replace("(?i:", "(?:").replace("'", "''")
        parts.append(
            f"""
select doc_id, '{rule.kind}' as kind, {n} as rank, k,
       list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) as a,
       length(m[k]) as size
from (select doc_id, m, g, unnest(generate_series(1, len(m))) as k
      from (select doc_id, regexp_extract_all(t, '{pattern}') as m, string_split_regex(t, '{pattern}') as g from t))
where length(regexp_extract(m[k], '{pattern}', {rule.part})) >= {rule.least}"""
        )
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in secretscan.BASE)
    told = "string_agg(kind || ':' || a::bigint || ':' || (a + size)::bigint, ',' order by a, rank)"
    return f"""
with t as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(parts)}),
told as (
  select doc_id, {counts}, {told} as spans, {told} filter (rank < {len(secretscan.BASE)}) as base from found group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in secretscan.BASE)},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join told using (doc_id)"""


SQL: dict[str, str] = {
    # a text is in the way if it closes its own turn, or holds what the parser would unescape
    "op2_chat_format": r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select *, case role when 'system' then '[/SYS]' when 'user' then '[/INST]' when 'assistant' then '</s>' else '[/TURN]' end as closing,
         case role when 'system' then 5 when 'user' then 6 when 'assistant' then 5 else 7 + length(hex(encode(role))) end as opening
  from rows
), conflicts as (
  select conv_id, bool_or(contains(text, closing)
                          or regexp_matches(text, '[\[<]\\+(/?(SYS|INST|TURN)\]|OUT\]|TURN:[0-9A-F]*\]|/s>)')) as escaped
  from marked group by conv_id
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(opening + length(closing) + length(case when escaped then regexp_replace(
             text, '([\[<])(\\*)(/?(?:SYS|INST|TURN)\]|OUT\]|TURN:[0-9A-F]*\]|/s>)', '\1\\\2\3', 'g') else text end))::bigint
         as formatted_chars,
       any_value(escaped) as escaped
from marked join conflicts using (conv_id) group by conv_id""",
    "op8_secret_scan": _secret_sql(),
    # every window of every document against every window of every item
    "op9_decontaminate": r"""
with low as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), d as (select doc_id, regexp_extract_all(t, '[0-9a-z\x{80}-\x{10FFFF}]+') as w from low
), i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+') as w from benchmark
), iw as (
  select distinct item_id, least(13, len(w)) as n, list_slice(w, s, s + least(13, len(w)) - 1) as c
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) as s from i where len(w) > 0)
), dw as (
  select doc_id, s, n, list_slice(w, s, s + n - 1) as c
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as s from d, (select distinct n from iw) where len(w) >= n)
), m as (select doc_id, s, n, item_id from dw join iw using (n, c)
), h as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(s, s + n - 1)) as p from m) group by doc_id
), k as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as keys
  from (select distinct doc_id, item_id from m) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(keys, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join h using (doc_id) left join k using (doc_id)""",
    "op4_warc_archives": """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages),
     f as (select html, min(page_id) as first from p where n >= 100 group by html)
select p.page_id, n as payload_bytes, sha256(p.html) as payload_digest,
       case when first <> p.page_id then 'revisit' else 'response' end as record_type,
       case when first <> p.page_id then first end as refers_to
from p left join f using (html)""",
    # all prefixes of all conversations as lists, grouped; crc32 is computed bit by bit
    "op12_prefix_trie": r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as p
  from conversations where conv_id is not null
), c as (
  select conv_id, conv_id - conv_id % 20 as base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
             lambda s, x: list_reduce(list_prepend(xor(s, x), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
               lambda r, z: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end)), 4294967295) % 4 as h
  from (select distinct conv_id from t)
), g as (
  select c.conv_id, 0 as side, t.p, role, text from c join t on t.conv_id = c.base and t.p < h
  union all select c.conv_id, 1, t.p, role, text from c join t on t.conv_id = c.conv_id and t.p >= h
), s as (
  select conv_id, coalesce(list({'role': role, 'text': text} order by side, p) filter (role is not null), []) as seq
  from c left join g using (conv_id) group by conv_id
), x as (
  select conv_id, d, len(seq) = d as ended, list_slice(seq, 1, d) as key,
         case when d > 0 then len(regexp_extract_all(seq[d].text, '[^\x20\x09-\x0D]+')) else 0 end as w
  from (select *, unnest(generate_series(0, len(seq))) as d from s)
), n as (
  select min(conv_id) as node, d, key, any_value(w) as w, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256
  from x group by d, key
), m as (select x.conv_id, x.d, n.node from x join n using (d, key)
), above as (
  select n.node, n.d, m.node as up, m.d as up_d from n join m on m.conv_id = n.node and m.d <= n.d
), kids as (select up as node, up_d as d, count(*) as n_children from above where d = up_d + 1 group by all
), sub as (
  select a.up as node, a.up_d as d, sum((n.n_convs - 1) * n.w)::bigint as saved_tokens,
         count(*) filter (k.n_children is null) as n_leaves
  from above a join n on n.node = a.node and n.d = a.d left join kids k on k.node = a.node and k.d = a.d group by all
)
select n.node as conv_id, n.d::bigint as depth, a.up as parent_conv_id, n_convs, coalesce(n_children, 0) as n_children,
       n_leaves, saved_tokens, ends_sha256
from n join sub using (node, d) left join kids using (node, d)
left join above a on a.node = n.node and a.d = n.d and a.up_d = n.d - 1""",
    # every anchor against every row
    "op13_hard_negatives": """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, list_dot_product(a.v, b.v)::bigint as score
  from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5""",
    # every window of whole lines, compared with all others: no fingerprints
    "op6_line_dedup": r"""
with raw as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as place
  from documents
), keyed as (
  select doc_id, place, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as k,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as w
  from raw
), lines as (
  select *, row_number() over (partition by doc_id order by place) as i,
         sum(w) over (partition by doc_id order by place) as upto
  from keyed where w > 0
), windows as (
  select a.doc_id, a.place as first_place, max(b.place) as last_place, list(b.k order by b.i) as content
  from lines a join lines b on a.doc_id = b.doc_id and b.i between a.i and a.i + 49
       and b.upto - b.w - (a.upto - a.w) < 50
  group by a.doc_id, a.place
  having sum(b.w) >= 50
), later as (
  select doc_id, first_place, last_place from (
    select *, row_number() over (partition by content order by doc_id, first_place) as nth from windows)
  where nth > 1
), gone as (
  select distinct doc_id, unnest(generate_series(first_place, last_place)) as place from later
), runs as (
  select doc_id, min(place) as a, max(place) as b from (
    select doc_id, place, place - row_number() over (partition by doc_id order by place) as g from gone)
  group by doc_id, g
), told as (
  select doc_id, string_agg(a || '-' || b, ',' order by a) as deleted, sum(b - a + 1)::bigint as n from runs group by doc_id
), kept as (
  select doc_id, coalesce(string_agg(line, chr(10) order by place) filter (where not hit), '') as t, count(*) as n_lines
  from (select r.*, g.place is not null as hit from raw r left join gone g using (doc_id, place)) group by doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n, 0) as n_deleted, coalesce(deleted, '') as deleted,
       length(coalesce(t, ''))::bigint as kept_chars, sha256(coalesce(t, '')) as kept_sha256
from documents d left join kept using (doc_id) left join told using (doc_id)""",
}

# the windows of two lines at least that grow backward from their last line, beside those of op6_line_dedup
SQL["op6_line_dedup_runs"] = SQL["op6_line_dedup"].replace(
    """
), later as (""",
    """
  union
  select b.doc_id, min(a.place) as first_place, b.place as last_place, list(a.k order by a.i) as content
  from lines a join lines b on a.doc_id = b.doc_id and b.i between a.i and a.i + 49
       and (b.upto - a.upto < 50 or a.i = b.i - 1)
  group by b.doc_id, b.place
  having sum(a.w) >= 50
), later as (""",
)
