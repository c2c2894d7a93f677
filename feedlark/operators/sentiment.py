"""Sentiment labels: a scorer supplied by the user, a naive Bayes model, and their evaluation."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.functions.text import text_key, with_term_counts
from feedlark.operators.texts import attach, distinct_texts, long_tokens
from feedlark.schemas import LABELS, SENTIMENT_ECOMMERCE, SENTIMENT_SOCIAL, names

Reply = tuple[int | None, str | None, str | None]  # status, body, exception
MODEL_ROWS = 500_000  # the most model rows that are sent to every executor


def http_scorer(endpoint: str, timeout: float = 10.0) -> Callable[[], Callable[[list[str]], list[Reply]]]:
    """A scorer that POSTs {"text": …} and expects {"sentiment": …}, one request per text."""

    def client():
        def ask(text: str) -> Reply:
            body = json.dumps({"text": text}).encode()
            request = urllib.request.Request(endpoint, body, {"Content-Type": "application/json"})
            try:
                with urllib.request.urlopen(request, timeout=timeout) as reply:
                    return reply.status, reply.read().decode(), None
            except urllib.error.HTTPError as e:
                return e.code, None, None
            except Exception as e:  # noqa: BLE001 - a failed call is a value, not a failed job
                return None, None, str(e)

        return lambda texts: [ask(t) for t in texts]

    return client


def reply_label(status: Column | str, body: Column | str, exception: Column | str) -> Column:
    """The label of a reply; failures are values: UNKNOWN, ERROR_<status>, ERROR_<exception>."""
    status, body, exception = (F.col(c) if isinstance(c, str) else c for c in (status, body, exception))
    label = F.get_json_object(body, "$.sentiment")
    parsed = F.try_parse_json(body).isNotNull()
    return (
        F.when(exception.isNotNull(), F.concat(F.lit("ERROR_"), exception))
        .when((status == 200) & ~F.coalesce(parsed, F.lit(False)), F.lit("ERROR_invalid reply"))
        .when(status == 200, F.coalesce(label, F.lit("UNKNOWN")))
        .otherwise(F.concat(F.lit("ERROR_"), F.coalesce(status.cast("string"), F.lit("no reply"))))
    )


def reply_error(status: Column | str, body: Column | str, exception: Column | str) -> Column:
    """What went wrong with a reply, or null; kept apart from the label."""
    label = reply_label(status, body, exception)
    return F.when(label.startswith("ERROR_"), F.substring(label, 7, 1_000_000)).when(
        label == "UNKNOWN", F.lit("no sentiment in reply")
    )


def _failed(reply: Reply) -> bool:
    """Would the label of this reply be an `ERROR_…`?"""
    status, body, exception = reply
    if exception is not None or status != 200 or body is None:
        return True
    try:
        json.loads(body)
    except ValueError:
        return True
    return False


def with_retries(
    send: Callable[[list[str]], list[Reply]], retries: int, pause: float
) -> Callable[[list[str]], list[Reply]]:
    """`send`, which asks up to `retries` times more for the texts that failed, and for no others; the pause
    before is `pause` seconds, and twice as long each time."""

    def ask(texts: list[str]) -> list[Reply]:
        replies = list(send(texts))
        for turn in range(retries):
            again = [i for i, reply in enumerate(replies) if _failed(reply)]
            if not again:
                break
            time.sleep(pause * 2**turn)
            for i, reply in zip(again, send([texts[i] for i in again])):
                replies[i] = reply
        return replies

    return ask


REPLY_FIELDS = "status int, body string, exception string"


def _known_replies(texts: DataFrame, store: str) -> DataFrame:
    """(text_key, copies, status, body, exception) of the texts that the store has a reply for. Runs that wrote at
    the same time may have left two replies for a text; the least counts."""
    spark = texts.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"text_key binary, copies long, {REPLY_FIELDS}")
    kept = spark.read.schema(f"text_key binary, {REPLY_FIELDS}").parquet(store)
    kept = kept.groupBy("text_key").agg(F.min(F.struct("status", "body", "exception")).alias("reply"))
    return texts.select("text_key", "copies").join(kept, "text_key").select("text_key", "copies", "reply.*")


def score_texts(
    df: DataFrame,
    text: str,
    scorer: Callable[[], Callable[[list[str]], list[Reply]]],
    label: str = "sentiment",
    concurrency: int | None = None,
    hot_rows: int = runtime.HOT_ROWS,
    store: str | None = None,
    waves: int = 1,
    retries: int = 0,
    pause: float = 1.0,
) -> DataFrame:
    """Add `label` and `error` from a batch scorer.

    `scorer()` is called once per task and returns a function from a list of texts to replies.
    Equal texts are sent once; `concurrency` limits the tasks that talk to the scorer. Failed calls are
    repeated up to `retries` times within the task. Replies are stored before they are used, so a lost
    executor does not repeat the finished calls.

    `store` names a folder of replies by text that outlives the run: texts with a reply there are not
    sent, and replies other than failures are added to it. Texts are sent in `waves` (by their key), each
    added before the next begins, so a run that breaks off loses the replies of one wave at most.
    A failure stays a value of this run, and is asked again by the next. A store belongs to one scorer.
    """
    texts = df.groupBy(F.col(text).alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.withColumn("text_key", text_key("text")).filter("text_key IS NOT NULL")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = with_retries(scorer(), retries, pause)
        for frame in frames:
            replies = send(frame["text"].tolist())
            out = pd.DataFrame(replies, columns=["status", "body", "exception"], dtype=object)
            out.insert(0, "copies", frame["copies"].to_numpy())
            out.insert(0, "text_key", frame["text_key"].to_numpy())
            yield out

    def sent(some: DataFrame) -> DataFrame:
        some = some.repartition(concurrency, "text_key") if concurrency else some
        return some.mapInPandas(ask, f"text_key binary, copies long, {REPLY_FIELDS}")

    reply = ("status", "body", "exception")
    if store is None:
        replies = sent(texts)
    else:
        texts = runtime.pack(texts, "texts")
        replies = runtime.pack(_known_replies(texts, store), "known")
        # keys are distinct on both sides, so no task gets more than its share
        new = texts.join(replies.select("text_key"), "text_key", "left_anti")
        for wave in range(waves):
            mine = F.pmod(F.xxhash64("text_key"), F.lit(waves)) == wave
            asked = runtime.pack(sent(new.filter(mine)), "replies")
            good = asked.filter(~reply_label(*reply).startswith("ERROR_"))
            good.select("text_key", *reply).write.mode("append").parquet(store)
            replies = replies.unionByName(asked)
    replies = replies.select(
        "text_key", "copies", reply_label(*reply).alias(label), reply_error(*reply).alias("error")
    )
    return attach(df, text, replies, hot_rows)


@dataclass
class BayesModel:
    """Multinomial naive Bayes with add-one smoothing. `terms` has term and one ln(n + 1) column per
    label; the numbers per label are scalars."""

    terms: DataFrame
    labels: tuple[str, ...]
    log_prior: dict[str, float | None]  # None: the label does not occur
    log_total: dict[str, float]  # ln(tokens of the label + number of terms)


def label_terms(df: DataFrame, text: str, label: str, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """(term, one number per label): how often a term of at least 3 characters occurs under a label."""
    words = df.select(F.col(label).alias("_label"), F.explode(long_tokens(text)).alias("term"))
    return words.groupBy("term").agg(*[F.count_if(F.col("_label") == x).alias(x) for x in labels])


def train_bayes(df: DataFrame, text: str, label: str, labels: tuple[str, ...] = LABELS) -> BayesModel:
    terms = runtime.pack(label_terms(df, text, label, labels), "model")
    docs = df.agg(*[F.count_if(F.col(label) == x).alias(x) for x in labels]).first()
    totals = terms.agg(
        F.count(F.lit(1)).alias("_terms"), *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in labels]
    )
    ln = lambda c: F.ln(F.lit(c).cast("double"))
    n_docs = sum(docs)
    if not n_docs:
        raise ValueError("no row has a label to train from")
    logs = totals.select(
        *[F.ln(F.col(x) + F.col("_terms")).alias(f"t_{x}") for x in labels],
        *[(ln(docs[x]) - ln(n_docs)).alias(f"p_{x}") for x in labels],
    ).first()
    return BayesModel(
        terms.select("term", *[F.ln(F.col(x) + 1.0).alias(x) for x in labels]),
        labels,
        {x: logs[f"p_{x}"] if docs[x] else None for x in labels},
        {x: logs[f"t_{x}"] for x in labels},
    )


def _known_sums(words: DataFrame, terms: DataFrame, load: Column, sums: list[Column]) -> DataFrame:
    """`sums` by text_no over the `words` (text_no, term, …) that `terms` has, with its columns. `load` is large for
    terms of many words.

    The terms of most words, at most MODEL_ROWS, are sent to every executor, and their words are summed where they lie:
    a text's words lie together, which leaves one row for it. Only the words of the other terms are shuffled.
    """
    power = F.floor(F.log2(F.greatest(load, F.lit(1.0)))).cast("int")
    sizes = terms.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each power of two
    held, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["power"]):
        if held + r["n"] > MODEL_ROWS:
            break
        held, least = held + r["n"], r["power"]
    if held == sum(r["n"] for r in sizes):
        return words.join(F.broadcast(terms), "term").groupBy("text_no").agg(*sums)
    frequent = power >= least if held else F.lit(False)
    sent = terms.filter(frequent)
    near = words.join(F.broadcast(sent), "term").groupBy("text_no").agg(*sums)
    others = words.join(F.broadcast(sent.select("term")), "term", "left_anti")
    far = others.join(terms.filter(~frequent), "term").groupBy("text_no").agg(*sums)
    names = [c for c in near.columns if c != "text_no"]
    return near.unionByName(far).groupBy("text_no").agg(*[F.sum(c).alias(c) for c in names])


def bayes_scores(texts: DataFrame, model: BayesModel) -> DataFrame:
    """(text_key, copies, sentiment, one score per label) of each distinct text.

    Words that the model does not know are left out. Scores are rounded to 6 decimals; equal scores
    go to the first label by name.
    """
    of_label = [F.sum(F.col("tf") * F.col(x)).alias(x) for x in model.labels]
    seen = sum((F.exp(x) for x in model.labels), F.lit(0.0))
    words = texts.select("text_no", F.inline("bag"))
    sums = _known_sums(words, model.terms, seen, [F.sum("tf").alias("_n"), *of_label])
    # one row per distinct text on both sides
    scored = texts.select("text_no", "text_key", "copies").join(sums, "text_no", "left")
    used = sorted(x for x in model.labels if model.log_prior[x] is not None)
    n = F.coalesce("_n", F.lit(0))
    scored = scored.select(
        "text_key",
        "copies",
        *[
            F.round(model.log_prior[x] + F.coalesce(x, F.lit(0.0)) - n * model.log_total[x], 6).alias(x)
            for x in used
        ],
    )
    best = F.greatest(*used) if len(used) > 1 else F.col(used[0])
    label = F.coalesce(*[F.when(F.col(x) == best, F.lit(x)) for x in used])
    return scored.select("text_key", "copies", label.alias("sentiment"), *used)


def bayes_label(
    df: DataFrame,
    text: str,
    model: BayesModel,
    label: str = "sentiment",
    keep_scores: bool = False,
    hot_rows: int = runtime.HOT_ROWS,
) -> DataFrame:
    """Add the model's label for the cleaned text in column `text`."""
    texts = distinct_texts(df, text, tokens=long_tokens, counted=lambda _: F.lit(True))  # no idf here
    scores = bayes_scores(texts, model)
    if not keep_scores:
        scores = scores.select("text_key", "copies", "sentiment")
    return attach(df, text, scores.withColumnRenamed("sentiment", label), hot_rows)


def cross_label(
    df: DataFrame,
    text: str,
    label: str,
    fold: str,
    folds: int,
    out: str = "sentiment",
    labels: tuple[str, ...] = LABELS,
    hot_rows: int = runtime.HOT_ROWS,
) -> DataFrame:
    """Add `out` to every row: the naive Bayes label by the model of the rows of all other folds.

    `fold` holds numbers from 0 to `folds` - 1. Each distinct text is cut into words once and carries how
    many of its rows lie in each fold under each label. So one aggregate counts the terms of all folds,
    a fold's model is the total less the fold's own counts, and one join scores a text by all models.

    Rows without a label are labelled, but not learnt from. A row whose fold is null or out of range is
    neither; nor is a row labelled if no other fold has a label. Copies of a text may lie in several folds,
    and then a model may have seen the words of a row it labels.
    """
    if folds < 2:
        raise ValueError("at least two folds are needed")
    cells = [(f, x) for f in range(folds) for x in labels]
    rows_of = [F.count_if((F.col(fold) == f) & (F.col(label) == x)) for f, x in cells]
    texts = df.groupBy(F.col(text).alias("text")).agg(
        F.count(F.lit(1)).alias("copies"), F.array(*rows_of).alias("cells")
    )
    texts = texts.select(
        text_key("text").alias("text_key"), "copies", "cells", long_tokens("text").alias("tokens")
    )
    texts = with_term_counts(texts, "tokens").withColumn("text_no", F.monotonically_increasing_id())
    texts = runtime.pack(texts, "texts")
    words = texts.select("text_no", "cells", F.inline("bag"))

    name = {cell: f"c{i}" for i, cell in enumerate(cells)}
    add_up = lambda factor: [
        F.sum(factor * F.col("cells")[i]).alias(name[cell]) for i, cell in enumerate(cells)
    ]
    own = words.filter(F.exists("cells", lambda n: n > 0)).groupBy("term").agg(*add_up(F.col("tf")))
    everywhere = {x: sum((F.col(name[f, x]) for f in range(folds)), F.lit(0)) for x in labels}
    # the columns of a term from here on: its count under a label in all folds but one
    others = runtime.pack(
        own.select("term", *[(everywhere[x] - F.col(name[f, x])).alias(name[f, x]) for f, x in cells]), "model"
    )

    docs = texts.agg(*add_up(F.lit(1))).first()
    n_docs = {cell: sum(docs[name[g, cell[1]]] or 0 for g in range(folds) if g != cell[0]) for cell in cells}
    all_docs = {f: sum(n_docs[f, x] for x in labels) for f in range(folds)}
    if not sum(all_docs.values()):
        raise ValueError("no row in a fold has a label to train from")
    used = {f: sorted(x for x in labels if n_docs[f, x]) for f in range(folds) if all_docs[f]}
    in_model = {f: sum((F.col(name[f, x]) for x in labels), F.lit(0)) > 0 for f in used}
    totals = others.agg(
        *[F.count_if(in_model[f]).alias(f"n{f}") for f in used],
        *[F.coalesce(F.sum(name[f, x]), F.lit(0)).alias(name[f, x]) for f in used for x in used[f]],
    )
    ln = lambda n: F.ln(F.lit(n).cast("double"))
    logs = totals.select(
        *[F.ln(F.col(name[f, x]) + F.col(f"n{f}")).alias(f"t_{name[f, x]}") for f in used for x in used[f]],
        *[(ln(n_docs[f, x]) - ln(all_docs[f])).alias(f"p_{name[f, x]}") for f in used for x in used[f]],
    ).first()

    seen = sum((F.col(name[cell]) for cell in cells), F.lit(0.0))
    sums = _known_sums(words.drop("cells"), others, seen, [
        *[F.sum(F.when(in_model[f], F.col("tf"))).alias(f"n{f}") for f in used],
        *[F.sum(F.when(in_model[f], F.col("tf") * F.ln(F.col(name[f, x]) + 1.0))).alias(name[f, x])
          for f in used for x in used[f]],
    ])

    def best_label(f: int) -> Column:
        n = F.coalesce(f"n{f}", F.lit(0))
        scores = [
            F.round(logs[f"p_{c}"] + F.coalesce(c, F.lit(0.0)) - n * logs[f"t_{c}"], 6)
            if logs[f"t_{c}"] is not None else F.lit(logs[f"p_{c}"])  # a model without a word: n is 0
            for c in (name[f, x] for x in used[f])
        ]
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        return F.coalesce(*[F.when(score == best, F.lit(x)) for x, score in zip(used[f], scores)])

    by_fold = [best_label(f) if f in used else F.lit(None).cast("string") for f in range(folds)]
    results = texts.select("text_no", "text_key", "copies").join(sums, "text_no", "left")
    results = results.select("text_key", "copies", F.array(*by_fold).alias("_by_fold"))
    place = F.when((F.col(fold) >= 0) & (F.col(fold) < folds), F.col(fold).cast("int"))
    return attach(df, text, results, hot_rows).withColumn(out, F.col("_by_fold")[place]).drop("_by_fold")


def ecommerce_table(scored: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The stored review table: human and model label side by side. `scored` has the cleaned review
    columns, the human `sentiment` and the model's `sentiment_api`; of `columns`, only what they need."""
    renamed = scored.withColumnRenamed("sentiment", "sentiment_humanlabels")
    return renamed.select(*(columns or names(SENTIMENT_ECOMMERCE)))


def social_table(scored: DataFrame, key: str, text: str, columns: list[str] | None = None) -> DataFrame:
    """The stored mention table, from mapped posts with a `sentiment` column; of `columns`, only what they need."""
    made = {
        "review_id": F.col(key).cast("bigint"),
        "review_text": F.col(text),
        "product_id": F.col("product_id").cast("string"),
    }
    return scored.select(*(made.get(c, F.col(c)).alias(c) for c in columns or names(SENTIMENT_SOCIAL)))


def confusion(df: DataFrame, human: str, model: str) -> DataFrame:
    """(human_label, model_label, row_count); rows without a human label are left out."""
    pairs = df.filter(F.col(human).isNotNull()).groupBy(
        F.col(human).alias("human_label"), F.col(model).alias("model_label")
    )
    return pairs.agg(F.count(F.lit(1)).alias("row_count"))


def label_quality(pairs: DataFrame) -> DataFrame:
    """Per label: rows, hits, precision, recall, and the accuracy over all labels.

    `pairs` is the small table made by `confusion`: one row per pair of labels.
    """
    hit = F.when(F.col("human_label") == F.col("model_label"), F.col("row_count")).otherwise(0)
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("human_label").alias("label"), F.col("row_count").alias("human"),
                         F.lit(0).cast("long").alias("model"), hit.alias("hits")),
                F.struct(F.col("model_label").alias("label"), F.lit(0).cast("long").alias("human"),
                         F.col("row_count").alias("model"), F.lit(0).cast("long").alias("hits")),
            )
        ).alias("s")
    ).select("s.*")
    per_label = sides.groupBy("label").agg(
        F.sum("human").alias("human_rows"), F.sum("model").alias("model_rows"), F.sum("hits").alias("hits")
    )
    total = pairs.agg(F.sum(hit).alias("all_hits"), F.sum("row_count").alias("all_rows")).first()
    accuracy = total["all_hits"] / total["all_rows"] if total["all_rows"] else None
    ratio = lambda a, b: F.round(F.when(F.col(b) > 0, F.col(a) / F.col(b)), 6)
    return per_label.select(
        "label", "human_rows", "model_rows", "hits",
        ratio("hits", "model_rows").alias("label_precision"),
        ratio("hits", "human_rows").alias("label_recall"),
        F.round(F.lit(accuracy).cast("double"), 6).alias("accuracy"),
    )
