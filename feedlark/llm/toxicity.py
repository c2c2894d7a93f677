"""Toxicity by weak supervision.

Voters are words (a lexicon) and patterns (word beginnings, shouting, strings of exclamation marks). A
voter speaks if a text has its term, and is silent otherwise. A generative label model says how often
each voter speaks on toxic and on other texts; expectation maximisation fits these rates, and the
correlations of the voters within a class, to the votes of all texts, and correlated voters share
their weight. A linear classifier is then trained on the posterior labels and scores any text.

Voters are proposed from, and the classifier is trained on, at most `MOST_ROWS` labelled rows, those of the
least hashed ids; the label model counts the votes of all texts. Only the text is ever an input of a
score. Rows of `is_held_out` take no part in learning from labels.

Defined results: null and empty texts have no terms and get the score of a text on which all are
silent; repeated labels of an id count as toxic if one of them says so; null labels are left out; without
labels, or without any term that speaks for toxicity, all scores are the assumed share of toxic texts.
Repeated rows get equal scores. All columns of the input
are kept, but for those named like an added one.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import shield, unshield

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_ROWS = 20_000  # labelled rows that voters and classifier are learned from
VOTERS = 200  # the terms with the strongest evidence
FEATURES = 2_000  # terms of the classifier
LEAST_SUPPORT = 3  # rows that have a term
LEAST_EVIDENCE = 12.0  # likelihood ratio statistic of a term
ANCHOR = 4.0  # weight of the labelled rows' counts beside those of all texts
DEPENDENT = 0.7  # correlation within a class from which voters share their weight
BEGINNINGS = (3, 4, 5)  # letters of the patterns for beginnings of words
ROUNDS = 12
FOLDS, TEST_FOLD = 5, 0
RIDGE = 1e-4

WORD = re.compile(r"[^\W\d_]+")


def is_held_out(doc: Column) -> Column:
    remainder = F.crc32(doc.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == TEST_FOLD, F.lit(False))


def terms(text: str | None) -> set[str]:
    """Words, beginnings of words (with *) and cues (with ~) of a whole text."""
    if not text:
        return set()
    words = WORD.findall(text)
    distinct = {w.lower() for w in set(words)}
    found = {w[:n] + "*" for n in BEGINNINGS for w in distinct if len(w) > n}
    found |= distinct
    if "!!" in text:
        found.add("~exclamation")
    if sum(len(w) > 2 and w.isupper() for w in words) * 10 > len(words):
        found.add("~shouting")
    return found


@dataclass
class Model:
    """Weights of terms and a bias; `voters` with the rates and weights that the label model found."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    voters: list[str] = field(default_factory=list)
    on_toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    on_other: np.ndarray = field(default_factory=lambda: np.zeros(0))
    share: np.ndarray = field(default_factory=lambda: np.zeros(0))
    correlation: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> DataFrame:
    """(doc, text, label): at most `most` labelled rows that are not held out; stored."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~is_held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("doc")).agg(F.max(label).cast("int").alias("label"))
    chosen = runtime.materialise(known.orderBy(F.xxhash64("doc"), "doc").limit(most), "chosen")
    texts = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # at most `most` rows of two numbers
    return runtime.materialise(texts.join(F.broadcast(chosen), "doc"), "sample")


def propose(rows: DataFrame) -> list[tuple[str, int, int]]:
    """(term, toxic rows, other rows) of the terms with the strongest evidence for either class."""

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), 200):
                part = frame.iloc[i : i + 200]
                found = [(t, label) for text, label in zip(part["text"], part["label"]) for t in terms(text)]
                yield pd.DataFrame(found, columns=["term", "label"])

    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = rows.select("text", "label").mapInPandas(pairs, "term string, label int").groupBy("term")
    counts = counts.agg(F.sum("label").alias("a"), (F.count(F.lit(1)) - F.sum("label")).alias("b"))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    all_rows, share = max(n, 1), toxic / max(n, 1)
    seen = F.col("a") + F.col("b")
    evidence = 2 * (
        part(F.col("a"), seen * share)
        + part(F.col("b"), seen * (1 - share))
        + part(toxic - F.col("a"), (all_rows - seen) * share)
        + part(all_rows - toxic - F.col("b"), (all_rows - seen) * (1 - share))
    )
    strong = counts.filter(seen >= LEAST_SUPPORT).withColumn("evidence", evidence)
    strong = strong.filter(F.col("evidence") >= LEAST_EVIDENCE).orderBy(F.desc("evidence"), "term").limit(FEATURES)
    return [(r["term"], r["a"], r["b"]) for r in strong.collect()]


def distinct_voters(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Without terms that speak as often as a stronger one that is their beginning or goes on from it."""
    kept: dict[str, tuple[str, int, int]] = {}
    for term, a, b in found:
        letters = term.rstrip("*")
        near = [letters[:n] for n in range(1, len(letters) + 1)] + [k for k in kept if k.startswith(letters)]
        if not any(n in kept and kept[n][1:] == (a, b) for n in near):
            kept[letters] = (term, a, b)
    return list(kept.values())


def votes_of(text: str, voters: list[str]) -> Column:
    """The numbers of the speaking voters, sorted and joined by commas."""
    number = {t: str(i) for i, t in enumerate(voters)}

    @F.pandas_udf("string")
    def votes(texts: pd.Series) -> pd.Series:
        return pd.Series([",".join(sorted(map(number.__getitem__, number.keys() & terms(t)))) for t in texts])

    return votes(F.col(text))


def vote_patterns(docs: DataFrame, text: str, voters: list[str]) -> DataFrame:
    """(votes, n): how many texts have each set of speaking voters; of all texts, stored."""
    counted = docs.select(votes_of(text, voters).alias("votes")).groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    return runtime.materialise(counted, "votes")


def _logits(model: Model, prior: float) -> tuple[float, np.ndarray]:
    """Log odds if all are silent, and what each voter adds by speaking."""
    silent = np.log((1 - model.on_toxic) / (1 - model.on_other))
    speaking = np.log(model.on_toxic / model.on_other)
    return math.log(prior / (1 - prior)) + float(model.share @ silent), model.share * (speaking - silent)


def _probability(z: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def rates(spoke: np.ndarray, rows: float) -> np.ndarray:
    return np.clip((spoke + 0.1) / (rows + 10), 1e-6, 1 - 1e-6)


def fit_label_model(
    patterns: DataFrame, voters: list[str], seen: np.ndarray, known: tuple[int, int], prior: float
) -> Model:
    """Expectation maximisation over the vote patterns, beginning with the counts of
    the labelled rows, `seen` by class and voter, of `known` rows by class; they keep `ANCHOR` times the
    weight of all texts, since posteriors alone may drift to other classes. A round sends back sums for every pair of
    voters that spoke together: at most VOTERS squared rows, whatever the corpus."""
    k = len(voters)
    bias = math.log(prior / (1 - prior))
    model = Model(bias, {}, voters, rates(seen[0], known[0]), rates(seen[1], known[1]), np.ones(k))
    for _ in range(ROUNDS):
        base, added = _logits(model, prior)

        def expect(frames: Iterator[pd.DataFrame], base=base, added=added) -> Iterator[pd.DataFrame]:
            toxic, other = np.zeros((k + 1, k)), np.zeros((k + 1, k))
            sums = np.zeros(2)
            for frame in frames:
                for votes, n in zip(frame["votes"], frame["n"]):
                    fired = [int(v) for v in votes.split(",")] if votes else []
                    q = _probability(base + float(added[fired].sum()))
                    sums += (n * q, n * (1 - q))
                    if fired:
                        toxic[np.ix_(fired, fired)] += n * q
                        other[np.ix_(fired, fired)] += n * (1 - q)
            i, j = np.nonzero(toxic[:k] + other[:k])
            yield pd.DataFrame({"i": [-1, *i], "j": [-1, *j], "t": [sums[0], *toxic[i, j]], "o": [sums[1], *other[i, j]]})

        told = patterns.mapInPandas(expect, "i int, j int, t double, o double")
        told = told.groupBy("i", "j").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).collect()
        toxic, other, total = np.zeros((k, k)), np.zeros((k, k)), (0.0, 0.0)
        for r in told:
            if r["i"] < 0:
                total = (r["t"], r["o"])
            else:
                toxic[r["i"], r["j"]], other[r["i"], r["j"]] = r["t"], r["o"]
        weight = ANCHOR * sum(total) / sum(known)
        on_toxic = rates(weight * seen[0] + np.diag(toxic), weight * known[0] + total[0])
        on_other = rates(weight * seen[1] + np.diag(other), weight * known[1] + total[1])
        spoke = np.clip(np.diag(toxic) / max(total[0], 1e-9), 1e-6, 1 - 1e-6)
        spread = np.sqrt(spoke * (1 - spoke))
        correlation = (toxic / max(total[0], 1e-9) - np.outer(spoke, spoke)) / np.outer(spread, spread)
        np.fill_diagonal(correlation, 0.0)
        share = 1 / (1 + np.where(correlation >= DEPENDENT, np.minimum(correlation, 1), 0).sum(axis=1))
        change = float(np.abs(on_toxic - model.on_toxic).max())
        model = Model(bias, {}, voters, on_toxic, on_other, share, correlation)
        if change < 1e-4:
            break
    return model


def train(rows: list[list[int]], labels: np.ndarray, n: int, rounds: int = 1500) -> tuple[float, np.ndarray]:
    """Logistic regression on binary features and soft labels, by accelerated gradient steps with the
    diagonal of the curvature as scale."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    which = np.array([f for r in rows for f in r], dtype=int)
    mean = min(max(float(labels.mean()), 1e-4), 1 - 1e-4)
    bias, weights = math.log(mean / (1 - mean)), np.zeros(n)
    widest = max((len(r) for r in rows), default=1) + 1
    scale = np.bincount(which, minlength=n) / len(rows) * 0.25 * min(widest, 40) + RIDGE
    ahead, ahead_bias, last, last_bias = weights, bias, weights, bias
    for turn in range(rounds):
        z = ahead_bias + np.bincount(at, ahead[which], minlength=len(rows))
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels
        gradient = np.bincount(which, error[at], minlength=n) / len(rows) + RIDGE * ahead
        weights, bias = ahead - gradient / scale, ahead_bias - float(error.mean())
        push = turn / (turn + 3)
        ahead, ahead_bias = weights + push * (weights - last), bias + push * (bias - last_bias)
        last, last_bias = weights, bias
    return bias, weights


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST_ROWS
) -> Model:
    rows = sample(docs, labels, key, text, label, most)
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    found = propose(rows)
    speaking = distinct_voters([t for t in found if t[1] >= LEAST_SUPPORT and t[1] > t[2]])[:VOTERS]
    voters = [t for t, _, _ in speaking]
    prior = (toxic + 1) / (n + 20)
    if not voters:
        return Model(math.log(prior / (1 - prior)))
    seen = np.array([[a for _, a, _ in speaking], [b for _, _, b in speaking]], dtype=float)
    model = fit_label_model(vote_patterns(docs, text, voters), voters, seen, (toxic, n - toxic), prior)
    names = {t: i for i, (t, _, _) in enumerate(found)}
    number = {t: i for i, t in enumerate(voters)}
    base, added = _logits(model, prior)

    def active(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            features, soft = [], []
            for text in frame["text"]:  # a text's terms are many times its size: one set at a time
                have = terms(text)
                features.append([names[t] for t in names.keys() & have])
                soft.append(_probability(base + float(added[[number[t] for t in number.keys() & have]].sum())))
            yield pd.DataFrame({"features": features, "soft": soft})

    got = rows.select("text").mapInPandas(active, "features array<int>, soft double").toPandas()
    bias, weights = train([list(f) for f in got["features"]], got["soft"].to_numpy(), len(names))
    model.bias, model.weights = bias, {t: float(weights[i]) for t, i in names.items()}
    return model


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with score (0 to 1) and predicted (1 from a score of 0.5)."""
    df, names = shield(df.withColumn("__text", F.col(text)), "__text")
    bias, weights = model.bias, model.weights

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        sums = [bias + math.fsum(map(weights.__getitem__, weights.keys() & terms(t))) for t in texts]
        return pd.Series([_probability(s) for s in sums], dtype=float)

    scored = df.select(*names.values(), probability(F.col("__text")).alias("score"))
    return unshield(scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), names)
