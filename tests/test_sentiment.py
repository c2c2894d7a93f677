import io
import math
import urllib.error
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlark.operators import sentiment as S


def test_reply_labels(spark, rows):
    replies = [
        (1, 200, '{"sentiment": "positive"}', None), (2, 200, "{}", None), (3, 503, None, None),
        (4, None, None, "timeout"), (5, 200, "no JSON", None), (6, None, None, None), (7, 200, None, None),
    ]
    df = spark.createDataFrame(replies, "i int, status int, body string, exception string")
    reply = ("status", "body", "exception")
    got = rows(df.select("i", S.reply_label(*reply), S.reply_error(*reply)))
    assert got == [
        (1, "positive", None), (2, "UNKNOWN", "no sentiment in reply"), (3, "ERROR_503", "503"),
        (4, "ERROR_timeout", "timeout"), (5, "ERROR_invalid reply", "invalid reply"),
        (6, "ERROR_no reply", "no reply"), (7, "ERROR_invalid reply", "invalid reply"),
    ]


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_each_text_is_scored_once(spark, rows, tmp_path, hot_rows):
    log = str(tmp_path)

    def scorer():
        def send(texts):
            import uuid

            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(texts))
            return [(200, '{"sentiment": "%s"}' % t.upper(), None) for t in texts]

        return send

    df = spark.createDataFrame([(i, "same") for i in range(9)] + [(9, "other"), (10, None)], "i int, t string")
    got = S.score_texts(df, "t", scorer, concurrency=2, hot_rows=hot_rows)
    assert rows(got.select("i", "sentiment")) == sorted(
        [(i, "SAME") for i in range(9)] + [(9, "OTHER"), (10, None)], key=repr
    )
    sent = Counter(x for p in tmp_path.iterdir() for x in p.read_text().split())
    assert sent == {"same": 1, "other": 1}


def counting_scorer(log, bad=(), broken=()):
    """Every text that is sent leaves a line; `bad` ones fail, and a `broken` one ends the job."""

    def scorer():
        def send(texts):
            import uuid

            if set(broken) & set(texts):
                raise RuntimeError("service gone")
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(texts))
            return [(503, None, None) if t in bad else (200, '{"sentiment": "%s"}' % t.upper(), None) for t in texts]

        return send

    return scorer


def sent_texts(folder):
    return Counter(x for p in folder.iterdir() for x in p.read_text().split())


@pytest.mark.parametrize("waves", [1, 3])
def test_replies_outlive_a_run(spark, rows, tmp_path, waves):
    logs = [tmp_path / f"log{i}" for i in range(4)]
    for log in logs:
        log.mkdir()
    store = str(tmp_path / "store")
    texts = [f"t{i}" for i in range(12)]
    df = spark.createDataFrame([(i, texts[i % 12]) for i in range(40)] + [(99, None)], "i int, t string")

    def run(log, bad=(), frame=df):
        got = S.score_texts(frame, "t", counting_scorer(str(log), bad), concurrency=2, store=store, waves=waves)
        return rows(got.select("i", "sentiment", "error"))

    want = lambda bad: sorted(
        [(i, "ERROR_503" if texts[i % 12] in bad else f"T{i % 12}", "503" if texts[i % 12] in bad else None) for i in range(40)]
        + [(99, None, None)], key=repr)
    assert run(logs[0], bad=("t3", "t7")) == want(("t3", "t7"))
    assert sent_texts(logs[0]) == Counter(texts)
    assert run(logs[1]) == want(())  # the failed ones only
    assert sent_texts(logs[1]) == Counter(["t3", "t7"])
    assert run(logs[2]) == want(())  # none
    assert sent_texts(logs[2]) == Counter()
    more = df.union(spark.createDataFrame([(100, "new")], df.schema))
    assert (100, "NEW", None) in run(logs[3], frame=more)
    assert sent_texts(logs[3]) == Counter(["new"])
    empty = spark.createDataFrame([], df.schema)
    assert run(logs[3], frame=empty) == []


def test_a_broken_run_keeps_its_finished_waves(spark, rows, tmp_path):
    logs = [tmp_path / "log0", tmp_path / "log1"]
    for log in logs:
        log.mkdir()
    texts, waves, store = [f"t{i}" for i in range(20)], 4, str(tmp_path / "store")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wave = F.pmod(F.xxhash64(S.text_key("t")), F.lit(waves)).alias("w")
    of = {r.t: r.w for r in df.select("t", wave).collect()}
    last = next(t for t in texts if of[t] == 2)
    with pytest.raises(Exception, match="service gone"):
        S.score_texts(df, "t", counting_scorer(str(logs[0]), broken=(last,)), concurrency=1, store=store, waves=waves)
    got = S.score_texts(df, "t", counting_scorer(str(logs[1])), store=store, waves=waves)
    assert rows(got.select("t", "sentiment")) == sorted([(t, t.upper()) for t in texts], key=repr)
    assert sent_texts(logs[1]) == Counter(t for t in texts if of[t] >= 2)


def test_only_failures_are_asked_again(monkeypatch):
    calls, slept = [], []
    monkeypatch.setattr(S.time, "sleep", slept.append)
    ok, down = (200, '{"sentiment": "neutral"}', None), (503, None, None)
    turns = [{"a": ok, "b": down, "c": (200, "no JSON", None), "d": (200, "{}", None)}, {"b": (None, None, "x"), "c": ok}, {"b": ok}]

    def send(texts):
        calls.append(texts)
        return [turns[len(calls) - 1][t] for t in texts]

    assert S.with_retries(send, 5, 0.5)(["a", "b", "c", "d"]) == [ok, ok, ok, (200, "{}", None)]
    assert calls == [["a", "b", "c", "d"], ["b", "c"], ["b"]] and slept == [0.5, 1.0]


def test_http_scorer(monkeypatch):
    class Answer(io.BytesIO):
        status = 200

    def urlopen(request, timeout):
        assert timeout == 10.0
        if b"down" in request.data:
            raise urllib.error.HTTPError("u", 503, "m", None, None)
        if b"slow" in request.data:
            raise TimeoutError("timed out")
        return Answer(b'{"sentiment": "neutral"}')

    monkeypatch.setattr(S.urllib.request, "urlopen", urlopen)
    send = S.http_scorer("http://host/predict")()
    assert send(["ok", "down", "slow"]) == [
        (200, '{"sentiment": "neutral"}', None), (503, None, None), (None, None, "timed out")]


TRAIN = [("good phone good", "positive"), ("nice good case", "positive"), ("bad phone", "negative"), ("phone", "neutral")]


def by_hand(text):
    docs = Counter(x for _, x in TRAIN)
    n = {x: Counter(w for t, y in TRAIN if y == x for w in t.split()) for x in docs}
    terms = {w for c in n.values() for w in c}
    return {
        x: round(math.log(docs[x] / len(TRAIN)) + sum(
            math.log((n[x][w] + 1) / (sum(n[x].values()) + len(terms))) for w in text.split() if w in terms
        ), 6)
        for x in docs
    }


@pytest.mark.parametrize("model_rows, hot_rows", [(500_000, 1_000_000), (0, 1), (0, 1_000_000)])
def test_bayes_by_hand(spark, monkeypatch, model_rows, hot_rows):
    monkeypatch.setattr(S, "MODEL_ROWS", model_rows)
    model = S.train_bayes(spark.createDataFrame(TRAIN, "t string, y string"), "t", "y")
    texts = ["good phone", "bad bad case", "unseen words", "", "phone", "phone", "phone"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = S.bayes_label(df, "t", model, keep_scores=True, hot_rows=hot_rows).collect()
    assert len(got) == len(texts)
    for r in got:
        want = by_hand(r.t)
        assert {x: getattr(r, x) for x in want} == pytest.approx(want, abs=2e-6)
        assert r.sentiment == max(sorted(want), key=lambda x: want[x])


def test_a_label_that_does_not_occur_is_never_given(spark):
    rows = [r for r in TRAIN if r[1] != "neutral"]
    model = S.train_bayes(spark.createDataFrame(rows, "t string, y string"), "t", "y")
    got = S.bayes_label(spark.createDataFrame([("phone",)], "t string"), "t", model, keep_scores=True)
    assert got.columns == ["t", "sentiment", "negative", "positive"]


def test_quality(spark, rows):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), (None, "a")], "h string, m string")
    pairs = S.confusion(df, "h", "m")
    assert rows(pairs) == [("a", "a", 1), ("a", "b", 1), ("b", "b", 2)]
    assert rows(S.label_quality(pairs)) == [
        ("a", 2, 1, 1, 1.0, 0.5, 0.75), ("b", 2, 3, 2, 0.666667, 1.0, 0.75)]
    assert rows(S.label_quality(pairs.filter("false"))) == []


def test_stored_columns(spark):
    df = spark.range(1).select(*[F.lit("x").alias(c) for c in (
        "product_id product_name rating review_text sentiment platform clean_product_name clean_text_review sentiment_api"
    ).split()])
    assert "sentiment_humanlabels" in S.ecommerce_table(df).columns


def test_training_without_labels_says_so(spark):
    df = spark.createDataFrame([("a b c", None)], "clean string, human string")
    with pytest.raises(ValueError, match="label"):
        S.train_bayes(df, "clean", "human")


@pytest.mark.parametrize("model_rows, hot_rows", [(500_000, 1_000_000), (0, 1)])
def test_cross_label_is_a_model_for_each_fold(spark, monkeypatch, model_rows, hot_rows):
    monkeypatch.setattr(S, "MODEL_ROWS", model_rows)
    words = "good bad phone case slow fast box cable".split()
    data = [
        (i, i % 4, " ".join(words[(i * j + i // 5) % 8] for j in range(1, 2 + i % 5)), ("negative", "neutral", "positive")[i * i % 3])
        for i in range(60)
    ]
    data += [(60, 0, "good phone", None), (61, 1, None, "positive"), (62, 2, "", "negative"), (63, None, "bad", "negative"),
             (64, 9, "bad", "negative"), (65, 3, "bad bad bad", "negative"), (66, 3, "only here", "neutral")]
    df = spark.createDataFrame(data, "i int, fold int, t string, y string")
    got = {r.i: r.sentiment for r in S.cross_label(df, "t", "y", "fold", 4, hot_rows=hot_rows).collect()}
    want = dict.fromkeys([63, 64])
    for f in range(4):
        model = S.train_bayes(df.filter(f"fold BETWEEN 0 AND 3 AND fold <> {f} AND y IS NOT NULL"), "t", "y")
        want |= {r.i: r.sentiment for r in S.bayes_label(df.filter(f"fold = {f}"), "t", model).collect()}
    assert got == want and len(set(got.values())) > 2


def test_cross_label_with_too_few_labels(spark):
    df = lambda *rows: spark.createDataFrame(rows, "t string, y string, fold int")
    with pytest.raises(ValueError, match="label"):
        S.cross_label(df(("a b c", None, 0)), "t", "y", "fold", 2)
    with pytest.raises(ValueError, match="folds"):
        S.cross_label(df(("abc", "positive", 0)), "t", "y", "fold", 1)
    got = S.cross_label(df(("abc", "positive", 0)), "t", "y", "fold", 2).collect()
    assert [r.sentiment for r in got] == [None]
    got = S.cross_label(df(("abc", "positive", 0), ("abc", None, 1), (None, "negative", 0)), "t", "y", "fold", 2).collect()
    assert sorted((r.fold, str(r.t), r.sentiment) for r in got) == [(0, "None", None), (0, "abc", None), (1, "abc", "negative")]


def test_cross_label_counts_words_once(spark, capsys):
    df = spark.createDataFrame([("abc def", "positive", i) for i in range(3)], "t string, y string, fold int")
    S.cross_label(df, "t", "y", "fold", 3).explain()
    plan = capsys.readouterr().out
    # the words of a text are cut when texts are stored, not once for each fold
    assert "regexp" not in plan and "split" not in plan


def test_only_words_of_rare_terms_are_shuffled(spark, monkeypatch):
    """A model longer than what is broadcast: words of its frequent terms are summed where they lie."""
    df = spark.createDataFrame([(f"the the word{i} more{i % 3}", "positive" if i % 2 else "neutral") for i in range(40)], "t string, y string")
    model = S.train_bayes(df, "t", "y")
    label = lambda: sorted(map(str, S.bayes_label(df, "t", model, keep_scores=True).collect()))
    whole, sent, broadcast = label(), [], S.F.broadcast
    monkeypatch.setattr(S, "MODEL_ROWS", 4)
    monkeypatch.setattr(S.F, "broadcast", lambda d: sent.append(sorted(r["term"] for r in d.select("term").collect())) or broadcast(d))
    assert label() == whole
    assert sent == [["more0", "more1", "more2", "the"]] * 2
