import random
import re

import pytest
from pyspark.sql import functions as F

from feedlark.functions import text as T
from feedlark.functions.stopwords import ENGLISH318, MAPPING, PRODUCT, PROFILES, REVIEW, SOCIAL

GOLDEN = [
    ("<b>Great</b> Phone!! see https://x.y/z it's 5 stars", "great phone see stars", "great phone see stars", "great phone see stars"),
    ("It is NOT about the price", "about price", "not price", "not about price"),
    ("Café déjà-vu", "caf djvu", "caf djvu", "caf djvu"),
    ("1 < 2 and 3 > 2 <b>ok</b>", "ok", "ok", "ok"),
    ("awwww.x http nice", "http nice", "http nice", "http nice"),
    ("line1\nline2\ttab  end", "line1 line2 tab end", "line1 line2 tab end", "line1 line2 tab end"),
    ("<p>Wi-Fi</p><p>router</p>", "wifirouter", "wifirouter", "wifirouter"),
    ("USB-C/Hub 3.0", "usbchub 30", "usbchub 30", "usbchub 30"),
    ("no\xa0break\u3000space\x1csep", "break space sep", "no break space sep", "no break space sep"),
    ("a<>b <>", "ab", "ab", "ab"),
    (None, "", "", ""),
    ("", "", "", ""),
    ("   ", "", "", ""),
    ("the of and", "", "", ""),
]


def test_list_sizes():
    assert [len(set(x)) for x in (REVIEW, PRODUCT, SOCIAL, MAPPING, ENGLISH318)] == [57, 76, 121, 102, 318]


@pytest.mark.parametrize("place, profile", [(1, "social"), (2, "product"), (3, "review")])
def test_golden(spark, place, profile):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, t string")
    got = df.select("i", T.clean_text("t", profile).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [g[place] for g in GOLDEN]


def plain_clean(text, profile):
    """The same steps, one regular expression after another."""
    stop, shortest = PROFILES[profile]
    text = text.lower()
    for pattern in (r"</?[^>]+>", r"http\S+|www\S+|https\S+", r"[^a-z0-9\s]"):
        text = re.sub(pattern, "", text)
    return " ".join(w for w in text.split() if len(w) >= shortest and w not in stop)


def test_random_texts_clean_like_plain_regexes(spark):
    rng = random.Random(7)
    bits = ["the", "Great", "not", "x", "<b>", "</b>", "<", ">", "<>", "http", "http://a.b/c", "www", "aWWW.q",
            " ", "  ", "\t", "\n", "\r", "\xa0", " ", " ", "　", "\x1c", "\x85", "᠎", "​",
            "é", "日本", "İ", "ß", "\U0001f600", "'", "-", "/", "_", "5", "30"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for profile in ("social", "review"):
        got = df.select("i", T.clean_text("t", profile).alias("c")).orderBy("i").collect()
        wrong = [(texts[r.i], r.c) for r in got if r.c != plain_clean(texts[r.i], profile)]
        assert not wrong
        assert all(re.fullmatch(r"([a-z0-9]{2,}( [a-z0-9]{2,})*)?", r.c) for r in got)


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN if g[0] and "http" not in g[0]], "t string")
    once = df.select(T.clean_text("t", "social").alias("a"))
    assert once.filter(F.col("a") != T.clean_text("a", "social")).isEmpty()


def test_mapping_profile_keeps_what_tags_leave_behind(spark):
    df = spark.createDataFrame([("<b>Great</b> to see it",)], "t string")
    assert df.select(T.clean_text("t", "mapping")).first()[0] == "bgreatb see"


def test_normalise_name(spark):
    df = spark.createDataFrame([("  USB - C  /  Hub ",), ("a -b\t c/ d",), (" - ",)], "t string")
    assert [r[0] for r in df.select(T.normalise_name("t")).collect()] == ["USB-C/Hub", "a-b c/d", "-"]


def test_words_and_strip(spark):
    df = spark.createDataFrame([("  Été_x, o'k ",)], "t string")
    assert df.select(T.word_tokens("t")).first()[0] == ["été_x", "o", "k"]
    assert df.select(T.strip("t")).first()[0] == "Été_x, o'k"


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "b"],), ([],)], "t array<string>")
    got = T.with_term_counts(df.select(F.sort_array("t").alias("t")), "t").collect()
    assert sorted([tuple(x) for x in r.bag] for r in got) == [[], [("a", 1), ("b", 3), ("c", 1)]]


def test_clean_text_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "t string").select(T.clean_text("t", "social"))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_term_counts_of_tokens_in_any_order(spark):
    texts = [["b", "a", "b"], [], None, ["é", None, "z", "a", "é", "\U0001f600"], [None]] + [["x", f"y{i}"] for i in range(2 * T.COUNT_ROWS)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t array<string>").coalesce(1)
    got = {r.i: r.bag and [tuple(x) for x in r.bag] for r in T.with_term_counts(df, "t").collect()}
    assert [got[i] for i in range(5)] == [[("a", 1), ("b", 2)], [], None, [("a", 1), ("z", 1), ("é", 2), ("\U0001f600", 1)], []]
    assert all(got[i] == [("x", 1), (t[1], 1)] for i, t in enumerate(texts) if i >= 5)


def test_spaces_above_latin_split_words(spark):
    spaces = "".join(map(chr, [0x1680, 0x2028, 0x3000])) + "\x85\xa0\x0b"
    df = spark.createDataFrame([(f"ab{c}-c{c}dée",) for c in spaces], "t string")
    assert [r[0] for r in df.select(T.keep_alnum("t")).collect()] == [f"ab{c}c{c}de" for c in spaces]
