import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from feedlark.llm import queries, secretscan
from feedlark.llm.secretscan import ADDED, BASE, Rule, trigram_query

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
PIECES = ["password", "PassWD", "api_key", "APIKEY", "Token", "secret", "=", ": ", '"', "'", " ", "abcdefgh", "x.y/z+w==", "AKIA", "AKIAABCDEFGHIJKL",
          "0123456789abcdef" * 2, "deadbeef", "é", "𝄞", "\n", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "ſecret", "toKen"]


def plain(text):
    text = text or ""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    kinds = [r.kind for r in BASE]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def base(row):
    return [tuple(s) for s in row["spans"] if s["kind"] in {r.kind for r in BASE}]


def test_spans_against_plain_python(spark):
    rnd = random.Random(6)
    texts = [None, "", "x" * 200_000 + " token = abcdefgh1", "secret = 12345678 " * 300]
    texts += ["".join(rnd.choices(PIECES, k=rnd.randint(1, 14))) for _ in range(600)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kind int")
    got = {r["doc_id"]: r for r in secretscan.scan(df).collect()}
    for i, t in enumerate(texts):
        assert base(got[i]) == plain(t), t
        for r in ADDED:
            want = [(m.start(), m.end()) for m in re.finditer(r.pattern, t or "", re.A)]
            assert [(s["start"], s["end"]) for s in got[i]["spans"] if s["kind"] == r.kind] == want


def test_repeated_ids_nulls_and_empty_table(spark):
    rows = [(1, "token=abcdefgh"), (1, "nothing"), (1, "token=abcdefgh"), (None, "secret=abcdefgh"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = secretscan.scan(df).collect()
    assert sorted(len(r["spans"]) for r in got) == [0, 0, 1, 1, 1]
    assert secretscan.scan(df.limit(0)).count() == 0
    clash = df.select("*", *(F.lit(9).alias(c) for c in ("spans", "kinds", "_doc", "_found0")))
    assert sorted(len(r["spans"]) + r["kinds"] for r in secretscan.scan(clash).collect()) == [9, 9, 10, 10, 10]


@pytest.mark.parametrize("pattern,clauses", [
    ("abcd", [{"abc", "bcd"}]), ("ab", []), ("a.c", []), ("(abc|xyz)+", [{"abc"}, {"xyz"}]), ("abc?d", [{"abd"}, {"abc", "bcd"}]), ("xabc?d", [{"xab", "abd"}, {"xab", "abc", "bcd"}]),
    ("(abc)*", []), ("(foo|bar)baz", [{"foo", "oob", "oba", "baz"}, {"bar", "arb", "rba", "baz"}]), ("[0-9a-f]{32,}", []), ("AKIA[A-Z]+", [{"aki", "kia"}]),
    ("(abc|.)def", [{"def"}]), ("abc{2}def", [{"def"}]),
])
def test_trigram_queries(pattern, clauses):
    assert {frozenset(c) for c in trigram_query(pattern)} == {frozenset(c) for c in clauses}


def test_a_query_never_misses_a_match():
    rnd = random.Random(9)
    patterns = [r.pattern for r in BASE + ADDED] + ["(abc|ab)+c?d", "x(yz|zy){1,2}w", "a[bc]d(ef)?g", "(a|bc)(de|f)gh"]
    for pattern in patterns:
        query = trigram_query(pattern)
        for _ in range(400):
            text = "".join(rnd.choices([*PIECES, "abc", "d", "x", "yz", "zy", "w", "efg", "a", "gh"], k=6))
            if query and re.search(pattern, text, re.A):
                low = "".join(c.lower() if c.isascii() else c for c in text)
                assert any(all(t in low for t in clause) for clause in query)


def test_own_rule_and_query_on_the_whole_table(spark):
    df = spark.createDataFrame([(1, "zz zq zqq")], "doc_id long, text string")
    got = secretscan.scan(df, rules=(Rule("z", "zq+", 0, 3),)).first()
    assert [tuple(s) for s in got["spans"]] == [("z", 6, 9)]
    found = {r["doc_id"]: r for r in queries.op8_secret_scan(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(found) == len(docs)
    assert sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in found.values()) > 0
    for d in docs:
        want, r = plain(d["text"]), found[d["doc_id"]]
        assert [r[f"n_{k.kind}"] for k in BASE] == [sum(s[0] == k.kind for s in want) for k in BASE]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
