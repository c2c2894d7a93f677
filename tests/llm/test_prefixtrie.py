import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlark.llm import prefixtrie

SCHEMA = "conv_id long, turn int, role string, text string, depth long"


def plain(rows):
    """Every prefix of every rebuilt conversation as a tuple."""
    turns = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = {}
    for key, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(key))))
        out[key] = [min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), 0, 0, 0, hashlib.sha256(ends.encode()).hexdigest()]
    for key in members:
        if key:
            out[key[:-1]][4] += 1
    for key, convs in members.items():
        saved = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            out[key[:d]][6] += saved
            out[key[:d]][5] += out[key][4] == 0
    return sorted(map(tuple, out.values()), key=repr)


def trie(spark, rows, block=4096):
    df = spark.createDataFrame(rows, SCHEMA)
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    turns = prefixtrie.with_shared_starts(prefixtrie.turn_rows(df), F.col("conv_id") - F.col("conv_id") % 20, heads, most=3)
    got = prefixtrie.prefix_trie(turns, block).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("seed, block", [(1, 1), (2, 2), (3, 3), (4, 7), (5, 4096)])
def test_against_plain_python(spark, seed, block):
    rnd = random.Random(seed)
    rows = []
    for conv in rnd.sample(range(-60, 400), 90):
        first = rnd.choice(["hi there", "hi there", "hello you two"])
        n = rnd.choice([1, 1, 2, 3, 5])
        texts = [first, *(rnd.choice(["a b", "c", "", None]) for _ in range(n))]
        rows += [(conv, k, rnd.choice(["user", "user", None]) if k else "user", t, 7) for k, t in enumerate(texts)]
    for conv in range(1000, 1040):  # a large group of copies
        rows += [(conv, k, "user", f"copy {k}", 7) for k in range(5)]
    rows += [(None, 1, "user", "no id", 7), (5000, None, "user", "late", 7), (5000, None, None, None, 7), (5000, 1, "user", " ", 7)]
    rows += rows[:5] + [(5001, k, "user", f"long {k} " * 30, 7) for k in range(40)]
    rnd.shuffle(rows)
    assert trie(spark, rows, block) == plain(rows)


def test_empty_and_turnless(spark):
    assert trie(spark, []) == []
    rows = [(c, 0, "user", "x", 1) for c in (11, 13)]  # fewer turns than are replaced, no base
    assert trie(spark, rows) == plain(rows)


def test_intervals():
    random_ = np.random.default_rng(2)
    for n in (1, 2, 3, 8, 21):
        lcp = random_.integers(0, 4, n)
        table = prefixtrie.sparse_table(lcp)
        at, depth = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        left, right = prefixtrie.reach_left(table, at, depth), prefixtrie.reach_right(table, at, depth)
        for i, d, a, b in zip(at, depth, left, right):
            want = i
            while want > 0 and lcp[want] >= d:
                want -= 1
            assert a == want
            want = i
            while want + 1 < n and lcp[want + 1] >= d:
                want += 1
            assert b == want
        spans = [(i, j) for i in range(n) for j in range(i, n)]
        low = prefixtrie.least_of(table, np.array([s[0] for s in spans]), np.array([s[1] for s in spans]))
        assert low.tolist() == [lcp[i : j + 1].min() for i, j in spans]
