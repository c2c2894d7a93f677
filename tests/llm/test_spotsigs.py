import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from feedlark.llm import queries, spotsigs

DOCUMENTS = "doc_id long, text string, mine string"


def plain_set(text):
    """Signatures as tuples, or the one of all words."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    stop = {w.decode() for w in spotsigs.STOP_WORDS}
    out = set()
    for i, w in enumerate(words):
        if w.encode() in spotsigs.ANCHORS:
            chain = [x for x in words[i + 1 :] if x not in stop][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add((w, *chain))
    return out or ({tuple(words)} if words else set())


def plain(rows):
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    sets = {d: plain_set(t) for d, t in order}
    group = {d: d for d in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    likeness = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    out = {}
    for i, (d, t) in enumerate(order):
        text, following = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        near = likeness(sets[d], plain_set(changed)), likeness(sets[d], plain_set(following))
        out[d] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), len(sets[d]), *near, root(d))
    return out


def told(df):
    return {
        r["doc_id"]: (r["n_chars"], r["edited_sha256"], len(r["fingerprint"]) // 16, r["near_edited"], r["near_next"], r["class_id"])
        for r in df.collect()
    }


def documents(seed, n=120):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "is", "was", "of", "a", "é", *(f"w{k}" for k in range(200))])
    rows = [(i, " ".join(word() for _ in range(rnd.choice([3, 30, 200])))) for i in range(n)]
    for i in range(n, n + 60):  # near copies of one text, each unlike any other
        words = rows[5][1].split() + ["the end of it all"]
        words[rnd.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    passage = " ".join(word() for _ in range(25))  # a passage that many have
    rows += [(i, f"{passage}. {' '.join(word() for _ in range(40))}") for i in range(300, 340)]
    rows += [(400, None), (401, ""), (402, "..."), (403, "The one, two; three"), (404, "the one two three"), (405, "The"), (500, "x " * 20000)]
    return rows


@pytest.mark.parametrize("seed, members, turns", [(1, 1024, 2), (2, 7, 0)])
def test_against_plain_python(spark, monkeypatch, seed, members, turns):
    monkeypatch.setattr(spotsigs, "MEMBERS", members)
    monkeypatch.setattr(spotsigs, "TURNS", turns)
    rows = documents(seed)
    df = spark.createDataFrame([(*r, "clash") for r in rows], DOCUMENTS)
    assert told(spotsigs.edited_likeness(df)) == plain(rows)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op11_spotsigs(spark, sf)
    assert told(got) == plain(rows)
    prints = {}
    for r in got.join(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect():
        assert prints.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]


def test_odd_rows(spark):
    empty = spotsigs.edited_likeness(spark.createDataFrame([], DOCUMENTS))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "n_chars", "edited_sha256"]
    rows = [(None, "the a b c", ""), (None, None, ""), (1, "one", ""), (1, "one", ""), (1, None, ""), (2, "is it so far so good", "")]
    got = sorted(((r["doc_id"], r["n_chars"], r["class_id"]) for r in spotsigs.edited_likeness(spark.createDataFrame(rows, DOCUMENTS)).collect()), key=repr)
    assert got == sorted([(None, 9, None), (None, 0, None), (1, 3, 1), (1, 3, 1), (1, 0, 1), (2, 20, 2)], key=repr)


def test_bounds():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        a, b = (np.unique(rnd.integers(0, 60, rnd.integers(0, 60)).astype(np.uint64)) for _ in range(2))
        common = len(np.intersect1d(a, b))
        want = common > 0 and 100 * common >= 80 * (len(a) + len(b) - common)
        assert spotsigs.reaches(a, b, chunk=4) == want
        if want:
            assert set(spotsigs.length_partitions(len(a))) & set(spotsigs.length_partitions(len(b)))
    for a in range(1, 3000):
        for b in (a, a + 1, 100 * a // 80):
            if 80 * b <= 100 * a:
                assert set(spotsigs.length_partitions(a)) & set(spotsigs.length_partitions(b))


def test_cells_are_counted_by_frame(monkeypatch):
    rnd = np.random.default_rng(6)
    sets = [np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 1, 5, 400, 400)]
    sets = sets * 3 + [np.array([7, 7 + spotsigs.CELLS], np.uint64)]  # a set may meet a cell twice
    want = np.zeros(spotsigs.CELLS, np.int64)
    for mine in sets:
        np.add.at(want, (mine % np.uint64(spotsigs.CELLS)).astype(np.int64), 1)
    passes, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **b: passes.append(1) or count(*a, **b))
    frames = [pd.DataFrame({"mine": [m.tobytes() for m in part]}) for part in (sets[:7], [], sets[7:])]
    got = pd.concat(spotsigs._cells(iter(frames)))
    assert dict(zip(got["cell"], got["n"])) == {int(c): int(want[c]) for c in np.flatnonzero(want > 1)}
    assert len(passes) <= len(frames)  # no pass over all cells for each text
