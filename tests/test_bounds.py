import random

import numpy as np
import pandas as pd
import pytest

from feedlark import runtime
from feedlark.operators import bounds


def block_of(rnd, n, vocabulary):
    rows = []
    for name in range(n):
        found = {rnd.choice(vocabulary): 1 for _ in range(rnd.randint(8, 15))}
        norm = len(found) ** 0.5
        rows += [(name * 3 + 1, t, rnd.uniform(0.5, 1) / norm) for t in found]
    packed = bounds.pack_names(pd.DataFrame(rows, columns=["name_no", "term", "weight"]))
    return bounds.NameBlock(next(packed.itertuples(index=False))), rows


@pytest.mark.parametrize("k", [None, 1, 3])
def test_against_all_sums(k):
    rnd = random.Random(7)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(300)]
    block, rows = block_of(rnd, 400, common * 20 + rare)
    bags, whole = [], 0
    for _ in range(60):  # rare words weigh more, as they do by their idf
        bag = {t: rnd.uniform(0.1, 0.4) for t in rnd.sample(common, 6)} | {t: rnd.uniform(4, 9) for t in rnd.sample(rare, 5)}
        bags.append({t: x for t, x in bag.items() if t in block.number} if rnd.random() > 0.1 else {})
    least = np.array([rnd.choice([0.0, 1.0, 2.0, 99.0] if k is None else [0.0, 0.0, 2.0]) for _ in bags])
    words = [(i, block.number[t], x) for i, bag in enumerate(bags) for t, x in bag.items()]
    given = (np.array([w[j] for w in words], float if j == 2 else np.int64) for j in range(3))
    bag, place, totals = bounds.reaching(block, *given, least, k)
    for i, have in enumerate(bags):
        sums: dict[int, float] = {}
        for name, t, w in rows:
            if t in have:
                sums[name] = sums.get(name, 0.0) + have[t] * w
                whole += 1
        want = sorted((-round(x, 6), name) for name, x in sums.items() if x >= least[i])[: k or len(sums)]
        got = sorted((-round(x, 6), int(block.names[p])) for p, x in zip(place[bag == i], totals[bag == i]) if x >= least[i])
        assert got == want
    assert block.added < 0.8 * whole  # bounds leave out sums


def test_a_worker_holds_few_sums_at_once(monkeypatch):
    """Many short names in one block meet many bags: bags go on in passes, with the same results."""
    rnd = random.Random(3)
    block, _ = block_of(rnd, 2_000, [f"t{i}" for i in range(50)])
    shared = [[{"term": f"t{t}", "raw": rnd.uniform(1, 3)} for t in rnd.sample(range(50), 10)] for _ in range(200)]
    frame = pd.DataFrame({"bag_no": range(200), "shared": shared, "least": 0.0})
    row = next(next(bounds.pack_bags(iter([frame]), 256)).itertuples(index=False))
    whole = pd.concat(bounds.BagBlock(row, 2).meet(block), ignore_index=True)

    held, reaching = [], bounds.reaching
    monkeypatch.setattr(bounds, "PASS_CELLS", 50_000)
    monkeypatch.setattr(bounds, "reaching", lambda *a: held.append(len(a[4]) * len(a[0].names)) or reaching(*a))
    parts = pd.concat(bounds.BagBlock(row, 2).meet(block), ignore_index=True)
    pd.testing.assert_frame_equal(parts, whole)
    assert len(held) > 8 and max(held) <= 50_000


def test_bags_are_packed_where_they_lie_and_dealt_out_evenly(spark, monkeypatch):
    """One shuffle brings packed bags to their cells; none comes before it."""
    rnd = random.Random(5)
    _, rows = block_of(rnd, 20, [f"t{i}" for i in range(50)])
    blocks = bounds.name_blocks(runtime.materialise(spark.createDataFrame([(n, t, w) for n, t, w in rows], "name_no long, term string, weight double"), "postings"))
    bags = [(i, [(f"t{t}", 1.0) for t in rnd.sample(range(50), 10)], 0.0) for i in range(160)]
    bags = spark.createDataFrame(bags, "bag_no long, shared array<struct<term: string, raw: double>>, least double")
    bags = runtime.materialise(bags.repartition(4), "bags")
    kept, store = {}, runtime.materialise
    monkeypatch.setattr(runtime, "materialise", lambda df, label, *more: kept.update({label: df}) or store(df, label, *more))
    found = bounds.scores(bags, blocks, 1, bag_rows=5, chunk_words=100)
    assert {r["bag_no"] for r in found.collect()} == set(range(160))
    packed = kept["bag-blocks"]
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    loads = [r["count"] for r in packed.groupBy("chunk").count().collect()]
    assert len(loads) == 16 and max(loads) <= 5  # 32 blocks


@pytest.mark.parametrize("k", [1, 3])
def test_one_bag_is_summed_at_a_time_and_at_once_where_bounds_spare_little(monkeypatch, k):
    """Words are about as frequent, so nearly every posting is needed: a step for each bag, over the names of the block."""
    rnd = random.Random(11)
    block, rows = block_of(rnd, 1_500, [f"t{i}" for i in range(60)])
    shared = [[{"term": f"t{t}", "raw": rnd.uniform(2, 3)} for t in rnd.sample(range(60), 30)] for _ in range(200)]
    frame = pd.DataFrame({"bag_no": range(200), "shared": shared, "least": 0.0})
    row = next(next(bounds.pack_bags(iter([frame]), 256)).itertuples(index=False))
    made, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **more: made.append(len(found := bincount(*a, **more))) or found)
    got = pd.concat(bounds.BagBlock(row, k).meet(block), ignore_index=True)
    assert max(made) <= 1_500 and len(made) < 1.5 * 200
    for bag, words in enumerate(shared):
        raws, sums = {w["term"]: w["raw"] for w in words}, {}
        for name, t, weight in rows:
            sums[name] = sums.get(name, 0.0) + raws.get(t, 0.0) * weight
        want = sorted((-round(x, 6), name) for name, x in sums.items())[:k]
        assert sorted((-x, n) for n, x in got[got["bag_no"] == bag][["name_no", "rank_by"]].itertuples(index=False)) == want


def test_blocks_of_short_names_are_split(spark, monkeypatch):
    monkeypatch.setattr(bounds, "BLOCK_NAMES", 30)
    postings = [(n, t, 0.5) for n in range(100) for t in (f"a{n % 7}", "b")] + [(200, f"c{i}", 0.1) for i in range(40)]
    postings = runtime.materialise(spark.createDataFrame(postings, "name_no long, term string, weight double"), "postings")
    blocks = [bounds.NameBlock(r) for r in bounds.name_blocks(postings).toPandas().itertuples(index=False)]
    assert sorted(n for b in blocks for n in b.names) == [*range(100), 200]
    assert len(blocks) == 5 and all(len(b.names) <= 30 for b in blocks)
    found = sorted((int(b.names[p]), t, w) for b in blocks for t, i in b.number.items() for p, w in zip(b.places[b.starts[i] : b.starts[i + 1]], b.weights[b.starts[i] : b.starts[i + 1]]))
    assert found == sorted((r.name_no, r.term, r.weight) for r in postings.collect())
