import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlark.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def plain(rows):
    """Every anchor against every row."""
    good = [
        (i, y, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, y, _ in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, y, v in good:
        if i % 100:
            continue
        met = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in good if j != i)
        for s, j, _ in [m for m in met if m[2] == y][:5]:
            far = [m for m in met if m[2] != y and 80 * -s <= 100 * -m[0] <= 100 * -s][:5]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(far)]
    return sorted(out)


def values(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_python(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    base = [rnd.gauss(0, 1) for _ in range(19)]

    def vector():
        spread = rnd.choice([0.05, 0.3, 2.0])
        return [x + rnd.gauss(0, spread) for x in base[: rnd.choice([19, 19, 19, 8, 0])]]

    rows = [(i, vector(), rnd.randrange(3), "x") for i in range(0, 700, 7)] + [(i, vector(), rnd.randrange(3), "x") for i in range(0, 900, 100)]
    rows += [(1000 + k, base, k % 3, None) for k in range(40)]  # one very common vector
    rows += [(3, base, None, ""), (5, None, 1, ""), (None, base, 1, ""), (6, [None] * 19, 1, ""), (8, [float("nan")], 1, ""), (9, [float("inf")], 2, "")]
    rows += rows[:4] + [(200, base, 1, "again")]
    monkeypatch.setattr(hardneg, "CANDIDATES", 37)
    monkeypatch.setattr(hardneg, "ANCHORS", 4)
    df = spark.createDataFrame(rows, SCHEMA)
    assert values(hardneg.hard_negatives(df, F.col("vec_id") % 100 == 0)) == plain(rows)


def test_scores_are_exact():
    random_ = np.random.default_rng(4)
    for width, most in ((1, 2), (8, 300), (64, 256), (70, 1 << 20)):
        a, c = random_.integers(-most, most, (5, width)), random_.integers(-most, most, (11, width))
        c[0], c[1] = most - 1, -most
        planes, data = hardneg.to_planes(c)
        packed = np.frombuffer(data, np.uint8).reshape(planes, -1, len(c))
        assert (hardneg.scores(hardneg.subset_sums(a), packed) == c @ a.T).all()


def test_too_large_components_raise(spark):
    rows = [(i, [1e30, 1.0], 1, None) for i in (100, 101)]
    with pytest.raises(Exception, match="too large"):
        hardneg.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect()


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1, None)], [(100, [1.0], 1, None)], [(100, [], 1, None), (101, [], 1, None), (7, [], 2, None)]])
def test_few_rows(spark, rows):
    df = hardneg.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
    assert values(df) == plain(rows)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
