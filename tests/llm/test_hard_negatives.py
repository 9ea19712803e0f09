"""Hard negatives against all scores in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.llm import hard_negatives

SCHEMA = "id long, label int, vector array<float>, row string, anchor string, a string, c string"


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 64, 33), (40, 37, 51), (64, 64, 64), (3, 200, 90), (0, 5, 4)])
def test_strassen(shape):
    m, k, n = shape
    rng = np.random.default_rng(m * 100 + n)
    a, b = rng.integers(-2 ** 20, 2 ** 20, (m, k)), rng.integers(-2 ** 20, 2 ** 20, (k, n))
    assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()
    big = rng.integers(-2 ** 62, 2 ** 62, (33, 34))                # additions wrap, the product is right modulo 2^64
    assert (hard_negatives.strassen(big, big.T, leaf=4) == big @ big.T).all()


def plain(rows, step):
    rows = [(i, la, [math.floor(256 * x) for x in v]) for i, la, v in rows
            if la is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    last = lambda i: (i is None, i or 0)
    for k, (a, la, va) in enumerate(rows):
        if a is None or a % step:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), last(i), i, lb == la) for j, (i, lb, v) in enumerate(rows) if j != k]
        scored.sort(key=lambda x: x[:2])
        for s, _, p, same in [x for x in scored if x[3]][:5]:
            near = [x for x in scored if not x[3] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, r, n, -s, -t) for r, (t, _, n, _) in enumerate(near, 1)]
    return sorted(out, key=repr)


def run(spark, rows, step, **blocks):
    df = spark.createDataFrame([(*r, "w", "x", "y", "z") for r in rows], SCHEMA)
    out = hard_negatives.mine(df, F.col("id") % step == 0, **blocks)
    assert out.columns == ["anchor_id", "positive_id", "place", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
                   for r in out.collect()), key=repr)


def test_blocks_and_ties(spark):
    rng = random.Random(5)
    grid = [-0.5, 0.0, 0.25, 0.5, 1.0]                            # few values: many equal scores
    rows = [(i, rng.randrange(3), [float(np.float32(rng.choice(grid))) for _ in range(7)]) for i in range(150)]
    rows += [(i, rng.randrange(3), [float(np.float32(rng.gauss(0, 1))) for _ in range(7)]) for i in range(150, 220)]
    want = plain(rows, 4)
    assert want and run(spark, rows, 4, anchor_block=10, candidate_block=30) == want
    assert run(spark, rows, 4) == want


def test_defined_cases(spark):
    one = [0.5, 0.5]
    rows = [(0, 1, one), (0, 1, one), (None, 1, one), (2, 1, [0.5]), (3, 2, [0.4, 0.4]), (None, 2, [0.4, 0.4]), (3, 2, [0.4, 0.4]),
            (5, None, one), (6, 1, None), (7, 2, [0.5, None]), (8, 2, [float("nan"), 0.1]), (9, 2, [float("inf"), 0.1]),
            (10, 5, []), (12, 7, [-0.5, -0.5])]
    f32 = [(i, la, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, la, v in rows]
    # a shorter vector counts as padded with zeros
    padded = [(i, la, None if v is None else v + [0.0] * (2 - len(v))) for i, la, v in f32]
    got = run(spark, f32, 2)
    assert got == plain(padded, 2)
    assert any(r[1] is None for r in got) and any(r[3] is None for r in got)


def test_empty(spark):
    assert run(spark, [], 2) == []
    assert run(spark, [(2, 1, [1.0])], 2) == []
    assert run(spark, [(1, 1, [1.0]), (3, 1, [1.0])], 2) == []
