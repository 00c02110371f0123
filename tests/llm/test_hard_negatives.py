"""Hard negatives against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parapet.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id long, anchor string, vec int, part int, length int"


def brute(rows, anchors, k=hn.POSITIVES, m=hn.NEGATIVES):
    """rows: (id, vector, label)."""
    ok = [(i, [int(np.floor(256 * float(x))) for x in v], y) for i, v, y in rows
          if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v, y in {(a, tuple(b), c) for a, b, c in ok if anchors(a)}:
        s = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in ok if j != i]
        for ps, p, _ in sorted(x for x in s if x[2] == y)[:k]:
            neg = sorted(x[:2] for x in s if x[2] != y and 30 * -ps <= 100 * -x[0] <= 90 * -ps)[:m]
            out += [(i, p, r, n, -ps, -ns) for r, (ns, n) in enumerate(neg, 1)]
    return sorted(out)


def mined(spark, rows, every=5, **how):
    df = spark.createDataFrame([(i, v, y, 0, "x", 1, 2, 3) for i, v, y in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % every == 0, **how).collect())


def vectors(rnd, n, dim, spread, groups=4, shortest=0.2):
    centres = rnd.normal(size=(groups, dim))
    x = centres[rnd.integers(0, groups, n)] + spread * rnd.normal(size=(n, dim))
    return (x / np.linalg.norm(x, axis=1)[:, None] * rnd.uniform(shortest, 2, n)[:, None]).astype(np.float32)


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_equals_all_pairs_in_any_cells(spark, spread):
    x = vectors(np.random.default_rng(3), 200, 6, spread)
    rows = [(i, x[i].tolist(), int(i * 7 % 3)) for i in range(200)]
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows, part_rows=30, group_anchors=7) == want
    assert mined(spark, rows, part_rows=50, group_anchors=1) == want       # some cells have no anchor


def test_odd_rows_ties_copies_and_no_rows(spark):
    rnd = random.Random(1)
    bad = [(None, [1.0, 0.0], 1), (1, None, 1), (2, [1.0, None], 0), (3, [float("nan"), 1.0], 0), (4, [float("inf"), 1.0], 1),
           (6, [1.0, 1.0], None)]
    good = [(i, [rnd.choice([0.0, 0.5, 1.0]), rnd.choice([0.0, 0.25, 1.0])], i % 2) for i in range(10, 60)]
    good += [(70, [], 0), (71, [1.0], 1), (72, [0.0, 0.0], 1), (75, [-1.0, -0.5], 0), (80, [0.0, 0.0], 0)]
    good += [(90 + i, [1.0, 0.5], 1) for i in range(30)] + [(90, [1.0, 0.5], 1)] * 3 + [(95, [1.0, 0.5], 1)] * 40
    rows = bad + good
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)
    assert mined(spark, bad) == [] == mined(spark, [])
    assert mined(spark, [(5, [1.0], 0), (6, [1.0], 1)]) == []          # no positive


@pytest.mark.parametrize("shortest", [0.1, 1.9])
def test_lists_discard_what_cannot_reach_the_score(shortest):
    rng = np.random.default_rng(5)
    x = np.floor(256 * vectors(rng, 4000, 16, 0.05, 12, shortest)).astype(np.int64)
    ids, a = np.arange(4000), np.arange(0, 4000, 100)
    low, high = np.full((len(a), 1), hn.LEAST), np.full((len(a), 1), hn.MOST)
    tally = hn.Tally()
    who, _, rows, s = hn.search(x[a], ids[a], low, high, x, ids, lambda p, q: np.ones(len(p), bool), 5, size=500, tally=tally)
    full = x[a] @ x.T
    full[np.arange(len(a)), a] = -1 << 60
    for i in range(len(a)):
        order = np.lexsort((ids, -full[i]))[:5]
        mine = hn.best(who[who == i], np.zeros(5, int), s[who == i], ids[rows[who == i]], 5)
        assert rows[who == i][mine].tolist() == order.tolist()
    assert tally.skipped if shortest < 1 else tally.listed        # by length, or by the lists
    assert tally.whole + tally.candidates < len(a) * len(x) / 2


def test_products_stay_exact_beyond_doubles():
    a = np.array([[1 << 30, 3], [-(1 << 30), 1]])
    b = np.array([[(1 << 30) + 1, 1]])
    assert hn.products(a, b).tolist() == [[(1 << 30) * ((1 << 30) + 1) + 3], [-(1 << 30) * ((1 << 30) + 1) + 1]]
