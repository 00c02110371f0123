"""Word pairs counted in their partition, whatever the sizes of pools and chunks."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parapet.operators import decode, skew


def _lines(seed, n=400):
    rnd = random.Random(seed)
    words = ["a"] * 40 + ["b"] * 8 + ["é", "日本", "</s>"] + [f"w{i}" for i in range(60)]
    return [(rnd.choice("mnx"), " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 14)))) for _ in range(n)]


@pytest.mark.parametrize("small", [True, False])
def test_pairs_are_added_up_in_their_partition(spark, monkeypatch, small):
    monkeypatch.setattr(skew, "HOT_MIN", 100)
    if small:
        for name in ("POOL_BYTES", "HELD_WORDS", "CHUNK_PAIRS", "ROWS_OUT"):
            monkeypatch.setattr(decode, name, 7)
    rows = _lines(1)
    df = spark.createDataFrame(rows, "member string, line string").repartition(3)
    c, t = Counter(), Counter()
    for m, line in rows:
        w = line.split()
        c.update((p, q, m) for p, q in zip(w, [*w[1:], "</s>"]))
        t.update((p, m) for p in w)
    want = {(p, q): (c[p, q, "m"], c[p, q, "n"], t[p, "m"], t[p, "n"]) for p, q, _ in c}
    cells, _ = decode.bigram_cells(df, "member", "line", ["m", "n"])
    got = [tuple(r) for r in cells.collect()]
    assert len(got) == len(want) and {r[:2]: r[2:] for r in got} == want
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "SortAggregate" not in plan     # Spark neither sorts nor gathers the pairs
    near, _ = decode.bigram_cells(df, "member", "line", ["m", "n"], decode.near_best)
    assert 0 < near.count() < len(got) / 2
    best = lambda x: {r["prev"]: (r["next"], r["p"]) for r in decode.best_next(x, 2).collect()}
    assert best(near) == best(cells)


def test_opaque_best_is_found_among_the_pairs_kept(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_MIN", 100)
    df = spark.createDataFrame(_lines(2), "member string, line string")
    make = lambda n: [lambda c, t: np.log1p(c) - np.log(n + t)] * 2
    best = lambda keep: {tuple(r) for r in decode.opaque_best_next(
        *decode.bigram_cells(df, "member", "line", ["m", "n"], keep), make).collect()}
    assert best(decode.opaque_near_best(make)) == best(None)


def test_starts_without_a_word_share_the_join(spark):
    best = spark.createDataFrame([("a", "b"), ("b", "</s>")], "prev string, next string")
    paths = decode.greedy_paths(best)
    paths = spark.createDataFrame(paths.collect(), paths.schema)
    starts = spark.createDataFrame([(i, [None, "a", "q", ""][i % 4]) for i in range(40)], "sid int, token string")
    for freq in (None, decode.start_counts(starts), decode.start_counts(starts.filter(F.col("token") == "a"))):
        out = decode.greedy_decode(starts, paths, freq=freq)
        assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()      # the starts are computed once
        got = {r["sid"]: (list(r["path"]), r["stop"]) for r in out.collect()}
        assert got == {i: [([], "empty"), (["b", "</s>"], "eos"), ([], "dead_end"), ([], "dead_end")][i % 4] for i in range(40)}


def test_the_keys_of_a_salted_join_are_shuffled_once(spark):
    facts = spark.createDataFrame([("a" if i % 3 else None, i) for i in range(90)], "k string, i int")
    acc = spark.sparkContext.accumulator(0)

    def seen(batches):
        for rb in batches:
            acc.add(len(rb))
            yield rb

    freq = facts.groupBy("k").agg(F.count(F.lit(1)).alias("__n")).mapInArrow(seen, "k string, __n bigint")
    hot = skew.frequent(freq, "k", hot_fraction=0.5, hot_min=1, total=facts.count())
    assert acc.value == 0       # they are not added up to learn how many rows there are
    assert [tuple(r) for r in hot.collect()] == [("a", True)] == [tuple(r) for r in skew.frequent(freq, "k", 0.5, 1).collect()]
    dim = spark.createDataFrame([("a", 7)], "k string, x int")
    got = sorted(tuple(r) for r in skew.salted_join(facts, dim, "k", hot_min=10, how="left").select("i", "x").collect())
    assert got == [(i, 7 if i % 3 else None) for i in range(90)]
