"""SimHash operators against brute force over all pairs."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_cases import ODD, SF01, no_docs, odd_docs  # noqa: F401
from parapet.llm import bits, document_fingerprints as prints, queries, simhash_dedup as dedup
from parapet.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text, n=4, lower=None):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower is None else lower(text or "")
    w = WORD.findall(t)
    s = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(docs, radius=4, n=4):
    """Union-find over all pairs: {(id, fp): smallest id}."""
    fps = [brute_fp(t, n) for _, t in docs]
    x = np.array(fps, np.uint64)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1:]) <= radius):
            parent[root(i)] = root(i + 1 + int(j))
    best = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            best[root(i)].append(d)
    return [(d, f"{fps[i]:016x}", min(best[root(i)], default=None)) for i, (d, _) in enumerate(docs)]


def key(rows):
    return sorted(rows, key=lambda r: [(x is None, x) for x in r])


def test_op5_whole_table(spark):
    docs = [tuple(r) for r in queries.documents(spark, SF01).select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op5(spark, SF01).collect()]
    want = brute_classes(docs)
    assert key(got) == key(want)
    assert len({c for _, _, c in want}) < len(want)


def test_classes_odd_and_empty(spark, odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").distinct().collect()]
    # null and empty text are one document under one id; here ids differ
    got = [(r["id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component"]) for r in dedup.classes(odd_docs).collect()]
    assert key(got) == key(brute_classes(docs))
    assert dedup.classes(no_docs).count() == 0
    assert dedup.keep_first(no_docs).columns == no_docs.columns and dedup.keep_first(no_docs).count() == 0
    kept = dedup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    classes = Counter(r[2] for r in brute_classes(docs))
    assert kept.count() == len(classes)


def chain_and_cluster():
    rnd = random.Random(11)
    centre = rnd.getrandbits(64)
    fps = {centre}
    for _ in range(900):        # a dense cluster, members mostly not within the radius of each other
        x = centre
        for b in rnd.sample(range(64), rnd.randint(1, 6)):
            x ^= 1 << b
        fps.add(x)
    x = rnd.getrandbits(64)
    for _ in range(40):         # a chain of steps of four bits
        for b in rnd.sample(range(64), 4):
            x ^= 1 << b
        fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(400)}
    return sorted(fps)


@pytest.mark.parametrize("chunk,blocks", [(4096, None), (100, 6), (64, 7)])
def test_links_keep_every_class(spark, chunk, blocks):
    fps = chain_and_cluster()
    x = np.array(fps, np.uint64)
    signed = x.view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    out = dedup.links(nodes, 4, chunk, blocks)
    rows = out.collect()
    for r in rows:
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 4
    got = {r["node"]: r["component"] for r in components(out).collect()}
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1:]) <= 4):
            parent[root(i)] = root(i + 1 + int(j))
    groups = defaultdict(set)
    for i in range(len(fps)):
        groups[root(i)].add(signed[i])
    want = {v: min(g) for g in groups.values() if len(g) > 1 for v in g}
    assert got == want


def test_components_of_a_path_and_self_links(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 100), (7, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_masks_hold_every_close_pair():
    rnd = random.Random(2)
    for blocks in (6, 7, 9):
        kept = bits.masks(blocks, 4)
        for _ in range(200):
            flips = sum(1 << b for b in rnd.sample(range(64), 4))
            assert any(flips & (m & (1 << 64) - 1) == 0 for m in kept)


def brute_print(text, n=3):
    w = WORD.findall((text or "").lower())
    s = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [(xxhash.xxh64(x.encode(), seed=42).intdigest(), len(x)) for x in s]
    return sum(1 << b for b in range(64) if sum(w if x >> b & 1 else -w for x, w in h) > 0)


def brute_edited(docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), (d[1] or "").encode()))
    out = []
    for i, (d, t) in enumerate(docs):
        t, nxt = t or "", docs[(i + 1) % len(docs)][1] or ""
        h = len(t) // 2
        e = t[:len(t) - h] + nxt[:h]
        f, g, x = brute_print(t), brute_print(e), brute_print(nxt)
        like = lambda a, b: 1 - bin(a ^ b).count("1") / 64
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, like(f, g), like(f, x)))
    return out


@pytest.mark.parametrize("blocks", [1, 5, 64])
def test_compare_edited_odd(odd_docs, no_docs, blocks):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = [(*r[:3], r[3] & (1 << 64) - 1, r[4] & (1 << 64) - 1, *r[5:])
           for r in map(tuple, prints.compare_edited(odd_docs, blocks=blocks).collect())]
    assert key(got) == key(brute_edited(docs))
    assert prints.compare_edited(no_docs, blocks=blocks).count() == 0


def test_single_document_follows_itself(spark):
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")
    r = prints.compare_edited(one).first()
    assert r["near_next"] == 1.0 and r["n_chars"] == 11


def test_op8_whole_table(spark):
    docs = [tuple(r) for r in queries.documents(spark, SF01).select("doc_id", "text").collect()]
    rows = queries.op8(spark, SF01).collect()
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16),
            r["near_edited"], r["near_next"]) for r in rows]
    want = brute_edited(docs)
    assert key(got) == key(want)
    fps = np.array([w[3] for w in want], np.uint64)
    counts = {w[0]: int((np.bitwise_count(fps ^ np.uint64(w[3])) <= 3).sum()) for w in want}
    assert all(r["n_within"] == (counts[r["doc_id"]] if r["doc_id"] % 20 == 0 else None) for r in rows)
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.1 + sum(r["near_next"] for r in rows) / len(rows)


def test_within_equals_brute_force(spark):
    fps = np.array(chain_and_cluster(), np.uint64).view(np.int64).tolist()
    index = spark.createDataFrame([(v,) for v in fps], "fp long")
    asked = index.filter(F.pmod("fp", F.lit(20)) == 0).select(F.col("fp").alias("query"))
    got = {(r["query"], r["fp"]): r["distance"] for r in prints.within(asked, index, 3).collect()}
    want = {(q, v): d for q in fps if q % 20 == 0 for v in fps if (d := bin((q ^ v) & (1 << 64) - 1).count("1")) <= 3}
    assert got == want


def test_copies_are_spread_and_any_names_are_kept(spark):
    names = "doc_id long, text string, __key string, __id int, __row string, __rn int, __FIRST int, __salt int, __hot int"
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(None, base, "b", 1, "r", 1, 2, 3, 4)] * 300 + [(None, base, "a", 1, "r", 1, 2, 3, 4)] * 3 + [
        (5, base + " more", "k", 2, "r", 1, 2, 3, 4), (5, "other text", "k", 3, "r", 1, 2, 3, 4), (9, None, "k", 4, None, 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, names).repartition(4)
    for hot_min in (50, 1000):
        out = dedup.keep_first(docs, hot_min=hot_min, hot_fraction=0.01)
        assert out.columns == docs.columns
        # the ids of one class: null and 5; the null ones come last
        assert key([tuple(r) for r in out.collect()]) == key([r for r in rows if r[0] in (5, 9)])
        alone = dedup.keep_first(docs.filter("doc_id is null"), hot_min=hot_min, hot_fraction=0.01)
        assert [tuple(r) for r in alone.collect()] == [rows[300]]


def test_votes_of_many_copies(spark):
    one = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    copies = one.crossJoin(spark.range(2000)).select("doc_id", "text").repartition(7)
    assert [tuple(r) for r in dedup.fingerprints(copies).collect()] == [tuple(dedup.fingerprints(one).first())]


def test_long_text_is_hashed_once(spark):
    text = " ".join(f"w{i % 9973}" for i in range(250_000))         # 1.5 MB
    t0 = time.time()
    fp = dedup.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["fp"]
    assert time.time() - t0 < 30
    assert fp & (1 << 64) - 1 == brute_fp(text)
