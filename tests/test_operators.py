"""Operator properties against plain-Python versions on small tables."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parapet.operators import bleu, decode, ensemble as ens, metrics_log as ml, sampling
from parapet.operators.ordinal import ordinal, running_offset


def test_running_offset_matches_python(spark):
    rnd = random.Random(3)
    rows = [(g, i, rnd.randint(0, 9)) for g in ("a", "b") for i in range(300)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, w int").repartition(5)
    out = running_offset(df, ["g"], ["i"], F.floor(F.col("i") / 7), F.col("w"), "off").collect()
    got = {(r["g"], r["i"]): r["off"] for r in out}
    for g in ("a", "b"):
        acc = 0
        for i in range(300):
            assert got[(g, i)] == acc
            acc += next(w for gg, ii, w in rows if gg == g and ii == i)


def test_sample_exact_is_exact_and_partition_independent(spark, monkeypatch):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = {r[0] for r in sampling.sample_exact(df.repartition(3), 700, 42, ["k"]).collect()}
    monkeypatch.setattr(sampling, "SMALL_ENOUGH", 10)      # force hash-prefix refinement
    b = {r[0] for r in sampling.sample_exact(df.repartition(11), 700, 42, ["k"]).collect()}
    import hashlib
    want = sorted(range(5000), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))[:700]
    assert a == b == set(want)


def test_split_partitions_the_corpus(spark):
    df = spark.range(4000).withColumnRenamed("id", "pair_id")
    s = sampling.train_valid_split(df, 1000, 7, ["pair_id"])
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"valid": 1000, "train": 3000}
    with pytest.raises(AssertionError):
        sampling.train_valid_split(spark.range(100).withColumnRenamed("id", "pair_id"), 60, 7, ["pair_id"])


def test_shuffle_positions_is_a_permutation(spark):
    df = spark.range(3000).withColumnRenamed("id", "k").repartition(4)
    pos = [r["pos"] for r in sampling.shuffle_positions(df, 1, ["k"]).collect()]
    assert sorted(pos) == list(range(3000))


def _py_bleu(pairs, max_n=4):
    c, t, hl, rl = [0] * max_n, [0] * max_n, 0, 0
    for h, r in pairs:
        hl += len(h)
        rl += len(r)
        for n in range(1, max_n + 1):
            hc = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
            rc = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
            c[n - 1] += sum(min(v, rc[g]) for g, v in hc.items())
            t[n - 1] += sum(hc.values())
    if c[0] == 0:
        return 0.0
    ps, smooth = [], 1.0
    for n in range(max_n):
        if t[n] == 0:
            return 0.0
        if c[n] == 0:
            smooth *= 2
            ps.append(100.0 / (smooth * t[n]))
        else:
            ps.append(100.0 * c[n] / t[n])
    bp = 1.0 if hl >= rl else (math.exp(1 - rl / hl) if hl > 0 else 0.0)
    return bp * math.exp(sum(math.log(p) for p in ps) / max_n)


def test_bleu_matches_reference_formula(spark):
    rnd = random.Random(5)
    vocab = "a b c d e f g".split()
    groups = {}
    rows = []
    for g in ("x", "y", "z"):
        for sid in range(40):
            r = [rnd.choice(vocab) for _ in range(rnd.randint(0, 12))]
            h = [w if rnd.random() < 0.7 else rnd.choice(vocab) for w in r][: rnd.randint(0, 14)]
            if g == "z":
                h = h[:2]     # orders 3 and 4 mostly without matches: smoothing
            rows.append((g, sid, h, r))
            groups.setdefault(g, []).append((h, r))
    df = spark.createDataFrame(rows, "g string, sid int, hyp array<string>, ref array<string>")
    got = {r["g"]: r["bleu"] for r in bleu.corpus_bleu(df, ["g"], ["sid"], F.col("hyp"), F.col("ref")).collect()}
    for g, pairs in groups.items():
        assert got[g] == pytest.approx(_py_bleu(pairs), abs=1e-9)
    same = spark.createDataFrame([("x", 1, ["a", "b", "c", "d", "e"])], "g string, sid int, t array<string>")
    assert bleu.corpus_bleu(same, ["g"], ["sid"], F.col("t"), F.col("t")).first()["bleu"] == pytest.approx(100.0)


def test_tokenize_13a_examples(spark):
    df = spark.createDataFrame([("Hello, world. It costs $3.50-ish!",)], "t string")
    toks = df.select(bleu.tokenize_13a("t").alias("x")).first()["x"]
    assert toks == ["Hello", ",", "world", ".", "It", "costs", "$", "3.50", "-", "ish", "!"]


def test_log_softmax_and_single_member(spark):
    rnd = np.random.default_rng(1)
    rows = [(s, m, [float(x) for x in rnd.normal(size=16)]) for s in range(10) for m in range(3)]
    df = spark.createDataFrame(rows, "sid int, model int, logits array<double>")
    lp = df.select("sid", "model", ens.log_softmax("logits").alias("lp"))
    for r in lp.collect():
        assert sum(math.exp(x) for x in r["lp"]) == pytest.approx(1.0)
    one = lp.filter("model = 0")
    avg = {r["sid"]: r["avg_logprobs"] for r in ens.ensemble_average(one, ["sid"], "lp", 1).collect()}
    for r in one.collect():
        assert avg[r["sid"]] == pytest.approx(r["lp"])
    three = {r["sid"]: r["avg_logprobs"] for r in ens.ensemble_average(lp, ["sid"], "lp", 3).collect()}
    for s in range(10):
        probs = np.mean([np.exp(r["lp"]) for r in lp.filter(F.col("sid") == s).collect()], axis=0)
        assert three[s] == pytest.approx(list(np.log(probs)))


def test_argmax_ties_go_to_lowest_id(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 2.0],)], "a array<double>")
    assert df.select(ens.argmax("a")).first()[0] == 1


def walk(best, start, limit):
    """Greedy path by a plain loop: (tokens, why it ends)."""
    path, seen, tok = [], {start}, start
    while True:
        if tok not in best:
            return path, "dead_end"
        if len(path) == limit:
            return path, "length"
        tok = best[tok]
        if tok in seen:
            return path, "repeat"
        path.append(tok)
        seen.add(tok)
        if tok == "</s>":
            return path, "eos"


@pytest.mark.parametrize("limit", [512, 5])
def test_greedy_decode_matches_loop(spark, limit):
    best = {"a": "b", "b": "c", "c": "a", "x": "</s>", "y": "z", "self": "self", "into": "b"}
    best |= {f"n{i}": f"n{i + 1}" for i in range(600)} | {f"e{i}": f"e{i + 1}" for i in range(100)} | {"e100": "</s>"}
    starts = [(i, t) for i, t in enumerate(["a", "x", "y", "q", "a", "n0", "n300", "e3", "e98", "self", "into", None])]
    bdf = spark.createDataFrame(list(best.items()), "prev string, next string")
    sdf = spark.createDataFrame(starts, "sid long, token string")
    out = decode.greedy_decode(sdf, decode.greedy_paths(bdf, limit))
    got = {r["sid"]: (list(r["path"]), r["stop"]) for r in out.collect()}
    assert len(got) == len(starts)
    for sid, tok in starts:
        path, why = ([], "empty") if tok is None else walk(best, tok, limit)
        assert got[sid][0] == path, tok
        # at the limit itself the path may also have come to its end
        assert got[sid][1] == why or len(path) == limit, tok
    text = {r["sid"]: (r["hypothesis"], r["n_steps"]) for r in decode.decoded_text(out).collect()}
    assert text[1] == ("", 1) and text[11] == ("", 0) and text[3] == ("", 0)


def test_pairs_of_long_conversations_have_keys_of_their_own(spark):
    from parapet.operators.corpus import conversation_pairs
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}-{t}") for c in (1, 2) for t in range(1010)]
    pairs = conversation_pairs(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert len(pairs) == len({r["pair_id"] for r in pairs}) == 1010


def test_pad_batch_has_two_widths_and_unknown_ids_stay(spark):
    from parapet.operators import features as ft
    df = spark.createDataFrame([(0, [5, 6], [1, 2, 3, 4]), (0, [7], [1])], "b int, input_ids array<int>, labels array<int>")
    rows = sorted((list(r["input_ids"]), list(r["attention_mask"]), list(r["labels"])) for r in ft.pad_batch(df, "b", 0).collect())
    assert rows == [([5, 6], [1, 1], [1, 2, 3, 4]), ([7, 0], [1, 0], [1, -100, -100, -100])]
    vocab = spark.createDataFrame([("the", 5)], "word string, id int")
    text = spark.createDataFrame([(1, "the zzunknownzz the")], "k int, t string")
    assert ft.word_ids(text, ["k"], "t", vocab, unknown="null").first()["ids"] == [5, None, 5]
    with pytest.raises(Exception, match="not in the vocabulary"):
        ft.word_ids(text, ["k"], "t", vocab).collect()
    tokens = spark.createDataFrame([(0, "", True), (1, "6869", False)], "id int, token_hex string, is_special boolean")
    ids = spark.createDataFrame([(1, [0, 1, 9]), (2, [0, 1]), (3, [])], "k int, ids array<int>")
    got = {r["k"]: r["text"] for r in ft.decode(ids, ["k"], "ids", tokens, unknown="null").collect()}
    assert got == {1: None, 2: "hi", 3: ""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        ft.decode(ids, ["k"], "ids", tokens).collect()


def test_partition_count_follows_the_bytes_read(spark, tmp_path):
    from parapet.operators.sizing import partitions_for
    spark.range(200_000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(df) == least
    assert partitions_for(df.join(df.withColumnRenamed("id", "j")), 1 << 14) > least
    assert partitions_for(spark.createDataFrame([(1,)], "a int")) == least


def test_opaque_scorer_decoding(spark):
    # member k prefers token (len(prefix) + k) % 5; eos id 4
    def member(k):
        def score(srcs, prefixes):
            out = np.full((len(srcs), 5), -5.0)
            for i, p in enumerate(prefixes):
                out[i, (len(p) + k) % 5] = 5.0 + len(srcs[i]) % 2
            return out
        return score
    df = spark.createDataFrame([(1, "ab"), (2, "abc")], "sid long, src string")
    one = {r["sid"]: list(r["ids"]) for r in decode.greedy_decode_batch(df, [member(0)], 4, 10).collect()}
    assert one[1] == [0, 1, 2, 3, 4]
    two = {r["sid"]: list(r["ids"]) for r in decode.greedy_decode_batch(df, [member(0), member(0)], 4, 3).collect()}
    assert two[2] == [0, 1, 2]


def _py_early_stop(values, patience=5):
    best, wait = None, 0
    for e, v in enumerate(values, 1):
        if best is None or v < best:
            best, wait = v, 0
        else:
            wait += 1
            if wait >= patience:
                return e
    return None


def test_early_stop_matches_loop_with_a_hot_run(spark, monkeypatch):
    monkeypatch.setattr(ml, "EPOCHS_PER_BLOCK", 8)      # many blocks per run
    rnd = random.Random(11)
    runs = {0: [1.0 / (i + 1) for i in range(400)]}     # always improves: never stops
    runs[1] = [rnd.random() for _ in range(2000)]        # a hot run
    for r in range(2, 30):
        runs[r] = [rnd.random() for _ in range(rnd.randint(1, 60))]
    rows = [(r, e + 1, v) for r, vs in runs.items() for e, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "run int, epoch long, value double")
    got = {r["run"]: r["stop_epoch"] for r in ml.early_stop(df, "run", "epoch", "value").collect()}
    for r, vs in runs.items():
        assert got[r] == _py_early_stop(vs), r


def test_best_checkpoints(spark):
    rows = [(1, e, v) for e, v in enumerate([5.0, 3.0, 4.0, 1.0, 2.0, 6.0, 0.5, 7.0], 1)]
    df = spark.createDataFrame(rows, "run int, epoch long, value double")
    out = {r["epoch"]: r for r in ml.best_checkpoints(df, "run", "epoch", "value").collect()}
    assert {e for e, r in out.items() if r["in_top_k"]} == {7, 4, 5, 2, 3}
    assert {e for e, r in out.items() if r["in_last_k"]} == {6, 7, 8}
    assert [e for e, r in out.items() if r["is_best"]] == [7]


def test_running_offset_with_coarse_blocks(spark):
    rnd = random.Random(9)
    rows = [(f"w{i:04d}", rnd.choice([1, 1, 1, 2, 3, 5, 8])) for i in range(800)]
    df = spark.createDataFrame(rows, "word string, cnt long").repartition(6)
    block = F.struct((-F.col("cnt")).alias("nc"), F.substring("word", 1, 3).alias("p"))
    out = running_offset(df, [], [-F.col("cnt"), F.col("word")], block, None, "o",
                         coarse=lambda b: b.getField("nc")).collect()
    got = {r["word"]: r["o"] for r in out}
    want = {w: i for i, (w, c) in enumerate(sorted(rows, key=lambda x: (-x[1], x[0])))}
    assert got == want


def test_require_members_skips_and_fails(spark):
    scores = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b")], "sid int, model string")
    assert ens.require_members(ens.available_members(scores, ["a", "b", "c"])) == ["a", "b"]
    with pytest.raises(RuntimeError):
        ens.require_members(ens.available_members(scores.limit(0), ["a"]))


def test_salted_join_equals_plain_join(spark):
    from parapet.operators import skew
    rnd = random.Random(4)
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{rnd.randint(0, 50)}") for i in range(3000)],
                                  "i long, k string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{j}", j) for j in range(40)], "k string, v int")
    want = sorted(tuple(r) for r in facts.join(dim, "k").select("i", "k", "v").collect())
    got_df = skew.salted_join(facts, dim, "k", salts=5, hot_min=100)
    assert sorted(tuple(r) for r in got_df.select("i", "k", "v").collect()) == want
    freq = facts.groupBy("k").agg(F.count(F.lit(1)).alias("__n"))
    assert skew.hot_keys(freq, "k", hot_min=100) == ["hot"]


def test_union_keeps_directions_an_order_does_not_name(spark):
    from parapet.operators import corpus
    rows = [("en__fr", 0), ("en__fr", 1), ("en__de", 0), ("en__it", 0), (None, 0)]
    df = spark.createDataFrame(rows, "direction string, idx long")
    ids = lambda out: {(r["direction"], r["idx"]): r["pair_id"] for r in out.collect()}
    assert ids(corpus.union_directions(df, order=["en__it", "en__xx"])) == {
        ("en__it", 0): 0, ("en__de", 0): 1, ("en__fr", 0): 2, ("en__fr", 1): 3, (None, 0): 4}
    assert ids(corpus.union_directions(df)) == {
        ("en__de", 0): 0, ("en__fr", 0): 1, ("en__fr", 1): 2, ("en__it", 0): 3, (None, 0): 4}


def test_bleu_counts_sentences_in_place_and_pools_rows_of_one_sentence(spark, monkeypatch):
    rnd = random.Random(9)
    words = ["a", "b", "c", ""]
    rows = [("x", rnd.choice([None, *range(150)]), [rnd.choice(words) for _ in range(rnd.randint(0, 9))],
             [rnd.choice(words) for _ in range(rnd.randint(0, 9))]) for _ in range(200)]
    rows += [("x", 7, [*"abcab"] * 5, [*"abcbb"] * 5)] * 3 + [("x", 200, None, ["a"])]
    df = spark.createDataFrame(rows, "g string, sid int, hyp array<string>, ref array<string>")
    c, t = Counter(), Counter()
    for sid in {r[1] for r in rows}:
        for n in range(1, 5):
            hc, rc = (Counter(tuple(r[k][i:i + n]) for r in rows if r[1] == sid and r[k] is not None
                              for i in range(len(r[k]) - n + 1)) for k in (2, 3))
            c[n] += sum(min(v, rc[g]) for g, v in hc.items())
            t[n] += sum(hc.values())
    for limit in (1 << 20, 40, 0):      # gathered, some gathered, none
        monkeypatch.setattr(bleu, "GATHER_TOKENS", limit)
        monkeypatch.setattr(bleu, "SLICE_TOKENS", 50)
        got = bleu.corpus_bleu(df, ["g"], ["sid"], F.col("hyp"), F.col("ref")).first()
        assert [got[f"p{n}"] for n in range(1, 5)] == [pytest.approx(100 * c[n] / t[n], abs=1e-6) for n in range(1, 5)]
        assert (got["hyp_len"], got["ref_len"]) == tuple(sum(len(r[k]) for r in rows if r[k] is not None) for k in (2, 3))
    alone = bleu.sentence_stats(df.filter("sid >= 200"), ["g"], ["sid"], F.col("hyp"), F.col("ref"))
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan        # no text and no n-gram is shuffled


def test_bigram_cells_shuffle_word_pairs_once_and_spread_frequent_words(spark, monkeypatch):
    from parapet.operators import skew
    monkeypatch.setattr(skew, "HOT_MIN", 20)
    rnd = random.Random(3)
    rows = [(rnd.choice("mn"), " ".join(rnd.choice("aaaabcd") for _ in range(rnd.randint(0, 9)))) for _ in range(120)]
    df = spark.createDataFrame(rows, "member string, line string")
    c, t = Counter(), Counter()
    for m, line in rows:
        w = [*line.split(), "</s>"]
        c.update((m, *p) for p in zip(w, w[1:]))
        t.update((m, x) for x in w[:-1])
    cells, totals = decode.bigram_cells(df, "member", "line", ["m", "n"])
    got = {(r["member"], r["prev"], r["next"]): (r["c"], r["p"]) for r in decode.bigram_scores(cells, ["m", "n"]).collect()}
    assert got == {k: (n, n / t[k[:2]]) for k, n in c.items()}
    assert {(r["prev"], r["t0"], r["t1"]) for r in totals.collect()} == {(w, t["m", w], t["n", w]) for _, w in t}
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2      # the pairs, and the few totals


def test_bigram_cells_shuffle_a_row_a_context_and_only_near_ties_are_ranked(spark, monkeypatch):
    from parapet.operators import skew
    monkeypatch.setattr(skew, "HOT_MIN", 50)
    rnd = random.Random(5)
    words = ["a", "b", "é", "日本", "</s>", "x\ty"]
    rows = [(rnd.choice(["m", "n", "other", None]), "  ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))) for _ in range(300)]
    df = spark.createDataFrame([*rows, ("m", None), ("m", "   ")], "member string, line string")
    c, t = Counter(), Counter()
    for m, line in rows:
        w = [x for x in line.split(" ") if x]
        c.update((p, q, m) for p, q in zip(w, [*w[1:], "</s>"]))
        t.update((p, m) for p in w)
    cells, totals = decode.bigram_cells(df, "member", "line", ["m", "n"])
    want = {(p, q): (c[p, q, "m"], c[p, q, "n"], t[p, "m"], t[p, "n"]) for p, q, _ in c}
    got = [tuple(r) for r in cells.collect()]
    assert len(got) == len(want) and {r[:2]: r[2:] for r in got} == want
    assert {r["prev"] for r in totals.collect()} == {p for p, _ in t}
    plan = cells.select("prev")._jdf.queryExecution().executedPlan().toString()
    assert "arrays_zip" not in plan and plan.count("MapInArrow") == 2       # a row a context and batch is shuffled, not a row a word pair
    share = lambda k, i: want[k][i] / want[k][2 + i] if want[k][2 + i] else 0.0
    p = {k: round((share(k, 0) + share(k, 1)) / 2, 9) for k in want}
    best = {x: min((-p[k], k[1].encode()) for k in want if k[0] == x) for x in {k[0] for k in want}}
    assert {r["prev"]: (-r["p"], r["next"].encode()) for r in decode.best_next(cells, 2).collect()} == best


def test_decoding_reads_its_lines_once_for_the_starts(spark, tmp):
    from parapet.operators.decode import first_token, tokens
    lines = [" a  b", "", None, "   ", "x", "\n y z", "b\n c"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert all(r[0] == r[1] for r in df.select(first_token("line"), F.get(tokens("line"), F.lit(0))).collect())
    acc = spark.sparkContext.accumulator(0)

    def seen(batches):
        for rb in batches:
            acc.add(len(rb))
            yield rb

    best = spark.createDataFrame([("a", "b"), ("b", "</s>")], "prev string, next string")
    starts = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(20)], "sid int, token string").mapInArrow(seen, "sid int, token string")
    paths = decode.greedy_paths(best, starts=starts)
    assert acc.value == 20
    out = decode.greedy_decode(starts, paths).collect()
    assert len(out) == 20 and acc.value <= 80       # the frequencies, the join and the rows without a token
