"""Opaque scorers over the whole vocabulary, against a dense walk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parapet.operators import decode, scorers
from parapet.sources import members
from parapet.plans.queries_ensemble import OPAQUE_MEMBERS, _opaque_members

CHAIN = [f"w{i:02d}" for i in range(40)]
LINES = [("m0", " ".join(CHAIN)), ("m1", "a b c a b c a"), ("m2", "b c a b"), ("m3", "x y"), ("m3", "x z"), ("m0", "x z")]


def _walk(lines, start):
    """Dense logits of each member over all ids, walked word by word."""
    words = sorted({w for _, x in lines for w in x.split()} | {decode.EOS})
    at = {w: i for i, w in enumerate(words)}
    c = {m: np.zeros((len(words), len(words))) for m in OPAQUE_MEMBERS}
    for m, x in lines:
        t = x.split()
        for p, n in zip(t, [*t[1:], decode.EOS]):
            c[m][at[p], at[n]] += 1
    path, seen, last = [], {start}, start
    while len(path) < decode.MAX_STEPS:
        z = np.stack([np.log1p(c[m][at[last]]) for m in OPAQUE_MEMBERS])
        p = (np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)).mean(axis=0)
        last = words[int(np.log(p).round(9).argmax())]
        if last in seen:
            return path, "repeat"
        path.append(last)
        seen.add(last)
        if last == decode.EOS:
            return path, "eos"
    return path, "length"


def _decoded(spark):
    df = spark.createDataFrame(LINES, "member string, line string")
    best = decode.opaque_best_next(*decode.bigram_cells(df, "member", "line", OPAQUE_MEMBERS), _opaque_members)
    starts = spark.createDataFrame([(i, w) for i, w in enumerate([*CHAIN, "a", "b", "c", "x", "y", "z", None])],
                                   "sid int, token string")
    out = decode.greedy_decode(starts, decode.greedy_paths(best, starts=starts), ["sid"]).join(starts, "sid")
    return {r["token"]: (list(r["path"]), r["stop"]) for r in out.collect()}


def test_paths_reach_their_end_and_say_which(spark):
    got = _decoded(spark)
    assert got["w00"] == (CHAIN[1:] + [decode.EOS], "eos")
    assert got["a"][1] == "repeat" and got[None] == ([], "empty")
    assert {k: v for k, v in got.items() if k is not None} == {w: _walk(LINES, w) for w in got if w is not None}


def test_length_is_the_only_limit(spark):
    n = decode.MAX_STEPS + 20
    df = spark.createDataFrame([("m0", " ".join(f"v{i}" for i in range(n)))], "member string, line string")
    best = decode.opaque_best_next(*decode.bigram_cells(df, "member", "line", OPAQUE_MEMBERS), _opaque_members)
    paths = {r["prev"]: r for r in decode.greedy_paths(best).filter(F.col("prev").isin("v0", "v100")).collect()}
    assert (len(paths["v0"]["path"]), paths["v0"]["stop"]) == (decode.MAX_STEPS, "length")
    assert paths["v100"]["stop"] == "eos" and len(paths["v100"]["path"]) == n - 100


def test_paths_of_some_starts_are_those_of_all_contexts(spark):
    rnd = np.random.default_rng(4)
    rows = [(f"t{i}", f"t{j}") for i, j in enumerate(rnd.integers(0, 300, 300)) if i % 29] + [("t29", decode.EOS), ("t58", decode.EOS)]
    best = spark.createDataFrame(rows, "prev string, next string")
    for limit in (1, 2, 7, decode.MAX_STEPS):
        every = {r["prev"]: (list(r["path"]), r["stop"]) for r in decode.greedy_paths(best, limit).collect()}
        table = dict(rows)
        for t, (path, stop) in every.items():
            want, seen, last, why = [], {t}, t, "length"
            while len(want) < limit:
                if last not in table:
                    why = "eos" if last == decode.EOS else "dead_end"
                    break
                last = table[last]
                if last in seen:
                    why = "repeat"
                    break
                want.append(last)
                seen.add(last)
                if last == decode.EOS:
                    why = "eos"
                    break
            assert path == want, (t, limit)
            assert stop == why or len(path) == limit
        some = spark.createDataFrame([("t3",), ("t3",), ("t200",), (None,), ("never",)], "token string")
        got = {r["prev"]: (list(r["path"]), r["stop"]) for r in decode.greedy_paths(best, limit, starts=some).collect()}
        assert got == {"t3": every["t3"], "t200": every["t200"], "never": ([], "dead_end")}


# ---- members that see the source and the whole prefix --------------------------

V, BOS, EOS_ID = 12, 0, 1


class Dense(scorers.TableMember):
    """The same member, every id listed."""

    def scores(self, state, vocab):
        s = super().scores(state, vocab)
        z = np.repeat(s.rest, vocab)
        z[s.key] = s.logit
        return scorers.Scores(np.arange(len(z)), z, s.rest)


def _members(rng, kind=scorers.TableMember):
    out = []
    for m in range(3):
        cells = sorted({(int(a), int(b)) for a, b in rng.integers(0, V, (40, 2))})
        out.append(kind(np.array([a for a, _ in cells]), np.array([b for _, b in cells]), rng.integers(1, 6, len(cells)), BOS, 0.5 * m, 0.7))
    return out


def _plain(source, prefix, members, max_steps, on_repeat):
    """Dense logits of the whole prefix, from the start at every step."""
    ids, prefix = [], list(prefix)
    while len(ids) < max_steps:
        p = []
        for m in members:
            z = np.zeros(V)
            last = prefix[-1] if prefix else BOS
            for a, b, c in zip(m.prev, m.next, m.c):
                if a == last:
                    z[b] += np.log1p(c)
            for t in set(source):
                z[t] += m.source
            for t in prefix:
                z[t] -= m.fresh
            p.append(np.exp(z) / np.exp(z).sum())
        t = int(np.log(np.mean(p, axis=0)).round(scorers.DIGITS).argmax())
        if on_repeat and t in prefix:
            return ids, "repeat"
        ids.append(t)
        prefix.append(t)
        if t == EOS_ID:
            return ids, "eos"
    return ids, "length"


@pytest.mark.parametrize("kind", [scorers.TableMember, Dense])
@pytest.mark.parametrize("on_repeat", [True, False])
def test_trie_equals_a_plain_loop(kind, on_repeat):
    rng = np.random.default_rng(8)
    members = _members(rng, kind)
    sources = [rng.integers(0, V, rng.integers(0, 6)).tolist() for _ in range(25)] * 2 + [[], []]
    prefixes = [rng.integers(0, V, rng.integers(0, 3)).tolist() for _ in sources[:-2]] + [[], [BOS]]
    work = scorers.Work()
    ids, stop = scorers.decode_batch(sources, prefixes, members, EOS_ID, V, 20, on_repeat, work=work)
    assert [(a, b) for a, b in zip(ids, stop)] == [_plain(s, p, members, 20, on_repeat) for s, p in zip(sources, prefixes)]
    assert work.scored < work.steps         # equal states were scored once
    first, _ = scorers.decode_batch([[3, 4]], [[]], members, EOS_ID, V, 20)
    work = scorers.Work()
    scorers.decode_batch([[3, 4]] * 3, [[], first[0][:1], first[0][:2]], members, EOS_ID, V, 18, work=work)
    assert work.scored <= 18 + 2            # three rows on one path of the trie


def test_sources_are_decoded_once_and_joined_back(spark):
    rng = np.random.default_rng(9)
    members = _members(rng)
    rows = [(i, [int(x) for x in rng.integers(0, V, 3)], [BOS]) for i in range(40)] + [(40, None, None), (40, [5, 5, 5], [BOS]), (40, [5, 5, 5], [BOS])]
    df = spark.createDataFrame(rows, "sid int, src array<int>, prefix array<int>").repartition(3)
    out = scorers.decode_sources(df, lambda: members, EOS_ID, V, max_steps=9, stop_on_repeat=True)
    want = sorted((i, *_plain(s or [], p or [], members, 9, True)) for i, s, p in rows)
    assert sorted((r["sid"], list(r["ids"]), r["stop"]) for r in out.collect()) == want
    with pytest.raises(Exception, match="no ensemble member"):
        scorers.decode_sources(df, lambda: [], EOS_ID, V).collect()


def test_successors_are_the_most_frequent(spark):
    df = spark.createDataFrame([("m0", [5, 6, 5, 6, 5, 7]), ("m0", [5]), ("m1", [])], "member string, ids array<int>")
    got = sorted(tuple(r) for r in scorers.successor_counts(df, "member", "ids", 0, 1, 2).collect())
    assert got == [("m0", 0, 5, 2), ("m0", 5, 1, 1), ("m0", 5, 6, 2), ("m0", 6, 5, 2), ("m0", 7, 1, 1), ("m1", 0, 1, 1)]


def test_members_that_do_not_load_are_skipped_and_named(spark, tmp):
    table = spark.createDataFrame([(m, p, n, 1 + m) for m in range(4) for p in (5, 3) for n in (7, 2)], "member int, prev int, next int, c long")
    saved = {r["model"]: r["path"] for r in members.save_members(table, f"{tmp}/models").collect()}
    assert sorted(saved) == ["0", "1", "2", "3"]
    a = members.read_member(saved["2"])
    assert list(zip(a["prev"], a["next"], a["c"])) == [(3, 2, 3), (3, 7, 3), (5, 2, 3), (5, 7, 3)]
    whole = open(saved["1"], "rb").read()
    with open(saved["1"], "wb") as f:
        f.write(whole[:-5])
    with open(saved["3"], "wb") as f:
        f.write(b"<html>404</html>")
    files = spark.createDataFrame([*saved.items(), ("4", f"{tmp}/models/4.member"), ("5", None)], "model string, path string")
    checked = members.check_members(files)
    assert {r["model"]: r["reason"] for r in checked.collect()} == {
        "0": None, "1": "damaged", "2": None, "3": "not a member file", "4": "no file", "5": "no path"}
    loaded = members.loaded_members(checked)
    assert [m for m, _ in loaded] == ["0", "2"]
    df = spark.createDataFrame([(1, [7], [5])], "sid int, src array<int>, prefix array<int>")
    out = scorers.decode_sources(df, lambda: members.table_members(loaded, 0, {"0": (1.0, 1.0), "2": (1.0, 1.0)}), 2, 10).first()
    assert list(out["ids"])[0] == 7             # two members, not six
    with pytest.raises(RuntimeError, match="no ensemble member"):
        members.loaded_members(checked.filter("not available"))


class OneByOne(scorers.TableMember):
    """Not scored together with the others."""


def test_tables_together_equal_tables_one_by_one():
    rng = np.random.default_rng(11)
    for trial in range(20):
        vocab, seed = int(rng.integers(3, 30)), int(rng.integers(1 << 30))

        def members(kind):
            r, out = np.random.default_rng(seed), []
            for _ in range(3):
                cells = sorted({(int(a), int(b)) for a, b in r.integers(0, vocab, (50, 2))})
                out.append(kind(np.array([a for a, _ in cells]), np.array([b for _, b in cells]), r.integers(1, 6, len(cells)), BOS,
                                float(r.choice([-1.0, 0.0, 2.0, 4.0])), float(r.choice([0.0, 0.5, 2.0]))))
            return out

        sources = [rng.integers(0, vocab, rng.integers(0, 2 * vocab)).tolist() for _ in range(20)]
        prefixes = [rng.integers(0, vocab, rng.integers(0, 4)).tolist() for _ in sources]
        assert type(scorers.together(members(scorers.TableMember))) is scorers.TableEnsemble
        assert type(scorers.together(members(OneByOne))) is scorers.Ensemble
        got, want = (scorers.decode_batch(sources, prefixes, members(kind), EOS_ID, vocab, 25, bool(trial % 2)) for kind in (scorers.TableMember, OneByOne))
        assert got == want


def test_rows_are_decoded_where_they_stand(spark):
    df = spark.createDataFrame([(i, [3, 4], [BOS]) for i in range(50)], "sid int, src array<int>, prefix array<int>").repartition(3)
    df = df.checkpoint()
    members = _members(np.random.default_rng(9))
    out = scorers.decode_sources(df, lambda: members, EOS_ID, V, max_steps=9)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r["ids"]) for r in out.collect()} == {tuple(_plain([3, 4], [BOS], members, 9, False)[0])} and out.count() == 50
