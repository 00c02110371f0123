"""BPE training and encoding against the installed public `tokenizers`
library (test-only dependency), on the driver's smallest tables."""

import json
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from parapet.operators import bpe, features as ft
from parapet.plans import fixtures as fx

tokenizers = pytest.importorskip("tokenizers")

SPECIALS = ["<de>", "<fr>", "<s>", "</s>", "<pad>"]
VOCAB = 330


def _shown():
    odd = [b for b in range(256) if not bpe._printable(b)]
    return {b: chr(b) if bpe._printable(b) else chr(256 + odd.index(b)) for b in range(256)}


@pytest.fixture(scope="module")
def trained(spark):
    lines = fx.lines(spark, SF001)
    model = bpe.learn_bpe(bpe.word_counts(lines, "line"), VOCAB, SPECIALS, phase_symbols=8000)
    texts = [r[0] for r in lines.select("line").collect()]
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=VOCAB, special_tokens=SPECIALS, show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet()))
    return model, tok, lines


def test_merges_and_vocab_equal_library(trained):
    model, tok, _ = trained
    js = json.loads(tok.to_str())
    lib = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in js["model"]["merges"]]
    shown = _shown()
    disp = lambda bs: "".join(shown[b] for b in bs)
    ours = [(disp(model.token_bytes[a]), disp(model.token_bytes[b])) for a, b, _ in model.merges]
    assert ours == lib
    vocab = {(SPECIALS[i] if i < len(SPECIALS) else disp(tb)): i for i, tb in enumerate(model.token_bytes)}
    assert vocab == js["model"]["vocab"]
    assert 1 < model.rounds < len(model.merges)      # several merges a phase


def test_encode_equals_library_and_round_trips(spark, trained):
    model, tok, lines = trained
    sample = lines.filter(F.col("doc_id") < 15).select("doc_id", "line_no", "line")
    enc = ft.encode(sample, ["doc_id", "line_no"], "line", model)
    got = {(r["doc_id"], r["line_no"]): list(r["ids"]) for r in enc.collect()}
    for r in sample.collect():
        assert got[(r["doc_id"], r["line_no"])] == tok.encode(r["line"]).ids
    dec = ft.decode(enc, ["doc_id", "line_no"], "ids", model.vocab_df(spark))
    back = {(r["doc_id"], r["line_no"]): r["text"] for r in dec.collect()}
    for r in sample.collect():
        assert back[(r["doc_id"], r["line_no"])] == r["line"]


def test_special_strings_in_texts_are_their_own_ids(spark, trained):
    model, tok, _ = trained
    tok.add_special_tokens(SPECIALS)
    texts = ["<de> hello world", "<de>", " <de> x", "a <fr><de>b </s>", "<dex> <d e>", "x<pad>", "", "<s>a</s> \n<de>\n b"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r["k"]: list(r["ids"]) for r in ft.encode(df, ["k"], "t", model).collect()}
    for k, t in enumerate(texts):
        assert got[k] == tok.encode(t).ids, t


def test_phases_of_any_size_learn_the_same_merges(spark, trained):
    # many ties: the live pairs end inside a run of equal counts
    words = [(a + b + c, 2 + (a == "a")) for a in "abcd" for b in "efgh" for c in "ijkl"] + [("aaaaaaa", 5), ("ababab", 5), ("é日本", 5)]
    df = spark.createDataFrame(words, "word string, cnt long")
    want = bpe.learn_bpe(df, 256 + 90, [])
    assert want.rounds == 1 and len(want.merges) > 60
    for symbols, pairs in ((1, 1), (40, 1000), (1000, 3)):
        got = bpe.learn_bpe(df, 256 + 90, [], symbols, pairs)
        assert got.merges == want.merges and got.rounds > 3
    empty = bpe.learn_bpe(df.limit(0), 300, SPECIALS)
    assert empty.merges == [] and empty.vocab_size == 256 + len(SPECIALS)


def test_a_merge_that_spells_a_token_again_ends_a_phase(spark):
    # "abc" grows once from (ab, c) and once from (a, bc)
    words = [("ab", 100), ("abc", 50), ("xbc", 300), ("bc", 40), ("yabc", 45), ("zabcq", 44), ("cq", 43)]
    ids = {b: i for i, b in enumerate(bpe.byte_order())}
    flat = np.array([ids[b] for w, _ in words for b in w.encode()], np.int32)
    lens, cnt = np.array([len(w) for w, _ in words]), np.array([c for _, c in words])
    names = bpe.new_model([]).token_bytes
    got = bpe.merge_in_turn(flat, lens, cnt, names, 400)
    model = bpe.learn_bpe(spark.createDataFrame(words, "word string, cnt long"), 400, [], 1, 1)
    assert model.merges == got
    names = names + [b"abc"]                 # known before: the merge that spells it is the phase's last
    twice = bpe.merge_in_turn(flat, lens, cnt, names, 400, floor=(1, 1 << 62))
    assert twice[-1][2] == 256 and [m[2] for m in twice].count(256) == 1
    assert len(bpe.merge_in_turn(flat, lens, cnt, names, 400)) > len(twice)


def plain_encode(ids, ranks):
    """Every occurrence of the lowest-ranked pair, again and again."""
    while True:
        found = [(ranks[p], p) for p in zip(ids, ids[1:]) if p in ranks]
        if not found:
            return ids
        (_, new), pair = min(found)
        out, i = [], 0
        while i < len(ids):
            hit = tuple(ids[i:i + 2]) == pair
            out.append(new if hit else ids[i])
            i += 2 if hit else 1
        ids = out


def test_long_words_are_encoded_in_order(spark, trained):
    model, tok, _ = trained
    rnd = random.Random(3)
    ranks, base = model.ranks(), {b: len(SPECIALS) + i for i, b in enumerate(bpe.byte_order())}
    for n in (0, 1, 2, 3, 50, 400):
        for letters in ("a", "ab", "thein", "the and ing"):
            w = "".join(rnd.choice(letters) for _ in range(n))
            ids = [base[b] for b in w.encode()]
            assert bpe.encode_word(ids, ranks) == plain_encode(ids, ranks)
    long = "".join(rnd.choice("theainx") for _ in range(1_000_000))
    t0 = time.time()
    got = bpe.encode_word([base[b] for b in long.encode()], ranks)
    assert time.time() - t0 < 30 and got == tok.encode(long).ids


def test_rows_of_equal_keys_keep_their_own_ids(spark, trained):
    model, tok, _ = trained
    texts = ["ab cd", "xyz", "ab cd", "", None, "the the"]
    df = spark.createDataFrame([(1, t) for t in texts] + [(None, "ab cd"), (None, "xyz")], "k int, t string").repartition(3)
    enc = ft.encode(df, ["k"], "t", model)
    got = sorted((r["k"] or 0, list(r["ids"])) for r in enc.collect())
    assert got == sorted([(1, tok.encode(t or "").ids) for t in texts] + [(0, tok.encode(t).ids) for t in ("ab cd", "xyz")])
    back = ft.decode(enc, ["k"], "ids", model.vocab_df(spark)).collect()
    assert sorted((r["k"] or 0, r["text"]) for r in back) == sorted([(1, t or "") for t in texts] + [(0, "ab cd"), (0, "xyz")])
    vocab = spark.createDataFrame([("ab", 3), ("cd", 4), ("xyz", 5), ("the", 6)], "word string, id int")
    ids = ft.word_ids(df, ["k"], "t", vocab)
    assert sorted((r["k"] or 0, list(r["ids"])) for r in ids.collect()) == sorted(
        [(1, [3, 4]), (1, [3, 4]), (1, [5]), (1, []), (1, []), (1, [6, 6]), (0, [3, 4]), (0, [5])])


def test_forgetful_workers_encode_the_same(spark, trained):
    model, tok, lines = trained
    sample = lines.filter(F.col("doc_id") < 40).select("doc_id", "line_no", "line")
    enc = ft.encode(sample, ["doc_id", "line_no"], "line", model, remembered=5)
    got = {(r["doc_id"], r["line_no"]): list(r["ids"]) for r in enc.collect()}
    for r in sample.collect():
        assert got[(r["doc_id"], r["line_no"])] == tok.encode(r["line"]).ids


def test_ids_the_vocabulary_lacks(spark, trained):
    model, _, _ = trained
    df = spark.createDataFrame([(1, [300, 301]), (2, [300, 99_999]), (3, [-1]), (4, []), (5, None), (6, [0, 300])], "k int, ids array<int>")
    got = {r["k"]: r["text"] for r in ft.decode(df, ["k"], "ids", model.vocab_df(spark), unknown="null").collect()}
    t = [b.decode("utf-8", "replace") for b in model.token_bytes]
    assert got == {1: t[300] + t[301], 2: None, 3: None, 4: "", 5: "", 6: t[300]}
    with pytest.raises(Exception, match="not in the vocabulary: 99999"):
        ft.decode(df, ["k"], "ids", model.vocab_df(spark)).collect()


def test_incremental_training_equals_library_to_the_end(spark, trained):
    model, _, lines = trained
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    odd = [("aaaa aaaaaa aaa abab ababab aab",), ("aaaaaaa baab abba bb bbb bbbb",)]
    df = lines.filter(F.col("doc_id") < 40).select("line").unionByName(spark.createDataFrame(odd, "line string"))
    texts = [r[0] for r in df.collect()]
    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=32_000, special_tokens=SPECIALS, show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet()))
    lib = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in json.loads(tok.to_str())["model"]["merges"]]
    shown = _shown()
    disp = lambda bs: "".join(shown[b] for b in bs)
    got = bpe.learn_bpe(bpe.word_counts(df, "line"), 32_000, SPECIALS, phase_symbols=30_000)
    assert got.rounds > 1
    ours = [(disp(got.token_bytes[a]), disp(got.token_bytes[b])) for a, b, _ in got.merges]
    assert len(ours) > 1000 and ours == lib


def test_registered_vocabulary_is_the_references():
    from parapet.plans import queries_vocab
    assert queries_vocab.VOCAB_SIZE == 32_000


def test_word_ids_in_blocks_of_any_size(spark):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("aab") for _ in range(rnd.randint(1, 14))) for _ in range(400)} | {"aaaaa", "aaaaab", "aaaaa" * 4, "éa"}
    rows = [(w, rnd.choice([1, 1, 1, 2, 9])) for w in sorted(words)]
    df = spark.createDataFrame(rows, "word string, cnt long").repartition(3)
    want = [w for w, _ in sorted(rows, key=lambda r: (-r[1], r[0].encode()))]
    for block in (1, 7, 100_000):
        got = sorted(tuple(r)[:2] for r in ft.word_vocab(df, block).collect())
        assert got == [(i + 3, w) for i, w in enumerate(want)]
    assert ft._prefixes(df, 7).groupBy("cnt", "__p").count().agg(F.max("count")).first()[0] <= 7


def test_pretokens_around_specials_equal_the_plain_cut(spark):
    import re
    specials = ["<fr>", "<f", "</s>", "<s>", "<pad>"]
    texts = ["<fr> it's a <s>b</s>", "", None, "a<b <<s>> <fr><fr>", "<fr>", "x <pad>\n\n y!<s", "no specials, we'll see", "<f<fr>\n", "''s 'll 're've"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    gpt2 = r"""(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    got = {r["i"]: r for r in df.select("i", ft.pretokens(F.col("t"), specials).alias("p"),
                                        F.regexp_extract_all("t", F.lit(gpt2), 0).alias("plain")).collect()}
    assert "(?:(?!" not in str(ft.pretokens(F.col("t"), specials))      # no look-ahead at every character
    either = "|".join(re.escape(x) for x in sorted(specials, key=len, reverse=True))
    flat = spark.createDataFrame([(i, k, x) for i, t in enumerate(texts) if t for k, x in enumerate(re.split(f"({either})", t)) if x], "i int, k int, x string")
    cut = {(r["i"], r["k"]): ([r["x"]] if r["x"] in specials else list(r["p"]))
           for r in flat.select("i", "k", "x", F.regexp_extract_all("x", F.lit(gpt2), 0).alias("p")).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else [w for k in sorted(k for j, k in cut if j == i) for w in cut[i, k]]
        assert got[i]["p"] == want
        if t and not re.search(either, t):
            assert got[i]["p"] == got[i]["plain"]


def test_words_are_cut_into_symbols_once_a_distinct_word(spark):
    from collections import Counter
    lines = ["ab a abc", "é ab", "", None, "x  yz"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    pairs = bpe.pair_counts(bpe.initial_symbols(bpe.word_counts(df, "line")))
    want = Counter()
    for word in ["ab", " a", " abc", "é", " ab", "x", " ", " yz"]:
        b = word.encode()
        want.update((f"{x:02X}", f"{y:02X}") for x, y in zip(b, b[1:]))
    assert {(r["a"], r["b"]): r["c"] for r in pairs.collect()} == want
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "hex" in plan and "hex" not in plan[plan.index("\n", plan.index("Aggregate [word")):]      # not below the counting of words


def test_words_merged_side_by_side_equal_words_by_themselves():
    rnd = random.Random(2)
    ranks, made = {}, 6
    for r in range(200):
        pair = (rnd.randrange(made), rnd.randrange(made))
        if pair not in ranks:
            again = rnd.random() < 0.1      # spells a token that exists
            ranks[pair] = (r, rnd.randrange(6, made) if again and made > 6 else made)
            made += not again
    words = [[rnd.randrange(6) for _ in range(rnd.randrange(0, 60))] for _ in range(3000)]
    flat, lens = np.array([x for w in words for x in w], np.int32), np.array([len(w) for w in words])
    ids, after = bpe.MergeTable(ranks).encode(flat, lens)
    assert [x.tolist() for x in np.split(ids, np.cumsum(after)[:-1])] == [bpe.encode_word(list(w), ranks) for w in words]
    ids, after = bpe.MergeTable({}).encode(flat, lens)
    assert ids.tolist() == flat.tolist() and after.tolist() == lens.tolist()
