"""SentencePiece, attribution and packing against the libraries and brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import SF01, no_docs, odd_docs, vocab  # noqa: F401
from parapet.llm import best_fit_packing as packing
from parapet.llm import byte_bpe, queries, sentencepiece_codec as spc, token_attribution as attribution, units


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) if not isinstance(x, list) else (False, str(x)) for x in r))


@pytest.fixture(scope="module")
def bpe_path(vocab):
    return vocab("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def sp_path(vocab):
    return vocab("piece_bpe_32k.model")


@pytest.mark.parametrize("window", [64, 1 << 20])
def test_units_equal_library_on_random_texts(monkeypatch, bpe_path, sp_path, window):
    monkeypatch.setattr(units, "WINDOW", window)
    rnd = random.Random(5)
    alphabet = ["a", "b", "The", "'s", "'", " ", " ", "  ", "\n", "\n\n", "\t", ".", ",", "é", " ", " ", "▁", "1", "!!", "日", "<|endoftext|>", "\x85"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 40))) for _ in range(800)]
    column = pa.array([None, *texts, ""])
    bpe = byte_bpe.ByteBpe(bpe_path)
    ids, offs = bpe.encode_column(column)
    for i, t in enumerate(column.to_pylist()):
        assert ids[offs[i]:offs[i + 1]].tolist() == bpe.tok.encode(t or "", add_special_tokens=False).ids, t
    codec = spc.Codec(sp_path)
    assert codec.by_unit
    ids, offs, begin, end = codec.encode_column(column)
    for i, t in enumerate(column.to_pylist()):
        got = ids[offs[i]:offs[i + 1]].tolist()
        assert got == codec.sp.encode(t or ""), t
        gids, gb, ge = codec.encode_text(t or "")
        assert gids.tolist() == got
        assert begin[offs[i]:offs[i + 1]].tolist()[:1] == gb.tolist()[:1]


def test_spans_cover_the_original_bytes(sp_path):
    codec = spc.Codec(sp_path)
    texts = ["Hello  world.\nNext é line 日本", "a▁b c", "x"]
    ids, offs, begin, end = codec.encode_column(pa.array(texts))
    for i, t in enumerate(texts):
        b, e = begin[offs[i]:offs[i + 1]], end[offs[i]:offs[i + 1]]
        assert b[0] == 0 and e[-1] == len(t.encode())
        assert all(x <= y for x, y in zip(b, e)) and all(b[1:] >= b[:-1])
    text = "Hello world"
    ids, offs, begin, end = codec.encode_column(pa.array([text]))
    got = [text.encode()[x:y].decode() for x, y in zip(begin, end)]
    assert "".join(got) == text


def test_longest_prefix_normalisation_equals_library():
    import sentencepiece
    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    own = spc.Normaliser(lib.serialized_normalizer_spec())
    assert own.map.units
    for t in ["", "  a  b ", "ﬁne ½ ①", "ｆｕｌｌ　ｗｉｄｔｈ", "é é", " x ", "한국어 ㈱", "​ a ﻿", "tab\tx"]:
        norm, align = own(t.encode())
        want, offsets = lib.normalize(t, with_offsets=True)
        assert norm.decode().strip(" ") == want.replace("▁", " ").strip(" "), t
        assert len(align) == len(norm) + 1 and align == sorted(align)


def test_op3_equals_library(spark, sp_path, odd_docs, no_docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_path)

    def brute(rows):
        out = []
        for i, t in rows:
            ids = sp.encode(t or "", add_bos=True, add_eos=True)
            out.append((i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
                        hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
        return key(out)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = spc.round_trip(odd_docs, sp_path)
    assert key([tuple(r)[:4] for r in got.collect()]) == brute(rows)
    assert spc.round_trip(no_docs, sp_path).count() == 0
    docs = [tuple(r) for r in queries.documents(spark, SF01).select("doc_id", "text").collect()]
    got = queries.op3(spark, SF01).collect()
    assert key([tuple(r)[:4] for r in got]) == brute(docs)
    size = {i: len((t or "").encode()) for i, t in docs}
    assert all(r["span_bytes"] == size[r["doc_id"]] for r in got)


def test_encode_then_decode(spark, sp_path, odd_docs):
    enc = spc.encode(odd_docs, sp_path)
    back = {r["doc_id"]: r["text"] for r in spc.decode(enc, sp_path).collect() if r["doc_id"] is not None}
    for r in odd_docs.collect():
        if r["doc_id"] is not None and r["text"] and "▁" not in r["text"]:
            assert back[r["doc_id"]] == r["text"]
    for r in enc.collect():
        assert len(r["ids"]) == len(r["begins"]) == len(r["ends"])


def brute_sections(tok, text, rule):
    """Character by character, from the library's own offsets in bytes."""
    data = (text or "").encode()
    lines, at = [], 0
    for part in _lines(text or ""):
        n = len(part.encode())
        lines.append((at, at + n))
        at += n
    widths = byte_bpe.load(tok).widths
    ids = byte_bpe.load(tok).tok.encode(text or "", add_special_tokens=False).ids
    out, spans, at = [], [], 0
    for i in ids:
        spans.append((at, at + int(widths[i])))
        at += int(widths[i])
    assert at == len(data)
    for k, (b, e) in enumerate(lines):
        touch = [(s, t) for s, t in spans if s < e and t > b]
        n = (sum(b <= s for s, t in touch) if rule == "first" else sum(t <= e for s, t in touch) if rule == "last"
             else sum((min(t, e) - max(s, b)) / (t - s) for s, t in touch))
        out.append((k, len(data[:b].decode()), len(data[:e].decode()), n, sum(not (b <= s and t <= e) for s, t in touch)))
    return out


def _lines(text):
    parts = text.split("\n")
    out = [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])
    return out or [""]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution_equals_brute_force(odd_docs, no_docs, bpe_path, rule):
    got = defaultdict(list)
    for r in attribution.attribute(odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), bpe_path, rule=rule).collect():
        got[r["doc_id"]].append((r["section"], r["begin"], r["end"], r["n_tokens"], r["n_crossing"]))
    for r in odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).collect():
        want = brute_sections(bpe_path, r["text"], rule)
        assert [x[:3] + x[4:] for x in sorted(got[r["doc_id"]])] == [x[:3] + x[4:] for x in want], r
        assert [x[3] for x in sorted(got[r["doc_id"]])] == pytest.approx([x[3] for x in want])
    assert attribution.attribute(no_docs, bpe_path, rule=rule).count() == 0


def test_attribution_to_given_spans(spark, bpe_path):
    df = spark.createDataFrame(
        [(1, "Hello wörld", [(0, 3), (3, 11), (0, 11), (5, 5), (20, 30)]), (2, "x", None), (3, None, [(0, 1)]), (4, "y", [(None, 1)])],
        "doc_id long, text string, spans array<struct<begin:long,end:long>>")
    rows = attribution.attribute(df, bpe_path, sections_col="spans").collect()
    got = {(r["doc_id"], r["section"]): (r["n_tokens"], r["n_crossing"]) for r in rows}
    total = len(byte_bpe.load(bpe_path).tok.encode("Hello wörld").ids)
    assert got[1, 2] == (total, 0) and got[1, 0] == (1, 1) and got[1, 1] == (total - 1, 1)
    assert got[1, 3] == (0, 0) and got[1, 4] == (0, 0) and got[3, 0] == (0, 0) and got[4, 0] == (None, None)
    assert (2, 0) not in got


def test_op9_adds_up(spark, bpe_path):
    tok = byte_bpe.load(bpe_path).tok
    want = {r["doc_id"]: len(tok.encode(r["text"] or "", add_special_tokens=False).ids)
            for r in queries.documents(spark, SF01).collect()}
    got = Counter()
    for r in queries.op9(spark, SF01).collect():
        got[r["doc_id"]] += r["n_tokens"]
    assert got == Counter(want)


def simulate(lengths, capacity):
    """Plain best-fit decreasing, piece by piece."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free[free.index(min(fits))] -= n
        else:
            free.append(capacity - n)
    return len(free)


def test_plan_equals_piecewise_best_fit():
    rnd = random.Random(3)
    for _ in range(60):
        cap = rnd.choice([10, 37, 64])
        lengths = [rnd.randint(1, cap) for _ in range(rnd.randint(0, 300))]
        segments = packing.plan(Counter(lengths), cap)
        bins, ranks = defaultdict(list), Counter()
        for n, start, count, per, seq, off in segments:
            assert start == ranks[n]
            ranks[n] += count
            for k in range(count):
                bins[seq + k // per].append((off + k % per * n, n))
        assert ranks == Counter(lengths)
        assert len(bins) == simulate(lengths, cap)
        for slots in bins.values():
            at = 0
            for off, n in sorted(slots):
                assert off == at
                at += n
            assert at <= cap


def check_packing(rows, docs, tok, cap, end=0):
    by_doc, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    want = Counter()
    for i, t in docs:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], "<u4")
        first = len(ids) if len(ids) <= cap else (len(ids) - 1) % cap + 1
        cuts = [0, *range(first, len(ids) + 1, cap)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    for slots in seqs.values():
        at = 0
        for off, n in sorted(slots):
            assert off == at
            at += n
        assert at <= cap
    assert len(seqs) == simulate([n for (_, _, _, n, _), c in want.items() for _ in range(c)], cap)


def test_packing_odd_and_empty(odd_docs, no_docs, bpe_path):
    tok = byte_bpe.load(bpe_path).tok
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    check_packing(packing.pack(odd_docs, bpe_path, capacity=32).collect(), docs, tok, 32)
    rows = packing.pack(odd_docs, bpe_path, capacity=32, keep_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert packing.pack(no_docs, bpe_path).count() == 0


def test_op10_whole_table(spark, bpe_path):
    docs = [tuple(r) for r in queries.documents(spark, SF01).select("doc_id", "text").collect()]
    check_packing(queries.op10(spark, SF01).collect(), docs, byte_bpe.load(bpe_path).tok, 2048)
