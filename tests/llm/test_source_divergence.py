"""Source divergence against plain Python arithmetic."""

import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from llm_cases import ODD
from parapet.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(AZ, AZ.lower())


def brute(rows, min_docs=sd.MIN_DOCS, top=sd.TOP_TERMS):
    """rows: (lang, source, text)."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        c = Counter(w.translate(LOWER) for w in TERM.findall(text or ""))
        count[lang or "", source or ""].update(c)
        docs[lang or ""].update(c.keys())
    out = []
    for lang in docs:
        kept = sorted((t for t, n in docs[lang].items() if n >= min_docs), key=lambda t: t.encode())
        v = len(kept)
        of = {s: c for (ln, s), c in count.items() if ln == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * v) for t in kept}
        p = {s: shares(c) for s, c in of.items()}
        q = shares(sum(of.values(), Counter()))
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in of:
            pairs = sorted(((-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in of if o != s))
            out += [(lang, s, "pair", o, -x, i) for i, (x, _, o) in enumerate(pairs, 1)]
            terms = sorted((-gap(p[s][t], q[t]), t.encode(), t) for t in kept if of[s][t] > 0 and p[s][t] > q[t])
            out += [(lang, s, "term", t, -x, i) for i, (x, _, t) in enumerate(terms[:top], 1)]
    return sorted(out)


def table(spark, rows):
    # columns with names the operator uses itself
    return spark.createDataFrame([(i, *r, 1, "x", 2) for i, r in enumerate(rows)],
                                 "doc_id long, lang string, source string, text string, cnt int, term string, v int").repartition(5)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def rows_of(rnd, n, langs, sources, words):
    return [(rnd.choice(langs), rnd.choice(sources), " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30)))) for _ in range(n)]


def test_equals_plain_arithmetic_in_any_cells(spark):
    rnd = random.Random(2)
    words = ["The", "the", "ÄB", "äb", "x1y", "don't", "日本", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = rows_of(rnd, 150, ["en", "", None, "fr"], ["a", "b", "", None, "ü", "c-1", "d", "e", "f"], words)
    rows += [("lone", "one", "x y"), ("bare", "p", ""), ("bare", "q", None)] + [("en", "a", t) for t in ODD]
    df, want = table(spark, rows), brute(rows)
    assert got(sd.audit(df)) == want
    assert got(sd.audit(df, block=2, cell_rows=20)) == want           # several blocks and shares
    assert any(r[0] == "bare" and r[4] == 0 for r in want) and not any(r[0] == "lone" for r in want)


def test_repeated_rows_ties_and_no_rows(spark):
    rows = [("en", s, "same words here") for s in "abc"] * 10 + [("en", "hot", "hot topic")] * 400
    assert got(sd.audit(table(spark, rows))) == brute(rows)
    assert sd.audit(table(spark, rows).limit(0)).count() == 0


def test_tallies_are_flushed_and_still_add_up():
    batch = pa.record_batch([pa.array(["en"] * 50), pa.array(["s", "t"] * 25), pa.array([f"a {'b' * (i + 1)} {'c' * (i + 1)}" for i in range(50)])],
                            ["lang", "source", "text"])
    total, docs, rows = Counter(), Counter(), 0
    for rb in sd.tally(iter([batch]), limit=7):
        rows += rb.num_rows
        for lang, source, term, n, d in zip(*(c.to_pylist() for c in rb.columns)):
            if term is not None:
                total[source, term] += n
                docs[source, term] += d
    assert rows > 100 and total["s", "a"] == docs["t", "a"] == 25 and total["s", "b"] == 1


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Word " * 700 + "x" * 5000 + " Éa-b " * 500 + "y" * 3000).encode()
    want = sd.document_counts(text)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(sd, "PIECE", size)
        assert sd.document_counts(text) == want == Counter(w.translate(LOWER).encode() for w in TERM.findall(text.decode()))


def test_shares_are_exact_for_large_counts(spark):
    n, v, c = 9_000_000_000_000_007, 50_000, 8_999_999_999_999_999
    row = spark.createDataFrame([(c, n, v)], "c long, n long, v long").select(sd.share(F.col("c")).alias("p")).first()
    assert row["p"] == 1 + 1_000_000_000 * (c + 2) // (n + 2 * v)


def test_a_cell_is_summed_in_a_process_that_has_loaded_nothing_else():
    # a worker is handed its cell: what makes Arrow arrays of lists loads more of Arrow
    cell = pa.table({"lang": ["en"] * 3, "left": pa.array([0] * 3, pa.int32()), "right": pa.array([0] * 3, pa.int32()), "share": pa.array([0] * 3, pa.int32()),
                     "own": pa.array([0] * 3, pa.int32()), "source": ["a", "b", "a"], "term": [None, None, "x"], "p": [5, 3, 9], "v": [1] * 3})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, cell.schema) as out:
        out.write_table(cell)
    run = """
import sys
import pyarrow as pa
from parapet.llm import source_divergence as sd
cell = pa.ipc.open_stream(sys.stdin.buffer.read()).read_all()
print(sorted(tuple(r.values()) for r in sd.cell_sums(tuple(cell.column(i)[0] for i in range(4)), cell).to_pylist()))
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", run], cwd=root, input=sink.getvalue().to_pybytes(), capture_output=True, timeout=120)
    assert done.stdout.decode().strip() == "[('en', 'a', 'b', 3), ('en', 'b', 'a', 3)]", done.stderr.decode()
