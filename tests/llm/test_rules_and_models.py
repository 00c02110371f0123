"""Quality rules, language ID, quality classifier and license scan."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from llm_cases import ODD, SF01, no_docs, odd_docs  # noqa: F401
from parapet.llm import language_id as lid, license_scan as lic, quality_classifier as qc, quality_rules as rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(rows):
    return sorted(rows, key=lambda r: [(x is None, x) for x in r])


# --- quality rules ------------------------------------------------------------

def brute_counts(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def brute_kept(text):
    t = text or ""
    n, chars, symbols, dup, repeat = brute_counts(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    letters, upper = len(regex.findall(r"\p{L}", t)), len(regex.findall(r"\p{Lu}", t))
    failed = n < 50 or 100 * repeat > 50 * n
    bad = symbols > n * 0.1 or dup > len(lines) * 0.4 or upper / max(letters, 1) > 0.6 or letters / max(chars, 1) < 0.3
    return failed, not (failed or bad)


def test_counts_and_verdicts_of_odd_texts(spark, odd_docs, no_docs):
    rnd = random.Random(4)
    more = [" ".join(rnd.choice(["a", "b", "c", "#x", "Z\n", "é"]) for _ in range(rnd.randint(0, 120))) for _ in range(60)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(more, 1000)), "doc_id long, text string"))
    want = [(r["doc_id"], *brute_counts(r["text"]), *brute_kept(r["text"])) for r in docs.collect()]
    assert key([tuple(r) for r in rules.judge(docs).collect()]) == key(want)
    assert rules.judge(no_docs).count() == 0
    assert rules.cascade(no_docs).count() == 0


def test_cascade_agrees_in_any_order_and_names_the_first(spark):
    docs = queries.documents(spark, SF01)
    all_rules = [*rules.BASE, *rules.RULES]
    got = {r["doc_id"]: r["rejected_by"] for r in rules.cascade(docs).collect()}
    back = docs.withColumn("rejected_by", rules.rejected_by(all_rules[::-1], F.col("text"))).collect()
    for r in back:
        assert (got[r["doc_id"]] is None) == (r["rejected_by"] is None) == brute_kept(r["text"])[1]
    assert set(got.values()) - {None} <= {r.name for r in all_rules}


def test_order_is_rejections_per_second():
    a, b, c = (rules.Rule(x, None) for x in "abc")
    est = [rules.Estimate(a, 0.1, 1.0), rules.Estimate(b, 0.5, 1.0), rules.Estimate(c, 0.2, 0.1)]
    assert [r.name for r in rules.order(est)] == ["c", "b", "a"]


def test_estimates_see_selectivity(spark):
    docs = spark.createDataFrame([(i, "x" if i % 4 else "y") for i in range(400)], "doc_id long, text string")
    est = rules.estimate(docs, [rules.Rule("y", lambda t: t == "y"), rules.Rule("none", lambda t: t == "z")], sample_rows=400)
    assert est[0].selectivity == pytest.approx(0.25) and est[1].selectivity == 0


# --- language ID ----------------------------------------------------------------

def test_tables_equal_convolution():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (40, 20 + max(lid.WIDTHS) - 1)).astype(np.uint8)
    model = lid.fit(x, rng.integers(0, 3, 40), ["a", "b", "c"], epochs=1)
    h = []
    for tables, bias in zip(model.tables, model.bias):
        conv = sum(t[x[:, k:k + 20]] for k, t in enumerate(tables)) + bias
        h.append(np.maximum(conv.max(axis=1), 0))
    z = np.concatenate(h, axis=1) @ model.out + model.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(lid.Scorer(model)(x, group=7), p / p.sum(axis=1, keepdims=True), atol=1e-4)


def test_windows_hold_every_byte():
    texts = [b"", b"abc", b"x" * 256, b"y" * 600, b""]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, size, doc = lid.windows(data, offsets)
    x = lid.pad(data, start, size)
    got = [b""] * len(texts)
    for row, n, d in zip(x, size, doc):
        got[d] += row[:n].tobytes()
        assert not row[n:].any()
    assert got == texts


def test_op2_held_out_accuracy(spark):
    got = queries.op2(spark, SF01).join(queries.documents(spark, SF01).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and 100 < len(held) < 300
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_texts(spark, odd_docs, no_docs):
    model = lid.train(queries.documents(spark, SF01), docs_per_language=20)
    rows = lid.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    text = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not regex.search(r"\p{L}", text[r["doc_id"]] or "")), r
            assert (r["score"] == 0) == (r["lang_pred"] == "und")
    assert lid.predict(no_docs, model).count() == 0
    none = lid.train(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in lid.predict(odd_docs, none).collect()} == {"und"}


# --- quality classifier -----------------------------------------------------------

def test_op7_held_out_accuracy(spark):
    rows = queries.op7(spark, SF01)
    assert rows.count() == 1000
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "quality")
    held = rows.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93
    assert all((r["score"] >= 0.7) == bool(r["predicted"]) for r in held)


def test_ranking_orders_pairs_and_threshold_is_the_quantile():
    rng = np.random.default_rng(0)
    y = np.repeat([0, 1], [100, 300])
    x = rng.normal(0, 1, (400, len(qc.FEATURES)))
    x[:, 2] += 3 * y
    model = qc.fit(x, y, (100, 300))
    z = model.strength(x)
    assert (z[y == 1][:, None] > z[y == 0][None, :]).mean() > 0.97
    assert np.mean(model.score(x) < qc.CUT) == pytest.approx(0.25, abs=0.01)
    assert qc.fit(x, np.ones(400)) is None


def test_scores_of_odd_texts(spark, odd_docs, no_docs):
    docs = queries.documents(spark, SF01)
    model = qc.train(docs, spark.read.parquet(f"{SF01}/labels.parquet"))
    rows = qc.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert qc.score(no_docs, model).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in qc.score(odd_docs, qc.train(docs, empty)).collect()} == {0.5}


# --- license scan -------------------------------------------------------------------

def brute_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = [(i, label) for p, label in lic.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


NOTICES = ["CC BY cc-by", "All  Rights\nReserved! all rights reserved", "General Public License", "general publik license",
           "GENERAL PUBLC LICENSE v3", "alll rights reserved", "cc by cc by cc", "the mozila public licence text",
           "Permission is hereby granted, free of charge", "permission hereby granted free of charge now",
           "xall rights reserved", "cc bye", "é general public license ü", "Licensed under the Apache License, Version 2.0."]


def test_license_base_equals_brute_force(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(NOTICES, 500)), "doc_id long, text string"))
    rows = docs.collect()
    got = []
    for r in lic.scan(docs).collect():
        exact = [m for m in r["matches"] if m["kind"] == "exact"]
        at = [m["first_word"] for m in exact]
        got.append((r["doc_id"], r["n_words"], len(exact), min(at, default=None), max(at, default=None),
                    ",".join(sorted({m["label"] for m in exact}))))
    assert key(got) == key([(r["doc_id"], *brute_base(r["text"])) for r in rows])
    assert lic.scan(no_docs).count() == 0


def test_fuzzy_equals_unseeded_search_and_spans_are_right():
    scanner = lic.Scanner(lic.BASE, lic.NOTICES)
    rnd = random.Random(9)
    texts = list(NOTICES)
    for notice in lic.NOTICES:
        for _ in range(25):         # up to one error more than allowed
            t = list("so " + notice + " it is")
            for _ in range(rnd.randint(0, lic.errors_for(notice) + 1)):
                i = rnd.randrange(3, len(t) - 6)
                t[i:i + 1] = rnd.choice([[], ["q"], [t[i], "z"]])
            texts.append("".join(t))
    for t in texts:
        joined, _ = lic.words_of(t.encode())
        got = {(n[2], n[3]) for n in scanner.fuzzy(joined)}
        want = set()
        for n in scanner.notices:
            for m in n.patterns[-1].finditer(joined):
                want.add((n.label, 1 - sum(m.fuzzy_counts) / len(n.text)))
        assert {x for x, _ in got} == {x for x, _ in want}, t


def test_op6_whole_table(spark):
    docs = queries.documents(spark, SF01).select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in queries.op6(spark, SF01).collect()}
    for d in docs:
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(d["text"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_spans_name_the_original_characters(spark):
    df = spark.createDataFrame([(1, "é! ALL -- rights\tReserved. x")], "doc_id long, text string")
    m = lic.scan(df).first()["matches"]
    assert {("é! ALL -- rights\tReserved. x"[x["begin"]:x["end"]], x["kind"]) for x in m} == {
        ("ALL -- rights\tReserved", "exact"), ("ALL -- rights\tReserved", "fuzzy")}


def _best_spans(text, notice, errors):
    """(begin, errors) of the best whole-word span by edit distance, then of
    the parts before and behind it: no regular expression, no window."""
    def parts(a, b):
        begins = [i + 1 for i in range(a - 1 if a else 0, b) if text[i] == 32]
        best = None
        for i in begins:
            row = list(range(len(notice) + 1))      # distances of the notice's prefixes to text[i:j]
            for j in range(i, min(b, i + len(notice) + errors) + 1):
                if j < b and text[j] == 32 and row[-1] <= errors and (best is None or (row[-1], i) < best[:2]):
                    best = (row[-1], i, j)
                if j < b:
                    new = [row[0] + 1]
                    for k, c in enumerate(notice):
                        new.append(min(new[-1] + 1, row[k + 1] + 1, row[k] + (c != text[j])))
                    row = new
        if best is None:
            return []
        e, i, j = best
        return parts(a, i) + [(i, e)] + parts(j, b)
    return parts(0, len(text))


def test_close_notices_are_all_found():
    scanner = lic.Scanner(lic.BASE, {"all rights reserved": "reserved"})
    spans = lambda t: [(a, b) for a, b, _, _ in scanner.fuzzy(t)]
    assert spans(b" all rights reservd x all rights reserved ") == [(1, 19), (22, 41)]
    rnd = random.Random(4)
    forms = ["all rights reserved", "all rights reservd", "all rihts reserved", "al rights reserved", "all rights served"]
    notice, n = b"all rights reserved", scanner.notices[0]
    for _ in range(60):
        t = (" " + " ".join(rnd.choice([*forms, "x", "so it is"]) for _ in range(rnd.randint(2, 6))) + " ").encode()
        got = [(a, round((1 - s) * len(n.text))) for a, _, _, s in scanner.fuzzy(t)]
        assert got == _best_spans(t, notice, n.errors), t


def test_rule_sample_is_drawn_row_by_row(spark):
    rows = 8_000
    null = spark.range(rows).select(F.lit(None).cast("long").alias("doc_id"), F.lit("y").alias("text"))
    same = spark.range(rows).select(F.lit(7).cast("long").alias("doc_id"), F.lit("y").alias("text"))
    for docs in (null, same):
        assert 250 < rules.drawn(docs, rows, "doc_id", 400).count() < 550
    assert rules.drawn(null, rows, "doc_id", rows).count() == rows


def test_license_work_grows_with_the_text():
    scanner = lic.Scanner(lic.BASE, lic.NOTICES)
    for unit, fuzzy, exact in ((b"all rights reservd ", 1, 0), (b"cc by ", 0, 1), (b"rights reser ", 0, 0)):
        n = 1_000_000 // len(unit)
        t0 = time.time()
        joined, words = lic.words_of(unit * n)
        assert (len(scanner.fuzzy(joined)), len(scanner.exact(joined))) == (fuzzy * n, exact * n)
        assert time.time() - t0 < 10


def test_places_in_a_long_text(spark):
    text = "Été " * 50_000 + "all RIGHTS reservd" + " x" * 300_000 + " cc-by"
    r = lic.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["n_words"] == 350_005 and {(m["label"], m["kind"], m["first_word"], m["end_word"], text[m["begin"]:m["end"]]) for m in r["matches"]} == {
        ("reserved", "fuzzy", 50_000, 50_003, "all RIGHTS reservd"), ("cc-by", "exact", 350_003, 350_005, "cc-by")}


def test_samples_are_drawn_row_by_row(spark, monkeypatch):
    rows = 6_000
    same = spark.range(rows).select(F.lit(7).cast("long").alias("doc_id"), F.lit("some words in one language").alias("text"), F.lit("en").alias("lang"))
    seen = []
    monkeypatch.setattr(lid, "fit", lambda x, y, languages: seen.append(len(x)))
    lid.train(same, docs_per_language=300)
    assert 200 < seen[0] < 400
    labels = spark.range(rows).select(F.lit(7).cast("long").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    monkeypatch.setattr(qc, "fit", lambda x, y, population: seen.append((y == 0).sum() + (y == 1).sum()))
    qc.train(same.limit(2000), labels, sample_per_label=100)
    assert 130 < seen[1] < 270


def test_quality_is_learned_from_every_labelled_row(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = 3_000
    y = (np.arange(n) < 60).astype(int)         # dealt so that blocks of one kind exist
    x = rng.normal(0, 1, (n, len(qc.FEATURES)))
    x[:, 2] += 2 * y
    table = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "doc_id long, x array<double>")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    monkeypatch.setattr(qc, "BLOCK", 16)
    model = qc.train_table(table, labels)
    assert np.allclose(model.centre, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))     # of all rows, not of 1,000
    z = np.sort(model.strength(x))
    assert model.threshold == pytest.approx((z[n - 61] + z[n - 60]) / 2, abs=1e-12)
    assert (model.strength(x)[y == 1][:, None] > model.strength(x)[y == 0][None, :]).mean() > 0.85
    # a single kind, and labels without documents
    assert qc.train_table(table, labels.filter("quality = 0")) is None and qc.train_table(table.limit(0), labels) is None
