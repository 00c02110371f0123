"""Sources and sinks against temporary files."""

import io
import glob
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from parapet.operators import files as fl
from parapet.sources import archives, sinks
from parapet.sources.cache import materialise_once
from parapet.sources.lines import lines_beside, read_lines
from parapet.sources.manifest import manifest_from_yaml


def _write(path, data: bytes):
    with open(path, "wb") as fh:
        fh.write(data)


def _python_lines(data: bytes):
    return data.decode().splitlines()


def test_read_lines_line_ends_and_numbers(spark, tmp):
    _write(f"{tmp}/a.en", b"one\r\ntwo\n\nfour")            # CRLF, empty line, no final newline
    _write(f"{tmp}/b.en", b"x\ny\n")                         # final newline adds no line
    _write(f"{tmp}/train.sl", b"t0\nt1\n")
    rows = read_lines(spark, tmp).orderBy("file", "line_no").collect()
    got = {}
    for r in rows:
        got.setdefault(os.path.basename(r["file"]), []).append((r["line_no"], r["line"]))
    assert got["a.en"] == [(0, "one"), (1, "two"), (2, ""), (3, "four")]
    assert got["b.en"] == [(0, "x"), (1, "y")]
    only = read_lines(spark, tmp, prefix="train").select("line").collect()
    assert sorted(r[0] for r in only) == ["t0", "t1"]


def test_read_lines_many_splits_keep_order(spark, tmp):
    # small splits: one file spans many partitions, and partitions mix files
    lines_a = [f"a{i:05d} " + "x" * (i % 17) for i in range(3000)]
    lines_b = [f"b{i:05d}" for i in range(1700)]
    _write(f"{tmp}/a.txt", ("\n".join(lines_a) + "\n").encode())
    _write(f"{tmp}/b.txt", ("\n".join(lines_b)).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(tmp).rdd.getNumPartitions() > 10
        rows = read_lines(spark, tmp).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    by = {}
    for r in rows:
        by.setdefault(os.path.basename(r["file"]), {})[r["line_no"]] = r["line"]
    assert [by["a.txt"][i] for i in range(len(lines_a))] == lines_a
    assert [by["b.txt"][i] for i in range(len(lines_b))] == lines_b


def test_read_archives(spark, tmp):
    def tgz(path, members):
        buf = io.BytesIO()
        with tarfile.open(fileobj=buf, mode="w:gz") as tf:
            for name, data in members.items():
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tf.addfile(info, io.BytesIO(data))
        _write(path, buf.getvalue())

    os.makedirs(f"{tmp}/arc")
    tgz(f"{tmp}/arc/en__it.tar.gz", {"en__it/c1.en": b"a\r\nb\n", "en__it/c1.it": b"A\nB", "en__it/README": b"x"})
    tgz(f"{tmp}/arc/en__de.tar.gz", {"en__de/d.en": b"\n\nz\n"})
    rows = archives.read_archives(spark, f"{tmp}/arc", member_glob="*.en").collect()
    got = sorted((os.path.basename(r["archive"]), r["member"], r["line_no"], r["line"]) for r in rows)
    assert got == [("en__de.tar.gz", "en__de/d.en", 0, ""), ("en__de.tar.gz", "en__de/d.en", 1, ""),
                   ("en__de.tar.gz", "en__de/d.en", 2, "z"),
                   ("en__it.tar.gz", "en__it/c1.en", 0, "a"), ("en__it.tar.gz", "en__it/c1.en", 1, "b")]


def test_manifest_from_yaml_resolves_anchors(spark, tmp):
    _write(f"{tmp}/datasets.yaml", b"""
test:
  en__it:
    setA:
      src: &set_a_en seta/eng.txt
      ref: seta/ita.txt
  en__de:
    setA:
      src: *set_a_en
    setB:
      src: setb/src.eng.txt
      ref: setb/ref.deu.txt
""")
    rows = manifest_from_yaml(spark, f"{tmp}/datasets.yaml", root="/data").collect()
    got = sorted(tuple(r) for r in rows)
    assert got == [("test", "en__de", "setA", "/data/seta/eng.txt", None),
                   ("test", "en__de", "setB", "/data/setb/src.eng.txt", "/data/setb/ref.deu.txt"),
                   ("test", "en__it", "setA", "/data/seta/eng.txt", "/data/seta/ita.txt")]


def test_write_parallel_round_trip_aligned(spark, tmp):
    n = 2500
    df = spark.range(n).select(
        F.when(F.col("id") % 7 == 0, "valid").otherwise("train").alias("split"),
        (F.col("id") * 3).alias("pair_id"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("sl"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("tl")).repartition(7)
    sinks.write_parallel(df, f"{tmp}/out", rows_per_file=400)
    for split in ("train", "valid"):
        sl = read_lines(spark, f"{tmp}/out/sl/split={split}").collect()
        tl = read_lines(spark, f"{tmp}/out/tl/split={split}").collect()
        key = lambda r: (r["file"].split("chunk=")[1].split("/")[0].zfill(6), r["line_no"])
        sl_l = [r["line"] for r in sorted(sl, key=key)]
        tl_l = [r["line"] for r in sorted(tl, key=key)]
        assert [x[1:] for x in sl_l] == [x[1:] for x in tl_l]
        ids = [int(x[1:]) for x in sl_l]
        assert ids == sorted(ids)
        assert len(ids) == sum(1 for i in range(n) if (i % 7 == 0) == (split == "valid"))


def test_write_eval_layout(spark, tmp):
    df = spark.createDataFrame(
        [("en__de", "setA", 0, "s0", "r0", "h0"), ("en__de", "setA", 1, "s1", "r1", "h1"),
         ("en__it", "setB", 0, "s", None, "h")],
        "direction string, dataset string, line_no bigint, source string, reference string, hypothesis string")
    sinks.write_eval(df, f"{tmp}/ev")
    src = read_lines(spark, f"{tmp}/ev/source/direction=en__de/dataset=setA").orderBy("line_no").collect()
    assert [r["line"] for r in src] == ["s0", "s1"]
    hyp = read_lines(spark, f"{tmp}/ev/hypothesis/direction=en__it/dataset=setB").collect()
    assert [r["line"] for r in hyp] == ["h"]


def test_sample_copy_files(spark, tmp):
    os.makedirs(f"{tmp}/in")
    names = []
    for i in range(30):
        for lang in ("en", "it"):
            _write(f"{tmp}/in/c{i}_Aligned.{lang}", f"{lang} {i} line1\n{lang} {i} line2\n".encode())
            names.append(f"{tmp}/in/c{i}_Aligned.{lang}")
    _write(f"{tmp}/in/other.txt", b"zzz\n")
    listing = spark.read.format("binaryFile").load(f"{tmp}/in").select(F.col("path"))
    aligned = fl.filter_paths(listing, glob="*Aligned*")
    assert aligned.count() == 60
    pairs = fl.sample_file_pairs(aligned, 5, 42, f"{tmp}/out")
    assert pairs.count() == 5
    sinks.copy_files(spark, pairs, f"{tmp}/gold")
    out = read_lines(spark, f"{tmp}/gold").collect()
    golds = {r["file"].split("gold=")[1].split("/")[0] for r in out}
    assert len(golds) == 10 and all("_gold." in g for g in golds)


def test_materialise_once_reuses_and_rebuilds(spark, tmp):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    a = materialise_once(spark, "thing", ["k1"], build, root=tmp)
    b = materialise_once(spark, "thing", ["k1"], build, root=tmp)
    c = materialise_once(spark, "thing", ["k2"], build, root=tmp)
    assert a.count() == b.count() == c.count() == 5
    assert len(calls) == 2


def test_artefact_follows_its_input(spark, tmp):
    from parapet.plans import fixtures as fx
    rows = [(i, f"w{i} x\ny", "en" if i % 2 else "de", f"src{i % 5}", 5) for i in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    write = lambda r: spark.createDataFrame(r, schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp}/sf/documents.parquet")
    write(rows[:20])
    first = fx.prepared_table(spark, f"{tmp}/sf").count()
    write(rows)
    assert fx.prepared_table(spark, f"{tmp}/sf").count() == 2 * first
    assert fx.doc_index(spark, f"{tmp}/sf").count() == 40


def test_half_written_artefacts_are_not_read(spark, tmp):
    from parapet.sources.cache import key_of, published
    path = f"{tmp}/thing-{key_of(['k'])}"
    spark.range(3).write.parquet(f"{path}/build-x")             # written, never published
    assert published(spark, path) is None
    assert materialise_once(spark, "thing", ["k"], lambda: spark.range(7), root=tmp).count() == 7
    good = materialise_once(spark, "thing", ["k"], lambda: spark.range(9), root=tmp)
    assert good.count() == 7
    os.remove(glob.glob(f"{path}/build-*/_SUCCESS")[0])
    os.remove(f"{path}/current/_SUCCESS")
    assert published(spark, path) is None


def test_zip_two_line_files(spark, tmp):
    from parapet.operators.corpus import zip_join
    _write(f"{tmp}/dataset.sl", b"s0\ns1\ns2\n")
    _write(f"{tmp}/dataset.tl", b"t0\r\nt1")
    sl = read_lines(spark, f"{tmp}/dataset.sl").select(F.lit("en__it").alias("direction"),
                                                       F.col("line_no").alias("idx"), F.col("line").alias("sl"))
    tl = read_lines(spark, f"{tmp}/dataset.tl").select(F.lit("en__it").alias("direction"),
                                                       F.col("line_no").alias("idx"), F.col("line").alias("tl"))
    inner = sorted(tuple(r) for r in zip_join(sl, tl, "inner").collect())
    left = sorted(tuple(r) for r in zip_join(sl, tl, "left").collect())
    assert inner == [("en__it", 0, "s0", "t0"), ("en__it", 1, "s1", "t1")]
    assert left == inner + [("en__it", 2, "s2", "")]
    shared = sl.drop("direction")
    padded = sorted(tuple(r) for r in zip_join(shared, tl, "left").collect())
    assert padded == left


def test_lines_are_numbered_where_they_are_read(spark, tmp):
    from parapet.sources import lines
    want = {}
    for k in range(3):
        rows = [f"{k}-{i} " + "x" * (i * 7 % 400) for i in range(3000)]
        want |= {(f"f{k}.txt", i): r for i, r in enumerate(rows)}
        with open(f"{tmp}/f{k}.txt", "w", newline="") as f:
            f.write("".join(r + ("\r\n" if i % 3 else "\n") for i, r in enumerate(rows)))      # ends at split edges differ
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = lines.read_lines(spark, tmp)
        got = {(r["file"].rsplit("/", 1)[1], r["line_no"]): r["line"] for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.select("file").distinct().count() == 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan     # no line is shuffled


def test_a_source_line_is_sent_once_for_all_its_sets(spark):
    from parapet.sources.evalsets import read_eval_sets
    sets = [("en__de", "a", "a/en", "a/de"), ("en__fr", "a", "a/en", "a/fr"), ("en__it", "a", "a/en", None), ("fr__en", "b", "a/fr", "a/en")]
    manifest = spark.createDataFrame([("test", *r) for r in sets] + [("valid", *sets[0])],
                                     "split string, direction string, dataset string, src string, ref string")
    lines = {"a/en": ["e0", "e1", ""], "a/de": ["d0"], "a/fr": ["f0", "f1", "f2", "f3"], "x": ["no"]}
    files = spark.createDataFrame([(p, i, x) for p, xs in lines.items() for i, x in enumerate(xs)], "path string, line_no long, line string")
    out = read_eval_sets(manifest, files)
    want = [(d, s, i, x, None if ref is None else dict(enumerate(lines[ref])).get(i, "")) for d, s, src, ref in sets for i, x in enumerate(lines[src])]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert {r["direction"] for r in read_eval_sets(manifest, files, "en__de").collect()} == {"en__de"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(src_path" in plan and "hashpartitioning(direction" not in plan


def test_what_is_known_of_a_source_line_meets_its_sets_where_their_chunk_is_written(spark, tmp):
    from parapet.sources.evalsets import read_eval_sets, source_lines
    manifest = spark.createDataFrame([("en__de", "x", "x/en", "x/de"), ("en__fr", "x", "x/en", None), ("en__de", "y", "y/en", "y/de")],
                                     "direction string, dataset string, src string, ref string")
    files = spark.createDataFrame([(p, i, f"{p} {i}") for p, n in [("x/en", 25), ("x/de", 23), ("y/en", 12), ("y/de", 30)] for i in range(n)],
                                  "path string, line_no long, line string").repartition(5)
    starts = source_lines(manifest, files)
    assert {r["path"] for r in starts.collect()} == {"x/en", "y/en"} and starts.count() == 37
    beside = starts.filter("path <> 'x/en' or line_no <> 7").select("path", "line_no", F.upper("line").alias("hypothesis"))
    out = read_eval_sets(manifest, files, beside=beside, chunk_rows=10)
    got = {(r["direction"], r["dataset"], r["line_no"]): (r["src"], r["ref"], r["hypothesis"]) for r in out.collect()}
    want = {("en__de", "x", i): (f"x/en {i}", f"x/de {i}" if i < 23 else "", None if i == 7 else f"X/EN {i}") for i in range(25)}
    want |= {("en__fr", "x", i): (f"x/en {i}", None, None if i == 7 else f"X/EN {i}") for i in range(25)}
    want |= {("en__de", "y", i): (f"y/en {i}", f"y/de {i}", f"Y/EN {i}") for i in range(12)}
    assert got == want
    spread = out.select("direction", "dataset", F.floor(F.col("line_no") / 10).alias("chunk"), F.spark_partition_id().alias("p")) \
                .groupBy("direction", "dataset", "chunk").agg(F.count_distinct("p").alias("n"))
    assert {r["n"] for r in spread.collect()} == {1}
    # the text of a source line is sent once, and not at all to write it
    ready = out.select("direction", "dataset", "line_no", F.col("src").alias("source"), F.coalesce("ref", F.lit("")).alias("reference"),
                       F.coalesce("hypothesis", F.lit("")).alias("hypothesis"))
    assert ready._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    sinks.write_eval(ready, f"{tmp}/ev", 10, placed=True)
    back = read_lines(spark, f"{tmp}/ev/source", name_glob="part-*", line_sep="\n", recursive=True)
    rows = lines_beside(back, "source", ["reference", "hypothesis"]).collect()
    assert sorted((r["line"], r["reference"], r["hypothesis"]) for r in rows) == sorted((s, t or "", h or "") for s, t, h in want.values())
    assert len({r["file"] for r in rows}) == 3 + 3 + 2


def test_lines_stand_beside_each_other_in_any_order_or_fail(spark, tmp):
    from pathlib import Path
    texts = {"own": "a\n\nc c\n", "other": "1\r\n\n  3\n"}
    for kind, text in texts.items():
        at = Path(tmp, "with space %3A", kind, "k=a%3Ab")
        at.mkdir(parents=True)
        (at / f"part-{kind}.txt").write_bytes(text.encode())
    back = read_lines(spark, f"{tmp}/with space %3A/own", name_glob="part-*", line_sep="\n", recursive=True)
    for rows in (back, back.repartition(1).sort(F.desc("line_no"))):
        got = lines_beside(rows, "own", ["other"]).collect()
        assert sorted((r["line_no"], r["line"], r["other"]) for r in got) == [(0, "a", "1\r"), (1, "", ""), (2, "c c", "  3")]
    (at / "part-other.txt").write_bytes(b"1\n")
    with pytest.raises(Exception, match="no line 1 in other"):
        lines_beside(back, "own", ["other"]).collect()


def test_translated_files_are_read_side_by_side_without_a_shuffle(spark):
    from parapet.plans.queries_sources import translation_files
    plan = translation_files(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
