"""Stand-ins for the reference's inputs, derived from the driver's tables.

Each builder takes (spark, sf_dir) and returns a lazy DataFrame; work grows
with the tables. The matching DuckDB definitions live in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parapet.operators import corpus
from parapet.operators.sizing import bounded_rows, partitions_for

SOURCE_LANG = "en"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, line_no, line): documents split on newlines."""
    docs = table(spark, sf_dir, "documents")
    return corpus.lines_from_text(docs, "text", keep=["doc_id", "lang", "source"])


def documents_key(spark: SparkSession, sf_dir: str) -> str:
    """Fingerprint of the documents table's files: artefacts follow their input."""
    from parapet.sources.cache import input_fingerprint
    return input_fingerprint(table(spark, sf_dir, "documents"))


def doc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, source, doc_id, n, first, file_first): lines of each document,
    and where they start in the concatenation of its language and of its
    (source, language) file. Thin (one row per document) and materialised
    once per input in the shared checkpoint folder (SURVEY 7.4)."""
    from parapet.operators.ordinal import running_offset
    from parapet.session import cut_lineage
    from parapet.sources.cache import materialise_once

    def build():
        docs = table(spark, sf_dir, "documents")
        n = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
        # the scans below read their input several times: the texts are read once
        counts = cut_lineage(docs.select("lang", "source", "doc_id", n.cast("bigint").alias("n")))
        block = F.floor(F.col("doc_id") / corpus.DEFAULT_FILES_PER_BLOCK)
        by_lang = running_offset(counts, ["lang"], ["doc_id"], block, F.col("n"), "first")
        return running_offset(by_lang, ["source", "lang"], ["doc_id"], block, F.col("n"), "file_first")

    return materialise_once(spark, "document-index", [documents_key(spark, sf_dir)], build)


def indexed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines`` plus ``idx``, the position in the concatenation of the
    language's documents in doc_id order (U2), and ``file_line``, that in the
    (source, language) file: the one line table every later step reads,
    written once per input, each file sorted by (lang, idx)."""
    from parapet.sources.cache import materialise_once
    from parapet.sources.positional import sorted_files

    def build():
        idx = doc_index(spark, sf_dir).select("doc_id", "lang", "source", "first", "file_first")
        # texts meet the index whole, and are cut into lines behind it
        placed = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text").join(idx, ["doc_id", "lang", "source"])
        numbered = corpus.lines_from_text(placed, "text", keep=["doc_id", "lang", "source", "first", "file_first"]).select(
            "lang", "source", "doc_id", "line_no", (F.col("first") + F.col("line_no")).alias("idx"),
            (F.col("file_first") + F.col("line_no")).alias("file_line"), "line")
        return sorted_files(numbered, "lang", "idx")

    return materialise_once(spark, "indexed-lines", [documents_key(spark, sf_dir)], build)


def line_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``indexed_lines``: which positions lie in which file."""
    from parapet.sources.positional import manifest_once
    return manifest_once(spark, "indexed-lines", [documents_key(spark, sf_dir)], indexed_lines(spark, sf_dir), "lang", "idx")


def line_totals(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Lines of each language, from the index."""
    totals = doc_index(spark, sf_dir).groupBy("lang").agg(F.sum("n").alias("total"))
    return dict(bounded_rows(totals, corpus.MAX_DIRECTIONS))


def target_langs(spark: SparkSession, sf_dir: str) -> list[str]:
    """Languages paired with English (a scan of the ``lang`` column only)."""
    docs = table(spark, sf_dir, "documents").filter(F.col("lang") != SOURCE_LANG)
    return corpus.distinct_values(docs, "lang")


RANGE_BYTES = 16 << 20      # of the line table, compressed, for a range of positions


def zip_pairs(spark: SparkSession, sf_dir: str, how: str = "inner", with_sizes: bool = False, in_ranges: bool = False):
    """(direction, idx, sl, tl): English lines against each other language.
    With ``with_sizes`` also (direction, n): pairs per direction, from the
    per-language line totals of the index (inner: the shorter side; left:
    English). With ``in_ranges`` each partition holds a range of positions,
    in order: the zip's one shuffle is dealt by range."""
    tgts = target_langs(spark, sf_dir)
    il = indexed_lines(spark, sf_dir).select("lang", "idx", "line")
    if in_ranges:
        il = il.repartitionByRange(partitions_for(il, RANGE_BYTES), "idx")
    z = corpus.zip_by_position(il, SOURCE_LANG, tgts, how)
    if in_ranges:
        z = z.sortWithinPartitions("idx", "direction")
    if not with_sizes:
        return z
    lengths = line_totals(spark, sf_dir)
    n_en = lengths.get(SOURCE_LANG, 0)
    rows = [(f"{SOURCE_LANG}__{t}", min(n_en, lengths[t]) if how == "inner" else n_en) for t in tgts]
    return z, spark.createDataFrame(rows, "direction string, n bigint")


def prepared_table(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    """``prepared``, written once per input as Parquet: multi-pass consumers
    (the exact split) then read only the columns they need. A file holds a
    range of ``idx``, in order, of every direction."""
    from parapet.sources.cache import materialise_once
    key = [documents_key(spark, sf_dir), how]
    return materialise_once(spark, "prepared-corpus", key, lambda: prepared(spark, sf_dir, how, in_ranges=True))


def prepared(spark: SparkSession, sf_dir: str, how: str = "left", in_ranges: bool = False) -> DataFrame:
    """Zip -> tag -> union: (direction, idx, pair_id, sl, tl), the corpus the
    split draws from. The tag decision and the direction sizes come from
    cheap side tables, so the zip itself is computed once."""
    z, sizes = zip_pairs(spark, sf_dir, how, with_sizes=True, in_ranges=in_ranges)
    tagged = corpus.tag_language(z, multi=len(target_langs(spark, sf_dir)) > 1)
    return corpus.union_directions(tagged, sizes=sizes)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, pair_id, sl, tl): user turn and the assistant's reply."""
    return corpus.conversation_pairs(table(spark, sf_dir, "conversations"))


def files(spark: SparkSession, sf_dir: str, with_content: bool = True) -> DataFrame:
    """(path[, content]): two language files per conversation pair, named
    ``c<conv>_<turn>_Aligned.<lang>`` (en, it), plus unrelated benchmark
    files. Without content it is a listing only, and no text is read."""
    p = pairs(spark, sf_dir)
    name = lambda lang: F.concat(F.lit("c"), F.col("conv_id"), F.lit("_"), F.col("turn"),
                                 F.lit("_Aligned."), lang)
    bench = table(spark, sf_dir, "benchmark")
    bench_path = F.concat(F.lit("bench_"), F.col("item_id"), F.lit(".txt")).alias("path")
    if not with_content:
        listing = p.select("conv_id", "turn", F.explode(F.array(F.lit("en"), F.lit("it"))).alias("lang"))
        return listing.select(name(F.col("lang")).alias("path")).unionByName(bench.select(bench_path))
    sides = F.explode(F.array(F.struct(F.lit("en").alias("lang"), F.col("sl").alias("content")),
                              F.struct(F.lit("it").alias("lang"), F.col("tl").alias("content"))))
    paired = p.select("conv_id", "turn", sides.alias("s")).select(
        name(F.col("s.lang")).alias("path"), F.col("s.content").alias("content"))
    return paired.unionByName(bench.select(bench_path, F.col("text").alias("content")))


def hyp_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, sid, hyp, ref): reference = the space-separated words of a
    document; hypothesis = the same without every 7th word."""
    docs = table(spark, sf_dir, "documents")
    ref = F.split(F.col("text"), " ")
    return docs.select("lang", F.col("doc_id").alias("sid"), ref.alias("ref")) \
               .withColumn("hyp", F.filter("ref", lambda x, i: (i + 1) % 7 != 0))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, model, logits array<double>): four members score each sentence."""
    e = table(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") / 4).cast("bigint").alias("sid"), (F.col("vec_id") % 4).alias("model"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("logits"))


def step_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, step, model, logits): five decoding steps of four members."""
    e = table(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") / 20).cast("bigint").alias("sid"),
                    ((F.col("vec_id") / 4).cast("bigint") % 5).alias("step"),
                    (F.col("vec_id") % 4).alias("model"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("logits"))


N_MEMBERS = 4
BIGRAM_MEMBERS = [f"m{k}" for k in range(N_MEMBERS)]


def member_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(member, line): every line; a source's number modulo ``N_MEMBERS``
    says which bigram member is counted on it."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("bigint") % N_MEMBERS
    return lines(spark, sf_dir).select(F.concat(F.lit("m"), number).alias("member"), "line")


def bigram_cells(spark: SparkSession, sf_dir: str, keep=None) -> tuple[DataFrame, DataFrame]:
    """The bigram members' successor counts with their contexts' totals, and those totals."""
    from parapet.operators import decode
    return decode.bigram_cells(member_lines(spark, sf_dir), "member", "line", BIGRAM_MEMBERS, keep)


def decode_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, line_no, token): the first word of every line, null without one."""
    from parapet.operators.decode import first_token
    return lines(spark, sf_dir).select(F.col("doc_id").alias("sid"), "line_no", first_token("line").alias("token"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, epoch, value): each user's events in time order as one run's
    evaluations; ``epoch`` is 1-based, numbered with the two-level scan over
    hourly blocks so no single window holds a whole run."""
    from parapet.operators.ordinal import ordinal
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), "ts", "event_id", "value")
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3_600_000_000))
    return ordinal(ev, ["run"], ["ts", "event_id"], hour, "epoch", base=1).select("run", "epoch", "value")


HELD_OUT_REF = "src19"      # the dataset whose references are missing


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, direction, dataset, src, ref): the nested manifest map built
    from the distinct (lang, source) of documents, then exploded (S4)."""
    from parapet.sources.manifest import explode_manifest
    d = table(spark, sf_dir, "documents").filter(F.col("lang") != SOURCE_LANG) \
        .select("lang", "source").distinct()
    leaf = F.struct(F.concat(F.col("source"), F.lit("/" + SOURCE_LANG)).alias("src"),
                    F.when(F.col("source") == HELD_OUT_REF, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.col("source"), F.lit("/"), F.col("lang"))).alias("ref"))
    per_dir = d.select(F.concat(F.lit(SOURCE_LANG + "__"), F.col("lang")).alias("direction"),
                       F.struct(F.col("source"), leaf).alias("e")) \
               .groupBy("direction").agg(F.map_from_entries(F.collect_list("e")).alias("sets"))
    nested = per_dir.agg(F.create_map(F.lit("test"), F.map_from_entries(
        F.collect_list(F.struct("direction", "sets")))).alias("m"))
    return explode_manifest(nested, "m")


def eval_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, line_no, line): one virtual file per (source, lang): that
    source's documents in that language, concatenated in doc_id order."""
    return indexed_lines(spark, sf_dir).select(F.concat_ws("/", "source", "lang").alias("path"),
                                               F.col("file_line").alias("line_no"), "line")


def scorer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prev, next, p): the ensemble's best continuation per context - a
    model artefact, materialised once per input."""
    from parapet.operators import decode
    from parapet.sources.cache import materialise_once

    def build():
        return decode.best_next(bigram_cells(spark, sf_dir, decode.near_best)[0], N_MEMBERS)

    return materialise_once(spark, "bigram-best-next", [documents_key(spark, sf_dir), N_MEMBERS], build)


def scorer_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prev, path, stop): the scorer's greedy path from the first word of
    every line, materialised once per input (part of the scorer artefact)."""
    from parapet.operators import decode
    from parapet.sources.cache import materialise_once
    key = [documents_key(spark, sf_dir), N_MEMBERS, "paths", decode.MAX_STEPS]
    return materialise_once(spark, "bigram-paths", key,
                            lambda: decode.greedy_paths(
                                scorer_table(spark, sf_dir).select("prev", "next"), starts=decode_starts(spark, sf_dir)))
