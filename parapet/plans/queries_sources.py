"""Sources and sinks over the driver's tables: write line files, eval-set
files and archives into the shared folder and read them back (S1, S2, S6, S7)."""

from __future__ import annotations

import io
import tarfile
import uuid

import pandas as pd
from pyspark.sql import functions as F

from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import with_
from parapet.plans.queries_eval import KEYS, _translations
from parapet.operators import files, sampling
from parapet.sources import archives, named, sinks
from parapet.sources.cache import artefact_root
from parapet.sources.lines import lines_beside, read_lines

ROWS_PER_FILE = 1000


def _fresh(spark, name: str) -> str:
    return f"{artefact_root(spark)}/{name}-{uuid.uuid4().hex}"


def _position(rows_per_file: int):
    """The position of a line read back: its chunk's start and its number in the chunk."""
    chunk = F.regexp_extract("file", "/chunk=([0-9]+)/", 1).cast("bigint")
    return (chunk * rows_per_file + F.col("line_no")).cast("bigint")


@query("line_files", with_("ilines") + "SELECT lang, idx, line FROM ilines")
def line_files(spark, sf):
    """Every language's lines written as line files and read with their numbers."""
    out = _fresh(spark, "line-files")
    sinks.write_aligned(fx.indexed_lines(spark, sf).select("lang", "idx", "line"), out, "idx", ["line"], ["lang"], ROWS_PER_FILE)
    back = read_lines(spark, f"{out}/line", name_glob="part-*", line_sep="\n", recursive=True)
    return back.select(F.regexp_extract("file", "/lang=([^/]*)/", 1).alias("lang"), _position(ROWS_PER_FILE).alias("idx"), "line")


@query("translation_files", with_("translations", recursive=True) + """
SELECT direction, dataset, line_no, src AS source, coalesce(ref, '') AS reference, hypothesis FROM translations
""")
def translation_files(spark, sf):
    """Eval sets read, translated and written as source, reference and
    hypothesis files, then read back side by side (S5, E4, S7)."""
    out = _fresh(spark, "eval-files")
    t = _translations(spark, sf, ROWS_PER_FILE).select(*KEYS, F.col("src").alias("source"), F.coalesce("ref", F.lit("")).alias("reference"),
                                                       "hypothesis")
    sinks.write_eval(t, out, ROWS_PER_FILE, placed=True)
    back = read_lines(spark, f"{out}/source", name_glob="part-*", line_sep="\n", recursive=True)
    part = lambda name: F.regexp_extract("file", f"/{name}=([^/]*)/", 1).alias(name)
    return lines_beside(back, "source", ["reference", "hypothesis"]).select(
        part("direction"), part("dataset"), _position(ROWS_PER_FILE).alias("line_no"), F.col("line").alias("source"), "reference", "hypothesis")


def _write_archives(docs, folder: str):
    """One ``.tar.gz`` a task with a member ``<source>/<doc_id>.<lang>`` per
    document, streamed; (archive) of what the finished tasks wrote."""
    def run(batches):
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.tar.gz"
        with store.open_output_stream(f"{base}/{name}", compression=None) as raw, \
                tarfile.open(fileobj=raw, mode="w|gz", compresslevel=1) as tar:
            for pdf in batches:
                for source, doc, lang, text in pdf.itertuples(index=False):
                    data = text.encode("utf-8")
                    info = tarfile.TarInfo(f"{source}/{doc}.{lang}")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
        yield pd.DataFrame({"archive": [f"{folder}/{name}"]})

    return docs.select("source", "doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")) \
               .mapInPandas(run, "archive string")


@query("archive_lines", """
SELECT source || '/' || doc_id || '.' || lang AS member, CAST(i - 1 AS BIGINT) AS line_no, parts[i] AS line
FROM (SELECT source, doc_id, lang, CASE WHEN parts[len(parts)] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts
      FROM (SELECT *, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM documents)) d,
     LATERAL (SELECT unnest(generate_series(1, len(d.parts))) AS i)
""")
def archive_lines(spark, sf):
    """Every document packed into archives and its lines read from them."""
    out = _fresh(spark, "archives")
    _write_archives(fx.table(spark, sf, "documents"), out).write.parquet(f"{out}/written")
    read = archives.read_archives(spark, out, addresses=spark.read.parquet(f"{out}/written").select(F.col("archive").alias("path")))
    return read.select("member", "line_no", "line")


SEED, N_VALID = 42, 3000
_SPLIT_SQL = f"""
, split AS (
  SELECT CASE WHEN pair_id IN (SELECT pair_id FROM corpus ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id
                               LIMIT {N_VALID}) THEN 'valid' ELSE 'train' END AS split, pair_id, sl, tl FROM corpus)
SELECT split || '.' || side AS name, row_number() OVER (PARTITION BY split, side ORDER BY pair_id) - 1 AS line_no, line
FROM (SELECT split, pair_id, unnest(['sl', 'tl']) AS side, unnest([sl, tl]) AS line FROM split)
"""


@query("split_files", with_("corpus") + _SPLIT_SQL)
def split_files(spark, sf):
    """The split corpus written as ``train.sl``, ``train.tl``, ``valid.sl`` and
    ``valid.tl`` and read back with line numbers (S6, S1)."""
    out = _fresh(spark, "split-files")
    corpus = fx.prepared_table(spark, sf, "left").withColumn("file", F.col("_metadata.file_path"))
    pairs = sampling.train_valid_split(corpus, N_VALID, SEED, ["pair_id"])
    named.write_split(pairs.select("split", "pair_id", "sl", "tl", "file", "direction"), out, run=["file", "direction"])
    back = read_lines(spark, out, name_glob="*.[st]l", line_sep="\n")
    return back.select(files.file_name("file").alias("name"), "line_no", "line")
