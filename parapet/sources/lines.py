"""Line files (S1): one row per line with its exact 0-based line number.

Spark packs file splits into partitions by size, so partition order is not
file order. ``monotonically_increasing_id()``, taken in the first projection
over the scan, counts the lines of a split in read order. A first scan, which
reads no line, gives each split's lines and its first such id; summed in file
order they are a thin side index (a row a split). The lines then find their
split's start in it and stay where they were read: nothing is shuffled. A
line outside its split's ids - the files were split otherwise the second
time - fails the job.
"""

from __future__ import annotations

import glob as _glob
import io
import itertools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parapet.session import cut_lineage

READ_BYTES = 1 << 16
MAX_SPLITS_BROADCAST = 200_000      # splits of 128 MB: 25 TB of text; more are joined by shuffling


def split_index(scan: DataFrame) -> DataFrame:
    """(file, split, low, n, first) of a scan (file, split, mid): the lines of
    each split, their first id, and where they start in the file."""
    totals = scan.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("low"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def read_lines(spark: SparkSession, path: str | list[str], prefix: str | None = None,
               name_glob: str | None = None, line_sep: str | None = None, recursive: bool = False) -> DataFrame:
    """(file, line_no, line) for a file, a directory of files, or a list.

    ``prefix`` keeps only files whose name starts with it; ``name_glob``
    filters names with a glob (both pushed into the file listing). Lines
    split on ``\\n``, ``\\r\\n`` and ``\\r`` unless ``line_sep`` is given."""
    reader = spark.read.format("text")
    pattern = None
    if prefix is not None:
        pattern = _glob.escape(prefix) + "*"
    if name_glob is not None:
        if pattern is not None:
            raise ValueError("give prefix or name_glob, not both")
        pattern = name_glob
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if recursive:       # all folders below, their names not taken as columns
        reader = reader.option("recursiveFileLookup", "true")
    raw = reader.load(path)
    scan = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.monotonically_increasing_id().alias("mid"), F.col("value").alias("line"))
    index = cut_lineage(split_index(scan.drop("line")))
    if index.limit(MAX_SPLITS_BROADCAST + 1).count() <= MAX_SPLITS_BROADCAST:
        index = F.broadcast(index)
    place = F.col("mid") - F.col("low")
    inside = F.coalesce((place >= 0) & (place < F.col("n")), F.lit(False))
    numbered = F.when(inside, F.col("first") + place).otherwise(F.raise_error(F.lit("the files were split otherwise when counted")))
    return scan.join(index, ["file", "split"], "left").select("file", numbered.cast("bigint").alias("line_no"), "line")


def _lines_from(folder: str, prefix: str, start: int) -> Iterator[bytes]:
    """The lines from number ``start`` of the one file in ``folder`` whose name begins with ``prefix``."""
    from pyarrow import fs

    from parapet.sources.named import _store
    store, base = _store(folder)
    found = [f.path for f in store.get_file_info(fs.FileSelector(base)) if f.base_name.startswith(prefix)]
    if len(found) != 1:
        raise ValueError(f"{folder}: one file was expected, not {len(found)}")
    with io.BufferedReader(store.open_input_stream(found[0], compression=None), READ_BYTES) as lines:
        for line in itertools.islice(lines, start, None):
            yield line[:-1] if line.endswith(b"\n") else line


def lines_beside(rows: DataFrame, own: str, others: Sequence[str], prefix: str = "part-") -> DataFrame:
    """``rows`` (file, line_no, ...) of :func:`read_lines` under a folder
    ``own``, with a column for each of ``others``: the same line of the file
    that stands at the same place under that folder, as
    :func:`sinks.write_aligned` writes them (``\\n`` ends a line). The other
    files are streamed along with the rows, in their order, so no line is
    shuffled; a file or line that is not there fails the job."""
    at = [rows.columns.index(c) for c in ("file", "line_no")]

    def run(batches):
        open_: dict[str, tuple] = {}       # the file read last, its next line's number, its lines

        def line_of(other: str, file: str, n: int) -> bytes:
            last, ahead, lines = open_.get(other, (None, 0, None))
            if last != file or n != ahead:
                top, _, below = file.rpartition("/")[0].rpartition(f"/{own}/")
                lines = _lines_from(f"{top}/{other}/{below}", prefix, n)
            line = next(lines, None)
            if line is None:
                raise ValueError(f"{file}: no line {n} in {other}")
            open_[other] = (file, n + 1, lines)
            return line

        for rb in batches:
            wanted = list(zip(*(rb.column(i).to_pylist() for i in at)))
            found = [pa.array([line_of(other, *w) for w in wanted], pa.binary()).cast(pa.string()) for other in others]
            yield pa.RecordBatch.from_arrays([*rb.columns, *found], [*rb.schema.names, *others])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *(StructField(other, StringType()) for other in others)]))
