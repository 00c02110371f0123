"""Materialise an artefact once.

The artefact lives under the shared checkpoint folder at
``<root>/<name>-<key>``, where the key hashes the code, the parameters and a
fingerprint of the input files (path, size, modification time): a changed
input, parameter or version builds a new artefact instead of reusing a stale
one, and another application over the same input finds it.

A build is written to a fresh folder and named by a small pointer written
after it; without the pointer and the writer's own success marker nothing is
read. Two builders of one key at a time write the same content twice, and
either pointer is right.
"""

from __future__ import annotations

import glob
import hashlib
import os
import uuid
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parapet.session import checkpoint_dir


def artefact_root(spark: SparkSession) -> str:
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or checkpoint_dir(spark)
    return base.rstrip("/") + "/artefacts"


def input_fingerprint(df: DataFrame) -> str:
    """Digest of (path, length, modification time) of the files behind
    ``df``, computed by Spark from its own listing: per-file hashes are summed
    and counted, and one row reaches the driver. No file content is read."""
    paths = df.inputFiles()
    if not paths:
        return "no-files"
    one = F.xxhash64("path", "length", "modificationTime")
    meta = df.sparkSession.read.format("binaryFile").load(paths).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(one).alias("x"), F.sum(F.pmod(one, F.lit(1 << 31))).alias("s"),
        F.sum("length").alias("bytes"), F.max("modificationTime").alias("last")).first()
    return hashlib.md5("|".join(map(str, meta)).encode()).hexdigest()


@lru_cache(maxsize=1)
def code_version() -> str:
    """Digest of the package's modules that build artefacts: another version
    of the code does not read what this one wrote."""
    h = hashlib.md5()
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for part in ("functions", "operators", "plans", "sources"):
        for path in sorted(glob.glob(os.path.join(here, part, "*.py"))):
            with open(path, "rb") as f:
                h.update(f.read())
    return h.hexdigest()


def key_of(parts: Sequence[object]) -> str:
    return hashlib.md5("\x1f".join(map(str, [code_version(), *parts])).encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The finished artefact at ``path``, or None."""
    if not _exists(spark, f"{path}/current/_SUCCESS"):
        return None
    try:
        names = [r["value"] for r in spark.read.text(f"{path}/current").limit(2).collect()]
    except AnalysisException:
        return None
    if len(names) != 1 or not _exists(spark, f"{path}/{names[0]}/_SUCCESS"):
        return None
    return spark.read.parquet(f"{path}/{names[0]}")


def materialise_once(spark: SparkSession, name: str, key_parts: Sequence[object],
                     build: Callable[[], DataFrame], root: str | None = None) -> DataFrame:
    """Read ``name`` for this key if it was finished before, else build it,
    write it as Parquet, publish it and read it back."""
    path = f"{(root or artefact_root(spark)).rstrip('/')}/{name}-{key_of(key_parts)}"
    found = published(spark, path)
    if found is not None:
        return found
    fresh = f"build-{uuid.uuid4().hex}"
    build().write.option("compression", "zstd").parquet(f"{path}/{fresh}")
    spark.createDataFrame([(fresh,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/current")
    return spark.read.parquet(f"{path}/{fresh}")
