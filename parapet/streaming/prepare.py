"""The stateless preparation steps on a stream.

The reference has no streaming; its per-line steps (direction parsing, the
language tag, white-space stripping) are pure column expressions, so they
run unchanged on new pair files as they arrive. Progress is kept in a
checkpoint under the cluster's shared checkpoint folder, so a restarted
query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parapet.functions import text as T
from parapet.session import checkpoint_dir

PAIR_SCHEMA = "direction string, idx bigint, sl string, tl string"


def prepare_pairs(stream: DataFrame, multi_direction: bool) -> DataFrame:
    """Strip both sides and tag the source with its target language when
    the corpus has several directions (fixed per job: a stream has no
    global distinct count)."""
    d = T.parse_direction(F.col("direction"))
    sl = T.strip_text(F.col("sl"))
    tagged = F.concat(F.lit("<"), d.getField("tgt"), F.lit("> "), sl) if multi_direction else sl
    return stream.select("direction", d.getField("src").alias("src"), d.getField("tgt").alias("tgt"),
                         "idx", tagged.alias("sl"), T.strip_text(F.col("tl")).alias("tl"))


def start_prepare(spark: SparkSession, in_dir: str, out_dir: str, multi_direction: bool,
                  name: str = "prepare_pairs", available_now: bool = True) -> StreamingQuery:
    """Parquet pair files in ``in_dir`` -> prepared pairs in ``out_dir``."""
    src = spark.readStream.schema(PAIR_SCHEMA).parquet(in_dir)
    out = prepare_pairs(src, multi_direction)
    writer = (out.writeStream.format("parquet").option("path", out_dir)
                 .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}")
                 .partitionBy("direction"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
