from pyspark.sql import functions as F

from parapet.streaming.prepare import PAIR_SCHEMA, start_prepare


def test_stream_prepares_new_files(spark, tmp):
    rows = [("en__de", 0, "  hello ", "hallo\t"), ("en__it", 0, "cat", " gatto")]
    spark.createDataFrame(rows, PAIR_SCHEMA).write.parquet(f"{tmp}/in/batch0")
    q = start_prepare(spark, f"{tmp}/in/*", f"{tmp}/out", multi_direction=True, name=f"t{abs(hash(tmp))}")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp}/out").orderBy("direction").collect()
    assert [(r["direction"], r["src"], r["tgt"], r["sl"], r["tl"]) for r in out] == [
        ("en__de", "en", "de", "<de> hello", "hallo"), ("en__it", "en", "it", "<it> cat", "gatto")]
