"""Lookup by position opens few files and reads few rows."""

import pytest
from pyspark.sql import functions as F

from parapet.sources import positional as at


def _scanned(df):
    """Rows that the scans of a collected plan put out."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if plan.nodeName().startswith("Scan") and plan.metrics().contains("numOutputRows"):
            total += plan.metrics().apply("numOutputRows").value()
        kids = plan.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


@pytest.fixture()
def table(spark, tmp):
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, "en").otherwise("de").alias("lang"),
                                       F.floor(F.col("id") / 3).alias("idx"), F.concat(F.lit("line "), F.col("id")).alias("line"))
    rows = rows.unionByName(spark.createDataFrame([("fr", 0, "one"), ("fr", 0, "again")], "lang string, idx long, line string"))
    at.sorted_files(rows.repartitionByRange(10, "idx"), "lang", "idx").write.option("parquet.page.row.count.limit", 500).parquet(f"{tmp}/t")
    return spark.read.parquet(f"{tmp}/t")


def test_rows_files_and_reading(spark, table):
    ranges = at.manifest(table, "lang", "idx").persist()
    assert ranges.agg(F.sum("n")).first()[0] == 200_002
    wanted = [("en", 0), ("en", 66_666), ("de", 31_234), ("fr", 0), ("fr", 1), ("xx", 5), ("en", 10**9), (None, 1)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = at.rows_at(table, ranges, wanted, "lang", "idx")
        got = sorted(tuple(r) for r in out.collect())
        read = _scanned(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = [tuple(r) for w in wanted if w[0] for r in table.filter((F.col("lang") == w[0]) & (F.col("idx") == w[1])).collect()]
    assert got == sorted(want) and ("fr", 0, "again") in got and len(got) == 6
    assert len(at.files_of(ranges, [("en", 0)])) == 1 and len(at.files_of(ranges, wanted[:3])) <= 3
    assert 0 < read < 0.05 * 200_000        # pages, not files


def test_nothing_wanted_and_too_much(spark, table):
    ranges = at.manifest(table, "lang", "idx")
    assert at.rows_at(table, ranges, [], "lang", "idx").count() == 0
    assert at.rows_at(table, ranges, [("xx", 0)], "lang", "idx").columns == ["lang", "idx", "line"]
    many = [("en", i) for i in range(450)]
    assert at.rows_at(table, ranges, many, "lang", "idx").count() == 450
    with pytest.raises(ValueError, match="join instead"):
        at.rows_at(table, ranges, [("en", i) for i in range(at.MAX_WANTED + 1)], "lang", "idx")
