"""Evaluation manifest (S4): split -> direction -> dataset -> {src, ref}.

The manifest is a small configuration file: the driver parses it (YAML
anchors resolve there), builds one nested-map row and Spark explodes it to
(split, direction, dataset, src, ref) rows; ``ref`` may be missing (null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_TYPE = "map<string, map<string, map<string, struct<src: string, ref: string>>>>"


def manifest_from_yaml(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    import yaml

    with open(path, encoding="utf-8") as fh:
        doc = yaml.safe_load(fh)
    prefix = root.rstrip("/") + "/" if root else ""

    def leaf(v):
        return {"src": prefix + v["src"], "ref": (prefix + v["ref"]) if v.get("ref") else None}

    nested = {split: {d: {name: leaf(v) for name, v in sets.items()} for d, sets in dirs.items()}
              for split, dirs in doc.items()}
    df = spark.createDataFrame([(nested,)], f"m {MANIFEST_TYPE}")
    return explode_manifest(df, "m")


def explode_manifest(df: DataFrame, col: str) -> DataFrame:
    """Three explodes of the nested map -> one row per eval set."""
    a = df.select(F.explode(col).alias("split", "dirs"))
    b = a.select("split", F.explode("dirs").alias("direction", "sets"))
    c = b.select("split", "direction", F.explode("sets").alias("dataset", "leaf"))
    return c.select("split", "direction", "dataset", F.col("leaf.src").alias("src"), F.col("leaf.ref").alias("ref"))
