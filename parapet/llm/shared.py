"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from parapet.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir`` (visible to every executor)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut by a
    table every executor can reread, and the work is done once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
