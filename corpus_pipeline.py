"""Training-corpus pipeline over ``documents``: language ID, quality rules,
near-duplicates, packing.

Each stage works on all rows its predecessor kept, and its result is written
as Parquet in the shared folder before the next one starts, so a lost
executor never costs more than one stage. All but the last return the
columns of ``documents``; every stage takes null, empty, repeated and no rows
(see the operators for what each becomes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parapet.llm import best_fit_packing, language_id, quality_rules, simhash_dedup
from parapet.llm.queries import vocabulary
from parapet.llm.shared import write_shared
from parapet.session import ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a learned language. Texts without a letter and texts whose best
    language has less than half the probability go. The network learns from
    the labelled rows among ``docs`` outside the held-out fold; without any
    it cannot tell, and every row stays."""
    ship_package(spark)
    model = language_id.train(docs.filter(language_id.fold("doc_id", 5) != 0))
    return language_id.keep_known(docs, model)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base conditions and every further rule."""
    rules = quality_rules.order(quality_rules.estimate(docs, [*quality_rules.BASE, *quality_rules.RULES]))
    return docs.filter(quality_rules.rejected_by(rules, F.col("text")).isNull())


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the smallest doc_id."""
    ship_package(spark)
    return simhash_dedup.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents with their places in sequences."""
    ship_package(spark)
    return best_fit_packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("language_id", identify_language), ("quality_rules", apply_quality_rules),
          ("simhash_dedup", drop_near_duplicates), ("best_fit_packing", pack_sequences)]

# A trained network and a tokenizer are not SQL; tests/llm/test_pipeline.py checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
