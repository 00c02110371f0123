"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
oracle per operator of the inventory. Column names match on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the DuckDB oracle (omitted for operators SQL cannot express)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from parapet.plans import queries_corpus, queries_decode, queries_ensemble, queries_eval, queries_files_bleu, queries_metrics, queries_sources, queries_split, queries_vocab  # noqa: F401
