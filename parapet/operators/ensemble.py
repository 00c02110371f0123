"""Ensembles of model scores in array form.

A score row is one (sentence, step, model) with the distribution over the
vocabulary as ``array<double>``: log-softmax, the vocabulary cut and the
arg-max are in-row expressions (no shuffle), and averaging gathers the M
member rows of a (sentence, step) - a group bounded by the ensemble size.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


log = logging.getLogger(__name__)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def logsumexp(values) -> Column:
    """``ln(sum(exp(v)))`` in one pass (running max and rescaled sum)."""
    start = F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))

    def step(acc, v):
        m = F.greatest(acc["m"], v)
        return F.struct(m.alias("m"), (acc["s"] * F.exp(acc["m"] - m) + F.exp(v - m)).alias("s"))

    return F.aggregate(_c(values), start, step, lambda acc: acc["m"] + F.log(acc["s"]))


def _minus_each(values: Column, scalar: Column) -> Column:
    # a per-row scalar used inside a lambda would be re-evaluated for every
    # element; zipping it in as a repeated array evaluates it once per row
    z = F.arrays_zip(values.alias("v"), F.array_repeat(scalar, F.size(values)).alias("k"))
    return F.transform(z, lambda e: e["v"] - e["k"])


def log_softmax(logits) -> Column:
    """``z - logsumexp(z)`` over the array."""
    a = _c(logits)
    return _minus_each(a, logsumexp(a))


def vocab_limit(logits, k: int | None) -> Column:
    """Keep the first ``k`` token ids (F8); ``None`` keeps all."""
    return _c(logits) if k is None else F.slice(_c(logits), 1, k)


def argmax(values) -> Column:
    """0-based position of the largest value; ties go to the lowest id."""
    a = _c(values)
    return (F.array_position(a, F.array_max(a)) - 1).cast("bigint")


def last_position(df: DataFrame, keys: Sequence[str], step: str, value: str) -> DataFrame:
    """The ``value`` at the largest ``step`` of each key."""
    return df.groupBy(*keys).agg(F.max(step).alias(step),
                                 F.max_by(value, step).alias(value))


def available_members(scores: DataFrame, declared: Sequence[str], model: str = "model") -> DataFrame:
    """(model, available, n_rows) for every declared member and every member
    that produced scores (E2). Members without scores are skipped by the
    ensemble; callers log them and fail when none is available."""
    spark = scores.sparkSession
    decl = spark.createDataFrame([(m,) for m in declared], f"{model} string")
    seen = scores.groupBy(F.col(model).cast("string").alias(model)).agg(F.count(F.lit(1)).alias("n_rows"))
    out = decl.join(seen, model, "full_outer").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("bigint"))
    return out.withColumn("available", F.col("n_rows") > 0)


def require_members(members: DataFrame, model: str = "model", max_members: int = 10_000) -> list[str]:
    """Names of the available members (E2): members without scores are
    logged as skipped; an ensemble with no member fails. The member table
    is a configuration-sized list (checked)."""
    rows = members.select(model, "available").limit(max_members + 1).collect()
    if len(rows) > max_members:
        raise ValueError("member table larger than a configuration list")
    skipped = sorted(r[0] for r in rows if not r[1])
    if skipped:
        log.warning("skipping ensemble members without scores: %s", ", ".join(skipped))
    ok = sorted(r[0] for r in rows if r[1])
    if not ok:
        raise RuntimeError("no ensemble member is available")
    return ok


def ensemble_average(df: DataFrame, keys: Sequence[str], logprobs: str, n_models: int | Column) -> DataFrame:
    """Log of the arithmetic mean of the members' probabilities (A7):
    elementwise ``logsumexp over members - ln M``. ``M`` is the number of
    available members, so a member without a row contributes no mass."""
    m = F.lit(float(n_models)) if not isinstance(n_models, Column) else n_models.cast("double")
    # ln M as a column: lambdas may reference columns but not subqueries
    g = df.groupBy(*keys).agg(F.collect_list(logprobs).alias("__m")).withColumn("__lnm", F.log(m))
    members = F.col("__m")

    def at(i):
        return logsumexp(F.transform(members, lambda a: a[i]))

    width = F.size(members[0])
    total = F.transform(F.sequence(F.lit(0), width - 1), at)
    return g.select(*keys, _minus_each(total, F.col("__lnm")).alias("avg_logprobs"))


def ensemble_step(scores: DataFrame, keys: Sequence[str], step: str, model: str, logits: str,
                  n_models: int | Column, vocab: int | None = None) -> DataFrame:
    """F7 -> W4 -> A7 -> W5 in one plan (E3): (keys, token_id, logprob)."""
    lp = scores.select(*keys, step, model, log_softmax(vocab_limit(logits, vocab)).alias("lp"))
    last = last_position(lp, [*keys, model], step, "lp")
    avg = ensemble_average(last, keys, "lp", n_models)
    tok = argmax("avg_logprobs")
    return avg.select(*keys, tok.alias("token_id"),
                      F.element_at("avg_logprobs", (tok + 1).cast("int")).alias("logprob"))


