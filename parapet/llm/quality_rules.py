"""Quality rules as a short-circuit cascade, with built-in functions only.

A rule is a name and a predicate on the text that rejects. On a bounded
sample of the documents each rule's share of rejections and its time are
measured, and rules run in descending order of rejections per second. The
cascade is one CASE expression: a row stops at the first rule that rejects
it, so dear rules see only what cheap ones let through. The verdict does not
depend on the order; ``rejected_by`` names the first rule in the order
found, which may differ from run to run.

Nulls and empties: a null text counts as empty. Every row is judged on its
own, repeated rows alike. An empty table gives no rows (and the given order).
A text of any length is judged whole, in one row's memory.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parapet.llm import bits
from parapet.llm.shared import write_shared

SAMPLE_ROWS = 1000      # expected size of the sample on which rules are measured
SAMPLE_SEED = 42
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 3

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINE_SHARE = 0.4
MAX_UPPER_SHARE = 0.6
MIN_LETTER_SHARE = 0.3


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Column], Column]     # predicate on the text, never null


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    selectivity: float      # share of the sample it rejects
    seconds: float          # for the sample

    @property
    def rank(self) -> float:
        return self.selectivity / max(self.seconds, 1e-3)


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, "[ \\t-\\r]+"), "")).cast("bigint")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")


def lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))


def n_dup_lines(text: Column) -> Column:
    return bits.let(lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def n_repeat_words(text: Column, n: int = REPEAT_WORDS) -> Column:
    """Words in windows of ``n`` words that occur twice or more. The windows
    are sorted with their positions, equal neighbours mark the repeats, and
    the words under the marked windows are counted once each."""
    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(-n).alias("last"))
        return F.aggregate(at, start, lambda a, p: F.struct(
            (a["words"] + F.least(F.lit(n), p - a["last"])).alias("words"), p.alias("last")), lambda a: a["words"])

    def repeats(z: Column) -> Column:
        return covered(F.sort_array(F.array_compact(F.transform(z, lambda x, i: F.when(
            (F.get(z, i - 1)["g"] == x["g"]) | (F.get(z, i + 1)["g"] == x["g"]), x["p"])))))

    return bits.let(bits.shingles(bits.spaced(text), n), lambda t: F.when(
        F.size(F.array_distinct(t)) == F.size(t), F.lit(0).cast("bigint")).otherwise(
        bits.let(F.sort_array(F.transform(t, lambda g, i: F.struct(g.alias("g"), i.alias("p")))), repeats)))


def _upper_share(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, "[^\\p{L}]+", ""))
    return F.length(F.regexp_replace(text, "[^\\p{Lu}]+", "")) / F.greatest(letters, F.lit(1))


def _letter_share(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^\\p{L}]+", "")) / F.greatest(word_chars(text), F.lit(1))


#: The two base conditions as rules, for cascades that need no counts.
BASE = [
    Rule("few_words", lambda t: n_words(t) < MIN_WORDS),
    Rule("repeated_words", lambda t: n_repeat_words(t) * 100 > n_words(t) * MAX_REPEAT_PERCENT),
]
RULES = [
    Rule("symbols", lambda t: n_symbols(t) > n_words(t) * MAX_SYMBOLS_PER_WORD),
    Rule("duplicate_lines", lambda t: n_dup_lines(t) > F.size(lines(t)) * MAX_DUP_LINE_SHARE),
    Rule("upper_case", lambda t: _upper_share(t) > MAX_UPPER_SHARE),
    Rule("few_letters", lambda t: _letter_share(t) < MIN_LETTER_SHARE),
]


def drawn(docs: DataFrame, rows: int, id_col: str, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` of the ``rows`` rows, by a hash of the id and a
    random number of the row: rows with equal or null ids are drawn one by one."""
    share = min(1.0, sample_rows / rows)
    return docs.filter(F.pmod(F.xxhash64(id_col, F.rand(SAMPLE_SEED)), F.lit(1 << 30)) < int(share * (1 << 30)))


def estimate(docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", text_col: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Selectivity and time of each rule on about ``sample_rows`` rows,
    whatever the table's size."""
    rows = docs.count()
    if not rows:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    sample = write_shared(drawn(docs, rows, id_col, sample_rows).select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).repartition(1),
                          "rule-sample")      # a bounded sample: one file, so that times compare

    def timed(rejects: Column) -> tuple[float, float]:
        began = time.monotonic()
        got = sample.agg(F.count_if(rejects).alias("bad"), F.count(F.lit(1)).alias("n")).first()
        return got["bad"] / max(got["n"], 1), time.monotonic() - began

    timed(F.length("text") < 0)                 # reading the sample alone, twice: code is compiled then
    base = timed(F.length("text") < 0)[1]
    out = []
    for r in rules:
        share, seconds = min((timed(r.rejects(F.col("text"))) for _ in range(2)), key=lambda x: x[1])
        out.append(Estimate(r, share, max(seconds - base, 0.0)))
    return out


def order(estimates: Sequence[Estimate]) -> list[Rule]:
    """Most rejections per second first; equal ranks stay as given."""
    return [e.rule for e in sorted(estimates, key=lambda e: -e.rank)]


def rejected_by(rules: Sequence[Rule], text: Column) -> Column:
    """Name of the first rule that rejects, null if none does."""
    text = F.coalesce(text, F.lit(""))
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(r.rejects(text), F.lit(r.name)).otherwise(out)
    return out


def cascade(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *RULES), id_col: str = "doc_id", text_col: str = "text",
            sample_rows: int = SAMPLE_ROWS, name: str = "rejected_by") -> DataFrame:
    """``docs`` with the first rule, in the measured order, that rejects each row."""
    ordered = order(estimate(docs, rules, id_col, text_col, sample_rows))
    return docs.withColumn(name, rejected_by(ordered, F.col(text_col)))


def judge(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES), id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts of every document, whether it fails the base conditions, and
    the verdict of base and cascade: (id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept). The counts are wanted of
    every row, so only the further rules are skipped where the base fails."""
    ordered = order(estimate(docs, rules, id_col, text_col, sample_rows))
    text = F.col("__text")
    counted = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("__text")).select(
        id_col, "__text", n_words(text).alias("n_words"), word_chars(text).alias("word_chars"),
        n_symbols(text).alias("n_symbols"), n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words(text).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return counted.withColumn("base_failed", failed).select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(rejected_by(ordered, text).isNull()).alias("kept"))
