"""Document quality by Bradley-Terry pairwise ranking.

A labelled good document is preferred to a labelled bad one; a document's
strength is linear in its features, so a preference's log-odds are the
weights times the difference of features. The weights minimise the logistic
loss (Newton steps, small ridge) over preferences in which every labelled
document takes part: Spark deals the labelled documents' features to blocks,
each document meets ``PAIRS_PER_DOC`` of the other kind in its block, and
every step sums the blocks' gradients and curvatures. The decision threshold
is the exact quantile of all labelled documents' strengths that leaves the
labelled share of bad documents below it; scores map that strength to
``CUT`` on a logistic scale. Only on demand (``sample_per_label``) is a
drawn sample fitted in the driver instead.

Features come from the whole text and nothing else.

Nulls and empties: a null text counts as empty and is scored by its zero
features. Labels other than 0 and 1 are ignored; a document labelled twice
counts twice. Without labels of both kinds every score is 0.5. Repeated rows
give repeated results; an empty table gives no rows. A strength at the
threshold scores ``CUT`` and is predicted 1. A text of any length is read
whole, in the memory of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parapet.llm.shared import type_of, write_shared
from parapet.llm.units import flat, slices

BLOCK = 512                 # labelled documents among which opponents are found
PAIRS_PER_DOC = 8           # preferences of each labelled document
STEPS = 30
CUT = 0.7                   # the score at the threshold quantile
RIDGE = 1e-2

FEATURES = ("log_words", "mean_word_bytes", "distinct_word_share", "duplicate_line_share", "symbol_share",
            "upper_share", "digit_share", "exclamation_share", "other_punctuation_share", "log_words_per_line")
_CLASSES = np.zeros((256, 6))
for _i, _set in enumerate((b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!",
                           b"\"'()+,-./:;=?@[\\]^_`{}~", bytes(range(97, 123)))):
    _CLASSES[list(_set), _i] = 1


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    size = np.diff(offsets)
    for i in range(n):
        text = data[offsets[i]:offsets[i + 1]].tobytes()
        words = text.split()
        if not words:
            continue
        lines = [x for x in text.split(b"\n") if x.strip()]
        counts = np.bincount(data[offsets[i]:offsets[i + 1]], minlength=256) @ _CLASSES
        symbols, upper, digits, exclaim, punct, lower = counts
        k = len(words)
        out[i] = (np.log1p(k), min(sum(map(len, words)) / k, 20.0), len(set(words)) / k,
                  1 - len(set(lines)) / len(lines), min(symbols / k, 1.0), upper / max(upper + lower, 1),
                  digits / size[i], min(exclaim / k, 1.0), min(punct / k, 1.0), np.log1p(k / len(lines)))
    return out


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.strength(x) - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, population: tuple[float, float] = (1.0, 1.0), seed: int = 11) -> Model | None:
    """Weights from pairs of a bad and a good row; ``population``: labelled
    documents of kind 0 and 1 that the sample stands for."""
    bad, good = np.flatnonzero(y == 0), np.flatnonzero(y == 1)
    if not len(bad) or not len(good):
        return None
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    s = (x - centre) / scale
    rng = np.random.default_rng(seed)
    loser = np.concatenate([np.repeat(bad, PAIRS_PER_DOC), rng.choice(bad, len(good) * PAIRS_PER_DOC)])
    winner = np.concatenate([rng.choice(good, len(bad) * PAIRS_PER_DOC), np.repeat(good, PAIRS_PER_DOC)])
    d = s[winner] - s[loser]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))       # probability of the preference
        grad = d.T @ (p - 1) / len(d) + RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    z = s @ w
    weight = np.where(y == 0, population[0] / len(bad), population[1] / len(good))
    order = np.argsort(z, kind="stable")
    share = np.cumsum(weight[order]) / weight.sum()
    at = int(np.searchsorted(share, population[0] / (population[0] + population[1]) - 1e-9))
    above = min(at + 1, len(z) - 1)
    return Model(centre, scale, w, float((z[order[at]] + z[order[above]]) / 2))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_per_label: int | None = None) -> Model | None:
    """Fit on all labelled documents (:func:`train_table`), or on about
    ``sample_per_label`` of each kind: then label rows are drawn one by one; those drawn (a few thousand whatever the
    table's size) are broadcast to the documents, and documents that share
    their ids are thinned one by one. The driver holds their features."""
    if sample_per_label is None:
        return train_table(feature_table(docs.select(id_col, text_col).join(labels.select(id_col), id_col, "left_semi"), id_col, text_col),
                           labels, id_col, label_col)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter("id is not null and label in (0, 1)")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None

    def chosen(value, have: dict[int, int]):
        out = F.lit(False)
        for label, n in sorted(have.items()):
            out = F.when(F.col("label") == label, value < min(1.0, sample_per_label / n)).otherwise(out)
        return out

    space = 1 << 30
    row = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(space)) / float(space)
    drawn = write_shared(known.filter(chosen(row, counts)), "quality-labels")
    matched = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id")
    have = {r["label"]: r["n"] for r in matched.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in slices(batches):
            x = features(*flat(rb.column(1)))
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    rows = matched.filter(chosen(F.rand(3), have)).select("label", "text").mapInArrow(run, "label int, x array<double>").collect()
    rows = sorted((r["label"], tuple(r["x"])) for r in rows)
    if not rows:
        return None
    return fit(np.array([x for _, x in rows]), np.array([y for y, _ in rows]), (counts[0], counts[1]))


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x) of every row, written once: training and scoring read it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in slices(batches):
            x = features(*flat(rb.column(1)))
            yield pa.RecordBatch.from_arrays([rb.column(0), _rows(x)], [id_col, "x"])

    return write_shared(docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {type_of(docs, id_col)}, x array<double>"), "quality-features")


def _rows(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _unpack(rb: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bad and the good documents' features of each block."""
    for bad, good in zip(rb.column(0), rb.column(1)):
        yield tuple(np.frombuffer(b.as_py(), np.float64).reshape(-1, len(FEATURES)) for b in (bad, good))


def _preferences(bad: np.ndarray, good: np.ndarray, panel: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Differences good - bad: every row meets ``PAIRS_PER_DOC`` of the other
    kind, spread over them; in a block of one kind, of the panel's."""
    out = []
    for own, others, sign in ((bad, good if len(good) else panel[1], 1), (good, bad if len(bad) else panel[0], -1)):
        at = np.arange(len(own))
        for k in range(PAIRS_PER_DOC):
            out.append(sign * (others[(at + k * len(others) // PAIRS_PER_DOC) % len(others)] - own))
    return np.concatenate(out)


def train_table(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """Fit on every labelled row of ``table`` (id, x). The driver holds sums
    of the size of the features, and a panel of ``BLOCK`` rows a kind."""
    spark, width = table.sparkSession, len(FEATURES)
    known = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("label")).filter(f"`{id_col}` is not null and label in (0, 1)")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo in range(0, rb.num_rows, BLOCK):
                some = rb.slice(lo, BLOCK)
                x, y = _matrix(some.column(1)), some.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([x[y == k].tobytes()], pa.binary()) for k in (0, 1)], ["bad", "good"])

    mixed = table.join(known, id_col).select("label", "x").repartition(parts)
    blocks = write_shared(mixed.mapInArrow(deal, "bad binary, good binary"), "quality-blocks")
    n = [F.sum(F.length(k) / (8 * width)).cast("bigint") for k in ("bad", "good")]
    counts = [c or 0 for c in blocks.agg(*n).first()]
    if not all(counts):
        return None
    panel = tuple(np.frombuffer(blocks.filter(F.length(k) > 0).orderBy(k).first()[k], np.float64).reshape(-1, width) for k in ("bad", "good"))

    def total(of) -> np.ndarray:
        """The sum of ``of(bad, good)``, an array, over all blocks."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [of(*b) for rb in batches for b in _unpack(rb)]
            if sums:
                yield pa.RecordBatch.from_arrays([_rows(sum(sums)[None])], ["s"])
        return sum(np.array(r["s"]) for r in blocks.mapInArrow(run, "s array<double>").collect())

    centre = total(lambda b, g: b.sum(axis=0) + g.sum(axis=0)) / sum(counts)
    scale = np.maximum(np.sqrt(total(lambda b, g: ((b - centre) ** 2).sum(axis=0) + ((g - centre) ** 2).sum(axis=0)) / sum(counts)), 1e-6)
    pairs, w = sum(counts) * PAIRS_PER_DOC, np.zeros(width)

    def slope(w: np.ndarray):
        def of(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
            d = _preferences(bad, good, panel) / scale
            p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))       # probability of the preference
            return np.concatenate([d.T @ (p - 1), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
        return of

    for _ in range(STEPS):
        s = total(slope(w)) / pairs
        step = np.linalg.solve(s[width:].reshape(width, width) + RIDGE * np.eye(width), s[:width] + RIDGE * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Model(centre, scale, w, _threshold(blocks, Model(centre, scale, w, 0.0), counts))


def _threshold(blocks: DataFrame, model: Model, counts: list[int]) -> float:
    """Between the labelled strengths of ranks ``counts[0]`` and the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for bad, good in _unpack(rb):
                bits = (model.strength(np.concatenate([bad, good])) + 0.0).view(np.int64)      # longs in the doubles' order
                yield pa.RecordBatch.from_arrays([pa.array(np.where(bits < 0, bits ^ np.int64(2 ** 63 - 1), bits))], ["key"])

    keys = write_shared(blocks.mapInArrow(run, "key bigint"), "quality-strengths")

    def ranked(rank: int) -> float:
        """The strength of a rank (from 0), 16 bits a pass."""
        left = keys
        for shift in (48, 32, 16, 0):
            seen = sorted(tuple(r) for r in left.groupBy(F.shiftright("key", shift).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
            for prefix, n in seen:
                if rank < n:
                    break
                rank -= n
            left = keys.filter(F.shiftright("key", shift) == prefix)
        key = np.int64(prefix)
        return float((key if key >= 0 else key ^ np.int64(2 ** 63 - 1)).view(np.float64))

    return (ranked(counts[0] - 1) + ranked(min(counts[0], sum(counts) - 1))) / 2


def score_table(table: DataFrame, model: Model | None, id_col: str = "doc_id") -> DataFrame:
    """(id, score, predicted) of every row of a :func:`feature_table`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            s = np.full(rb.num_rows, 0.5) if model is None else model.score(_matrix(rb.column(1)))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(s), pa.array((s >= CUT).astype(np.int32))], [id_col, "score", "predicted"])

    return table.select(id_col, "x").mapInArrow(run, f"`{id_col}` {type_of(table, id_col)}, score double, predicted int")


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    schema = f"`{id_col}` {type_of(docs, id_col)}, score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in slices(batches):
            x = features(*flat(rb.column(1)))
            s = np.full(rb.num_rows, 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(s), pa.array((s >= CUT).astype(np.int32))], [id_col, "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
