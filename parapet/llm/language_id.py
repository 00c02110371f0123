"""Language identification by a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, rectified and
max-pooled over a fixed-length window; a softmax over the pooled features
gives the language. The network is trained in numpy on windows of a bounded
sample of labelled documents, and applied to every window of every text; a
document's language has the largest mean probability over its windows,
weighted by their bytes.

A convolution over embedded bytes is a sum of table rows, one table per
filter position, so inference gathers rows of tables indexed by byte pairs.

Nulls and empties: a null text and one without a letter are ``und`` with
score 0; rows without a label are never learned from. Without any labelled
row every prediction is ``und``. Repeated rows give repeated results; an
empty table gives no rows. Other columns are ignored. A long text is cut
into windows like any other, a few thousand at a time. Of equally probable
languages the first in alphabetical order is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parapet.llm.shared import type_of
from parapet.llm.units import flat, slices

WINDOW = 256            # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16            # of each width
EMBEDDING = 8
DOCS_PER_LANGUAGE = 300     # expected size of the training sample, documents of a language
WINDOWS_PER_DOC = 4
MAX_LANGUAGES = 500
EPOCHS = 12
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    tables: list[list[np.ndarray]]      # of each width: a (256, filters) table per position
    bias: list[np.ndarray]              # of each width
    out: np.ndarray                     # pooled features x languages
    out_bias: np.ndarray


# --- windows ----------------------------------------------------------------

def windows(data: np.ndarray, offsets: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, bytes, document) of each window: a text is cut into windows of
    ``length`` bytes, the last one shorter."""
    size = np.diff(offsets)
    count = -(-size // length)
    doc = np.repeat(np.arange(len(size)), count)
    no = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[doc] + no * length
    return start, np.minimum(length, offsets[doc + 1] - start), doc


def pad(data: np.ndarray, start: np.ndarray, size: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """(windows, length + widest filter - 1) bytes, zeros after the text."""
    width = length + max(WIDTHS) - 1
    out = np.zeros((len(start), width), np.uint8)
    whole = size == length
    if len(data) >= length and whole.any():
        view = np.lib.stride_tricks.sliding_window_view(data, length)
        out[whole, :length] = view[start[whole]]
    for i in np.flatnonzero(~whole):
        out[i, :size[i]] = data[start[i]:start[i] + size[i]]
    return out


# --- training -----------------------------------------------------------------

def fit(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Minimise the cross-entropy of windows ``x`` (padded bytes) and labels
    ``y`` by Adam; max pooling passes gradients to the winning position only."""
    rng = np.random.default_rng(seed)
    length, classes = x.shape[1] - max(WIDTHS) + 1, len(languages)
    par = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "o": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)),
           "ob": np.zeros(classes)}
    for w in WIDTHS:
        par[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS))
        par[f"b{w}"] = np.zeros(FILTERS)
    par = {k: v.astype(np.float32) for k, v in par.items()}
    m, v = ({k: np.zeros_like(p) for k, p in par.items()} for _ in range(2))
    step, batch = 0, 64
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            xb, yb = x[at], y[at]
            pooled, winners = [], []
            for w in WIDTHS:
                tables = [par["e"] @ par[f"w{w}"][k] for k in range(w)]
                conv = sum(t[xb[:, k:k + length]] for k, t in enumerate(tables)) + par[f"b{w}"]
                win = conv.argmax(axis=1)
                winners.append(win)
                pooled.append(np.maximum(np.take_along_axis(conv, win[:, None], 1)[:, 0], 0))
            h = np.concatenate(pooled, axis=1)
            z = h @ par["o"] + par["ob"]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(yb)), yb] -= 1
            p /= len(yb)
            grad = {k: np.zeros_like(q) for k, q in par.items()}
            grad["o"], grad["ob"] = h.T @ p, p.sum(axis=0)
            back = (p @ par["o"].T) * (h > 0)
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS:(i + 1) * FILTERS]
                grad[f"b{w}"] = g.sum(axis=0)
                for k in range(w):
                    hit = np.take_along_axis(xb, winners[i] + k, 1)         # the byte under each filter's winner
                    table = np.zeros((256, FILTERS), np.float32)
                    np.add.at(table, (hit, np.arange(FILTERS)[None, :]), g)
                    grad[f"w{w}"][k] = par["e"].T @ table
                    grad["e"] += table @ par[f"w{w}"][k].T
            step += 1
            for k, q in par.items():
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                q -= (0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Model(languages, [[par["e"] @ par[f"w{w}"][k] for k in range(w)] for w in WIDTHS],
                 [par[f"b{w}"] for w in WIDTHS], par["o"], par["ob"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Fit on a sample of the labelled rows of ``docs``: of each language about
    ``docs_per_language`` documents drawn row by row (copies too), and up to
    ``WINDOWS_PER_DOC`` windows spread over the whole of each text. The driver
    holds the windows of the sample and nothing else. More than
    ``MAX_LANGUAGES`` labels are refused with an error."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy(F.col(lang_col).alias("lang"))
              .agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return Model([], [], [], np.zeros((0, 0)), np.zeros(0))
    space = 1 << 30
    drawn = F.pmod(F.xxhash64(id_col, F.monotonically_increasing_id()), F.lit(space))
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = F.when(F.col(lang_col) == lang, drawn < int(min(1.0, docs_per_language / n) * space)).otherwise(chosen)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in slices(batches):
            data, offsets = flat(rb.column(1))
            start, size, doc = windows(data, offsets)
            number = np.arange(len(doc)) - np.searchsorted(doc, doc)
            total = np.bincount(doc, minlength=rb.num_rows)[doc]
            step = np.maximum(1, total // WINDOWS_PER_DOC)
            take = np.flatnonzero((number % step == 0) & (number // step < WINDOWS_PER_DOC))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0).take(pa.array(doc[take])),
                 pa.array([data[a:a + n].tobytes() for a, n in zip(start[take], size[take])], pa.binary())],
                ["lang", "bytes"])

    rows = sorted((r["lang"], bytes(r["bytes"])) for r in labelled.filter(chosen)
                  .select(F.col(lang_col).cast("string"), text_col).mapInArrow(cut, "lang string, bytes binary").collect())
    languages = sorted({lang for lang, _ in rows})
    if not rows:
        return Model([], [], [], np.zeros((0, 0)), np.zeros(0))
    data = np.frombuffer(b"".join(b for _, b in rows), np.uint8)
    size = np.array([len(b) for _, b in rows])
    x = pad(data, np.cumsum(size) - size, size)
    return fit(x, np.array([languages.index(lang) for lang, _ in rows]), languages)


# --- inference ------------------------------------------------------------------

class Scorer:
    """Class probabilities of padded windows, by tables over byte pairs."""

    def __init__(self, model: Model):
        self.model = model
        pair = np.arange(1 << 16)
        self.steps = []         # of each width: (pair table, position) and perhaps (byte table, position)
        for tables in model.tables:
            parts = [(tables[k][pair & 255] + tables[k + 1][pair >> 8], k, True) for k in range(0, len(tables) - 1, 2)]
            if len(tables) % 2:
                parts.append((tables[-1], len(tables) - 1, False))
            self.steps.append([(np.ascontiguousarray(t, np.float32), k, two) for t, k, two in parts])

    def __call__(self, x: np.ndarray, group: int = 16) -> np.ndarray:
        length = x.shape[1] - max(WIDTHS) + 1
        h = np.empty((len(x), FILTERS * len(WIDTHS)), np.float32)
        for lo in range(0, len(x), group):
            t = np.ascontiguousarray(x[lo:lo + group].T)            # position by window
            pairs = t[:-1].astype(np.uint16) | (t[1:].astype(np.uint16) << 8)
            for i, parts in enumerate(self.steps):
                conv = None
                for table, k, two in parts:
                    got = table.take((pairs if two else t)[k:k + length], axis=0)
                    conv = got if conv is None else np.add(conv, got, out=conv)
                h[lo:lo + group, i * FILTERS:(i + 1) * FILTERS] = conv.max(axis=0) + self.model.bias[i]
        z = np.maximum(h, 0) @ self.model.out + self.model.out_bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _classify(model: Model, score: Scorer | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of each text of a column."""
    import pyarrow.compute as pc
    lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    data, offsets = flat(column)
    total = np.zeros((len(column), max(1, len(model.languages))))
    if score is not None:
        start, size, doc = windows(data, offsets)
        for lo in range(0, len(start), 4096):       # the windows' bytes stay small
            at = slice(lo, lo + 4096)
            np.add.at(total, doc[at], score(pad(data, start[at], size[at])) * size[at, None])
    known = lettered.astype(bool) & (score is not None)
    best = total.argmax(axis=1)
    share = total[np.arange(len(best)), best] / np.maximum(np.diff(offsets), 1)
    names = np.array([*model.languages, UNKNOWN], object)[np.where(known, best, len(model.languages))]
    return names, np.where(known, np.clip(share, 0, 1), 0.0)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model) if model.languages else None
        for rb in slices(batches):
            names, share = _classify(model, score, rb.column(1))
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(names.tolist(), pa.string()), pa.array(share)],
                                             [id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {type_of(docs, id_col)}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at
    least ``min_score``. A model without languages keeps every row."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model) if model.languages else None
        for rb in slices(batches, at):
            if score is not None:
                names, share = _classify(model, score, rb.column(at))
                rb = rb.filter(pa.array((names != UNKNOWN) & (share >= min_score)))
            yield rb

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string")) % n
