"""Toxicity by gradient-boosted trees over dense features.

1. Of the labelled documents a bounded sample is drawn row by row and parted
   in random halves. A lexicon of stems (word beginnings) that are surely
   more frequent in toxic documents stands beside a stated list of insults.
   Documents learned from are described by the stems of the other half, all
   other documents by the stems of both.
2. A text becomes a few dense numbers: densities of both lexicons,
   second-person words and how many hits stand near one, capitals,
   punctuation and its runs, obfuscated spellings (inner digits and signs,
   drawn-out letters) and whether they read as an insult when undone.
3. Trees of small depth are boosted on these numbers with the logistic loss
   (Newton steps over binned features).
4. Isotonic regression of out-of-fold margins, weighted to the labelled
   population, turns a margin into a probability.

Features come from the whole text and nothing else. Texts are cut into
words in windows of 4 MB from the text's start, between words, so a long
one costs a window of memory; nearness does not reach over a window's edge.

Nulls and empties: a null text counts as empty; empty texts have zero
features and are scored like any other. Labels other than 0 and 1, null ids
and ids whose labels disagree are not learned from. Without labels of both
kinds every score is 0.5. Equal margins get equal scores. Repeated rows give
repeated results and are drawn one by one; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parapet.llm.shared import type_of, write_shared
from parapet.llm.units import flat, slices

SAMPLE_PER_LABEL = 5000     # expected sampled documents of each label
CUT = 0.7                   # predicted is 1 from this score on
WINDOW = 4 << 20            # bytes of text cut into words at a time
NEAR = 5                    # words between a hit and a second-person word
STEMS = (3, 4, 5, 6)        # lengths of word beginnings
MAX_STEMS = 4000
SURE = 1.0                  # least log-odds of a stem, two standard errors below its estimate
TALLY_ENTRIES = 300_000     # stems a task holds before it passes its counts on
CACHE = 200_000             # distinct words a worker remembers
TREES, DEPTH, BINS, RATE, RIDGE, FOLDS = 60, 3, 32, 0.2, 1.0, 3

#: Insults (fixed values).
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb fool imbecile loser losers trash garbage scum worthless pathetic disgusting
clown jerk creep freak ugly filthy vermin coward liar bastard bitch asshole crap damn shit fuck fucking hate
idioten dumm dummkopf trottel depp blödmann arschloch scheisse scheiße abschaum wertlos erbärmlich ekelhaft
idiote imbécile stupide crétin connard salaud merde ordure débile minable pathétique dégoûtant
idiota idiotas estúpido estúpida imbécil tonto basura escoria mierda patético asqueroso cabrón
""".split())
#: Words that address the reader (fixed values).
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch tu toi te ton ta vous votre tú ti usted ustedes".split())
_UNDO = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W\d_][\d@$!|*._+\-]+[^\W\d_]")
_DRAWN = re.compile(r"([^\W\d_])\1\1")
_RUN = re.compile(r"[!?*#%&$@]{2}")
_TAIL, _FILL = re.compile(r"""[!?.,;:'")\]]+$"""), re.compile(r"[*._+\-]")
_CLASSES = np.zeros((256, 6))       # of bytes: upper, lower, digits, exclamation, question, other signs
for _i, _set in enumerate((range(65, 91), range(97, 123), range(48, 58), b"!", b"?", b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~")):
    _CLASSES[list(_set), _i] = 1

# sums over the words of a text
WORD_SUMS = ("insult", "stem", "stem_hit", "second_person", "all_caps", "run", "inner", "undone", "drawn")
FEATURES = ("log_words", "insult_density", "log_insults", "stem_density", "log_stem_hits", "strongest_stem",
            "second_person_density", "near_share", "log_near", "upper_share", "all_caps_share", "exclamations", "questions",
            "other_signs", "runs", "inner_signs", "undone_insults", "drawn_out")


# --- words and features ---------------------------------------------------------

def core(word: str) -> str:
    return _EDGE.sub("", word.lower())


def beginnings(word: str) -> list[str]:
    """The stems of a word: its first letters, of each length it has."""
    return [word[:n] for n in STEMS if len(word) >= n]


class Words:
    """What each distinct word adds to ``WORD_SUMS``."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.seen: dict[bytes, tuple] = {}

    def look(self, word: bytes) -> tuple:
        text = word.decode("utf-8", "replace")
        plain = text.strip(".,;:()[]\"'").rstrip("!?")
        letters = plain.isalpha()               # most words: nothing inside to undo
        plain = plain.lower() if letters else core(text)
        weight = 0.0
        for n in STEMS:
            if len(plain) < n:
                break
            weight = max(weight, self.stems.get(plain[:n], 0.0))
        insult, drawn = plain in INSULTS, _DRAWN.search(plain) is not None
        if letters:
            undone = _DRAWN.sub(r"\1", plain) if drawn else ""
        else:
            undone = core(_DRAWN.sub(r"\1", _FILL.sub("", _TAIL.sub("", text.lower()).translate(_UNDO))))
        return (insult, weight, weight > 0, plain in SECOND_PERSON, len(plain) > 2 and text.isupper(),
                (not letters or len(text) - len(plain) > 1) and _RUN.search(text) is not None, not letters and _INNER.search(text) is not None,
                not insult and undone in INSULTS, drawn)

    def rows(self, words: list[bytes]) -> np.ndarray:
        out = []
        for w in words:
            got = self.seen.get(w)
            if got is None:
                got = self.look(w)
                if len(w) <= 64:
                    if len(self.seen) >= CACHE:
                        self.seen = {}
                    self.seen[w] = got
            out.append(got)
        return np.array(out, np.float64).reshape(len(out), len(WORD_SUMS))


def word_windows(text: bytes, size: int = WINDOW) -> Iterator[list[bytes]]:
    """The words of a text, window by window, cut between words."""
    lo = 0
    while lo < len(text):
        hi = lo + size
        if hi < len(text):
            found = re.compile(rb"[ \t-\r]").search(text, hi)
            hi = found.start() if found else len(text)
        yield text[lo:hi].split()
        lo = hi


def features(words: Words, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    sums = np.zeros((n, len(WORD_SUMS)))
    count, near, strongest = np.zeros(n), np.zeros(n), np.zeros(n)
    held: list[tuple[int, list[bytes]]] = []

    def add():
        """Sums of the held windows, all at once."""
        every = [w for _, ws in held for w in ws]
        if not every:
            return
        coded = pa.array(every, pa.binary()).dictionary_encode()
        rows = words.rows(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy(zero_copy_only=False)
        size = [len(ws) for _, ws in held]
        doc = np.repeat([i for i, _ in held], size)
        place = np.arange(len(doc)) + np.repeat(np.arange(len(held)) * (NEAR + 1), size)    # windows do not touch
        np.add.at(count, [i for i, _ in held], size)
        some = np.flatnonzero(rows.any(axis=1)[code])
        at, who = code[some], doc[some]
        for k in range(len(WORD_SUMS)):
            sums[:, k] += np.bincount(who, rows[at, k], n)
        np.maximum.at(strongest, who, rows[at, 1])
        hit = some[(rows[at, 0] > 0) | (rows[at, 2] > 0) | (rows[at, 7] > 0)]
        you = place[some[rows[at, 3] > 0]]
        if len(hit) and len(you):
            spot = place[hit]
            after = np.searchsorted(you, spot)
            gap = np.minimum(np.abs(you[np.minimum(after, len(you) - 1)] - spot), np.abs(you[np.maximum(after - 1, 0)] - spot))
            near[:] += np.bincount(doc[hit], gap <= NEAR, n)

    held_bytes = 0
    letters = np.zeros((n, 6))
    for i in range(n):
        text = data[offsets[i]:offsets[i + 1]]
        for lo in range(0, len(text), WINDOW):
            letters[i] += np.bincount(text[lo:lo + WINDOW], minlength=256) @ _CLASSES
        for ws in word_windows(text.tobytes()):
            held.append((i, ws))
            held_bytes += min(len(text), WINDOW)
            if held_bytes >= WINDOW:
                add()
                held, held_bytes = [], 0
    add()
    k = np.maximum(count, 1)
    s = dict(zip(WORD_SUMS, sums.T))
    upper, lower, _, exclaim, question, other = letters.T
    hits = s["insult"] + s["stem_hit"] + s["undone"]
    for j, col in enumerate((
            np.log1p(count), s["insult"] / k, np.log1p(s["insult"]), s["stem"] / k, np.log1p(s["stem_hit"]), strongest,
            s["second_person"] / k, near / np.maximum(hits, 1), np.log1p(near), upper / np.maximum(upper + lower, 1),
            s["all_caps"] / k, exclaim / k, question / k, other / k, s["run"] / k, s["inner"] / k,
            np.log1p(s["undone"]), s["drawn"] / k)):
        out[:, j] = col
    return out


# --- trees and calibration ------------------------------------------------------

@dataclass
class Trees:
    """Boosted trees over binned features: a node goes right if the bin of its
    feature is above its cut; ``value`` of the leaves, level by level."""
    edges: list[np.ndarray]
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1).astype(np.int16)

    def margins(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (b[np.arange(len(x)), feature[node]] > cut[node])
            out += value[node - (2 ** DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES) -> Trees:
    """Newton boosting of the weighted logistic loss."""
    weight = weight * len(y) / weight.sum()
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    # a feature most rows lack: its few values get edges of their own
    edges = [np.unique(np.r_[e, np.quantile(x[x[:, j] > e[-1], j], np.linspace(0, 1, 9)[:-1])]) if len(e) and (x[:, j] > e[-1]).any() else e
             for j, e in enumerate(edges)]
    share = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    model = Trees(edges, float(np.log(share / (1 - share))))
    b = model.bins(x)
    width = int(b.max(initial=0)) + 1
    margin = np.full(len(y), model.start)
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, cut, value = np.zeros(inner, np.int64), np.full(inner, width), np.zeros(leaves)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first = 2 ** level - 1
            for at in range(first, 2 * first + 1):
                rows = np.flatnonzero(node == at)
                if len(rows) < 2:
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                top = 1e-6
                for j in range(x.shape[1]):
                    gl = np.cumsum(np.bincount(b[rows, j], g[rows], width))[:-1]
                    hl = np.cumsum(np.bincount(b[rows, j], h[rows], width))[:-1]
                    gain = gl ** 2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs ** 2 / (hs + RIDGE)
                    if len(gain) and gain.max() > top:
                        top, feature[at], cut[at] = gain.max(), j, int(gain.argmax())
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        margin = margin + value[leaf]
        model.trees.append((feature, cut, value))
    return model


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(margins, probabilities) of the best non-decreasing fit: neighbours out
    of order are pooled; between the pools' edges the fit is linear."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []               # mean, weight, first and last margin
    for xi, yi, wi in zip(x[order], y[order], weight[order]):
        if pools and xi == pools[-1][3]:        # equal margins are one point
            last = pools.pop()
            pools.append([(last[0] * last[1] + yi * wi) / (last[1] + wi), last[1] + wi, last[2], xi])
        else:
            pools.append([float(yi), float(wi), xi, xi])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    return np.array([v for p in pools for v in (p[2], p[3])]), np.array([p[0] for p in pools for _ in range(2)])


@dataclass
class Model:
    stems: dict[str, float]
    trees: Trees
    margins: np.ndarray
    probabilities: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.trees.margins(x), self.margins, self.probabilities), 0, 1)


def fit(x: np.ndarray, y: np.ndarray, population: tuple[float, float], stems: dict[str, float], seed: int = 13) -> Model:
    """``population``: labelled documents of kind 0 and 1 that the rows stand for."""
    weight = np.where(y == 1, population[1] / max((y == 1).sum(), 1), population[0] / max((y == 0).sum(), 1))
    fold = np.empty(len(y), np.int64)
    rng = np.random.default_rng(seed)
    for label in (0, 1):                        # as many of each label in each fold
        at = np.flatnonzero(y == label)
        fold[at] = rng.permutation(np.arange(len(at)) % FOLDS)
    apart = np.zeros(len(y))
    for k in range(FOLDS):
        mine = fold == k
        if mine.any() and len(set(y[~mine])) == 2:
            apart[mine] = boost(x[~mine], y[~mine], weight[~mine]).margins(x[mine])
    return Model(stems, boost(x, y, weight), *isotonic(apart, y, weight))


# --- training on Spark ----------------------------------------------------------

def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
           per_label: int) -> tuple[DataFrame, dict[int, int]] | None:
    """((label, half, text) of about ``per_label`` rows of each label, written
    once; how many labelled ids of each label there are)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter("id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("top")) \
        .filter("label = top").drop("top")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None

    def drawn(value, have: dict[int, int]):
        out = F.lit(False)
        for label, n in sorted(have.items()):
            out = F.when(F.col("label") == label, value < min(1.0, per_label / n)).otherwise(out)
        return out

    # ids are unique here, so a hash draws them one by one; they are as many as the sample, whatever the tables' size
    space = 1 << 30
    ids = known.filter(drawn(F.pmod(F.xxhash64("id"), F.lit(space)) / float(space), counts))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    have = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(have) < 2:
        return None
    # rows that share an id are thinned one by one
    rows = rows.filter(drawn(F.rand(5), have)).select("label", (F.rand(7) < 0.5).alias("half"), "text")
    return write_shared(rows, "toxicity-sample"), counts


HALVES = ("clean0", "toxic0", "clean1", "toxic1")


def stem_tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(2 half + label, text) -> (stem, HALVES): documents that hold the stem."""
    tally = [Counter() for _ in HALVES]

    def rows() -> pa.RecordBatch:
        stems = list(set().union(*tally))
        return pa.RecordBatch.from_arrays([pa.array(stems, pa.string()),
                                           *(pa.array([c[x] for x in stems], pa.int64()) for c in tally)], ["stem", *HALVES])

    for rb in slices(batches):
        data, offsets = flat(rb.column(1))
        for i, kind in enumerate(rb.column(0).to_pylist()):
            words: set[bytes] = set()
            for ws in word_windows(data[offsets[i]:offsets[i + 1]].tobytes()):
                words.update(ws)
            tally[kind].update({x for w in words for x in beginnings(core(w.decode("utf-8", "replace")))})
            if sum(map(len, tally)) > TALLY_ENTRIES:
                yield rows()
                for c in tally:
                    c.clear()
    yield rows()


def sure_stems(counts: DataFrame, clean: str, toxic: str, n_clean: int, n_toxic: int, max_stems: int = MAX_STEMS) -> dict[str, float]:
    """Stem -> log-odds of toxic documents, for stems whose odds are surely
    high; the surest ``max_stems``."""
    a, b = F.expr(toxic), F.expr(clean)
    odds = F.log((a + 0.5) / (n_toxic + 1)) - F.log((b + 0.5) / (n_clean + 1))
    error = F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    sure = counts.filter(a > 1).select("stem", odds.alias("odds"), (odds - 2 * error).alias("sure")).filter(F.col("sure") > SURE)
    return {r["stem"]: r["odds"] for r in sure.orderBy(F.col("sure").desc(), "stem").limit(max_stems).collect()}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """Fit on a sample of about ``per_label`` labelled documents of each kind.
    The driver holds their features and the stems, never a text."""
    drawn = sample(docs, labels, id_col, text_col, label_col, per_label)
    if drawn is None:
        return None
    rows, population = drawn
    kind = (F.when(F.col("half"), 2).otherwise(0) + F.col("label")).cast("int").alias("kind")
    n = {r["kind"]: r["n"] for r in rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = write_shared(rows.select(kind, "text").mapInArrow(stem_tally, "stem string, " + ", ".join(f"{c} long" for c in HALVES))
                          .groupBy("stem").agg(*[F.sum(c).alias(c) for c in HALVES]).filter("toxic0 + toxic1 > 1"), "toxicity-stems")
    of = [n.get(k, 0) for k in range(len(HALVES))]
    apart = [sure_stems(counts, f"clean{h}", f"toxic{h}", of[2 * h], of[2 * h + 1]) for h in (0, 1)]
    stems = sure_stems(counts, "clean0 + clean1", "toxic0 + toxic1", of[0] + of[2], of[1] + of[3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Words(apart[1]), Words(apart[0])]      # of each half: the other half's stems
        for rb in slices(batches):
            half = rb.column(0).to_numpy() // 2
            for h in (0, 1):
                part = rb.filter(pa.array(half == h))
                x = features(words[h], *flat(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], ["kind", "x"])

    got = rows.select(kind, "text").mapInArrow(run, "kind int, x array<double>").collect()
    got = sorted((r["kind"] % 2, tuple(r["x"])) for r in got)
    if len({y for y, _ in got}) < 2:
        return None
    return fit(np.array([x for _, x in got]), np.array([y for y, _ in got]), (population[0], population[1]), stems)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    schema = f"`{id_col}` {type_of(docs, id_col)}, score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model.stems) if model else None
        for rb in slices(batches):
            s = model.score(features(words, *flat(rb.column(1)))) if model else np.full(rb.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(s, pa.float64()), pa.array((s >= CUT).astype(np.int32))],
                                             [id_col, "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
