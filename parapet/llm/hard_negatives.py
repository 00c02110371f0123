"""Hard negatives of anchors, by length buckets and coordinate pruning.

Vectors become integers and every score is an exact inner product. The rows
are written in parts of bounded size, ordered by label and length; a cell is
one part and one group of anchors, and each cell works by itself:

1. Its rows are cut into length buckets, longest first. A bucket keeps, for
   every coordinate, the values of its normalised vectors in sorted order.
2. A score of at least t needs a cosine of at least t / (|anchor| longest),
   so the vector lies within an angle b of the anchor, and at a coordinate
   where the anchor stands at angle a to the axis its value lies between
   cos(a + b) and cos(a - b). A bucket no angle of which is feasible is
   skipped. The ranges of the anchor's largest coordinates (focus
   coordinates) are looked up in the sorted lists and intersected.
3. The candidates are verified exactly. t is the anchor's k-th best score so
   far and rises from bucket to bucket. Where no range is narrow the whole
   bucket is verified at once: the lists could discard little.

A first pass finds each anchor's positives (best rows of its label), a
second its negatives (best rows of other labels whose score is within the
given per cent of the positive's). Each cell returns at most k rows for
each question, and the best k of all cells are the answer.

Nulls and empties: rows with a null id, label or vector or a null, NaN or
infinite component take no part; a vector shorter than the longest counts as
padded with zeros; an anchor without positives, or a positive without
negatives, has no rows. Rows with an anchor's own id are neither its
positives nor its negatives; other repeated rows each take a place, and
equal anchor rows are answered once. Equal scores go by the smaller id. An
empty table gives no rows. Other columns are ignored. Scores must fit in a
long, as the result's columns do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parapet.llm.shared import type_of, write_shared

SCALE = 256             # a component x becomes floor(SCALE * x)
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90      # per cent of the positive's score
PART_ROWS = 16_384      # rows of a part, on average
GROUP_ANCHORS = 2_048   # anchors of a group, on average
BUCKET = 1_024          # rows of a length bucket
SIDE = 256              # anchors compared with a bucket at a time
FOCUS = 4               # coordinates whose lists are intersected
NARROW = 0.5            # share of a list below which it is used
_EXACT = 2.0 ** 53      # integers up to here are exact as doubles
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


# --- one cell -----------------------------------------------------------------

class Bucket:
    """Rows of similar length: exact vectors and sorted coordinate lists."""

    def __init__(self, rows: np.ndarray, vecs: np.ndarray, norms: np.ndarray):
        self.rows, self.vecs = rows, vecs
        self.longest, self.shortest = float(norms.max()), float(norms.min())
        unit = vecs.astype(np.float64) / np.where(norms > 0, norms, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(unit, self.order, 0).T)   # a list a coordinate
        self.order = np.ascontiguousarray(self.order.T)

    def angle(self, floor: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """The largest feasible angle to each anchor for a score of at least
        ``floor``; NaN where none is."""
        floor = floor.astype(np.float64)
        length = np.where(floor > 0, self.longest, self.shortest) * norms
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(length > 0, floor / length, np.where(floor > 0, np.inf, -1.0))
        need = need - 1e-9
        return np.where(need > 1, np.nan, np.arccos(np.clip(need, -1, 1)))

    def ranges(self, units: np.ndarray, focus: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) in the sorted list of each anchor's focus coordinates."""
        alpha = np.arccos(np.clip(np.take_along_axis(units, focus, 1), -1, 1))
        high = np.cos(np.maximum(alpha - angle[:, None], 0)) + 1e-9
        low = np.cos(np.minimum(alpha + angle[:, None], np.pi)) - 1e-9
        begin, end = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            begin[at] = np.searchsorted(self.sorted[f], low[at], "left")
            end[at] = np.searchsorted(self.sorted[f], high[at], "right")
        return begin, end

    def candidates(self, focus: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The rows that lie in the ranges of all focus coordinates."""
        hits = np.zeros(len(self.rows), np.int8)
        for f, a, b in zip(focus, begin, end):
            hits[self.order[f, a:b]] += 1
        return np.flatnonzero(hits == len(focus))


def buckets(vecs: np.ndarray, ids: np.ndarray, size: int = BUCKET) -> list[Bucket]:
    """Length buckets, longest first; inside a bucket rows go by id."""
    exact = vecs.astype(np.float64)
    norms = np.sqrt((exact * exact).sum(axis=1))
    order = np.lexsort((ids, -norms))
    out = []
    for lo in range(0, len(order), size):
        rows = order[lo:lo + size]
        rows = rows[np.argsort(ids[rows], kind="stable")]
        out.append(Bucket(rows, vecs[rows], norms[rows]))
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors. Doubles hold them where they
    stay below 2^53; beyond, Python's integers do."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def best(anchor: np.ndarray, window: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` rows of each (anchor, window), by score and then id."""
    order = np.lexsort((ids, -score, window, anchor))
    a, w = anchor[order], window[order]
    new = np.append(True, (a[1:] != a[:-1]) | (w[1:] != w[:-1])) if len(a) else np.zeros(0, bool)
    place = np.arange(len(a)) - np.maximum.accumulate(np.where(new, np.arange(len(a)), 0)) if len(a) else np.zeros(0, int)
    return order[place < k]


class Tally:
    """What a search looked at (for tests and reports)."""

    def __init__(self):
        self.skipped = self.listed = self.candidates = self.whole = 0


def search(anchors: np.ndarray, anchor_ids: np.ndarray, low: np.ndarray, high: np.ndarray, vecs: np.ndarray, ids: np.ndarray,
           allowed, k: int, size: int = BUCKET, tally: Tally | None = None) -> tuple[np.ndarray, ...]:
    """(anchor, window, row, score): for each anchor and each of its windows
    ``low`` <= score <= ``high`` (anchors x windows) the first
    ``k`` rows, of those ``allowed(anchors, rows)`` marks."""
    if not len(anchors) or not len(vecs):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    parts = buckets(vecs, ids, size)
    exact = anchors.astype(np.float64)
    norms = np.sqrt((exact * exact).sum(axis=1))
    units = exact / np.where(norms > 0, norms, 1)[:, None]
    focus = np.argsort(-np.abs(units), axis=1, kind="stable")[:, :FOCUS]
    out = []
    for lo in range(0, len(anchors), SIDE):
        side = np.arange(lo, min(lo + SIDE, len(anchors)))
        floor = low[side].copy()                    # rises as windows fill up
        held = [np.zeros(0, np.int64) for _ in range(4)]
        for part in parts:
            need = floor.min(axis=1)
            angle = part.angle(need, norms[side])
            live = np.flatnonzero(~np.isnan(angle) & (high[side] >= floor).any(axis=1))
            if tally:
                tally.skipped += len(side) - len(live)
            if not len(live):
                continue
            at = side[live]
            begin, end = part.ranges(units[at], focus[at], angle[live])
            narrow = (end - begin).min(axis=1) < NARROW * len(part.rows)
            found = []
            wide = live[~narrow]
            if len(wide):
                s = products(anchors[side[wide]], part.vecs)
                x, y = np.nonzero((s >= need[wide][:, None]) & (s <= high[side[wide]].max(axis=1)[:, None]))
                found.append((wide[x], y, s[x, y]))
                if tally:
                    tally.whole += s.size
            for i in np.flatnonzero(narrow):
                rows = part.candidates(focus[at[i]], begin[i], end[i])
                if len(rows):
                    found.append((np.full(len(rows), live[i]), rows, products(anchors[at[i]][None, :], part.vecs[rows])[0]))
                if tally:
                    tally.listed += 1
                    tally.candidates += len(rows)
            if not found:
                continue
            x, y, s = (np.concatenate(c) for c in zip(*found))
            rows = part.rows[y]
            ok = allowed(side[x], rows) & (anchor_ids[side[x]] != ids[rows])
            x, rows, s = x[ok], rows[ok], s[ok]
            for w in range(low.shape[1]):
                hit = np.flatnonzero((s >= floor[x, w]) & (s <= high[side[x], w]))
                if not len(hit):
                    continue
                mine = held[1] == w
                a = np.r_[held[0][mine], x[hit]]
                r, sc = np.r_[held[2][mine], rows[hit]], np.r_[held[3][mine], s[hit]]
                top = best(a, np.zeros(len(a), np.int64), sc, ids[r], k)
                a, r, sc = a[top], r[top], sc[top]
                held = [np.r_[h[~mine], n] for h, n in zip(held, (a, np.full(len(a), w), r, sc))]
                full = np.flatnonzero(np.bincount(a, minlength=len(side)) == k)
                if len(full):
                    last = np.searchsorted(a, full, "right") - 1        # ``best`` leaves them by anchor, best first
                    floor[full, w] = np.maximum(floor[full, w], sc[last])
        out.append((side[held[0]], *held[1:]))
    return tuple(np.concatenate(c) for c in zip(*out))


# --- the whole table ------------------------------------------------------------

def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)))


def prepared(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column, scale: int = SCALE) -> DataFrame:
    """(id, anchor, label, vec) of the rows that take part."""
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return rows.select(F.col(id_col).alias("id"), F.coalesce(anchor, F.lit(False)).alias("anchor"), label.alias("label"),
                       F.col(vector_col).alias("raw")) \
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & F.coalesce(finite, F.lit(False))) \
        .select("id", "anchor", "label", quantised(F.col("raw"), scale).alias("vec"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    size, values = np.diff(offsets), column.values.to_numpy()
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(offsets[0], offsets[-1]) - offsets[row]] = values[offsets[0]:offsets[-1]]
    return out


def _codes(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Equal values have equal numbers, across the columns."""
    both = pa.chunked_array([c for col in columns for c in col.chunks], columns[0].type).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy(zero_copy_only=False)
    return np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


def positives_of(width: int, k: int, kind: pa.Schema):
    """Of one cell: the best ``k`` rows of each anchor's label."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, anchor_ids = left["id"].to_numpy(), right["id"].to_numpy()
        mine, of = _codes(left["label"], right["label"])
        vecs, anchors = _matrix(left["vec"], width), _matrix(right["vec"], width)
        a_all, r_all, s_all = [], [], []
        for label in np.unique(of):
            rows, who = np.flatnonzero(mine == label), np.flatnonzero(of == label)
            low, high = np.full((len(who), 1), LEAST), np.full((len(who), 1), MOST)
            a, _, r, s = search(anchors[who], anchor_ids[who], low, high, vecs[rows], ids[rows],
                                lambda x, y: np.ones(len(x), bool), k)
            a_all.append(who[a])
            r_all.append(rows[r])
            s_all.append(s)
        a, r, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_all, r_all, s_all))
        return pa.table([right["anchor"].take(pa.array(a)), left["id"].take(pa.array(r)), pa.array(s, pa.int64())], schema=kind)
    return run


def negatives_of(width: int, k: int, windows: int, kind: pa.Schema):
    """Of one cell: the best ``k`` rows of other labels in each window."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, anchor_ids = left["id"].to_numpy(), right["id"].to_numpy()
        mine, of = _codes(left["label"], right["label"])
        low, high = (np.array(right[c].to_pylist(), np.int64).reshape(right.num_rows, windows) for c in ("low", "high"))
        a, w, r, s = search(_matrix(right["vec"], width), anchor_ids, low, high, _matrix(left["vec"], width), ids,
                            lambda x, y: of[x] != mine[y], k)
        return pa.table([right["anchor"].take(pa.array(a)), pa.array(w, pa.int32()), left["id"].take(pa.array(r)),
                         pa.array(s, pa.int64())], schema=kind)
    return run


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         part_rows: int = PART_ROWS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). ``anchor``: a condition on the rows; a row is a negative
    of a positive if low * positive_score <= 100 * negative_score <= high *
    positive_score."""
    label = F.col("label") if label is None else label
    spark, id_type = rows.sparkSession, type_of(rows, id_col)
    data = prepared(rows, id_col, vector_col, label, anchor, scale)
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    data = write_shared(data.withColumn("length", length), "vectors")
    facts = data.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width"),
                     F.coalesce(F.max(F.array_max(F.transform("vec", F.abs))), F.lit(0)).alias("top")).first()
    width, n_parts = facts["width"], max(1, -(-facts["n"] // part_rows))
    if facts["top"] < 1 << 31:
        data = data.withColumn("vec", F.col("vec").cast("array<int>"))
    # contiguous ranges of label and length; equal rows are told apart by their place, so no range is one row's copies
    place = F.monotonically_increasing_id()
    parts = write_shared(data.withColumn("__place", place).repartitionByRange(n_parts, "label", F.col("length").desc(), "id", "__place")
                         .select("id", "anchor", "label", "vec", F.spark_partition_id().alias("part")), "parts")
    whole = F.struct("id", "label", "vec")
    asked = write_shared(parts.filter("anchor").select("id", "label", "vec", F.xxhash64(whole).alias("h")).distinct()
                         .select(F.struct("id", "label", "h").alias("anchor"), "id", "label", "vec"), "anchors")
    n_groups = max(1, -(-asked.count() // group_anchors))
    asked = asked.withColumn("grp", F.pmod(F.xxhash64("id", "anchor.h"), F.lit(n_groups)).cast("int"))
    has = write_shared(parts.select("part", "label").distinct(), "part-labels")
    last_part = has.agg(F.max("part")).first()[0] or 0
    numbers = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("grp")
    dealt = parts.select("part", "id", "label", "vec", numbers)

    def cells(anchors: DataFrame, run, schema: str) -> DataFrame:
        return dealt.groupBy("part", "grp").cogroup(anchors.groupBy("part", "grp")).applyInArrow(run, schema)

    def arrow(schema: str) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema
        return to_arrow_schema(spark.createDataFrame([], schema).schema)

    key_type = type_of(asked, "anchor")
    schema = f"anchor {key_type}, positive_id {id_type}, positive_score long"
    near = cells(asked.join(has, "label"), positives_of(width, positives, arrow(schema)), schema)
    order = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = write_shared(near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives), "positives")

    # low p <= 100 n <= high p, as whole numbers
    per = F.col("positive_score").cast("decimal(20,0)")
    bounds = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "place", F.ceil(per * low / 100).cast("bigint").alias("low"), F.floor(per * high / 100).cast("bigint").alias("high")))).alias("of"))

    def padded(name: str, value: int) -> Column:
        return F.slice(F.concat(F.transform("of", lambda x: x[name]), F.array_repeat(F.lit(value).cast("bigint"), positives)), 1, positives)

    # an empty window stands for a positive that is not there
    windows = asked.join(bounds, "anchor").select("grp", "anchor", "id", "label", "vec", padded("low", int(MOST)).alias("low"),
                                                  padded("high", int(LEAST)).alias("high"))
    everywhere = windows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last_part))))
    schema = f"anchor {key_type}, window int, negative_id {id_type}, negative_score long"
    hard = cells(everywhere, negatives_of(width, negatives, positives, arrow(schema)), schema)
    order = Window.partitionBy("anchor", "window").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.join(chosen.withColumn("window", F.col("place") - 1), ["anchor", "window"]).select(
        F.col("anchor.id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
