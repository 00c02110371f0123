"""Byte-level BPE vocabulary training and encoding (A3, A4, F2).

Merges depend on each other, so they are learned in *phases*, each of which
needs only a bounded extract of the corpus. The state is the table of
distinct pre-tokens with their counts, as arrays of symbol ids. A phase

1. counts all adjacent pairs (partial and final aggregation);
2. takes the first pairs in the trainer's order, as many as
   ``phase_symbols`` and ``phase_pairs`` allow: its live pairs. The last one
   is the ``floor``;
3. cuts every pre-token where a pair is not live. A pair's count only falls
   while merges are made, and a pair that a merge creates stands behind the
   one it grows out of (it is not more frequent, and its ids are larger), so
   no merge before the floor ever reaches over such a cut. The remaining
   stretches, most of them shared by many pre-tokens, are aggregated: this is
   all that merges before the floor can depend on;
4. makes these merges one after another in one task, with an index from each
   pair to its places: a merge reads and updates only those;
5. applies them to the pre-tokens, spread over the cluster.

The merges are those of the sequential trainer, whatever the bounds; a
smaller bound takes more phases. There is one exception to falling counts: a
merge that spells an existing token again. A phase that has cut anything
ends behind such a merge.

Ties are broken as the public byte-level trainer does: larger count first,
then smaller (left id, right id), ids being specials, then the 256 byte
symbols in the order of their printable stand-ins, then merges in order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parapet.functions.text import GPT2_PATTERN, pretokenize
from parapet.session import cut_lineage

PHASE_SYMBOLS = 4 << 20     # places of live pairs one phase indexes, at most (one task's memory)
PHASE_PAIRS = 200_000       # live pairs of a phase, at most (broadcast, eight bytes each)
WORDS_PER_PARTITION = 200_000
SHORT = 24                  # symbols of a word that is merged beside others
_PAIR = 1 << 32             # a pair (a, b) as one key: a * _PAIR + b


def _printable(b: int) -> bool:
    # bytes shown as themselves by the byte-level alphabet
    return 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255


def byte_order() -> list[int]:
    """Bytes in the order of their printable stand-ins: the printable bytes
    keep their code point; the others are shifted past 255 in byte order."""
    return [b for b in range(256) if _printable(b)] + [b for b in range(256) if not _printable(b)]


def word_counts(df: DataFrame, text: str, pattern: str = GPT2_PATTERN) -> DataFrame:
    """(word, cnt): pre-token frequencies (A3); partial + final hash-agg."""
    return df.select(F.explode(pretokenize(F.col(text), pattern)).alias("word")) \
             .groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def initial_symbols(words: DataFrame) -> DataFrame:
    """(word, cnt, syms): each UTF-8 byte as a symbol, written in hex
    (``" 68 69 "``); ids are attached only when pairs are ranked."""
    spaced = F.regexp_replace(F.hex(F.encode("word", "UTF-8")), "(..)", "$1 ")
    return words.select("word", "cnt", F.concat(F.lit(" "), spaced).alias("syms"))


def pair_counts(state: DataFrame) -> DataFrame:
    """(a, b, c): weighted counts of adjacent symbols (as written in ``syms``).

    Words of one symbol are dropped behind the explode: a filter on ``syms``
    (or the one Spark infers from a plain explode) would move below the
    aggregation of the words and cut up every occurrence of each."""
    s = F.split(F.trim(F.col("syms")), " ")
    n = F.size(s)
    z = F.arrays_zip(F.slice(s, 1, n - 1).alias("a"), F.slice(s, 2, n - 1).alias("b"))
    return (state.select("cnt", F.explode_outer(z).alias("p")).filter("p is not null")
                 .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
                 .agg(F.sum("cnt").alias("c")))


@dataclass
class BpeModel:
    specials: list[str]
    token_bytes: list[bytes]                 # id -> bytes ('' for specials)
    merges: list[tuple[int, int, int]] = field(default_factory=list)   # (left, right, new id)
    rounds: int = 0

    @property
    def vocab_size(self) -> int:
        return len(self.token_bytes)

    def ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        return {(a, b): (r, c) for r, (a, b, c) in enumerate(self.merges)}

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, self.specials[i] if i < len(self.specials) else None, tb.hex().upper(),
                 i < len(self.specials)) for i, tb in enumerate(self.token_bytes)]
        return spark.createDataFrame(rows, "id int, special string, token_hex string, is_special boolean")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        tb = self.token_bytes
        rows = [(r, tb[a].hex().upper(), tb[b].hex().upper(), c) for r, (a, b, c) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left_hex string, right_hex string, id int")


def new_model(specials: Sequence[str]) -> BpeModel:
    return BpeModel(list(specials), [b""] * len(specials) + [bytes([b]) for b in byte_order()])


# ---- training -----------------------------------------------------------------

def _grouped(keys: np.ndarray, weights: np.ndarray, pos: np.ndarray | None = None):
    """(key, weight sum[, positions]) of each distinct key."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cut = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    sums = np.add.reduceat(weights[order], cut)
    parts = [None] * len(cut) if pos is None else np.split(pos[order], cut[1:])
    return zip(k[cut].tolist(), sums.tolist(), parts)


def merge_in_turn(ids: np.ndarray, lens: np.ndarray, cnt: np.ndarray, token_bytes: Sequence[bytes], vocab_size: int,
                  floor: tuple[int, int] | None = None) -> list[tuple[int, int, int]]:
    """(left, right, made) of each merge of the sequential trainer, until the
    vocabulary holds ``vocab_size`` entries or the next pair is behind the
    ``floor`` (count, pair); without a floor, until no pair is left.

    ``ids``: the symbols of all stretches one after another, ``lens`` and
    ``cnt`` their lengths and counts; ``token_bytes`` the vocabulary so far.
    A symbol takes as many cells as it has bytes; ``first`` and ``last`` hold
    its id at its first and last cell, so both neighbours are found by
    length. With a floor, a merge that spells an existing token is the last."""
    names = list(token_bytes)
    n_merges: list[tuple[int, int, int]] = []
    kind = np.uint16 if max(vocab_size, len(names)) + 300 < 1 << 16 else np.int32
    sep, dead = np.iinfo(kind).max, np.iinfo(kind).max - 1
    width = np.ones(max(vocab_size, len(names)) + 1, dtype=np.int64)
    width[:len(names)] = [max(1, len(t)) for t in names]
    if not len(ids):
        return n_merges
    size = width[ids]
    stretch = np.repeat(np.arange(len(lens)), lens)
    at = np.cumsum(size) - size + stretch + 1            # a separator before each stretch, and one behind the last
    n = int(size.sum() + len(lens) + 1)
    place = np.int32 if n < (1 << 31) else np.int64
    heads = np.cumsum(lens) - lens
    starts = at[heads]                                   # where each stretch begins
    first = np.full(n, dead, dtype=kind)
    first[starts - 1], first[-1] = sep, sep
    last = first.copy()
    first[at], last[at + size - 1] = ids, ids
    known = {t: i for i, t in enumerate(names) if t}
    least = floor[0] if floor else 1
    weight = lambda p: cnt[np.searchsorted(starts, p, "right") - 1]
    counts: dict[int, int] = {}
    places: dict[int, list[np.ndarray]] = {}

    def add(groups):
        for key, c, pos in groups:
            c += counts.get(key, 0)
            if c >= least:                               # a rarer pair is never merged here
                counts[key] = c
                places.setdefault(key, []).append(pos)
                yield key

    inside = np.flatnonzero(stretch[1:] == stretch[:-1])
    keys = ids[inside].astype(np.int64) * _PAIR + ids[inside + 1]
    for _ in add(_grouped(keys, cnt[stretch[inside]], at[inside].astype(place)) if len(inside) else ()):
        pass
    del keys, inside, stretch, at, size
    heap = [(-c, k) for k, c in counts.items()]
    heapq.heapify(heap)
    while heap and len(names) < vocab_size:
        c, key = heapq.heappop(heap)
        now = counts.get(key, 0)
        if now != -c:                                    # changed since it was noted
            if 0 < now < -c:
                heapq.heappush(heap, (-now, key))
            continue
        if floor and (c, key) > (-floor[0], floor[1]):
            break
        a, b = divmod(key, _PAIR)
        la, lb = int(width[a]), int(width[b])
        p = np.unique(np.concatenate(places.pop(key))).astype(np.int64)
        del counts[key]
        p = p[first[p] == a]
        p = p[first[p + la] == b]
        if a == b:                                       # left to right in runs of the same symbol
            new = np.r_[True, p[1:] != p[:-1] + la]
            run = np.flatnonzero(new)[np.cumsum(new) - 1]
            p = p[(np.arange(len(p)) - run) % 2 == 0]
        product = names[a] + names[b]
        again = product in known
        made = known.setdefault(product, len(names))
        if not again:
            names.append(product)
            width[made] = la + lb
        n_merges.append((a, b, made))
        if again and floor:
            break
        w = weight(p)
        after_prev = np.r_[False, p[1:] == p[:-1] + la + lb]      # stands right behind another place of the pair
        before_next = np.r_[after_prev[1:], False]
        left, right = last[p - 1].astype(np.int64), first[p + la + lb].astype(np.int64)
        dl, dr = left != sep, (right != sep) & ~before_next
        gone = np.r_[left[dl] * _PAIR + a, b * _PAIR + right[dr]]
        if len(gone):
            for k, d, _ in _grouped(gone, np.r_[w[dl], w[dr]]):
                if k in counts:
                    counts[k] -= d
                    if counts[k] < least:
                        del counts[k], places[k]
        first[p], first[p + la], last[p + la + lb - 1] = made, dead, made
        left, right = last[p - 1].astype(np.int64), first[p + la + lb].astype(np.int64)
        dl, dr = (left != sep) & ~after_prev, right != sep
        come = np.r_[left[dl] * _PAIR + made, made * _PAIR + right[dr]]
        if len(come):
            where = np.r_[p[dl] - width[left[dl]], p[dr]].astype(place)
            for k in add(_grouped(come, np.r_[w[dl], w[dr]], where)):
                heapq.heappush(heap, (-counts[k], k))
    return n_merges


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of an array<int> column."""
    offs = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[offs[0]:offs[-1]], np.diff(offs)


def _as_lists(values: np.ndarray, lens: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)], pa.int32()), pa.array(values, pa.int32()))


def initial_ids(words: DataFrame, specials: Sequence[str]) -> DataFrame:
    """(ids, cnt) of the pre-tokens (word, cnt) of two bytes or more."""
    id_of = np.zeros(256, np.int32)
    id_of[byte_order()] = np.arange(len(specials), len(specials) + 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            col = rb.column(0).cast(pa.large_binary())
            offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
            data = np.frombuffer(col.buffers()[2], np.uint8)[offs[0]:offs[-1]] if len(col) else np.zeros(0, np.uint8)
            yield pa.RecordBatch.from_arrays([_as_lists(id_of[data], np.diff(offs)), rb.column(1)], ["ids", "cnt"])

    raw = words.select(F.encode("word", "UTF-8").alias("w"), F.col("cnt").cast("bigint").alias("cnt")).filter(F.length("w") > 1)
    return raw.mapInArrow(run, "ids array<int>, cnt long")


def id_pairs(state: DataFrame) -> DataFrame:
    """(key, c, n): count of each adjacent pair, and the places it stands at."""
    a, b = F.slice("ids", 1, F.size("ids") - 1), F.slice("ids", 2, F.size("ids") - 1)
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    return state.select("cnt", F.explode(both).alias("p")) \
        .groupBy((F.col("p.a").cast("bigint") * _PAIR + F.col("p.b")).alias("key")) \
        .agg(F.sum("cnt").alias("c"), F.count(F.lit(1)).alias("n"))


def live_pairs(pairs: DataFrame, symbols: int, most: int) -> tuple[np.ndarray, tuple[int, int] | None]:
    """(sorted keys of the live pairs, the last one in the trainer's order as
    (count, key), or None if all pairs are live)."""
    first = pairs.orderBy(F.col("c").desc(), "key").limit(most + 1).toPandas()
    fits = int(np.searchsorted(np.cumsum(first["n"].to_numpy(np.int64)), symbols, "right"))
    keys = first["key"].to_numpy(np.int64)
    if len(keys) <= most and fits >= len(keys):
        return np.sort(keys), None
    k = max(1, min(fits, most))
    return np.sort(keys[:k]), (int(first["c"].iloc[k - 1]), int(keys[k - 1]))


def stretches(state: DataFrame, live: np.ndarray | None) -> DataFrame:
    """(s, cnt): the stretches of live pairs, as the bytes of their ids, with
    their counts over all pre-tokens. ``live``: sorted keys; None: all are."""
    keys = None if live is None else state.sparkSession.sparkContext.broadcast(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids, lens = _lists(rb.column(0))
            word = np.repeat(np.arange(len(lens)), lens)
            joined = word[1:] == word[:-1]
            if keys is not None and len(keys.value):
                pair = ids[:-1].astype(np.int64) * _PAIR + ids[1:]
                spot = np.minimum(np.searchsorted(keys.value, pair), len(keys.value) - 1)
                joined &= keys.value[spot] == pair
            begins = np.flatnonzero(np.r_[True, ~joined]) if len(ids) else np.zeros(0, np.int64)
            size = np.diff(np.r_[begins, len(ids)])
            keep = size > 1
            of = np.repeat(keep, size)
            offs = np.r_[0, np.cumsum(size[keep] * 4)]
            data = np.ascontiguousarray(ids[of], "<i4")
            out = pa.Array.from_buffers(pa.binary(), int(keep.sum()), [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([out, rb.column(1).take(pa.array(word[begins[keep]]))], ["s", "cnt"])

    return state.mapInArrow(run, "s binary, cnt long").groupBy("s").agg(F.sum("cnt").alias("cnt"))


def phase_merges(parts: DataFrame, model: BpeModel, vocab_size: int,
                 floor: tuple[int, int] | None) -> list[tuple[int, int, int]]:
    """:func:`merge_in_turn` over all stretches, in one executor task."""
    names = parts.sparkSession.sparkContext.broadcast(model.token_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lens, cnt = [], [], []
        for rb in batches:
            col = rb.column(0).cast(pa.large_binary())
            offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
            ids.append(np.frombuffer(col.buffers()[2], np.uint8)[offs[0]:offs[-1]].view("<i4").copy() if len(col) else np.zeros(0, np.int32))
            lens.append(np.diff(offs) // 4)
            cnt.append(rb.column(1).to_numpy())
        if ids:
            got = merge_in_turn(np.concatenate(ids), np.concatenate(lens), np.concatenate(cnt), names.value, vocab_size, floor)
            yield pa.RecordBatch.from_pydict({"rank": pa.array(range(len(got)), pa.int32()), **{
                k: pa.array([x[i] for x in got], pa.int32()) for i, k in enumerate(("a", "b", "id"))}})

    rows = parts.repartition(1).mapInArrow(run, "rank int, a int, b int, id int").orderBy("rank").collect()
    return [(r["a"], r["b"], r["id"]) for r in rows]


def apply_merges(state: DataFrame, merges: Sequence[tuple[int, int, int]]) -> DataFrame:
    """The pre-tokens after a phase; those that are one symbol now have no
    pair left and go. The last merge may spell an existing token and goes by
    itself: earlier ones do not see what it made."""
    steps = state.sparkSession.sparkContext.broadcast([
        MergeTable({(a, b): (r, made) for r, (a, b, made) in enumerate(part)}) for part in (merges[:-1], merges[-1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids, lens = _lists(rb.column(0))
            for table in steps.value:
                ids, lens = table.encode(ids, lens)
            yield pa.RecordBatch.from_arrays([_as_lists(ids, lens), rb.column(1)], ["ids", "cnt"]).filter(pa.array(lens > 1))

    return state.mapInArrow(run, "ids array<int>, cnt long")


def learn_bpe(words: DataFrame, vocab_size: int, specials: Sequence[str], phase_symbols: int = PHASE_SYMBOLS,
              phase_pairs: int = PHASE_PAIRS) -> BpeModel:
    """Learn merges until the vocabulary holds ``vocab_size`` entries or no
    pair is left (A4), in phases over ``words`` (word, cnt)."""
    model = new_model(specials)
    spark = words.sparkSession
    state = cut_lineage(initial_ids(words, specials))       # the corpus is read once
    # an explicit count, which AQE keeps: the distinct words of a large corpus are few bytes
    n_parts = max(spark.sparkContext.defaultParallelism, -(-state.count() // WORDS_PER_PARTITION))
    state = state.repartition(n_parts, "ids")
    while model.vocab_size < vocab_size:
        live, floor = live_pairs(id_pairs(state), phase_symbols, phase_pairs)
        if not len(live):
            break
        merges = phase_merges(stretches(state, live if floor else None), model, vocab_size, floor)
        for a, b, made in merges:
            if made == len(model.token_bytes):
                model.token_bytes.append(model.token_bytes[a] + model.token_bytes[b])
            model.merges.append((a, b, made))
        model.rounds += 1
        if not floor:
            break
        if model.vocab_size < vocab_size:
            state = cut_lineage(apply_merges(state, merges))
    return model


# ---- encoding -----------------------------------------------------------------

def encode_word(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges by rank (F2): the pair of the lowest rank first, from left
    to right. Symbols are linked and waiting pairs stand in a heap, so a word
    of n symbols takes O(n log n) steps however long it is."""
    n = len(ids)
    get = ranks.get
    heap = [(r[0], i) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
    if not heap:
        return ids
    heapq.heapify(heap)
    sym: list[int] = list(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if sym[i] < 0 or j >= n:
            continue
        r = get((sym[i], sym[j]))
        if r is None or r[0] != rank:                    # one of them has been merged since
            continue
        sym[i], sym[j] = r[1], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = get((sym[i], sym[k]))
            if r is not None:
                heapq.heappush(heap, (r[0], i))
        h = before[i]
        if h >= 0:
            r = get((sym[h], sym[i]))
            if r is not None:
                heapq.heappush(heap, (r[0], h))
    return [x for x in sym if x >= 0]


class MergeTable:
    """Merges by pair, for many words at a time."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        self.ranks = ranks
        key = np.array([a * _PAIR + b for a, b in ranks], np.int64)
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], *np.array(list(ranks.values()), np.int64).reshape(-1, 2)[order].T

    def encode(self, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:func:`encode_word` of words one after another: (ids, lengths).
        Short words of one length stand in a table; each makes its first merge
        (the lowest rank, the leftmost place) and goes on among those that are
        one symbol shorter."""
        ids, lens = ids.astype(np.int64), np.asarray(lens, np.int64)
        starts, after = np.cumsum(lens) - lens, lens.copy()
        done: list[tuple[np.ndarray, np.ndarray]] = []          # (words, their symbols)
        none = len(self.key) and int(self.rank.max()) + 1
        order = np.argsort(lens, kind="stable")
        edge = np.searchsorted(lens[order], np.arange(SHORT + 2))
        rest, table = np.zeros(0, np.int64), np.zeros((0, SHORT), np.int64)
        for n in range(SHORT, 0, -1):
            own = order[edge[n]:edge[n + 1]]
            rest, table = np.r_[rest, own], np.concatenate([table, ids[starts[own][:, None] + np.arange(n)]])
            if n == 1 or not none:
                done.append((rest, table))
                rest, table = rest[:0], np.zeros((0, n - 1), np.int64)
                continue
            pair = table[:, :-1] * _PAIR + table[:, 1:]
            spot = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            rank = np.where(self.key[spot] == pair, self.rank[spot], none)
            first = rank.argmin(axis=1)
            go = rank[np.arange(len(rest)), first] < none
            done.append((rest[~go], table[~go]))
            rest, first = rest[go], first[go]
            made = self.made[spot[go, first]]
            keep = np.arange(n - 1) + (np.arange(n - 1) > first[:, None])
            table = np.take_along_axis(table[go], keep, axis=1)
            table[np.arange(len(rest)), first] = made
        for i in order[edge[SHORT + 1]:].tolist():
            word = encode_word(ids[starts[i]:starts[i] + lens[i]].tolist(), self.ranks)
            done.append((np.array([i]), np.array([word], np.int64)))
        for words, found in done:
            after[words] = found.shape[1]
        out, begin = np.empty(int(after.sum()), np.int32), np.cumsum(after) - after
        for words, found in done:
            out[begin[words][:, None] + np.arange(found.shape[1])] = found
        return out, after
