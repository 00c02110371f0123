"""Ensemble members that see the source and the whole prefix.

A member keeps a state per prefix. Decoding goes level by level through the
trie of the prefixes of a batch: rows with the same source and prefix stand
at one node, which every member scores once and extends once, however many
rows there are. Forced prefixes are walked through the same trie.

A member lists the ids whose logit it knows and gives one logit for all
others, so a vocabulary of 32,000 costs what is listed; a member that lists
every id is a dense one. The members' probabilities are averaged over the
whole vocabulary (log-sum-exp - ln M) and the arg-max is appended, ties to
the lowest id.

Members that are tables (:class:`TableMember`) are scored together: the ids of
a source that nothing else is known of share one logit, as do all ids outside
it, so a step looks at the successors of the last id and at the prefix, and
not at the source. The sums over the vocabulary are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from parapet.functions.text import MAX_LENGTH

DIGITS = 9
STOPS = ("eos", "repeat", "length")


class Scores(NamedTuple):
    """Logits of n nodes: ``key`` = node * vocabulary + id of the listed ids,
    sorted and each once, their ``logit``, and of each node the logit of the
    ids that are ``rest``."""
    key: np.ndarray
    logit: np.ndarray
    rest: np.ndarray


class Member(Protocol):
    def start(self, sources: Sequence[np.ndarray]) -> Any:
        """The states of the empty prefix of each source."""

    def scores(self, state: Any, vocab: int) -> Scores:
        """Next-token logits of every state."""

    def extend(self, state: Any, parent: np.ndarray, token: np.ndarray) -> Any:
        """The states of prefixes that are one token longer than ``parent``'s."""


# ---- averaging ------------------------------------------------------------------

def _rows_lse(key: np.ndarray, value: np.ndarray, n: int, vocab: int, rest: np.ndarray) -> np.ndarray:
    """log of the sum over the whole vocabulary of exp(logit), by node."""
    row = key // vocab
    top = rest.copy()
    np.maximum.at(top, row, value)
    listed = np.bincount(row, minlength=n)
    return top + np.log(np.bincount(row, np.exp(value - top[row]), n) + (vocab - listed) * np.exp(rest - top))


def best_tokens(scores: Sequence[Scores], n: int, vocab: int, digits: int | None = DIGITS) -> np.ndarray:
    """Of each node the id with the highest mean probability of all members."""
    keys = np.unique(np.concatenate([s.key for s in scores]))
    row = keys // vocab
    lp, lp_rest = np.empty((len(scores), len(keys))), np.empty((len(scores), n))
    for m, s in enumerate(scores):
        total = _rows_lse(s.key, s.logit, n, vocab, s.rest)
        lp_rest[m] = s.rest - total
        lp[m] = lp_rest[m][row]
        lp[m][np.searchsorted(keys, s.key)] = s.logit - total[s.key // vocab]

    def mean(x: np.ndarray) -> np.ndarray:
        top = x.max(axis=0)
        out = top + np.log(np.exp(x - top).sum(axis=0)) - np.log(len(scores))
        return out if digits is None else out.round(digits)

    avg, other = mean(lp), mean(lp_rest)
    best, token = np.full(n, -np.inf), np.full(n, -1)
    np.maximum.at(best, row, avg)
    hit = np.flatnonzero(avg == best[row])[::-1]            # the lowest id comes last and stays
    token[row[hit]] = keys[hit] % vocab
    begin = np.searchsorted(keys, np.arange(n + 1) * vocab)
    for i in np.flatnonzero(other >= best):                 # an id that no member lists may be the best
        ids = keys[begin[i]:begin[i + 1]] - i * vocab
        gaps = np.flatnonzero(ids != np.arange(len(ids)))
        free = int(gaps[0]) if len(gaps) else len(ids)      # the lowest id that is not listed
        if free < vocab and (other[i] > best[i] or free < token[i]):
            token[i] = free
    return token


class Ensemble:
    """Any members, each with states of its own."""

    def __init__(self, members: Sequence[Member]):
        self.members = members

    def start(self, sources: Sequence[np.ndarray]) -> list:
        return [m.start(sources) for m in self.members]

    def extend(self, states: list, parent: np.ndarray, token: np.ndarray) -> list:
        return [m.extend(s, parent, token) for m, s in zip(self.members, states)]

    def best(self, states: list, n: int, vocab: int, digits: int | None) -> np.ndarray:
        return best_tokens([m.scores(s, vocab) for m, s in zip(self.members, states)], n, vocab, digits)


# ---- decoding ---------------------------------------------------------------------

class Work:
    """What a decoding looked at (for tests and reports)."""

    def __init__(self):
        self.scored = self.steps = 0


def decode_batch(sources: Sequence[Sequence[int]], prefixes: Sequence[Sequence[int]], members: Sequence[Member], eos: int,
                 vocab: int, max_steps: int = MAX_LENGTH, stop_on_repeat: bool = False, digits: int | None = DIGITS,
                 work: Work | None = None) -> tuple[list[list[int]], list[str]]:
    """(ids after the prefix, why they end) of each row: ``eos``, ``repeat``
    (the next id stands in the prefix; if asked for) or ``length``."""
    n = len(sources)
    ensemble = together(members)
    numbers: dict[bytes, int] = {}
    node = np.array([numbers.setdefault(np.asarray(s, np.int64).tobytes(), len(numbers)) for s in sources], np.int64)
    states = ensemble.start([np.frombuffer(s, np.int64) for s in numbers])
    n_nodes = len(numbers)
    forced = [list(p) for p in prefixes]
    seen = [set(p) for p in forced]
    out: list[list[int]] = [[] for _ in range(n)]
    stop = ["length"] * n
    live = np.arange(n) if max_steps > 0 else np.arange(0)
    level = 0
    while len(live):
        free = np.array([level >= len(forced[i]) for i in live], bool)
        token = np.empty(len(live), np.int64)
        token[~free] = [forced[i][level] for i in live[~free]]
        if free.any():
            asked, of = np.unique(node[live[free]], return_inverse=True)
            some = ensemble.extend(states, asked, np.full(len(asked), -1)) if len(asked) < n_nodes else states
            token[free] = ensemble.best(some, len(asked), vocab, digits)[of]
            if work:
                work.scored += len(asked)
                work.steps += int(free.sum())
        go = np.ones(len(live), bool)
        for j in np.flatnonzero(free):
            i, t = live[j], int(token[j])
            if stop_on_repeat and t in seen[i]:
                stop[i], go[j] = "repeat", False
                continue
            out[i].append(t)
            seen[i].add(t)
            if t == eos:
                stop[i], go[j] = "eos", False
            elif len(out[i]) >= max_steps:
                go[j] = False
        live, token = live[go], token[go]
        # equal (node, token) are one node of the next level
        keys, of = np.unique(node[live] * vocab + token, return_inverse=True)
        states = ensemble.extend(states, keys // vocab, keys % vocab) if len(keys) else states
        node[live], n_nodes = of, len(keys)
        level += 1
    return out, stop


def decode_sources(df: DataFrame, make: Callable[[], Sequence[Member]], eos: int, vocab: int, src: str = "src", prefix: str = "prefix",
                   keys: Sequence[str] = ("sid",), max_steps: int = MAX_LENGTH, stop_on_repeat: bool = False,
                   digits: int | None = DIGITS) -> DataFrame:
    """(keys..., ids, stop), a row for each row of ``df`` (keys..., src
    array<int>, prefix array<int>). ``make`` gives the members, on the
    executor. Every row is decoded where it stands, rows of a batch that are
    equal in source and prefix once: nothing is shuffled, and a frequent
    source costs no task more than its share. A null source or prefix counts
    as empty."""
    none = F.array().cast("array<int>")
    rows = df.select(*keys, F.coalesce(F.col(src), none).alias("src"), F.coalesce(F.col(prefix), none).alias("prefix"))
    n_keys = len(rows.columns) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = list(make())
        if not members:
            raise ValueError("no ensemble member is available")
        for rb in batches:
            asked: dict[tuple[bytes, bytes], int] = {}
            of = [asked.setdefault(q, len(asked)) for q in zip(_row_bytes(rb.column(n_keys)), _row_bytes(rb.column(n_keys + 1)))]
            sources, prefixes = zip(*asked) if asked else ((), ())
            ids, stop = decode_batch([np.frombuffer(x, np.int32) for x in sources], [np.frombuffer(x, np.int32).tolist() for x in prefixes],
                                     members, eos, vocab, max_steps, stop_on_repeat, digits)
            done = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([*rb.columns[:n_keys], pa.array(ids, pa.list_(pa.int32())).take(done), pa.array(stop, pa.string()).take(done)],
                                             [*rb.schema.names[:n_keys], "ids", "stop"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:n_keys], StructField("ids", ArrayType(IntegerType())), StructField("stop", StringType())]))


def _row_bytes(column: pa.ListArray) -> Iterator[bytes]:
    """Each list of an array<int> column as bytes."""
    at = column.offsets.to_numpy().astype(np.int64) * 4
    data = np.ascontiguousarray(column.values.to_numpy(), np.int32).tobytes()
    return (data[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist()))


# ---- members fitted on a corpus ------------------------------------------------------

def successor_counts(lines: DataFrame, member: str, ids: str, bos: int, eos: int, top: int) -> DataFrame:
    """(member, prev, next, c): of each member and id the ``top`` most
    frequent successors (ties to the lower id); a line stands between
    ``bos`` and ``eos``. At most members x vocabulary x ``top`` rows: the
    size of the model, whatever the corpus."""
    whole = F.concat(F.array(F.lit(bos)), F.col(ids), F.array(F.lit(eos)))
    t = lines.select(F.col(member).alias("member"), whole.alias("t"))
    pairs = F.arrays_zip(F.slice("t", 1, F.size("t") - 1).alias("prev"), F.slice("t", 2, F.size("t") - 1).alias("next"))
    counts = t.select("member", F.explode(pairs).alias("b")).groupBy("member", F.col("b.prev").alias("prev"), F.col("b.next").alias("next")) \
        .agg(F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy("member", "prev").orderBy(F.col("c").desc(), "next")
    return counts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= top).drop("r")


class _State(NamedTuple):
    source: np.ndarray          # of each node
    last: np.ndarray
    prefix: np.ndarray          # nodes x level
    ids: np.ndarray             # of all sources, one after another, each id once a source
    begin: np.ndarray


def _spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of all places of the spans."""
    size = end - begin
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + begin[row]


@dataclass
class TableMember:
    """Logit of an id = log(1 + its count behind the last id), plus ``source``
    if it stands in the source, less ``fresh`` for each time it stands in the
    prefix. ``prev``, ``next``, ``c``: rows of :func:`successor_counts`,
    sorted by ``prev``."""
    prev: np.ndarray
    next: np.ndarray
    c: np.ndarray
    bos: int
    source: float = 1.0
    fresh: float = 1.0

    def start(self, sources: Sequence[np.ndarray]) -> _State:
        ids = [np.unique(s) for s in sources]
        n = len(ids)
        return _State(np.arange(n), np.full(n, self.bos), np.zeros((n, 0), np.int64),
                      np.concatenate(ids) if ids else np.zeros(0, np.int64), np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int64))

    def extend(self, state: _State, parent: np.ndarray, token: np.ndarray) -> _State:
        if len(token) and token[0] < 0:             # the same prefixes, some of them
            return state._replace(source=state.source[parent], last=state.last[parent], prefix=state.prefix[parent])
        return state._replace(source=state.source[parent], last=token, prefix=np.concatenate([state.prefix[parent], token[:, None]], axis=1))

    def scores(self, state: _State, vocab: int) -> Scores:
        n, depth = state.prefix.shape
        row, at = _spans(np.searchsorted(self.prev, state.last, "left"), np.searchsorted(self.prev, state.last, "right"))
        row2, at2 = _spans(state.begin[state.source], state.begin[state.source + 1])
        key = np.concatenate([row * vocab + self.next[at], row2 * vocab + state.ids[at2],
                              np.repeat(np.arange(n), depth) * vocab + state.prefix.ravel()])
        value = np.concatenate([np.log1p(self.c[at]), np.full(len(at2), self.source), np.full(n * depth, -self.fresh)])
        keys, of = np.unique(key, return_inverse=True)
        return Scores(keys, np.bincount(of, value, len(keys)), np.zeros(n))


MAX_WEIGHT = 300.0          # of a source: its exponential is far from the largest number


def together(members: Sequence[Member]) -> Ensemble:
    """The members as one: tables are scored together, others one by one."""
    tables = all(type(m) is TableMember and m.bos == members[0].bos and m.fresh >= 0 and abs(m.source) <= MAX_WEIGHT for m in members)
    return TableEnsemble(members) if tables and members else Ensemble(members)


class TableEnsemble(Ensemble):
    """:class:`TableMember` s with one state. exp(logit) of an id is
    (1 + count) * exp(source) * exp(-fresh * times in the prefix), so of each
    node a member's sum over the vocabulary is that of two groups, the ids in
    the source and those outside, corrected for the prefix and the successors."""

    def start(self, sources: Sequence[np.ndarray]) -> _State:
        size = np.array([len(s) for s in sources], np.int64)
        ids = np.concatenate([*sources, np.zeros(0, np.int64)])
        key = np.sort(np.repeat(np.arange(len(size)), size) << 32 | ids)
        key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key        # sorting is faster than np.unique's hashing
        return _State(np.arange(len(size)), np.full(len(size), self.members[0].bos), np.zeros((len(size), 0), np.int64), key,
                      np.searchsorted(key, np.arange(len(size) + 1) << 32))

    extend = TableMember.extend

    def best(self, state: _State, n: int, vocab: int, digits: int | None) -> np.ndarray:
        nodes, begin, end = np.arange(n), state.begin[state.source], state.begin[state.source + 1]
        # the prefix and the members' successors: (node, id) once each, in order
        prefix = (nodes[:, None] << 32 | state.prefix).ravel()
        spans = [_spans(np.searchsorted(m.prev, state.last, "left"), np.searchsorted(m.prev, state.last, "right")) for m in self.members]
        known = [row << 32 | m.next[at] for m, (row, at) in zip(self.members, spans)]
        keys, of = np.unique(np.concatenate([prefix, *known]), return_inverse=True)
        row, ids = keys >> 32, keys & 0xFFFFFFFF
        times = np.bincount(of[:len(prefix)], minlength=len(keys))
        wanted = state.source[row] << 32 | ids
        place = np.searchsorted(state.ids, wanted)
        inside = place < end[row]
        inside[inside] = state.ids[place[inside]] == wanted[inside]
        # one more for each node: the lowest id of the source that is not among them
        within = np.flatnonzero(inside)
        turn = np.arange(len(within)) - np.searchsorted(row[within], row[within])
        taken = begin + np.bincount(row[within][place[within] - begin[row[within]] == turn], minlength=n)
        more = np.flatnonzero(taken < end)
        total, other = np.zeros(len(keys) + len(more)), np.zeros(n)
        spot = len(prefix)
        for m, (_, at) in zip(self.members, spans):
            up, c = np.exp(m.source), np.bincount(of[spot:spot + len(at)], m.c[at], len(keys))
            spot += len(at)
            plain = np.where(inside, up, 1.0)
            value = (1.0 + c) * plain * np.exp(-m.fresh * times)
            whole = vocab + (end - begin) * (up - 1.0) + np.bincount(row, value - plain, n)
            total[:len(keys)] += value / whole[row]
            total[len(keys):] += up / whole[more]
            other += 1.0 / whole
        row = np.concatenate([row, more])
        ids = np.concatenate([ids, state.ids[taken[more]] & 0xFFFFFFFF])

        def mean(x: np.ndarray) -> np.ndarray:
            out = np.log(x) - np.log(len(self.members))
            return out if digits is None else out.round(digits)

        avg, other = mean(total), mean(other)
        best, token = np.full(n, -np.inf), np.full(n, vocab)
        np.maximum.at(best, row, avg)
        hit = avg == best[row]
        np.minimum.at(token, row[hit], ids[hit])
        for i in np.flatnonzero(other >= best):             # an id of which nothing is known may be the best
            listed = np.union1d(keys[slice(*np.searchsorted(keys, [i << 32, i + 1 << 32]))], state.ids[begin[i]:end[i]] & 0xFFFFFFFF | i << 32) & 0xFFFFFFFF
            gaps = np.flatnonzero(listed != np.arange(len(listed)))
            free = int(gaps[0]) if len(gaps) else len(listed)
            if free < vocab and (other[i] > best[i] or free < token[i]):
                token[i] = free
        return token
