"""Encoding, decoding and model features.

Merges and vocabulary have a configured size, so they are broadcast and every
text is encoded and decoded where it stands: nothing is shuffled, rows need
no key, and a frequent word or a repeated row costs no task more than its
share. Texts are pre-tokenised in the JVM; a batch's distinct words are found
by Arrow, encoded side by side unless the worker remembers them, and gathered
back.
The word-level vocabulary grows with the corpus and is joined (J5).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from parapet.functions import text as T
from parapet.operators import skew
from parapet.operators.bpe import BpeModel, MergeTable, byte_order
from parapet.operators.ordinal import running_offset
from parapet.session import cut_lineage

MAX_VOCAB_BROADCAST = 1_000_000   # vocabularies are configured sizes (32,000 in the reference)
REMEMBERED = 200_000        # words a worker remembers
MAX_REMEMBERED_CHARS = 64


def pretokens(text: Column, specials: Sequence[str], pattern: str = T.GPT2_PATTERN) -> Column:
    """Pre-tokens of a text in which the strings of special tokens stand for
    themselves: the text is cut at them first, as the public tokenizers do,
    and only the stretches between are matched with ``pattern``."""
    if not specials:
        return T.pretokenize(text, pattern)
    # longer strings first: one may begin another
    begin = commonprefix(list(specials))        # tried first at each place
    either = re.escape(begin) + "(?:" + "|".join(re.escape(x[len(begin):]) for x in sorted(specials, key=len, reverse=True)) + ")"
    found, between = F.regexp_extract_all(text, F.lit(either), F.lit(0)), F.split(text, either, -1)
    cut = F.flatten(F.zip_with(between, found, lambda x, s: F.concat(
        T.pretokenize(x, pattern), F.when(s.isNotNull(), F.array(s)).otherwise(F.array().cast("array<string>")))))
    return F.when(F.rlike(text, F.lit(either)), cut).otherwise(T.pretokenize(text, pattern))


def _flat_lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(values, length of each list); a null list is empty."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten(), size       # flatten leaves null lists out


def encode(df: DataFrame, keys: Sequence[str], text: str, model: BpeModel,
           pattern: str = T.GPT2_PATTERN, name: str = "ids", remembered: int = REMEMBERED) -> DataFrame:
    """(keys..., ids): BPE ids of ``text`` (F2), a row for each row of ``df``;
    a special token's string is its own id. Texts without pre-tokens, and
    null ones, get an empty array. A worker remembers the ids of
    ``remembered`` short words."""
    n_special = len(model.specials)
    base = np.zeros(256, np.int32)
    base[byte_order()] = np.arange(n_special, n_special + 256)
    special = {t: np.array([i], np.int32) for i, t in enumerate(model.specials)}
    bc = df.sparkSession.sparkContext.broadcast((MergeTable(model.ranks()), base, special))
    words = df.select(*keys, pretokens(F.col(text), model.specials, pattern).alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, base_ids, special_ids = bc.value
        known: dict[str, np.ndarray] = dict(special_ids)
        for rb in batches:
            values, size = _flat_lists(rb.column(rb.num_columns - 1))
            coded = values.dictionary_encode()
            words = coded.dictionary.to_pylist()
            new = [w for w in words if w not in known]
            data = [w.encode("utf-8") for w in new]
            ids, lens = table.encode(base_ids[np.frombuffer(b"".join(data), np.uint8)], np.array([len(x) for x in data], np.int64))
            known.update(zip(new, np.split(ids, np.cumsum(lens)[:-1])))
            found = [known[w] for w in words]
            for w in new:
                if len(w) > MAX_REMEMBERED_CHARS:
                    del known[w]
            if len(known) > remembered:
                known = dict(special_ids)
            lens = np.fromiter(map(len, found), np.int64, len(found))
            pool = np.concatenate([*found, np.zeros(0, np.int32)])
            code = coded.indices.to_numpy(zero_copy_only=False)
            ids, ends = _taken(pool, lens, code)
            offsets = np.r_[0, ends][np.r_[0, np.cumsum(size)]]
            out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], out], names)

    names = [*keys, name]
    return words.mapInArrow(run, StructType([*[df.schema[k] for k in keys], StructField(name, ArrayType(IntegerType()))]))


def _taken(pool: np.ndarray, lens: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the stretches ``code`` of ``pool`` one after another, where each ends)."""
    begin, count = np.cumsum(lens) - lens, lens[code]
    ends = np.cumsum(count)
    at = np.repeat(begin[code] - (ends - count), count)
    return pool[at + np.arange(len(at))], ends


def decode(df: DataFrame, keys: Sequence[str], ids: str, vocab: DataFrame,
           skip_special: bool = True, name: str = "text", unknown: str = "fail") -> DataFrame:
    """(keys..., text): ids back to text (F6, J5), a row for each row of
    ``df``. ``vocab``: (id, token_hex, is_special), broadcast: its size is the
    configured vocabulary size. An id the vocabulary lacks fails, or with
    ``unknown="null"`` makes the text null; null ids count as none."""
    if unknown not in UNKNOWN:
        raise ValueError(f"unknown must be one of {UNKNOWN}")
    rows = vocab.select("id", "token_hex", "is_special").limit(MAX_VOCAB_BROADCAST + 1).collect()
    if len(rows) > MAX_VOCAB_BROADCAST:
        raise ValueError("vocabulary too large to broadcast")
    top = max((r["id"] for r in rows), default=-1)
    tokens, there = [b""] * (top + 2), np.zeros(top + 2, bool)
    for r in rows:
        tokens[r["id"]] = b"" if r["is_special"] and skip_special else bytes.fromhex(r["token_hex"])
        there[r["id"]] = True
    bc = df.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens], np.int64), there))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, lens, known = bc.value
        for rb in batches:
            values, size = _flat_lists(rb.column(rb.num_columns - 1))
            code = pc.fill_null(values, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            code = np.where((code < 0) | (code >= len(known)), len(known) - 1, code)        # the last place is no id
            if unknown == "fail" and not known[code].all():
                lost = values.take(pa.array(np.flatnonzero(~known[code])[:1]))[0].as_py()
                raise ValueError(f"not in the vocabulary: {lost}")
            data, ends = _taken(pool, lens, code)
            edges = np.r_[0, np.cumsum(size)]
            offsets = np.r_[0, ends][edges]
            some_lost = np.diff(np.r_[0, np.cumsum(~known[code])][edges]) > 0
            out = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
            out = pc.if_else(pa.array(some_lost), pa.scalar(None, pa.binary()), out)
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], out], names)

    names = [*keys, name]
    raw = df.select(*keys, F.col(ids).alias(name)).mapInArrow(
        run, StructType([*[df.schema[k] for k in keys], StructField(name, BinaryType())]))
    return raw.withColumn(name, F.decode(F.col(name), "UTF-8"))


def model_features(df: DataFrame, src_ids: str, tgt_ids: str, bos: int, eos: int, pad: int,
                   max_length: int = T.MAX_LENGTH, pad_to_max: bool = True) -> DataFrame:
    """input_ids / attention_mask / labels (F3, F4, F5, F10, P6): truncate so
    the specials fit, wrap in <s> ... </s>, optionally pad to ``max_length``."""
    inp = T.wrap(T.truncate(F.col(src_ids), max_length), bos, eos)
    lab = T.wrap(T.truncate(F.col(tgt_ids), max_length), bos, eos)
    out = df.withColumn("input_ids", inp).withColumn("labels", lab)
    if pad_to_max:
        out = out.withColumn("attention_mask", T.attention_mask("input_ids", max_length)) \
                 .withColumn("input_ids", T.pad_to("input_ids", max_length, pad)) \
                 .withColumn("labels", T.pad_to("labels", max_length, pad))
    else:
        out = out.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    return out


def select_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep ``keep`` plus whichever of input_ids, attention_mask, labels exist."""
    wanted = [c for c in ("input_ids", "attention_mask", "labels") if c in df.columns]
    return df.select(*keep, *wanted)


def pad_batch(df: DataFrame, batch: str, pad: int, label_pad: int = T.IGNORE_INDEX) -> DataFrame:
    """Pad each row to its batch (W3): ids with ``pad`` and the attention
    mask with 0 to the longest ``input_ids``, labels with ``label_pad`` to
    the longest ``labels``. The window is bounded by the batch size."""
    w = Window.partitionBy(batch)
    return (df.withColumn("__in", F.max(F.size("input_ids")).over(w))
              .withColumn("__lab", F.max(F.size("labels")).over(w))
              .withColumn("attention_mask", T.attention_mask("input_ids", F.col("__in")))
              .withColumn("input_ids", T.pad_to("input_ids", F.col("__in"), pad))
              .withColumn("labels", T.pad_to("labels", F.col("__lab"), label_pad))
              .drop("__in", "__lab"))


UNKNOWN = ("fail", "null")


def _known(value: Column, what: Column, unknown: str) -> Column:
    """The looked-up value; an entry the vocabulary lacks fails the job or
    stays null in its place, and is never dropped."""
    if unknown not in UNKNOWN:
        raise ValueError(f"unknown must be one of {UNKNOWN}")
    if unknown == "null":
        return value
    return F.when(value.isNull(), F.raise_error(F.concat(F.lit("not in the vocabulary: "), what.cast("string")))) \
            .otherwise(value)


# ---- a word-level vocabulary (SQL-checkable stand-in for J5 and F3-F6) ------

VOCAB_PREFIX = 5            # letters by which words of one count are parted, and parted again
VOCAB_BLOCK = 100_000       # words of a block from which it is parted again
WORD_SPECIALS = [T.BOS, T.EOS, T.PAD]


def _prefixes(words: DataFrame, block: int) -> DataFrame:
    """(word, cnt, __p): ``__p`` begins the word, so that (count descending,
    ``__p``) is in the order of the words and at most ``block`` words share
    one. Blocks that are too large take ``VOCAB_PREFIX`` letters more, until
    none is: words are distinct, so the whole word parts them in the end."""
    letters = VOCAB_PREFIX
    out = words.withColumn("__p", F.substring("word", 1, letters))
    while True:
        # at most (number of words) / block of them
        large = cut_lineage(out.groupBy("cnt", "__p").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > block)
                            .select("cnt", "__p", F.lit(True).alias("__large")))
        if not large.take(1):
            return out
        letters += VOCAB_PREFIX
        out = out.join(F.broadcast(large), ["cnt", "__p"], "left").select(
            "word", "cnt", F.when(F.col("__large"), F.substring("word", 1, letters)).otherwise(F.col("__p")).alias("__p"))


def word_vocab(words: DataFrame, block: int = VOCAB_BLOCK) -> DataFrame:
    """(id, word, cnt): specials first, then words by count desc, word. Ids come
    from the two-level scan over blocks of a count and a word beginning that
    hold at most ``block`` words; their totals are scanned per count. Words
    that occur once are the largest class and are spread like the others."""
    parted = _prefixes(cut_lineage(words.select("word", "cnt")), block)
    key = F.struct((-F.col("cnt")).alias("nc"), F.col("__p").alias("p"))
    # block totals are summed per count first, so no step is one task over all blocks
    ranked = running_offset(parted, [], [(-F.col("cnt")), F.col("word")], key, None, "__o",
                            coarse=lambda b: b.getField("nc"))
    return ranked.select((F.col("__o") + len(WORD_SPECIALS)).cast("int").alias("id"), "word", "cnt")


# Rows are told apart by their keys and the hash of what is looked up, and rows
# equal in both have the same result: it is made once and given as often as
# they stand. Keys may repeat, and no row needs a number of its own.

def _exploded(df: DataFrame, keys: Sequence[str], value: Column, items: Column, name: str) -> DataFrame:
    """(keys..., __h, pos, name): a row for each item."""
    return df.select(*keys, F.xxhash64(value).alias("__h"), F.posexplode(items).alias("pos", name))


def _gathered(items: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """(keys..., __s) with a row for each row that was exploded: its items in order."""
    groups = items.groupBy(*keys, "__h").agg(F.array_sort(F.collect_set(F.struct("pos", item))).alias("__s"),
                                             F.sum(F.when(F.col("pos") == 0, 1)).alias("__n"))
    return groups.select(*keys, F.transform("__s", lambda x: x[item]).alias("__s"),
                         F.explode(F.when(F.col("__n") > 1, F.sequence(F.lit(1).cast("bigint"), "__n"))
                                   .otherwise(F.array(F.lit(1).cast("bigint")))).alias("__i")).drop("__i")


def word_ids(df: DataFrame, keys: Sequence[str], text: str, vocab: DataFrame,
             pattern: str = T.WORD_PATTERN, unknown: str = "fail") -> DataFrame:
    """(keys..., ids): words of ``text`` mapped through ``vocab`` (J5). A word
    the vocabulary lacks fails, or with ``unknown="null"`` has a null id.
    Hot words are those of the texts being mapped."""
    words = F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    pos = _exploded(df, keys, F.col(text), words, "word")
    joined = skew.salted_join(pos, vocab.select("word", "id"), "word", how="left")
    got = _gathered(joined.withColumn("id", _known(F.col("id"), F.col("word"), unknown)), keys, "id") \
        .select(*keys, F.col("__s").alias("ids"))
    none = df.filter(F.coalesce(F.size(words) <= 0, F.lit(True))).select(*keys, F.array().cast("array<int>").alias("ids"))
    return got.unionByName(none)


def ids_digest(ids: Column) -> Column:
    """Short, engine-independent fingerprint of an id array."""
    return F.md5(F.array_join(ids, " "))
