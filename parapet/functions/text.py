"""Column functions: directions, lists, text cleanup, pre-tokens, features.

All are built from ``pyspark.sql.functions`` so they stay in whole-stage
codegen and run unchanged on batch or streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for equal results) -----------
BOS, EOS, PAD = "<s>", "</s>", "<pad>"
IGNORE_INDEX = -100
MAX_LENGTH = 512
DIRECTION_SEP = "__"
# GPT-2 byte-level pre-tokenisation pattern (public), with Unicode classes; the
# contractions are tried once a place, behind their apostrophe.
GPT2_PATTERN = r"""(?U)'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Look-ahead-free word pattern (letters, digits, other runs).
WORD_PATTERN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_direction(direction) -> Column:
    """``'en__it'`` -> struct(src='en', tgt='it')."""
    parts = F.split(_c(direction), DIRECTION_SEP)
    return F.struct(parts.getItem(0).alias("src"), parts.getItem(1).alias("tgt"))


def parse_list(text) -> Column:
    """``'a,b;c'`` -> ['a','b','c']: either delimiter, blanks dropped."""
    return F.filter(F.transform(F.split(_c(text), "[,;]"), lambda x: F.trim(x)), lambda x: x != "")


def artifact_name(src, tgts) -> Column:
    """``tokenizer-<src>__<t1>_<t2>...``."""
    return F.concat(F.lit("tokenizer-"), _c(src), F.lit(DIRECTION_SEP), F.array_join(_c(tgts), "_"))


def strip_text(x) -> Column:
    """Remove leading and trailing (Unicode) white space (P5)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+\z", "")


def as_reference(x) -> Column:
    """Wrap a stripped label as a one-element reference list (P5)."""
    return F.array(strip_text(x))


def pretokenize(text, pattern: str = GPT2_PATTERN) -> Column:
    """Byte-level pre-tokens of ``text`` in order (F1)."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), 0)


def special_tokens(tgts) -> Column:
    """One ``<lang>`` per target when there are several, then <s> </s> <pad>."""
    tgts = _c(tgts)
    langs = F.when(F.size(tgts) > 1, F.transform(tgts, lambda t: F.concat(F.lit("<"), t, F.lit(">")))) \
             .otherwise(F.array().cast("array<string>"))
    return F.concat(langs, F.array(F.lit(BOS), F.lit(EOS), F.lit(PAD)))


def truncate(ids, max_length: int = MAX_LENGTH, reserved: int = 2) -> Column:
    """Keep the first ``max_length - reserved`` ids; specials count toward the limit."""
    return F.slice(_c(ids), 1, max_length - reserved)


def wrap(ids, bos_id, eos_id) -> Column:
    """``<s> ids </s>``."""
    return F.concat(F.array(_lit(bos_id)), _c(ids), F.array(_lit(eos_id)))


def pad_to(ids, length, pad_id) -> Column:
    """Right-pad ``ids`` with ``pad_id`` up to ``length``."""
    n = F.greatest(_lit(length) - F.size(_c(ids)), F.lit(0))
    return F.concat(_c(ids), F.array_repeat(_lit(pad_id), n))


def attention_mask(ids, length) -> Column:
    """1 for real ids, 0 for padding up to ``length``."""
    n = F.size(_c(ids))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.greatest(_lit(length) - n, F.lit(0))))


def replace_sentinel(labels, pad_id, sentinel: int = IGNORE_INDEX) -> Column:
    """Ignored label positions back to the pad id before decoding."""
    return F.transform(_c(labels), lambda x: F.when(x == sentinel, _lit(pad_id)).otherwise(x))


def to_translation(sl="sl", tl="tl") -> Column:
    """Pack a pair as ``translation: struct<sl, tl>``."""
    return F.struct(_c(sl).alias("sl"), _c(tl).alias("tl"))


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)
