"""SimHash votes and block keys with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
_LANES = 0x0000000100000001         # bit k and bit k + 32 of a hash, in one long


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. For texts of ASCII
    only the built-in ``lower`` says the same and is faster."""
    az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, az, az.lower()))


def spaced(text: Column) -> Column:
    """The words of a text (separated by white space) joined by single spaces."""
    return F.trim(F.regexp_replace(text, "[ \\t-\\r]+", " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(words: Column, n: int) -> Column:
    """All runs of ``n`` words of a single-spaced text, repeats included; a
    shorter text is one shingle, an empty one has none."""
    ahead = " ".join(["[^ ]++"] * n)
    enough = "^" + "[^ ]++ " * (n - 1) + "[^ ]"
    return let(words, lambda w: F.when(
        F.rlike(w, F.lit(enough)), F.regexp_extract_all(w, F.lit(f"(?=({ahead}))[^ ]++"), F.lit(1)))
        .when(w != "", F.array(w)).otherwise(F.array().cast("array<string>")))


def vote(terms: DataFrame, keys: Sequence[str], term: str = "term", weight: Column | None = None) -> DataFrame:
    """(keys..., fp): bit b is set if the terms whose XXH64 (seed 42) has it
    hold over half the weight, which is the sign of their summed +w / -w
    votes. A null term votes for nothing; without votes fp is 0.

    Two bits share one sum of longs: 32 sums, combined map-side."""
    w = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    w = F.when(F.col(term).isNull(), F.lit(0).cast("bigint")).otherwise(w)
    h = terms.select(*keys, F.xxhash64(term).alias("__h"), w.alias("__w"))
    lanes = [F.sum(F.shiftrightunsigned("__h", k).bitwiseAND(F.lit(_LANES)) * F.col("__w")).alias(f"__s{k}")
             for k in range(32)]
    sums = h.groupBy(*keys).agg(F.sum("__w").alias("__n"), *lanes)
    fp = F.lit(0).cast("bigint")
    for k in range(32):
        low, high = F.col(f"__s{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"__s{k}", 32)
        for bit, votes in ((k, low), (k + 32, high)):
            one = (1 << bit) - (1 << 64 if bit == 63 else 0)
            fp = fp.bitwiseOR(F.when(votes * 2 > F.col("__n"), F.lit(one).cast("bigint"))
                              .otherwise(F.lit(0).cast("bigint")))
    return sums.select(*keys, fp.alias("fp"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def masks(blocks: int, radius: int) -> list[int]:
    """The kept bits of each block table: fingerprints within ``radius`` bits
    agree on all bits of at least ``blocks - radius`` of the blocks, so they
    share a key in at least one table. Signed, as longs."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    out = [sum(kept) for kept in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def blocks_for(n: int, radius: int) -> int:
    """Blocks such that the narrowest table's keys outnumber the fingerprints
    at least about fourfold: the work per fingerprint then stays level as the
    corpus grows. Any number of blocks above ``radius`` finds the same."""
    want = max(n, 2).bit_length() + 2
    blocks = radius + 2
    while BITS * (blocks - radius) // blocks < want and blocks < 2 * radius + 8:
        blocks += 1
    return blocks
