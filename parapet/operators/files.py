"""File-name operators: globs, language suffixes, stem pairing, sampling.

They work on a column of paths (a listing from ``sources.files`` or any
table of names), so selection happens before any file content is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parapet.operators import sampling


def glob_to_regex(pattern: str) -> str:
    """Anchored Java regex for a file-name glob (``*``, ``?``, literals)."""
    out = []
    for ch in pattern:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch.isalnum() or ch == "_":
            out.append(ch)
        else:
            out.append("\\" + ch)
    return "^" + "".join(out) + "$"


def file_name(path) -> Column:
    """Last path component."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]*)$", 1)


def lang_suffix(path) -> Column:
    """Language id: the text after the last ``.`` of the name."""
    return F.regexp_extract(file_name(path), r"\.([^.]*)$", 1)


def stem(path) -> Column:
    """The path without its last ``.``-suffix."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"^(.*)\.[^./]*$", 1)


def filter_paths(df: DataFrame, path: str = "path", glob: str | None = None,
                 prefix: str | None = None, exclude_prefix: str | None = None,
                 ext: str | None = None) -> DataFrame:
    """Keep paths whose *name* matches every given condition (S3)."""
    name = file_name(path)
    cond = F.lit(True)
    if glob is not None:
        cond = cond & name.rlike(glob_to_regex(glob))
    if prefix is not None:
        cond = cond & name.startswith(prefix)
    if exclude_prefix is not None:
        cond = cond & ~name.startswith(exclude_prefix)
    if ext is not None:
        cond = cond & (lang_suffix(path) == ext)
    return df.filter(cond)


def distinct_langs(df: DataFrame, path: str = "path") -> DataFrame:
    """Distinct language suffixes, sorted (A2)."""
    return df.select(lang_suffix(path).alias("lang")).distinct().orderBy("lang")


def stem_join(df: DataFrame, left_lang: str, right_lang: str, path: str = "path") -> DataFrame:
    """Pair the ``left_lang`` and ``right_lang`` files sharing a stem (J2):
    (stem, l_path, r_path). An equi-join on the stem."""
    d = df.select(F.col(path).alias("p"), stem(path).alias("stem"), lang_suffix(path).alias("lang"))
    left = d.filter(F.col("lang") == left_lang).select("stem", F.col("p").alias("l_path"))
    right = d.filter(F.col("lang") == right_lang).select("stem", F.col("p").alias("r_path"))
    return left.join(right, "stem", "inner")


def gold_path(out_dir: str, path, lang) -> Column:
    """``<out_dir>/<name without suffix>_gold.<lang>``."""
    base = F.regexp_replace(file_name(path), r"\.[^.]*$", "")
    lang = F.lit(lang) if isinstance(lang, str) else lang
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), base, F.lit("_gold."), lang)


def sample_file_pairs(df: DataFrame, n: int, seed: int | str, out_dir: str, path: str = "path",
                      langs: tuple[str, str] | None = None) -> DataFrame:
    """Exactly ``n`` stems of the first language, paired with the second
    language's file and the two copy targets (W9, J2, S8). Fails if fewer
    than ``n`` files exist (P8). Languages default to the sorted suffixes."""
    if langs is None:
        found = [r[0] for r in distinct_langs(df, path).limit(3).collect()]
        if len(found) != 2:
            raise ValueError(f"expected two languages, found {found}")
        langs = (found[0], found[1])
    pairs = stem_join(df, langs[0], langs[1], path)
    sampling.require(pairs.limit(n).count() == n, "Sample size mismatch")
    chosen = sampling.sample_exact(pairs, n, seed, ["l_path"])
    return chosen.select("stem", "l_path", "r_path",
                         gold_path(out_dir, F.col("l_path"), langs[0]).alias("l_gold"),
                         gold_path(out_dir, F.col("l_path"), langs[1]).alias("r_gold"))
