"""Ensemble members as files, opened and verified where they are used.

A member is one file: a mark, the SHA-256 of what follows, and its arrays.
Executors open every declared file; one that is missing, cut short or
changed is no member, and says why. The number of members is the number that
loaded, never the number declared.
"""

from __future__ import annotations

import hashlib
import io
import logging
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parapet.operators.scorers import TableMember
from parapet.session import cut_lineage
from parapet.sources.named import _copy, _store

log = logging.getLogger(__name__)

MARK = b"PMEMBER1"
ARRAYS = ("prev", "next", "c")
MAX_MEMBERS = 10_000
LOADED = "model string, path string, available boolean, reason string, n_rows bigint"


def member_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    body = io.BytesIO()
    np.savez(body, **{k: np.asarray(arrays[k], np.int64) for k in ARRAYS})
    return MARK + hashlib.sha256(body.getvalue()).digest() + body.getvalue()


def read_member(path: str) -> dict[str, np.ndarray]:
    """The arrays of a member file; a ValueError names what is wrong with it."""
    store, at = _store(path)
    if not store.get_file_info(at).is_file:
        raise ValueError("no file")
    with store.open_input_stream(at, compression=None) as f:
        data = f.read()
    if data[:len(MARK)] != MARK:
        raise ValueError("not a member file")
    body = data[len(MARK) + 32:]
    if hashlib.sha256(body).digest() != data[len(MARK):len(MARK) + 32]:
        raise ValueError("damaged")
    with np.load(io.BytesIO(body)) as z:
        out = {k: z[k] for k in ARRAYS}
    if len({len(x) for x in out.values()}) != 1 or (np.diff(out["prev"]) < 0).any():
        raise ValueError("unequal or unsorted columns")
    return out


def save_members(table: DataFrame, out_dir: str, member: str = "member") -> DataFrame:
    """(model, path): one file for each member of a table (member, prev,
    next, c), written by one task and renamed when whole. A member's table
    has a configured size (its ids times the successors listed)."""
    out = out_dir.rstrip("/")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        name = str(pdf["model"].iloc[0])
        rows = pdf.sort_values(["prev", "next"])
        store, base = _store(out)
        _copy(iter([io.BytesIO(member_bytes({k: rows[k].to_numpy() for k in ARRAYS}))]), store, f"{base}/{name}.member", None)
        return pd.DataFrame({"model": [name], "path": [f"{out}/{name}.member"]})

    named = table.select(F.col(member).cast("string").alias("model"), *ARRAYS)
    return cut_lineage(named.groupBy("model").applyInPandas(write, "model string, path string"))


def check_members(files: DataFrame) -> DataFrame:
    """(model, path, available, reason, n_rows) of declared files (model, path)."""
    def run(batches):
        for pdf in batches:
            rows = []
            for model, path in zip(pdf["model"], pdf["path"]):
                try:
                    if path is None:
                        raise ValueError("no path")
                    n = len(read_member(path)["prev"])
                    rows.append((model, path, True, None, n))
                except Exception as e:          # whatever is wrong with a file, the others go on
                    rows.append((model, path, False, str(e) if isinstance(e, ValueError) else f"{type(e).__name__}: {e}", 0))
            yield pd.DataFrame(rows, columns=["model", "path", "available", "reason", "n_rows"])

    return files.select("model", "path").mapInPandas(run, LOADED)


def loaded_members(checked: DataFrame) -> list[tuple[str, str]]:
    """(model, path) of the members that loaded, by name; the others are
    logged with their reason, and none at all is an error."""
    rows = checked.limit(MAX_MEMBERS + 1).collect()
    if len(rows) > MAX_MEMBERS:
        raise ValueError("member table larger than a configuration list")
    for r in rows:
        if not r["available"]:
            log.warning("skipping ensemble member %s: %s", r["model"], r["reason"])
    ok = sorted((r["model"], r["path"]) for r in rows if r["available"])
    if not ok:
        raise RuntimeError("no ensemble member is available")
    return ok


def table_members(files: Sequence[tuple[str, str]], bos: int, weights: dict[str, tuple[float, float]]) -> list[TableMember]:
    """The members of files that loaded, on an executor; ``weights`` of
    (source, prefix) by model."""
    out = []
    for model, path in files:
        a = read_member(path)
        out.append(TableMember(a["prev"], a["next"], a["c"], bos, *weights[model]))
    return out
