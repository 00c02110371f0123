"""Compressed text archives (S2): members of many ``.tar.gz`` files as lines.

Spark lists the archives (their contents stay where they are); each task
opens its archives by address and streams them: members are unpacked and
decoded line by line, so neither an archive nor a member is held whole and
their sizes have no limit. Stores that only Spark can open fall back to
``binaryFile`` contents (at most 2 GB an archive). Line ends follow the text
source: ``\\n``, ``\\r\\n`` or ``\\r``, and a final line end adds no empty
line. Bytes that are not valid in ``encoding`` fail the job, unless
``errors`` says otherwise.
"""

from __future__ import annotations

import fnmatch
import io
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

CHUNK = 10_000
SCHEMA = "archive string, member string, line_no bigint, line string"
OPENABLE = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def open_stream(address: str):
    """A byte stream of the file at an address."""
    from urllib.parse import unquote

    from pyarrow import fs
    scheme, _, rest = address.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + unquote(rest).lstrip("/"), compression=None)
    store, path = fs.FileSystem.from_uri(address.replace("s3a:", "s3:", 1))
    return store.open_input_stream(path, compression=None)


class _Member(io.RawIOBase):
    """A member of a streamed archive as a plain, forward-only raw stream."""

    def __init__(self, member):
        self.member = member

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        got = self.member.read(len(buffer))
        buffer[:len(got)] = got
        return len(got)


def member_lines(stream, member_glob: str, encoding: str, errors: str):
    """(member, [lines]) in chunks of the matching members of a tar stream."""
    with tarfile.open(fileobj=stream, mode="r|*") as tf:
        for m in tf:
            if not m.isfile() or not fnmatch.fnmatchcase(m.name.rsplit("/", 1)[-1], member_glob):
                continue
            # universal newlines: a line ends at \n, \r\n or \r
            text = io.TextIOWrapper(io.BufferedReader(_Member(tf.extractfile(m))), encoding=encoding, errors=errors, newline=None)
            part = []
            for line in text:
                part.append(line[:-1] if line.endswith("\n") else line)
                if len(part) == CHUNK:
                    yield m.name, part
                    part = []
            if part:
                yield m.name, part


def read_archives(spark: SparkSession, path: str, archive_glob: str = "*.tar.gz", member_glob: str = "*",
                  encoding: str = "utf-8", errors: str = "strict", addresses: DataFrame | None = None) -> DataFrame:
    """Lines of every archive member whose base name matches ``member_glob``.
    ``addresses`` (path) names the archives instead of a listing of ``path``."""
    files = addresses if addresses is not None else (spark.read.format("binaryFile").option("pathGlobFilter", archive_glob)
                  .option("recursiveFileLookup", "true").load(path))
    first = files.select("path").head()
    by_address = addresses is not None or first is not None and first["path"].partition(":")[0] in OPENABLE
    if by_address:
        listed = files.select("path")
        files = listed.repartition(max(1, listed.count()))      # an archive a task

    def run(batches):
        for pdf in batches:
            for i, archive in enumerate(pdf["path"]):
                stream = open_stream(archive) if by_address else io.BytesIO(pdf["content"][i])
                with stream:
                    last, at = None, 0
                    for member, lines in member_lines(stream, member_glob, encoding, errors):
                        at = at if member == last else 0
                        yield pd.DataFrame({"archive": archive, "member": member,
                                            "line_no": range(at, at + len(lines)), "line": lines})
                        last, at = member, at + len(lines)

    return files.select("path", *([] if by_address else ["content"])).mapInPandas(run, SCHEMA)
