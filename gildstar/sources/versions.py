"""Numbered versions of stored state: compare-and-create commits.

A table's folder holds ``_versions/<number>.json``; the highest number is
current.  A commit creates the next number and fails if another writer has
created it, so two writers cannot both build on one version, and a reader that
holds a version is not disturbed.  Nothing is overwritten: a driver lost at any
moment leaves the last committed version current.

Creation is atomic on local disks (hard link) and on HDFS-like stores (rename
that fails if the name is taken).  Object stores need a connector whose rename
refuses to overwrite.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession

from gildstar.session import file_system

FOLDER = "_versions"


class CommitConflict(RuntimeError):
    """Another writer has committed the version this one wanted to create."""


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}"


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file as a whole; False if the name is taken."""
    fs, p = file_system(spark, path)
    fs.mkdirs(p.getParent())
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    if fs.getScheme() == "file":
        local, target = (file_system(spark, x)[1].toUri().getPath() for x in (draft, path))
        with open(local, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(local, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
    jvm, source = spark._jvm, file_system(spark, draft)[1]
    stream = fs.create(source, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
            source, p, flags
        )
        return True
    except Exception as e:
        if fs.exists(p) and (isinstance(e, CapturedException) or "FileAlreadyExists" in str(e)):
            fs.delete(source, False)
            return False
        raise


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions still kept, oldest first."""
    fs, p = file_system(spark, _folder(root))
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def state_of(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{_folder(root)}/{number:012d}.json"))


def current(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """The newest version's number and state; (0, None) if there is none."""
    known = numbers(spark, root)
    return (known[-1], state_of(spark, root, known[-1])) if known else (0, None)


def commit(spark: SparkSession, root: str, expected: int, state: dict) -> int:
    """Make ``state`` the version after ``expected`` and return its number."""
    if not create_text(spark, f"{_folder(root)}/{expected + 1:012d}.json", json.dumps(state)):
        raise CommitConflict(f"version {expected + 1} of {root} exists")
    return expected + 1


def forget(spark: SparkSession, root: str, keep: int) -> tuple[list[dict], list[dict]]:
    """Remove all but the newest ``keep`` versions; states removed and states kept.

    The caller deletes what only the removed states refer to, after this call.
    """
    known = numbers(spark, root)
    old, kept = known[: max(0, len(known) - keep)], known[max(0, len(known) - keep) :]
    gone = [state_of(spark, root, n) for n in old]
    for n in old:
        delete(spark, f"{_folder(root)}/{n:012d}.json")
    return gone, [state_of(spark, root, n) for n in kept]
