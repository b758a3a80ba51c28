"""Numbers that only one writer gets: claimed by an atomic rename in the shared folder.

A writer makes a folder of its own that holds a marker, and renames it to the number's name.  Of
writers that try the same number one rename finds no such folder; the others' folders fail or end up
inside the winner's.  Who owns a number is read off the marker at its top, so a writer knows whether it
has won whatever the rename returned.  Needs a file system whose rename is atomic (HDFS and the like).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

TRIES = 1000


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing where there is none."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; fails where it cannot be."""
    p, fs = _fs(spark, path)
    if not fs.rename(p, _fs(spark, to)[0]):
        raise OSError(f"{path} could not be renamed to {to}")


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def claimed(spark: SparkSession, base: str) -> list[int]:
    """The numbers claimed under ``base``, rising."""
    return sorted(int(m.group(1)) for n in names(spark, base) if (m := re.fullmatch(r"n-(\d+)", n)))


def claim(spark: SparkSession, base: str) -> int:
    """The next number under ``base`` (from 1); no other caller gets the same one."""
    token = uuid.uuid4().hex
    folder, fs = _fs(spark, f"{base}/claim-{token}")
    number = max(claimed(spark, base), default=0)
    for _ in range(TRIES):
        number += 1
        fs.mkdirs(folder)
        fs.create(_fs(spark, f"{base}/claim-{token}/owner-{token}")[0], False).close()
        to = _fs(spark, f"{base}/n-{number}")[0]
        try:
            fs.rename(folder, to)
        except Exception as e:  # the name is taken, on file systems that refuse it aloud
            if "FileAlreadyExists" not in str(e) and "File exists" not in str(e):
                raise
        if exists(spark, f"{base}/n-{number}/owner-{token}"):
            return number
        for left in (f"{base}/n-{number}/claim-{token}", f"{base}/claim-{token}"):
            p, _ = _fs(spark, left)
            if fs.exists(p):
                fs.delete(p, True)
    raise RuntimeError(f"no free number under {base} after {TRIES} tries")
