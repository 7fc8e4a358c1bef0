"""Numbered commit entries that are put once.

``<table_root>/_current/n=<k>/entry`` holds the path of a table's k-th copy. An
entry is written aside in full and then takes its number only if no other entry
has it: by a hard link on a local file system, elsewhere by a rename that does
not overwrite (atomic on HDFS and on object stores with atomic rename). Of two
writers that want the same number one gets it; the other learns so, and takes
the next number or gives up. Spark ignores the folder of unfinished entries.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTER = "_current"
RETRIES = 50


class ConcurrentWrite(RuntimeError):
    """Another writer has published a copy in the meantime."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return fs.makeQualified(p), fs


def delete(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def put_if_absent(spark: SparkSession, path: str, text: str, aside: str) -> bool:
    """Make the file ``path`` with this text, whole, unless it exists; ``aside`` is a folder for the unfinished file."""
    jvm = spark.sparkContext._jvm
    target, fs = file_system(spark, path)
    temp, _ = file_system(spark, f"{aside}/{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        fs.mkdirs(target.getParent())
        if fs.getUri().getScheme() == "file":
            file = jvm.java.io.File
            jvm.java.nio.file.Files.createLink(file(target.toUri().getPath()).toPath(), file(temp.toUri().getPath()).toPath())
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), fs.getConf()).rename(temp, target, none)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(temp, False)


def entries(spark: SparkSession, table_root: str) -> list[tuple[int, str]]:
    """(number, path) of every recorded copy, oldest first (one line per kept version)."""
    top = f"{table_root.rstrip('/')}/{POINTER}"
    p, fs = file_system(spark, top)
    if not fs.exists(p):
        return []
    rows = spark.read.schema("value string, n long").text(top).collect()
    return sorted((r["n"], r["value"]) for r in rows)


def record(spark: SparkSession, table_root: str, path: str, after: int | None = None) -> int:
    """Record ``path`` as the table's next copy; its number.

    A number that another writer has taken is given up for the next one, so both
    copies stay in the history in the order of their numbers. With ``after``, the
    copy was made from that number's: if it is no longer the newest, this fails.
    """
    for _ in range(RETRIES):
        known = entries(spark, table_root)
        newest = known[-1][0] if known else 0
        if after is not None and newest != after:
            raise ConcurrentWrite(f"{table_root}: copy {newest} was published after copy {after} was read")
        top = f"{table_root.rstrip('/')}/{POINTER}"
        if put_if_absent(spark, f"{top}/n={newest + 1}/entry", path + "\n", f"{top}/_unfinished"):
            return newest + 1
    raise ConcurrentWrite(f"{table_root}: {RETRIES} numbers were taken by other writers")
