"""File system calls on the cluster's file system (through Hadoop's FileSystem).

Only metadata operations live here: existence checks, listing partition
folders, small manifests, and removing folders no manifest names. Data always
moves through Spark reads and writes.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def modified(spark: SparkSession, path: str) -> float:
    """When ``path`` was last written to, in seconds since 1970."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def list_partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=value`` folders directly under ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            out.append(name[len(prefix):])
    return sorted(out)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (none if it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def list_data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path`` that Spark reads (not hidden, not markers)."""
    fs, p = _fs(spark, path)
    names = [(st.getPath().getName(), st.isFile()) for st in fs.listStatus(p)]
    return sorted(n for n, is_file in names if is_file and not n.startswith(("_", ".")))


def list_file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, time of change in milliseconds) of the files that ``list_data_files`` names."""
    fs, p = _fs(spark, path)
    states = [(st.getPath().getName(), st.isFile(), st.getLen(), st.getModificationTime()) for st in fs.listStatus(p)]
    return sorted((n, length, changed) for n, is_file, length, changed in states if is_file and not n.startswith(("_", ".")))


def leaf_folders(spark: SparkSession, root: str, columns) -> list[tuple[str, ...]]:
    """Value tuples of the partition folders ``root/<c1>=…/<c2>=…`` (a listing; no data is read)."""
    columns = list(columns)
    found: list[tuple[str, ...]] = [()]
    for depth, column in enumerate(columns):
        found = [
            (*v, x)
            for v in found
            for x in list_partition_values(spark, "/".join([root.rstrip("/"), *(f"{c}={y}" for c, y in zip(columns[:depth], v, strict=True))]), column)
        ]
    return found


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` in one step; False if it is there already.

    The text is written aside and renamed without replacing, which of several
    writers one can do (HDFS and other file systems with an atomic rename).
    """
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    _, aside = _fs(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(text.encode())
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    try:
        files.rename(fs.makeQualified(aside), fs.makeQualified(p), how)
        return True
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
