"""Small file-system steps on any Hadoop file system: names, markers, moves.

Only metadata and files of a few lines pass through the driver here; tables
are read and written by Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def under(root: str, *names: str) -> str:
    return "/".join([root.rstrip("/"), *names])


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; a missing folder has none."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all files under a folder whose names do not start with ``_`` or ``.``."""
    fs, p = _at(spark, folder)
    found, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        at = walk.next().getPath()
        if not at.getName().startswith(("_", ".")):
            found.append(at.toString())
    return sorted(found)


def state(spark: SparkSession, folder: str) -> int:
    """A number that changes with the names, sizes and times of the entries of a folder."""
    fs, p = _at(spark, folder)
    return hash(tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that is free."""
    fs, p = _at(spark, source)
    _, to = _at(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def mark(spark: SparkSession, path: str) -> None:
    """An empty file; its name is the message, so it is there whole or not at all."""
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    fs.create(p, False).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written beside its place, then renamed."""
    beside = f"{path}.part"
    fs, p = _at(spark, beside)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, beside, path)


def read_text(spark: SparkSession, path: str, most: int = 1 << 20) -> str:
    """The first ``most`` bytes of a file."""
    fs, p = _at(spark, path)
    opened = fs.open(p)
    try:
        length = min(most, fs.getFileStatus(p).getLen())
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(
            spark.sparkContext._jvm.org.apache.commons.io.input.BoundedInputStream(opened, length))).decode("utf-8", "replace")
    finally:
        opened.close()
