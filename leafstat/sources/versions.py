"""K4: whole-table replaces that a reader never sees half done.

A replaced table keeps its data in version folders.  A replace writes a new
version folder and then commits it: one empty marker, named after a running
number and the folder, appears in ``_commits``.  Readers follow the marker with
the largest name.  A write that dies before its marker leaves the committed
version as it was.  The version before the current one stays for readers that
began with it; older ones are removed by the next replace.

    <table>/_versions/<id>/...            data, partition folders, schema version
    <table>/_commits/<number>.<id>        the commits; the largest one counts

Both folders have hidden names, so a reader that knows nothing of versions
sees an empty table, never a mixture.  A table without commits is a plain
Parquet folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from leafstat.sources import paths

COMMITS, VERSIONS = "_commits", "_versions"
KEPT = 2                   # the current version and the one before it


def commits(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """(number, version id) of every commit, oldest first."""
    split = (n.split(".", 1) for n in paths.names(spark, paths.under(table, COMMITS)))
    return [(int(number), version) for number, version in split]


def current(spark: SparkSession, table: str) -> str:
    """The folder that holds the table's data now."""
    done = commits(spark, table)
    return paths.under(table, VERSIONS, done[-1][1]) if done else table


def new_version(table: str) -> tuple[str, str]:
    """(id, folder) of a version that nobody reads yet."""
    version = uuid.uuid4().hex
    return version, paths.under(table, VERSIONS, version)


def commit(spark: SparkSession, table: str, version: str) -> int:
    """Make a written version the current one; returns its number."""
    done = commits(spark, table)
    number = done[-1][0] + 1 if done else 1
    paths.mark(spark, paths.under(table, COMMITS, f"{number:012d}.{version}"))
    for old, gone in done[:-(KEPT - 1)]:
        paths.delete(spark, paths.under(table, VERSIONS, gone))
        paths.delete(spark, paths.under(table, COMMITS, f"{old:012d}.{gone}"))
    return number


def uncommitted(spark: SparkSession, table: str) -> list[str]:
    """Folders of versions without a commit: dead writes, or ones that still run."""
    known = {v for _, v in commits(spark, table)}
    return [paths.under(table, VERSIONS, v) for v in paths.names(spark, paths.under(table, VERSIONS)) if v not in known]
