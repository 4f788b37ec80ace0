"""A stored lakehouse as a source: side feeds kept beside the silver tables.

    <root>/<silver table>/...       the five conformed tables
    <root>/side/<feed>/...          enumerations, lookups and run logs

Both are versioned (``versions``).  Raw events are not stored: questions that
need them answer from the source they came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafstat import schemas as sch
from leafstat.sources import files, paths, versions
from leafstat.sources.telemetry import SIDE_FEEDS, Feeds

SIDE = "side"


class StoredSource:
    """The side feeds of a stored lakehouse, and its daily facts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _path(self, name: str) -> str:
        return paths.under(self.root, name) if name in sch.SILVER else paths.under(self.root, SIDE, name)

    def provides(self, name: str) -> bool:
        return (name in SIDE_FEEDS or name in sch.SILVER) and paths.exists(self.spark, self._path(name))

    def feed(self, name: str) -> DataFrame:
        if name in sch.SILVER:
            return files.read_table(self.spark, self.root, name)
        return self.spark.read.parquet(versions.current(self.spark, self._path(name)))


def store_side(feeds: Feeds, root: str, names=tuple(SIDE_FEEDS), **args) -> list[str]:
    """Store the side feeds that a source has; returns their names.  ``args`` holds
    arguments of a feed's method by its name."""
    stored = []
    for name in names:
        if feeds.has(name):
            table = paths.under(root, SIDE, name)
            version, folder = versions.new_version(table)
            feeds.get(name, *args.get(name, ())).write.parquet(folder)
            versions.commit(feeds.spark, table, version)
            stored.append(name)
    return stored
