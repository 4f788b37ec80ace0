"""The silver set: the five conformed tables plus the feeds they come from.

``Lakehouse.from_star`` derives everything lazily from the supplied tables
(no data moves until a query runs); ``Lakehouse.from_path`` reads what
``Lakehouse.store`` wrote.  Every query function takes a Lakehouse, so the
same code answers on raw-derived or stored silver, and on any source: a feed
that a source lacks is empty (``sources.telemetry``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.dates import DEFAULT_DAYS, as_of_date, window_bounds
from leafstat.operators import silver as sv
from leafstat.session import scratch_dir
from leafstat.sources.telemetry import Feeds


# Bytes of the supplied compressed facts per initial reducer.  Joined and aggregated they
# are several times as large, and a task sorts or hashes its share in memory.
FACT_BYTES_PER_REDUCER = 4 << 20


class Lakehouse:
    def __init__(self, spark: SparkSession, source=None, tables: dict | None = None,
                 as_of: _dt.date | None = None):
        self.spark = spark
        self.source = source
        self.feeds = Feeds(spark, source)
        self._tables = tables or {}
        self.stored: dict[str, str] = {}        # folders written once for several steps (of a query: QueryLakehouse)
        self.gold: dict[str, str] = {}          # folder of the refreshed marts, which several queries read
        self._as_of = as_of

    @classmethod
    def from_star(cls, spark: SparkSession, sf_dir: str, as_of=None) -> "Lakehouse":
        from leafstat.session import size_reducers, size_shuffles
        from leafstat.sources.star import StarSource
        src = StarSource(spark, sf_dir)
        size_shuffles(spark, src.fact_bytes(), FACT_BYTES_PER_REDUCER)
        size_reducers(spark)
        return cls(spark, source=src, as_of=as_of)

    @classmethod
    def from_path(cls, spark: SparkSession, root: str, source=None) -> "Lakehouse":
        """Silver and side feeds as stored; a side feed that ``source`` has wins."""
        from leafstat.sources.files import load_table, path_exists
        from leafstat.sources.stored import StoredSource
        tables = {n: load_table(spark, "parquet", root, n) for n in sch.SILVER
                  if path_exists(spark, f"{root.rstrip('/')}/{n}")}
        return cls(spark, source=source or StoredSource(spark, root), tables=tables)

    def store(self, root: str) -> "Lakehouse":
        """Land the silver tables and side feeds, each once, and read them back.
        ``unused_pages`` is made from the landed catalog and facts."""
        from leafstat.sources.files import write_table
        from leafstat.sources.stored import store_side
        pulled = _dt.datetime.combine(self.as_of, _dt.time())
        store_side(self.feeds, root, catalog=(pulled,) if self.source is not None else ())
        for name in ("page_catalog", "page_views", "report_views", "user_views"):
            write_table(getattr(self, name), root, name)
        landed = Lakehouse.from_path(self.spark, root)
        write_table(landed.unused_pages, root, "unused_pages")
        return Lakehouse.from_path(self.spark, root)

    # -- anchor ----------------------------------------------------------
    @cached_property
    def as_of(self) -> _dt.date:
        if self._as_of is not None:
            return self._as_of
        if "page_views" in self._tables:
            return as_of_date(self.page_views)
        raw = self.feeds.has("raw_page_events")         # the facts need the anchor for their catalog
        return self.feeds.date("as_of") or as_of_date(self.events if raw else self.page_views)

    def window(self, days: int = DEFAULT_DAYS) -> tuple[_dt.date, _dt.date]:
        return window_bounds(self.as_of, days)

    # -- feeds -----------------------------------------------------------
    @cached_property
    def events(self) -> DataFrame:
        return self.feeds.get("raw_page_events")

    def land_events(self, storage_level=None) -> DataFrame:
        """Materialise the raw events once (the landing step) so the three
        fact builders read them instead of re-running the source joins.
        Persisted blocks lost with an executor are recomputed from lineage."""
        from pyspark import StorageLevel
        ev = self.events.persist(storage_level or StorageLevel.MEMORY_AND_DISK)
        self.__dict__["events"] = ev
        self.__dict__.pop("visits", None)
        return ev

    def on_landed_events(self, path: str) -> "Lakehouse":
        """The same feeds over raw events written once to ``path``, for building several fact
        tables in a row: each would run the source's joins again."""
        landed = Lakehouse(self.spark, source=self.source, as_of=self.as_of)
        landed.__dict__.update(catalog_full=self.catalog_full, rdim=self.rdim)
        self.events.write.parquet(path)
        landed.__dict__["events"] = self.spark.read.schema(self.events.schema).parquet(path)
        return landed

    @cached_property
    def visits(self) -> DataFrame:
        return self.feeds.get("report_visits", self.events)

    @cached_property
    def workspaces(self) -> DataFrame:
        return self.feeds.get("workspaces")

    @cached_property
    def reports(self) -> DataFrame:
        return self.feeds.get("reports")

    @cached_property
    def first_date(self) -> _dt.date:
        known = None if "page_views" in self._tables else self.feeds.date("first_date")
        return known or self.page_views.select(F.min("view_date")).first()[0] or self.as_of

    def side(self, name: str) -> DataFrame:
        """A side feed (``sources.telemetry.SIDE_FEEDS``), empty where the source lacks it."""
        return self.feeds.get(name)

    @cached_property
    def catalog_full(self) -> DataFrame:
        """Catalog with the report_total_pages sidecar column."""
        return self.feeds.get("catalog", _dt.datetime.combine(self.as_of, _dt.time()))

    @cached_property
    def rdim(self) -> DataFrame:
        """The report dimension, landed so that Spark joins it knowing its size: while it is
        small the facts are not shuffled by report, which would give each report to one task."""
        tot = self.catalog_full.groupBy(*sch.REPORT_KEY).agg(
            F.max("report_total_pages").alias("report_total_pages"))
        dim = sv.report_dim(self.workspaces, self.reports).join(tot, sch.REPORT_KEY, "left")
        path = scratch_dir(self.spark, f"rdim-{uuid.uuid4().hex[:12]}")
        dim.write.parquet(path)
        return self.spark.read.schema(dim.schema).parquet(path)

    # -- silver ----------------------------------------------------------
    def _t(self, name, build):
        if name not in self._tables:
            self._tables[name] = build()
        return self._tables[name]

    @property
    def page_catalog(self) -> DataFrame:
        return self._t("page_catalog", lambda: sv.conform(self.catalog_full, sch.PAGE_CATALOG))

    def _daily(self, name: str, raw: str, build) -> DataFrame:
        """A fact table: built from its raw feed, or the daily rows that the source has instead."""
        if self.feeds.has(raw):
            return build()
        return sv.conform(self.feeds.get(name), sch.SILVER[name])

    @property
    def page_views(self) -> DataFrame:
        return self._t("page_views", lambda: self._daily(
            "page_views", "raw_page_events", lambda: sv.page_views_daily(self.events, self.catalog_full, self.rdim)))

    @property
    def report_views(self) -> DataFrame:
        if not (self.feeds.has("report_visits") or self.feeds.has("report_views")):
            return self._t("report_views", lambda: sv.report_views_rollup(self.page_views))     # A4
        return self._t("report_views", lambda: self._daily(
            "report_views", "report_visits", lambda: sv.report_views_daily(self.visits, self.rdim)))

    @property
    def user_views(self) -> DataFrame:
        return self._t("user_views", lambda: self._daily(
            "user_views", "raw_page_events", lambda: sv.user_views_daily(self.events, self.rdim)))

    @property
    def unused_pages(self) -> DataFrame:
        lo, hi = self.window(DEFAULT_DAYS)
        return self._t("unused_pages", lambda: sv.unused_pages(self.page_catalog, self.page_views, lo, hi,
                                                               order=False))

    def silver(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in sch.SILVER}


class QueryLakehouse:
    """A Lakehouse as one query call sees it: the tables that the call stores are its own,
    everything else is the Lakehouse's.  So a query's work does not depend on what other
    queries stored before it."""

    def __init__(self, lakehouse: Lakehouse):
        self._lakehouse = lakehouse
        self.stored: dict[str, str] = {}

    def __getattr__(self, name: str):
        return getattr(self._lakehouse, name)
