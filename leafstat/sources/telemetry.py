"""The source contract: what a telemetry source may provide, and what its absence means.

A source is any object with a method for each feed that it has; no feed is
required.  ``Feeds`` finds out which ones are there and gives an empty frame of
the declared columns for the others, so every query answers on every source:
a source of page events alone has no catalog, hence no unused pages, and its
report views are rolled up from its page views.

Sources that hold their feeds as data rather than as methods have
``provides(name)`` and ``feed(name)`` instead.
"""

from __future__ import annotations

import datetime as _dt
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from leafstat import schemas as sch

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampType()


def _of(**columns) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


# Feeds of facts: raw (events, visits) or already one row a day.
RAW_FEEDS = {
    "raw_page_events": sch.RAW_PAGE_EVENTS,
    "report_visits": _of(workspace_id=_S, report_id=_S, visit_id=_S, view_date=_D, user_upn=_S,
                         session_seconds=T.DoubleType(), visits=_L),
}
DAILY_FEEDS = {n: sch.SILVER[n] for n in ("page_views", "report_views", "user_views")}
# Enumerations, lookups and run logs; small beside the facts, stored next to the silver tables.
SIDE_FEEDS = {
    "workspaces": _of(type=_S, state=_S, workspace_id=_S, workspace_name=_S, capacity_name=_S),
    "reports": sch.REPORTS,
    "datasets": _of(workspace_id=_S, dataset_id=_S, dataset_name=_S, position=_I),
    "catalog": T.StructType([*sch.CATALOG_SIDECAR.fields[:7], T.StructField("catalog_pulled_at", T.TimestampNTZType()),
                             sch.CATALOG_SIDECAR.fields[7]]),
    "workspace_owners": _of(workspace_id=_S, owner_upn=_S, owner_name=_S),
    "workspace_units": _of(workspace_id=_S, business_unit=_S),
    "unit_members": _of(business_unit=_S, member_upn=_S),
    "people": _of(upn=_S, display_name=_S, department=_S),
    "collection_errors": _of(scope=_S, error=_S),
    "runs_from_events": _of(run_date=_D, reports=_L, errors=_L, ended_at=_TS),
    "runs_from_volume": _of(run_date=_D, rows=_L),
    "runs_scope": _of(run_date=_D, reports=_L, workspaces=_L),
}
FEEDS = {**RAW_FEEDS, **DAILY_FEEDS, **SIDE_FEEDS}


@runtime_checkable
class StoredFeeds(Protocol):
    """A source whose feeds are data under a name."""

    def provides(self, name: str) -> bool: ...

    def feed(self, name: str) -> DataFrame: ...


class MissingColumns(ValueError):
    pass


class Feeds:
    """The feeds of any source, whole or empty."""

    def __init__(self, spark: SparkSession, source=None):
        self.spark = spark
        self.source = source

    def has(self, name: str) -> bool:
        if name not in FEEDS:
            raise KeyError(f"no feed named {name}")
        if isinstance(self.source, StoredFeeds):
            return self.source.provides(name)
        return callable(getattr(self.source, name, None))

    def empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], FEEDS[name])

    def get(self, name: str, *args) -> DataFrame:
        """The feed, or an empty frame of its columns where the source has none.
        Columns beyond the declared ones stay; a lacking one is an error."""
        if not self.has(name):
            return self.empty(name)
        df = self.source.feed(name) if isinstance(self.source, StoredFeeds) else getattr(self.source, name)(*args)
        lacking = [c for c in FEEDS[name].fieldNames() if c not in df.columns]
        if lacking:
            raise MissingColumns(f"feed {name} lacks the columns {lacking}")
        return df

    def date(self, name: str) -> _dt.date | None:
        """A date that the source knows without a query (``as_of``, ``first_date``)."""
        know = getattr(self.source, name, None)
        return know() if callable(know) else None
