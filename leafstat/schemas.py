"""Schemas, grains and the silver schema version."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed value: the silver schema version the tables are written with.
SILVER_SCHEMA_VERSION = "1.2.0"

S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()
TS = T.TimestampNTZType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


PAGE_VIEWS = _st(
    ("workspace_id", S), ("workspace_name", S), ("capacity_name", S),
    ("report_id", S), ("report_name", S), ("report_total_pages", I),
    ("page_id", S), ("page_name", S), ("page_ordinal", I),
    ("view_date", DT), ("view_count", L), ("unique_users", L),
    ("avg_dwell_seconds", D), ("top_persona", S),
)
PAGE_CATALOG = _st(
    ("workspace_id", S), ("workspace_name", S), ("report_id", S), ("report_name", S),
    ("page_id", S), ("page_name", S), ("page_ordinal", I), ("catalog_pulled_at", TS),
)
REPORT_VIEWS = _st(
    ("workspace_id", S), ("workspace_name", S), ("capacity_name", S),
    ("report_id", S), ("report_name", S), ("view_date", DT),
    ("view_count", L), ("unique_users", L), ("avg_session_seconds", D),
)
USER_VIEWS = _st(
    ("workspace_id", S), ("workspace_name", S), ("report_id", S), ("report_name", S),
    ("user_id_hash", S), ("view_date", DT), ("view_count", L), ("distinct_pages_viewed", L),
)
UNUSED_PAGES = PAGE_CATALOG

# Raw feeds a TelemetrySource provides (missing feed = empty DF of this shape).
RAW_PAGE_EVENTS = _st(
    ("workspace_id", S), ("report_id", S), ("page_id", S), ("view_date", DT),
    ("user_upn", S), ("views", L), ("dwell_seconds", D), ("persona", S), ("visit_id", S),
)
WORKSPACES = _st(("workspace_id", S), ("workspace_name", S), ("capacity_name", S))
REPORTS = _st(("workspace_id", S), ("report_id", S), ("report_name", S), ("report_type", S))
CATALOG_SIDECAR = _st(
    ("workspace_id", S), ("workspace_name", S), ("report_id", S), ("report_name", S),
    ("page_id", S), ("page_name", S), ("page_ordinal", I), ("report_total_pages", I),
)

# One row for each collection run (K5).  Lists are JSON, of at most RUN_LIST entries; counts are whole.
RUN_LIST = 100
RUNS = _st(
    ("run_id", S), ("schema_version", S), ("run_date", DT), ("started_at", TS), ("ended_at", TS), ("since", DT), ("until", DT),
    ("workspaces", L), ("reports", L), ("datasets", L),
    ("page_view_rows", L), ("page_catalog_rows", L), ("report_view_rows", L), ("user_view_rows", L),
    ("unused_pages", L), ("reports_with_unused_pages", L), ("unused_pages_sample", S), ("rows", L),
    ("reports_skipped_no_bootstrap", L), ("workspaces_not_bootstrapped", S),
    ("reports_without_catalog", S), ("n_reports_without_catalog", L),
    ("errors", S), ("n_errors", L), ("ok", T.BooleanType()), ("silver_path", S), ("bronze_path", S),
)

SILVER = {
    "page_views": PAGE_VIEWS,
    "page_catalog": PAGE_CATALOG,
    "report_views": REPORT_VIEWS,
    "user_views": USER_VIEWS,
    "unused_pages": UNUSED_PAGES,
}

# Natural keys (table grain).  Upserts match on these.
KEYS = {
    "page_views": ["workspace_id", "report_id", "page_id", "view_date"],
    "page_catalog": ["workspace_id", "report_id", "page_id"],
    "report_views": ["workspace_id", "report_id", "view_date"],
    "user_views": ["workspace_id", "report_id", "user_id_hash", "view_date"],
    "unused_pages": ["workspace_id", "report_id", "page_id"],
}
PAGE_KEY = ["workspace_id", "report_id", "page_id"]
REPORT_KEY = ["workspace_id", "report_id"]

# Fact tables are partitioned by day on disk.
PARTITION_COL = {"page_views": "view_date", "report_views": "view_date", "user_views": "view_date"}
