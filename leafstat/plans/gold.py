"""Gold marts and the dashboard payload."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat import schemas as sch
from leafstat.functions.prefix import running_total
from leafstat.functions.scalars import safe_div
from leafstat.operators import pages as pg
from leafstat.operators import reports as rp
from leafstat.operators.common import page_totals, with_latest
from leafstat.operators.silver import dedup_catalog

LONG_REPORT_PAGES = 30  # "long" report cut-off


def kpi_page_usage_daily(pv: DataFrame) -> DataFrame:
    """M1: page-day pre-aggregate for tile loads (written partitioned by day)."""
    return pv.groupBy(*sch.PAGE_KEY, "view_date").agg(
        F.sum("view_count").alias("views"), F.sum("unique_users").alias("user_days"),
        F.coalesce(safe_div(F.sum(F.col("view_count") * F.col("avg_dwell_seconds")), F.sum("view_count")),
                   F.lit(0.0)).alias("avg_dwell_weighted"))


def kpi_underused_pages(pv: DataFrame, threshold: int = 100) -> DataFrame:
    """M2: every viewed page below the threshold (A13 without the display cap)."""
    t = with_latest(pv, sch.PAGE_KEY, ["workspace_name", "report_name", "page_name"], views=("sum", "view_count"))
    return t.filter((F.col("views") > 0) & (F.col("views") < threshold))


def kpi_long_report_engagement(pv: DataFrame, catalog: DataFrame, min_pages: int = LONG_REPORT_PAGES,
                               share: float = 0.80) -> DataFrame:
    """M3: for reports with >= 30 pages: coverage, first-page share of views and
    the first ordinal at which cumulative views reach 80 %."""
    cat = dedup_catalog(catalog.select(*sch.PAGE_CATALOG.fieldNames()))
    defined = cat.groupBy(*sch.REPORT_KEY).agg(F.count(F.lit(1)).alias("pages_defined"))
    longr = defined.filter(F.col("pages_defined") >= min_pages)
    per_ord = pv.groupBy(*sch.REPORT_KEY, "page_ordinal").agg(F.sum("view_count").alias("views"))
    cum = running_total(per_ord, sch.REPORT_KEY, ["page_ordinal"], "views", out="cum", group_total="total")
    per_rep = cum.groupBy(*sch.REPORT_KEY).agg(
        F.count(F.lit(1)).alias("_ords"),
        F.sum(F.when(F.col("page_ordinal") == 1, F.col("views"))).alias("_first"),
        F.max("total").alias("views"),
        F.min(F.when(F.col("cum") / F.col("total").cast("double") >= share, F.col("page_ordinal")))
        .alias("ordinal_reaching_80pct"))
    viewed = pv.groupBy(*sch.REPORT_KEY).agg(F.count_distinct("page_id").alias("pages_viewed"))
    j = longr.join(viewed, sch.REPORT_KEY, "left").join(per_rep, sch.REPORT_KEY, "left")
    return j.select(*sch.REPORT_KEY, "pages_defined",
                    F.coalesce("pages_viewed", F.lit(0)).cast("bigint").alias("pages_viewed"),
                    safe_div(F.coalesce("pages_viewed", F.lit(0)), "pages_defined").alias("coverage"),
                    F.coalesce("views", F.lit(0)).cast("bigint").alias("views"),
                    safe_div("_first", "views").alias("first_page_share"),
                    F.col("ordinal_reaching_80pct").cast("int").alias("ordinal_reaching_80pct"))


def dim_workspace(pv: DataFrame) -> DataFrame:
    """M4: latest name per workspace id."""
    return with_latest(pv, ["workspace_id"], ["workspace_name", "capacity_name"])


def dim_report(pv: DataFrame) -> DataFrame:
    return with_latest(pv, sch.REPORT_KEY, ["report_name", "report_total_pages"])


def dim_page(pv: DataFrame, catalog: DataFrame) -> DataFrame:
    """M4: latest name and ordinal of every page that was viewed, and those of the
    catalog for pages that nobody viewed yet."""
    seen = with_latest(pv, sch.PAGE_KEY, ["page_name", "page_ordinal"])
    never = dedup_catalog(catalog.select(*sch.PAGE_CATALOG.fieldNames())).join(
        seen.select(*sch.PAGE_KEY), sch.PAGE_KEY, "left_anti")
    return seen.unionByName(never.select(*seen.columns))


def dim_date(pv: DataFrame) -> DataFrame:
    """Dense calendar between the first and last view date (bounded by the calendar)."""
    b = pv.agg(F.min("view_date").alias("lo"), F.max("view_date").alias("hi"))
    d = b.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return d.select("date", F.year("date").alias("year"), F.month("date").alias("month"),
                    F.dayofmonth("date").alias("day"), (F.weekday("date") + 1).alias("iso_day_of_week"))


def fact_page_views(pv: DataFrame) -> DataFrame:
    """M5: conformed fact: dimension keys + measures."""
    return pv.select(*sch.PAGE_KEY, F.col("view_date").alias("date"), "view_count", "unique_users",
                     "avg_dwell_seconds")


def dashboard_payload(pv: DataFrame, catalog: DataFrame, as_of: _dt.date | None = None) -> DataFrame:
    """K7: the dashboard data as tagged JSON lines (section, json).

    The reference nests every page of every report in one document; here
    each section row (meta, workspace, report, page, persona, day, top page,
    under-used page, unused page, histogram bucket) is its own line, so no
    report's page list is ever gathered into a single row or task.
    """
    opts = {"ignoreNullFields": "false"}
    # Page totals feed seven sections, the J2 zero-view pages four.  Column
    # pruning makes every use a different plan (no exchange reuse), so they
    # are computed once - one row per page - and cut off with a reliable
    # checkpoint in the shared spark.checkpoint.dir.
    from leafstat.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(pv.sparkSession)
    totals = page_totals(pv).checkpoint(eager=True)
    missing = pg.missing_page_ordinals(pv, catalog, totals).checkpoint(eager=True)
    meta = rp.dashboard_meta(pv, catalog, totals=totals, missing=missing)
    parts = [
        ("meta", meta.select(F.to_json(F.struct(*meta.columns), opts).alias("json"))),
        ("workspace", pg.workspace_summary(pv, totals)),
        ("report", pg.report_summary(pv, totals)),
        ("page", pg.page_detail(pv, catalog, totals=totals, missing=missing)),
        ("persona", pg.persona_breakdown(pv)),
        ("day", rp.daily_trend(pv)),
        ("top_page", pg.top_pages(pv, totals=totals)),
        ("underused_page", pg.underused_dashboard(pv, totals=totals)),
        ("unused_page", missing.select("workspace_name", "report_name", "page_name", "page_ordinal")),
        ("bucket", pg.views_distribution(pv, catalog, totals=totals, missing=missing)),
    ]
    out = None
    for name, df in parts:
        j = df if name == "meta" else df.select(F.to_json(F.struct(*df.columns), opts).alias("json"))
        j = j.select(F.lit(name).alias("section"), "json")
        out = j if out is None else out.unionByName(j)
    return out
